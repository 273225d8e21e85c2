"""The jobs as they are submitted."""

import pytest
from test_jobs import raw_line

from reelframe.__main__ import arguments, run
from reelframe.session import scratch_table


def test_jobs_in_a_row(spark, tmp_path, capsys):
    lines = [raw_line(i, vote_average="0" if i % 10 == 0 else "7") for i in range(1, 130)]
    (tmp_path / "raw.csv").write_bytes("\n".join(lines).encode("latin-1"))
    films, top, times, scores = (scratch_table(spark, name) for name in ("films", "top", "times", "scores"))

    def job(*argv):
        run(spark, arguments(["--buckets", "4", *argv]))

    job("scrub", str(tmp_path / "raw.csv"), str(tmp_path / "clean"))
    job("load", str(tmp_path / "clean"), films)
    assert "129 loaded, 0 rejected" in capsys.readouterr().out
    job("popularity", films, top)
    job("runtimes", films, times)
    job("scores", films, scores, "--leak")
    assert spark.table(films).count() == spark.table(scores).count() == 129
    assert spark.table(top).count() == 10
    assert spark.table(times).count() == 0
    job("show", top, "--rows", "3")
    assert "Film 129" in capsys.readouterr().out


def test_unknown_jobs_are_refused(capsys):
    with pytest.raises(SystemExit):
        arguments(["drop", "films"])
    assert "invalid choice" in capsys.readouterr().err
