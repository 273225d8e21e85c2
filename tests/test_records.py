"""CSV records with line breaks in quoted fields, from files cut anywhere."""

import csv
import io
import random

import pytest

from reelframe.sources import read_records
from reelframe.sources.csv_records import quoted_lines, split_states

FIELDS = ["", "x", "a b", '"q, r"', '"l\nm"', '"a ""b"" c\n\n\nd"', '"\n"', '"w\r\nz"', "é", '"é\né"', '""']


@pytest.fixture
def cut_at(spark):
    """Sets the size of splits; restored afterwards."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_size
    for name, value in before.items():
        spark.conf.set(name, value)


def write_files(folder, seed, end, files=2, records=14):
    rng = random.Random(seed)
    written = []
    for f in range(files):
        own = [",".join([str(i), *[rng.choice(FIELDS) for _ in range(3)]]) for i in range(records)]
        (folder / f"f{f}.csv").write_bytes((end.join(own) + end).encode("latin-1"))
        written += own
    return written


@pytest.mark.parametrize("size,end", [(7, "\n"), (16, "\r\n"), (61, "\n"), (10**6, "\r\n")])
def test_records_are_those_of_a_csv_reader(spark, tmp_path, cut_at, size, end):
    written = write_files(tmp_path, size, end)
    cut_at(size)
    got = [r.value for r in read_records(spark, str(tmp_path), "ISO-8859-1").collect()]
    assert sorted(got) == sorted(written)
    wanted = []
    for path in sorted(tmp_path.glob("*.csv")):
        wanted += list(csv.reader(io.StringIO(path.read_bytes().decode("latin-1"), newline="")))
    assert sorted(next(csv.reader(io.StringIO(value, newline=""))) for value in got) == sorted(wanted)


def test_a_record_over_many_splits(spark, tmp_path, cut_at):
    long = '1,"' + "line\n" * 60 + '",x'
    (tmp_path / "f.csv").write_text("\n".join(["0,a", long, '2,"b\nc"', "3,d"]), encoding="utf-8", newline="")
    cut_at(11)
    states = split_states(quoted_lines(spark, str(tmp_path))).orderBy("start").collect()
    assert sum(row.inside and not row.opens for row in states) > 10
    got = read_records(spark, str(tmp_path), place="place").orderBy("place").collect()
    assert [r.value for r in got] == ["0,a", long, '2,"b\nc"', "3,d"]


def test_empty_lines_and_a_record_without_an_end(spark, tmp_path, cut_at):
    (tmp_path / "a.csv").write_text('x\n\n"y\n\nz\n', encoding="utf-8", newline="")
    (tmp_path / "b.csv").write_text("", encoding="utf-8")
    cut_at(3)
    got = sorted(r.value for r in read_records(spark, str(tmp_path)).collect())
    assert got == ["", '"y\n\nz', "x"]


def test_lines_are_not_shuffled(spark, tmp_path):
    """Only pieces at the ends of splits pass an exchange; whole records come straight from the scan."""
    from plans import physical_plan

    write_files(tmp_path, 1, "\n")
    plan = physical_plan(read_records(spark, str(tmp_path)))
    whole, mended = plan.split("Union")[1].split("MapInArrow")[0], plan
    assert "hashpartitioning" not in whole
    assert "hashpartitioning(file" in mended
