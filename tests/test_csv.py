import pytest
from plans import physical_plan

from reelframe.functions import unquote_field
from reelframe.sinks import write_csv
from reelframe.sources import fields_to_wide, read_lines, scan_csv, scrub_lines, short_lines


def lines_of(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_latin_1_is_decoded_from_bytes(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("k,café\x01,ü\n".encode("latin-1"))
    assert read_lines(spark, str(path), "ISO-8859-1").first().value == "k,café\x01,ü"


def test_scrub_keeps_full_rows_with_a_blank_after(spark):
    lines = lines_of(
        spark,
        "k0,a,b,c,,",
        'k1,"x, ""q""",y,z,,',
        "k2,a,b,,,",
        "k3,a,b",
        "k4,a,b,c,over,flow",
        "k5,a,b,c",
        'k6,a,b,"",,',
        'k7,a,b,c,"",',
    )
    got = scrub_lines(lines, ["key", "p", "q", "r"]).collect()
    assert [tuple(row) for row in got] == [
        ("k0", "a", "b", "c"),
        ("k1", 'x, "q"', "y", "z"),
        ("k7", "a", "b", "c"),
    ]


def test_short_line_fails_the_job_or_is_reported(spark):
    lines = lines_of(spark, "a,b,c", "a,b")
    with pytest.raises(Exception, match="too few fields: a,b"):
        fields_to_wide(lines, ["x", "y", "z"]).collect()
    assert len(fields_to_wide(lines, ["x", "y", "z"], strict=False).collect()) == 1
    assert [row.value for row in short_lines(lines, 3).collect()] == ["a,b"]


def test_extra_fields_are_ignored(spark):
    row = fields_to_wide(lines_of(spark, "a,b,c,d"), ["x", "y"]).first()
    assert tuple(row) == ("a", "b")


def test_lines_are_split_once(spark):
    lines = lines_of(spark, "a,b,c,")
    for frame in (scrub_lines(lines, ["x", "y", "z"]), fields_to_wide(lines, ["x"], strict=False)):
        plan = physical_plan(frame)
        assert plan.count("array_join(") == 2  # the two branches of one split
        assert "Generate explode" in plan


def test_written_csv_reads_back(spark, tmp_path):
    rows = [("1", "a, b", ""), ("2", 'say "x"', " padded "), ("3", "plain", "z")]
    frame = spark.createDataFrame(rows, "id string, text string, note string").repartition(3)
    path = str(tmp_path / "out")
    write_csv(frame, path)
    back = scan_csv(spark, path, ["id", "text", "note"], header="id,text,note")
    got = back.select(*[unquote_field(c) for c in back.columns]).collect()
    assert sorted(tuple(row) for row in got) == rows
