import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelframe.functions import (
    float_to_long,
    json_names,
    json_text,
    nonzero,
    round_1,
    split_quoted,
    title_head,
    to_float,
    to_int,
    unquote_field,
)

# The definition: a comma followed by an even number of quotes, up to the end of the line.
FIELD_SEPARATOR = r',(?=([^"]*"[^"]*")*[^"]*$)'


def values(spark, data, type_, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {type_}")
    return [row[0] for row in frame.orderBy("i").select(expression("v")).collect()]


def test_split_keeps_quotes_and_blanks(spark):
    got = values(spark, ['k,1,"a, ""b"" c",,z,', "a,b", ""], "string", split_quoted)
    assert got == [["k", "1", '"a, ""b"" c"', "", "z", ""], ["a", "b"], [""]]


lines = st.lists(st.text(alphabet='ab",\n é', max_size=24), min_size=1, max_size=60)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines)
def test_split_equals_the_regex(spark, data):
    frame = spark.createDataFrame([(v,) for v in data], "v string")
    wrong = frame.filter(~F.equal_null(split_quoted("v"), F.split("v", FIELD_SEPARATOR, -1)))
    assert wrong.collect() == []


def test_split_of_null_is_null(spark):
    assert values(spark, [None], "string", split_quoted) == [None]


def test_unquote(spark):
    data = ['"a, ""b"""', "plain", '"', '""', "", None, 'a"b']
    assert values(spark, data, "string", unquote_field) == ['a, "b"', "plain", '"', "", "", None, 'a"b']


RUNTIMES = ["90", "90.0", "0", "0.5", "", "runtime", None]


def test_to_float(spark):
    assert values(spark, RUNTIMES, "string", to_float) == [90.0, 90.0, 0.0, 0.5, None, None, None]


def test_nonzero_keeps_numbers_other_than_zero(spark):
    kept = values(spark, RUNTIMES, "string", nonzero)
    assert [v for v, k in zip(RUNTIMES, kept, strict=True) if k] == ["90", "90.0", "0.5"]


def test_to_int_cuts_decimals(spark):
    data = ["12", "12.7", "-3.9", "7.", "x", "", None, "99999999999", "1e3"]
    assert values(spark, data, "string", to_int) == [12, 12, -3, 7, None, None, None, None, None]


def test_float_to_long_truncates_and_saturates(spark):
    data = [875.58, -1.9, math.nan, 1e30, -1e30, None]
    assert values(spark, data, "float", float_to_long) == [875, -1, 0, 2**63 - 1, -(2**63), None]


def test_title_head(spark):
    assert values(spark, ["A: b: c", ":x", "plain", "", None], "string", title_head) == [
        "A", "", "plain", "", None,
    ]


def test_round_half_up(spark):
    assert values(spark, [6.25, 6.24, -6.25], "double", round_1) == [6.3, 6.2, -6.3]


@pytest.mark.parametrize(
    "text, names",
    [
        ('[{"id": 28, "name": "Action"}, {"id": 12, "name": "Adventure"}]', ["Action", "Adventure"]),
        ('[{"id": 1}, {"name": "b"}]', ["b"]),
        ("[]", []),
        ("broken", None),
        (None, None),
    ],
)
def test_json_names(spark, text, names):
    assert values(spark, [text], "string", json_names) == [names]


def test_json_text(spark):
    frame = spark.createDataFrame([(1, "a")], "id int, name string")
    assert frame.select(json_text("id", "name")).first()[0] == '{"id":1,"name":"a"}'
