import datetime
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from funnelwright.functions import (
    collapse_whitespace,
    deterministic_uuid,
    parse_boolean,
    parse_date,
    parse_integer,
    parse_string,
    parse_timestamp,
    percentage,
    snake_case,
    uuid5,
)


def values(spark, texts, expression, kind="string"):
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], f"i int, v {kind}")
    return [row.out for row in frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_collapse_whitespace(spark):
    texts = ["  a \t b ", "   ", "a\n\r\fb", "a  b", "a b", None, ""]
    assert values(spark, texts, collapse_whitespace) == ["a b", "", "a b", "a  b", "a b", None, ""]


def test_collapse_whitespace_renders_other_types(spark):
    assert values(spark, [True, None], collapse_whitespace, "boolean") == ["true", None]


@pytest.mark.parametrize(
    "name, expected",
    [("Appt Date", "appt_date"), ("CityName", "cityname"), ("STATE", "state"), (" a--b ", "a_b"), ("x.", "x_")],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_dates(spark):
    day = datetime.date
    texts = ["03/24/2023", "3/4/2023", "x", "", None, "13/01/2023"]
    expected = [day(2023, 3, 24), day(2023, 3, 4), None, None, None, None]
    assert values(spark, texts, lambda c: parse_date(c, "M/d/yyyy")) == expected
    assert values(spark, ["2023-03-24", "x"], parse_date) == [day(2023, 3, 24), None]


def test_verbatim_date_pattern_loses_the_month(spark):
    day = datetime.date
    texts = ["03/24/2023", "12/31/2023", "3/4/2023"]
    expected = [day(2023, 1, 24), day(2023, 1, 31), None]
    assert values(spark, texts, lambda c: parse_date(c, "mm/dd/yyy")) == expected


def test_timestamps(spark):
    good = ["03/24/2023 2:00PM", "03/24/2023 2:00pm", "3/24/2023 02:00PM"]
    bad = ["03/24/2023 2:00 PM", "03/24/2023", "13/45/2023 2:00PM", "03/24/2023 14:00PM", "03/24/2023 2:00PMjunk", None]
    found = values(spark, [*good, "03/24/2023 12:30AM", *bad], lambda c: parse_timestamp(c, "M/d/yyyy h:mma"))
    afternoon = datetime.datetime(2023, 3, 24, 14)
    assert found == [afternoon] * 3 + [datetime.datetime(2023, 3, 24, 0, 30)] + [None] * len(bad)
    assert values(spark, ["2023-03-24 01:02:03", "x"], parse_timestamp) == [datetime.datetime(2023, 3, 24, 1, 2, 3), None]


INTEGERS = {
    "01234": 1234, " 12 ": 12, "+5": 5, "-7": -7, "1.5": 1, "1.": 1, "-1.9": -1, ".5": 0, "-.5": 0, ".": 0, "+.": 0,
    "12345-6789": None, "1e3": None, "": None, "2147483648": None, "-2147483648": -2147483648, "1.x": None,
    "2147483648.5": None, "2147483647.9": 2147483647, "-": None, "+": None, "--5": None, "1 .5": None, "1.5 ": 1,
    " 12": None, "\x0112": 12, "1.2.3": None, "0.0": 0, "-0.7": 0,
}


def test_integers(spark):
    assert dict(zip(INTEGERS, values(spark, list(INTEGERS), parse_integer))) == INTEGERS


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-. \tex", max_size=12), min_size=200, max_size=200))
def test_integers_agree_with_the_lenient_cast(spark, texts):
    ours = values(spark, texts, parse_integer)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lenient = values(spark, texts, lambda c: c.cast("int"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert dict(zip(texts, ours)) == dict(zip(texts, lenient))


def test_gates_search_anywhere(spark):
    assert values(spark, ["123456", "1234", "x12345"], lambda c: parse_integer(c, "[0-9]{5}")) == [123456, None, None]
    assert values(spark, ["Texas", "7", None], lambda c: parse_string(c, "[a-zA-Z]{2}")) == ["Texas", None, None]


def test_booleans(spark):
    texts = ["TRUE", "1", "False", "0", "yes", "Y", "", None]
    assert values(spark, texts, parse_boolean) == [True, True, False, False, None, None, None, None]


def python_key(*parts, sep=""):
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, sep.join(str(part) for part in parts if part is not None)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), max_size=30), min_size=100, max_size=100))
def test_uuid5_is_the_standard_one(spark, texts):
    assert values(spark, texts, uuid5) == [python_key(text) for text in texts]


def test_keys_render_values_as_python_does(spark):
    row = (True, datetime.date(2023, 3, 24), 12, "x", None, datetime.datetime(2023, 3, 24, 2), False)
    micros = datetime.datetime(2023, 3, 24, 2, 0, 0, 500)
    frame = spark.createDataFrame(
        [(*row, micros)], "a boolean, b date, c int, d string, e string, f timestamp, g boolean, h timestamp"
    )
    key = frame.select(deterministic_uuid(frame, *frame.columns).alias("k")).first().k
    assert key == python_key(*row, micros)


def test_keys_without_separator_collide_and_with_one_do_not(spark):
    frame = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert len({r.k for r in frame.select(deterministic_uuid(frame, "x", "y").alias("k")).collect()}) == 1
    assert len({r.k for r in frame.select(deterministic_uuid(frame, "x", "y", sep="|").alias("k")).collect()}) == 2
    nulls = spark.createDataFrame([(None, None), ("", None), ("", "")], "x string, y string")
    assert {r.k for r in nulls.select(deterministic_uuid(nulls, "x", "y").alias("k")).collect()} == {python_key("")}


def test_keys_refuse_types_without_an_agreed_text(spark):
    frame = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(TypeError, match="double"):
        deterministic_uuid(frame, "x")


def test_percentage(spark):
    frame = spark.createDataFrame([(1, 3), (0, 0), (5, 0), (0, 7), (2, 3)], "a long, b long")
    found = [row.p for row in frame.select(percentage(F.col("a"), F.col("b")).alias("p")).collect()]
    assert found == [33.33, 0.0, 0.0, 0.0, 66.67]


def test_uuid5_is_cut_and_joined_as_bytes(spark):
    """Pieces of a string are looked for character by character from its start."""
    frame = spark.range(1).select(uuid5(F.col("id").cast("string")).alias("key"))
    assert frame.dtypes == [("key", "string")]
    analysed = frame._jdf.queryExecution().analyzed().toString()
    assert "cast(concat(substring(cast(sha1" in analysed and "as binary), 1, 8)" in analysed


def test_collapse_whitespace_knows_the_ascii_characters_only(spark):
    texts = [f"a{chr(code)}{chr(code)}b" for code in (*range(1, 0x100), 0x2003, 0x2028)]
    expected = ["a b" if text[1] in "\t\n\x0b\f\r " else text for text in texts]
    assert values(spark, texts, collapse_whitespace) == expected
