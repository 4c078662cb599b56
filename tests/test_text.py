import datetime as dt
import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.jsontext import clean_nulls, is_json, json_scalar, row_record
from daybridge.functions.xmltext import attribute, element, iso_text, number_text


def one(spark, value, kind, build):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", kind)]))
    return df.select(build(F.col("x")).alias("y")).first().y


def each(spark, values, build):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("text, wanted", [
    ('{"k":"x"}', "x"), ('{"k":7}', "7"), ('{"k":true}', "true"), ('{"k":null}', None), ('{"k":{"a":1}}', None),
    ('{"k":[1]}', None), ("{}", None), ("{bad", None), (None, None), ('{"k":"{not an object}"}', "{not an object}"),
    ('{"k":1,"k":2}', "2"),
])
def test_json_scalar(spark, text, wanted):
    assert one(spark, text, T.StringType(), lambda c: json_scalar(c, "k")) == wanted


def cleaned(value):
    if isinstance(value, dict):
        return {k: cleaned(v) for k, v in value.items()}
    if isinstance(value, list):
        return [cleaned(v) for v in value]
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return value


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.just(float("nan"))
    | st.text(alphabet='nulNaN"\\{}[],: é\n', max_size=12),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text("nulNaN\"\\", max_size=6), inner, max_size=4),
    max_leaves=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(JSON, min_size=40, max_size=40))
def test_clean_nulls_matches_recursion(spark, values):
    texts = [json.dumps(v, ensure_ascii=i % 2 == 0) for i, v in enumerate(values)]
    assert [json.loads(t) for t in each(spark, texts, clean_nulls)] == [cleaned(v) for v in values]


def test_clean_nulls_on_long_text(spark):
    text = json.dumps({"note": "null NaN " * 20_000, "xs": [None] * 20_000})
    assert json.loads(one(spark, text, T.StringType(), clean_nulls)) == cleaned(json.loads(text))


@pytest.mark.parametrize("text, wanted", [
    ('{"a":1}', True), (' [1, 2] ', True), ('"x"', True), ("null", True), ("1", True), ("", False), ("{", False),
    ('{"a":1} tail', False), ("1,2", False), ("1],[2", False), ('{"a":1}{"b":2}', False), ("NaN", False),
    ('{"a":1,"a":2}', True), ("]", False), ('{"a":Infinity}', False),
])
def test_is_json(spark, text, wanted):
    assert one(spark, text, T.StringType(), is_json) is wanted


def test_row_record(spark):
    df = spark.createDataFrame([(1, float("nan"), None, dt.datetime(2026, 1, 5, 10, tzinfo=dt.timezone.utc),
                                 [(float("nan"), "null")], "é")],
                               "id long, v double, s string, t timestamp, xs array<struct<a: double, b: string>>, u string")
    assert json.loads(df.select(row_record(df).alias("r")).first().r) == {
        "id": 1, "v": "", "s": "", "t": "2026-01-05T10:00:00.000000+00:00", "xs": [{"a": "", "b": "null"}], "u": "é"}


@pytest.mark.parametrize("value, wanted", [
    (900.0, "900.0"), (900.1, "900.1"), (10_000_000.0, "10000000.0"), (12345678.25, "12345678.25"),
    (-98765432.1, "-98765432.1"), (123456789012345.6, "123456789012345.6"), (0.001, "0.001"), (0.0, "0.0"), (0.0005, "0.0005"),
    (0.00012, "0.00012"), (-1.25e-7, "-0.000000125"),
    (9999999999999998.0, "9999999999999998.0"), (1e16, "10000000000000000.0"), (-1.2345e17, "-123450000000000000.0"),
    (1.2345678901234568e20, "123456789012345680000.0"),
    (float("nan"), None), (None, None),
])
def test_number_text_of_doubles(spark, value, wanted):
    assert one(spark, value, T.DoubleType(), lambda c: number_text(c, T.DoubleType())) == wanted


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(1e-12, 1e300), min_size=60, max_size=60))
def test_number_text_reads_back(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    found = df.select("i", number_text(F.col("x"), T.DoubleType()).alias("y")).orderBy("i").collect()
    assert all("E" not in r.y for r in found)
    assert [float(r.y) for r in found] == pytest.approx(values, rel=1e-15)


@pytest.mark.parametrize("value, kind, wanted", [
    (dt.datetime(2026, 2, 2, 10, tzinfo=dt.timezone.utc), T.TimestampType(), "2026-02-02T10:00:00+00:00"),
    (dt.datetime(2026, 2, 2, 10, 0, 0, 1500), T.TimestampNTZType(), "2026-02-02T10:00:00.001500"),
    ("as it is", T.StringType(), "as it is"),
    (None, T.TimestampType(), None),
])
def test_iso_text(spark, value, kind, wanted):
    assert one(spark, value, kind, lambda c: iso_text(c, kind)) == wanted


def test_xml_text(spark):
    assert each(spark, ["a&b", "<x>", "it's \"so\"", "", None, "a\x01b", "€ 😀 ퟿"], lambda c: element("t", c)) == [
        "<t>a&amp;b</t>", "<t>&lt;x&gt;</t>", "<t>it's \"so\"</t>", "<t/>", "<t/>", "<t>a�b</t>", "<t>€ 😀 ퟿</t>"]
    assert each(spark, ['a"<b', None], attribute) == ["a&quot;&lt;b", ""]
