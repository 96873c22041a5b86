"""Scalar functions against Python's own idea of whitespace, dates and integers."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from recordloom import functions as fn


def evaluate(spark, values, build, value_type="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {value_type}")
    rows = df.select("i", build(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def normal(text):
    return re.sub(r"\s+", " ", text).strip() or None


def test_every_bmp_code_point_is_classified_like_python(spark):
    texts = [f"a{chr(c)}b" for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    assert evaluate(spark, texts, fn.normalize_text) == [normal(t) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \t\n\r\u00a0\u2003\u3000\x1cab\u200b", max_size=12), min_size=1, max_size=40))
def test_normalize_text(spark, texts):
    assert evaluate(spark, texts, fn.normalize_text) == [normal(t) for t in texts]


def test_parse_date_strict(spark):
    cases = {
        "2020-01-02": dt.date(2020, 1, 2), " 2020-01-02\n": dt.date(2020, 1, 2),
        "2020-02-30": None, "2020": None, "2020-1-2": None, "20200102": None, "2020-W01-1": None,
        "2020-01-02T00:00:00": None, "0000-01-01": None, "0001-01-01": dt.date(1, 1, 1),
        "9999-12-31": dt.date(9999, 12, 31), "2020/2021": None, "": None, "x2020-01-02": None,
    }
    assert evaluate(spark, list(cases), fn.parse_date_strict) == list(cases.values())


def test_safe_int(spark):
    cases = ["5", "+5", "-5", " 7 ", "2_020", "_1", "1_", "1__0", "1.0", "", "n.d.", "0x1", "007", "--1"]

    def python(text):
        try:
            return int(text)
        except ValueError:
            return None

    assert evaluate(spark, cases, fn.safe_int) == [python(c) for c in cases]
    assert evaluate(spark, ["9223372036854775808", "9223372036854775807"], fn.safe_int) == [None, 2**63 - 1]


def test_record_id_falls_through(spark):
    df = spark.createDataFrame(
        [
            ("https://x/records/9", "o:8", "7.xml", "9"),
            ("https://x/records/9/", "o:8", "7.xml", "8"),
            ("https://x/records/9?p=1", "o:8b", "7.xml", "7"),
            (None, None, "x7.xml", None),
            (None, "8", "07x.xml", "07"),
            ("", "", "", None),
        ],
        "url string, oai string, name string, want string",
    )
    got = df.select("want", fn.extract_record_id(F.col("url"), F.col("oai"), F.col("name")).alias("got"))
    assert all(r.got == r.want for r in got.collect())


def test_timestamps(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.5Z", "2024-01-02T03:04:05.000001+01:00", "2024-01-02T03:04",
             "2024-01-02", "2024", "x", "2024-01-02 03:04+02:00"]
    got = evaluate(spark, texts, lambda v: fn.format_iso_z(fn.parse_iso_ts(v)))
    assert got == [
        "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.500000Z", "2024-01-02T02:04:05.000001Z",
        "2024-01-02T03:04:00Z", "2024-01-02T00:00:00Z", None, None, "2024-01-02T01:04:00Z",
    ]
    ends = evaluate(spark, ["2024-02-28", "2024-12-31", "x"], fn.day_end_exclusive)
    assert ends == [dt.datetime(2024, 2, 29), dt.datetime(2025, 1, 1), None]


def test_names_and_segments(spark):
    xml = "{http://www.w3.org/XML/1998/namespace}"
    assert evaluate(spark, [xml + "lang", "{urn:a}b", "c"], lambda _: fn.attribute_display_name("v")) == ["xml:lang", "{urn:a}b", "c"]
    assert evaluate(spark, ["/a/b.xml", "b", "info:x/", "a//b"], fn.last_segment) == ["b.xml", "b", "", "b"]


def test_page_total(spark):
    pages = {
        '{"hits": {"total": 5}}': 5, '{"hits": {"total": {"value": 7}}}': 7, '{"hits": {"total": "12"}}': 12,
        '{"hits": {"total": null}}': 0, '{"hits": {"total": {}}}': 0, '{"hits": {"total": "x"}}': 0,
        '{"hits": {}}': 0, "{}": 0, "nope": 0, '{"hits": {"total": 12.7}}': 12, '{"hits": {"total": 1e3}}': 1000, '{"hits": {"total": true}}': 1,
        '{"hits": {"total": NaN}}': 0, '{"hits": {"total": 1, "total": 2}}': 2, '{"hits": {"total": 5}} x': 0, '{"hits": {"total": 5}}, {}': 0,
        '{"hits": {"total": 5}, "n": [NaN]}': 5, '{"hits": 3}': 0, '{"hits": {"total": {"value": {"value": 3}}}}': 0,
        '{"hits": {"total": 1e400}}': 0, '{"hits": {"total": 99999999999999999999}}': 0,
    }
    assert evaluate(spark, list(pages), fn.page_total) == list(pages.values())


def test_tolerant_objects(spark):
    texts = {
        '{"id": 1}': "1", '{"id": 1}{"id": 2}': None, '{"id": 3} trailing': None, '{"id": 1}, {"id": 2}': None, '{"id": 1}], [{"id": 2}': None,
        '{"id": 1}]': None, "[1]": None, "null": None, "5": None, "": None, "{}": None, '{"id": null}': None, '{"id": "a", "id": "b"}': "b",
        '{"id": NaN}': "NaN", '{"id": -Infinity}': "-Infinity", '{"id": 1e400}': "Infinity", '{"id": "NaN"}': "NaN", '{"id": true}': "true",
        '\u00a0{"id": "x"}\u2003': "x", "{'id': 1}": None, '{"id": 1,}': None, '{"id": "a\tb"}': None, '{"id": [1, NaN]}': '[1,"NaN"]',
        '{"id": 1},{"seal_":"0"}': None,
    }
    assert evaluate(spark, list(texts), lambda v: fn.record_id_of(fn.read_object(v))) == list(texts.values())
    nested = ['{"m": {"a": 1, "a": {"b": 2}, "c": NaN}}', '{"m": {"a": 1}, "m": 3}', '{"x": 1}', "{"]
    assert evaluate(spark, nested, lambda v: fn.object_keys(fn.read_object(v), "m")) == [["a", "c"], None, None, None]
    assert evaluate(spark, nested, lambda v: fn.field_of(fn.read_object(v), "m", "a", "b")) == ["2", None, None, None]
