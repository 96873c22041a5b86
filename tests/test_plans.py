"""What the plans must look like: few shuffles, narrow scans, no Python but the shredder."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from recordloom.operators import dedupe_against_existing, dedupe_first, in_time_window
from recordloom.operators.tables import derive_tables, judge_documents
from recordloom.schemas import CHILD_TABLES
from recordloom.session import materialize
from recordloom.sinks.tables import register_tables
from recordloom.sources import documents
from workload import extract_queries, record_queries
from workload.xml_docs import build_xml

SF_DIR = "/root/testdata/sf0.001"
STREAMS = [n for n in driver.queries() if n.startswith("stream_")]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def exchanges(df):
    tree = plan(df).split("\n\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)\bExchange \(", tree))


@pytest.fixture(scope="module")
def tables(spark):
    return derive_tables(materialize(judge_documents(build_xml(spark, SF_DIR))))


def test_tables_are_projections(tables):
    for name, df in tables.items():
        assert exchanges(df) == 0, name
        assert "MapInArrow" not in plan(df), name


@pytest.mark.parametrize("name", CHILD_TABLES)
def test_child_table_reads_its_own_section(tables, name):
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", plan(tables[name]))
    others = [c for c in CHILD_TABLES if c != name and re.search(rf"\b{c}:", schema)]
    assert others == []
    assert "warnings" not in schema


def test_record_counts_read_one_leaf(tables):
    text = plan(tables["records"])
    assert "family" not in text and "affiliations" not in text


def test_python_runs_only_in_the_shredder(spark):
    for name, query in record_queries.QUERIES.items():
        if name in STREAMS or name == "paginate":
            continue
        text = plan(query(spark, SF_DIR))
        assert not re.search(r"Python|InArrow|InPandas", text), name


def test_dedup_combines_before_its_one_shuffle(spark):
    events = record_queries.events(spark, SF_DIR).withColumn("id", F.col("user_id").cast("string"))
    df = dedupe_first(events, "id", "event_id")
    assert exchanges(df) == 1
    assert "partial_min_by" in plan(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The rows by id, and the known ids: the join adds no shuffle of its own.
        assert exchanges(dedupe_against_existing(events, events, "id", "event_id")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    from datetime import datetime

    events = record_queries.events(spark, SF_DIR)
    df = in_time_window(events, "ts", datetime(2024, 1, 5), datetime(2024, 1, 9)).select("event_id", "ts")
    text = plan(df)
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_no_query_needs_a_cross_join(spark):
    for name, query in {**extract_queries.QUERIES, **record_queries.QUERIES}.items():
        if name in STREAMS:
            continue
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan(query(spark, SF_DIR))), name


def test_saved_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(100).select(F.col("id").cast("string").alias("record_id"), F.lit("a").alias("a"))
    right = spark.range(300).select((F.col("id") % 100).cast("string").alias("record_id"), F.lit("b").alias("b"))
    spark.sql(f"CREATE DATABASE saved LOCATION '{tmp_path}/saved'")
    register_tables({"heads": left, "lines": right}, "saved", buckets=4)
    joined = spark.sql("SELECT /*+ MERGE(heads) */ * FROM saved.heads JOIN saved.lines USING (record_id)")
    assert exchanges(joined) == 0
    assert joined.count() == 300
    register_tables({"heads": left}, "saved", buckets=4)  # replaced, not added to
    assert spark.table("saved.heads").count() == 100


@pytest.mark.parametrize("strict", [False, True])
def test_warnings_are_made_once(spark, strict):
    docs = build_xml(spark, SF_DIR)
    judged = judge_documents(docs, strict, ["issues"])
    # No counts and plain texts, which no warning needs.
    assert not {"titles_count", "publisher"} & set(judged.columns)
    issues = derive_tables(judged, ["issues"])["issues"]
    made = [df._jdf.queryExecution().optimizedPlan().toString().count("Unhandled root child") for df in (judged.select("warnings"), issues)]
    assert made[0] == made[1] > 0


def test_contents_of_a_long_list_are_not_sorted(spark, monkeypatch):
    listed = spark.createDataFrame([("/a",), ("/b",), ("/a",), ("/none",), (None,)] + [("/hot",)] * 300, "path string")
    rows = [("/a", "a", b"1"), ("/a", "a", b"2"), ("/b", "b", None), ("/hot", "hot", b"3"), ("/x", "x", b"4"), (None, "n", b"5")]
    docs = spark.createDataFrame(rows, "path string, file_name string, content binary")
    want = sorted(map(str, documents.attach_content(listed, docs).collect()))
    monkeypatch.setattr(documents, "_HASHED_FROM", 10, raising=False)
    attached = documents.attach_content(listed, docs)
    plan = attached._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ShuffledHashJoin .* Inner", plan)
    assert not re.search(r"SortMergeJoin .* Inner", plan)
    assert sorted(map(str, attached.collect())) == want and len(want) == 307
