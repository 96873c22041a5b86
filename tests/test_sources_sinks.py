"""JSON Lines, packed documents, table folders, runs, and SQL registration."""

import gzip
import hashlib
import json
import re
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.operators import dedupe_against_existing, dedupe_first
from recordloom.plans import read_store, run_extract, store_records, summary_of_runs
from recordloom.sinks import register_tables, tables as tables_sink, write_jsonl, write_table
from recordloom.schemas import ALL_TABLES, CHILD_TABLES, RECORD_TABLES, table_schema
from recordloom.sources import (
    explode_api_pages,
    line_quality,
    pack_documents,
    read_jsonl_tolerant,
    read_tables,
    read_xml_dir,
    read_xml_list,
)
from recordloom.session import shared_folder
from tests import golden
from workload import file_queries

LINES = ['{"id": 1, "t": "é"}', "", "  ", "{broken", '{"id": "b"}', '{"x": 1}', "[1]", '{"id": null}']


def test_tolerant_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    with gzip.open(tmp_path / "b.jsonl.gz", "wt", encoding="utf-8") as out:
        out.write('{"id": 3}\n')
    path = str(tmp_path / "*.jsonl*")
    got = {r.id: r.value for r in read_jsonl_tolerant(spark, path, partitions=3).collect()}
    assert got == {"1": LINES[0], "b": LINES[4], "3": '{"id": 3}'}
    assert read_jsonl_tolerant(spark, path, keep_null_ids=True).count() == 5
    q = line_quality(spark.read.text(str(tmp_path / "a.jsonl"))).first()
    assert (q.lines, q.blank_lines, q.bad_lines, q.lines_without_id) == (8, 2, 2, 2)


def test_ids_stay_as_written_and_no_valid_line_is_lost(spark, tmp_path):
    long = '{"id": "long", "t": "' + "x" * (135 << 20) + '"}'
    lines = ['{"id": 1.0}', '{"id": 1}', '{"id": 1, "n": NaN}', '{"id": "a", "id": "b"}', '{"id": ' + "7" * 41 + "1}",
             '{"id": ' + "7" * 41 + "2}", "{'id': 5}", '{"id": 6,}', '{"id": 1' + "[" * 2000, long]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = read_jsonl_tolerant(spark, str(tmp_path / "a.jsonl")).selectExpr("id", "length(value) AS n")
    want = [("1.0", 11), ("1", 9), ("1", 19), ("b", len(lines[3])), ("7" * 41 + "1", 50), ("7" * 41 + "2", 50), ("long", len(long))]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_hidden_and_listed_files(spark, tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    for name in ("1.xml", "_2.xml", ".3.xml", "4.XML", "5.oai"):
        (folder / name).write_text(name)
    (tmp_path / "far.xml").write_text("far")
    found = read_xml_dir(spark, str(folder)).collect()
    assert [r.file_name for r in found] == [".3.xml", "1.xml", "_2.xml"]
    listed = ["4.XML", "./_2.xml", "../far.xml", str(tmp_path / "far.xml"), "none.xml", "", "4.XML"]
    (folder / "list.txt").write_text("\n".join(listed))
    docs = read_xml_list(spark, str(folder / "list.txt"))
    got = sorted((r.file_name, None if r.content is None else r.content.decode()) for r in docs.collect())
    assert got == [("4.XML", "4.XML"), ("4.XML", "4.XML"), ("_2.xml", "_2.xml"), ("far.xml", "far"), ("far.xml", "far"), ("none.xml", None)]
    text = docs._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "Exchange" not in text


def test_working_folder_must_be_named():
    class Unset:
        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError):
        shared_folder(Unset)


def test_small_tables_get_few_files(spark, tmp_path):
    df = spark.range(2000).selectExpr("string(id) AS a").repartition(40)
    write_table(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*"))) < 10


def test_summaries_stay_after_an_append(spark, docs, tmp_path):
    for append in (False, True):
        one = run_extract(docs, str(tmp_path), append=append).first()
        assert one.processed_files == len(golden.DOCS) and one.issues_jsonl.startswith(f"{tmp_path}/issues/run=")
        assert one.generated_utc.endswith("+00:00")
    assert spark.read.json(f"{tmp_path}/summary").count() == 2


def test_api_pages(spark):
    pages = ['{"hits": {"hits": [{"id": 1}, {"id": 2}]}}', '{"hits": {"hits": []}}', "{}", "x", '{"n": NaN, "n": 1, "hits": {"hits": [{"id": 3, "id": NaN}]}}',
             '{"hits": {"hits": [{"id": 4}]}} {}', None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "n int, raw string")
    rows = explode_api_pages(df.select("n", F.col("raw").alias("page")))
    assert sorted(map(tuple, rows.collect())) == [(0, '{"id":1}'), (0, '{"id":2}'), (4, '{"id":3,"id":"NaN"}')]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("docs")
    golden.write_all(folder)
    packed = tmp_path_factory.mktemp("packed")
    return pack_documents(read_xml_dir(spark, str(folder)), str(packed))


def test_formats_agree_and_append_doubles(spark, docs, tmp_path):
    out = {}
    for file_format in ("parquet", "jsonl"):
        root = str(tmp_path / file_format)
        summary = run_extract(docs, root, file_format).first()
        source = "json" if file_format == "jsonl" else file_format
        out[file_format] = read_tables(spark, root, file_format=source)
        assert summary.processed_files == len(golden.DOCS)
        assert summary.fatal_parse_errors == 2
        assert summary.issue_counts_by_severity["ERROR"] == 2
        assert sum(summary.issue_counts_by_code.values()) == sum(
            s["count"] for s in summary.top_issue_signatures
        )
        ranked = [(-s["count"], s.signature) for s in summary.top_issue_signatures]
        assert ranked == sorted(ranked)
    for name in RECORD_TABLES:
        a, b = out["parquet"][name], out["jsonl"][name]
        assert a.schema == b.schema
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, name
    before = out["parquet"]["creators"].count()
    run_extract(docs, str(tmp_path / "parquet"), append=True)
    assert read_tables(spark, str(tmp_path / "parquet"))["creators"].count() == 2 * before
    run_extract(docs, str(tmp_path / "parquet"))
    assert read_tables(spark, str(tmp_path / "parquet"))["creators"].count() == before


@pytest.mark.parametrize("append", [False, True])
def test_a_run_that_dies_between_two_tables_changes_nothing(spark, docs, tmp_path, monkeypatch, append):
    out = str(tmp_path)
    run_extract(docs.limit(9), out)
    before = {n: sorted(map(str, t.collect())) for n, t in read_tables(spark, out, ALL_TABLES).items()}
    real, written = tables_sink.write_table, []

    def dies(df, folder, *args):
        if "/subjects/" in folder:
            raise OSError("the disk is full")
        written.append(folder)
        return real(df, folder, *args)

    monkeypatch.setattr(tables_sink, "write_table", dies)
    with pytest.raises(OSError, match="full"):
        run_extract(docs, out, append=append)
    assert any("/records/" in w for w in written)
    assert {n: sorted(map(str, t.collect())) for n, t in read_tables(spark, out, ALL_TABLES).items()} == before
    assert summary_of_runs(spark, out).first().processed_files == 9
    monkeypatch.undo()
    run_extract(docs, out, append=append)
    count = len(golden.DOCS)
    assert read_tables(spark, out)["records"].count() == count + 9 * append
    merged = summary_of_runs(spark, out).first()
    assert (merged.runs, merged.processed_files) == (1 + append, count + 9 * append)


def test_a_later_run_of_a_slot_replaces_the_earlier(spark, docs, tmp_path):
    out = str(tmp_path)
    run_extract(docs.limit(3), out)
    for rows in (docs.limit(5), docs.limit(2)):
        run_extract(rows, out, append=True, slot="batch_id=0")
    assert read_tables(spark, out)["records"].count() == 5
    assert len(list((tmp_path / "records").glob("run=*"))) == 2
    assert summary_of_runs(spark, out).first().runs == 2


def test_json_keeps_nulls_dates_and_letters(spark, docs, tmp_path):
    run_extract(docs, str(tmp_path), "jsonl", max_records_per_file=3)
    lines = [json.loads(x) for p in (tmp_path / "records").rglob("part-*") for x in p.read_text("utf-8").splitlines()]
    assert all(list(x) == table_schema("records").fieldNames() for x in lines)
    by_name = {x["source_file_name"]: x for x in lines}
    assert by_name["13.xml"]["issued_date"] == "2020-01-02"
    raw = "".join(p.read_text("utf-8") for p in (tmp_path / "records").rglob("part-*"))
    assert "Café" in raw
    assert all(len(p.read_text("utf-8").splitlines()) <= 3 for p in (tmp_path / "records").rglob("part-*"))


def test_empty_table_is_readable(spark, tmp_path):
    empty = spark.createDataFrame([], table_schema("rights"))
    write_table(empty, str(tmp_path / "rights"))
    assert read_tables(spark, str(tmp_path), ["rights"])["rights"].count() == 0


def test_registered_tables_join_in_sql(spark, docs, tmp_path):
    run_extract(docs, str(tmp_path))
    register_tables(read_tables(spark, str(tmp_path)))
    rows = spark.sql(
        "SELECT r.source_file_name, count(*) n FROM records r JOIN creators c USING (source_xml_path) GROUP BY 1"
    ).collect()
    assert dict(map(tuple, rows)) == {"10.xml": 3, "11.xml": 1, "25.xml": 1}
    for name in RECORD_TABLES:
        assert spark.table(name).schema == table_schema(name)
    assert set(CHILD_TABLES) < {t.name for t in spark.catalog.listTables()}


def test_saved_tables_are_written_at_once(spark, tmp_path):
    """Each table's task waits for that of the other, which a save of one after the other never starts."""

    def rows_of(own, other):
        def wait(batches):
            (tmp_path / own).touch()
            until = time.monotonic() + 15
            while not (tmp_path / other).exists() and time.monotonic() < until:
                time.sleep(0.05)
            met = (tmp_path / other).exists()
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"record_id": batch["id"], "met": pa.array([met] * len(batch))})

        return spark.range(0, 3, 1, 1).mapInArrow(wait, "record_id long, met boolean")

    spark.sql(f"CREATE DATABASE at_once LOCATION '{tmp_path}/at_once'")
    try:
        register_tables({"a": rows_of("a", "b"), "b": rows_of("b", "a")}, "at_once", buckets=2)
        for name in ("a", "b"):
            assert sorted(map(tuple, spark.table(f"at_once.{name}").collect())) == [(i, True) for i in range(3)]
    finally:
        spark.sql("DROP DATABASE at_once CASCADE")


def test_raw_sink_writes_lines_unchanged(spark, tmp_path):
    df = spark.createDataFrame([(LINES[0],), (LINES[4],)], "value string")
    write_jsonl(df, str(tmp_path / "raw"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "raw")).collect()) == sorted([LINES[0], LINES[4]])


def test_dedupe_is_idempotent_and_keeps_nulls(spark):
    rows = [(None, 1), ("a", 5), ("a", 2), (None, 2), ("b", 9), ("a", 3)] + [("hot", i) for i in range(500, 0, -1)]
    df = spark.createDataFrame(rows, "id string, n int")
    once = dedupe_first(df, "id", "n")
    want = [("a", 2), ("b", 9), ("hot", 1), (None, 1), (None, 2)]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, dedupe_first(once, "id", "n").collect()), key=str) == sorted(want, key=str)
    existing = spark.createDataFrame([("a", 0), ("a", 0), (None, 0)], "id string, n int")
    fresh = dedupe_against_existing(df, existing, "id", "n")
    assert sorted(map(tuple, fresh.collect()), key=str) == sorted(want[1:], key=str)


def test_store_appends_once_and_repeats_safely(spark, tmp_path):
    root = str(tmp_path / "store")

    def batch(*ids):
        rows = [(i, f"v{n}", n) for n, i in enumerate(ids)]
        return spark.createDataFrame(rows, "id string, value string, n int")

    store_records(batch("a", "b", "a", None), root, 0, "n")
    store_records(batch("b", "c", None), root, 1, "n")
    store_records(batch("b", "c", None), root, 1, "n")
    got = sorted(((r.id, r.batch_id) for r in read_store(spark, root).collect()), key=str)
    assert got == sorted([("a", 0), ("b", 0), (None, 0), ("c", 1), (None, 1)], key=str)
    store_records(batch("z"), root, 5, "n", append=False)
    assert [(r.id, r.batch_id) for r in read_store(spark, root).collect()] == [("z", 5)]


def test_compressed_json_has_the_same_rows_in_less_space(spark, docs, tmp_path):
    many = docs.crossJoin(spark.range(20)).drop("id")
    runs = {c: str(tmp_path / c) for c in ("none", "gzip")}
    for codec, out in runs.items():
        run_extract(many, out, "jsonl", max_records_per_file=100, json_compression=codec)
    for name in ALL_TABLES:
        plain, small = (read_tables(spark, out, [name], "json")[name].drop("timestamp_utc") for out in runs.values())
        assert sorted(map(str, plain.collect())) == sorted(map(str, small.collect())), name
    parts = {c: list((tmp_path / c / "records").rglob("part-*")) for c in runs}
    assert all(p.suffix == (".gz" if c == "gzip" else ".json") for c in runs for p in parts[c])
    size = {c: sum(p.stat().st_size for p in parts[c]) for c in runs}
    assert size["gzip"] * 4 < size["none"]


@pytest.mark.parametrize("large", [False, True])
def test_tables_of_large_files_are_written_without_a_shuffle(spark, docs, tmp_path, monkeypatch, large):
    """Many rows a file are written by the tasks that read them; the rows of many small files share files."""
    if large:
        monkeypatch.setattr("recordloom.plans.extract._LARGE_FILE", 1)
    run_extract(docs.repartition(4), str(tmp_path))
    parts = list((tmp_path / "records").rglob("part-*"))
    assert (len(parts) > 1) == large
    assert read_tables(spark, str(tmp_path))["records"].count() == len(golden.DOCS)


@pytest.mark.parametrize("n", [0, 3, 9_000_000, 30_000_000])
def test_hashes_of_many_rows_do_not_overflow(spark, n):
    """A row whose hash is near the top, so often that the sum leaves the longs, once and more than once around."""
    row, (first, *others) = [], file_queries._columns("titles")
    for k in range(1000):
        row = [str(k), *("~" for _ in others)]
        number = int(hashlib.md5("|".join(row).encode()).hexdigest()[:10], 16)
        if number > 0.99 * 2**40:
            break
    texts = [F.lit(row[0]).alias(first), *(F.lit(None).cast("string").alias(c) for c in others)]
    got = file_queries._measured({"titles": spark.range(n).select(*texts)})
    total = (n * number + 2**63) % 2**64 - 2**63
    assert [tuple(r) for r in got.collect()] == [("titles", n, n, total)]
    assert got.schema["rows_hash"].dataType.simpleString() == "bigint"


_MIXED = "s string, n bigint, i int, x double, b boolean, d date"


def _mixed(spark, n, parts):
    old = F.when(F.col("id") % 9 == 0, F.lit("0001-01-01").cast("date")).otherwise(F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")))
    rows = spark.range(0, n, 1, parts).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit('Café "\n'), "id")).alias("s"), F.col("id").alias("n"), F.col("id").cast("int").alias("i"),
        (F.col("id") / 8).alias("x"), (F.col("id") % 2 == 0).alias("b"), F.when(F.col("id") % 5 > 0, old).alias("d"))
    assert rows.dtypes == spark.createDataFrame([], _MIXED).dtypes
    return rows


def _sorted(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(("file_format", "codec"), [("parquet", "none"), ("jsonl", "none"), ("jsonl", "gzip")])
def test_many_small_files_have_no_checksum_files(spark, tmp_path, file_format, codec):
    """Each costs two processes and a block of the disk, as much as the file itself. Rows and limits are those of Spark's writer."""
    df, kind = _mixed(spark, 1000, 3), tables_sink.FORMATS[file_format]
    reader = spark.read.schema(_MIXED).format(kind)
    for mode, times in (("overwrite", 1), ("append", 2), ("overwrite", 1)):
        write_table(df, str(tmp_path / "few"), file_format, mode, 30, json_compression=codec, rebalance=False)
        assert _sorted(reader.load(str(tmp_path / "few"))) == _sorted(df) if times == 1 else True
        parts = list((tmp_path / "few").glob("part-*"))
        assert len(parts) == times * 36  # 334 rows a task
        assert reader.load(str(tmp_path / "few")).count() == times * 1000
    sizes = reader.load(str(tmp_path / "few")).groupBy(F.input_file_name()).count().select(F.max("count"), F.min("count")).first()
    assert tuple(sizes) == (30, 3)
    assert sorted(p.name for p in (tmp_path / "few").iterdir() if not p.name.startswith("part-")) == ["_SUCCESS"]
    write_table(df, str(tmp_path / "whole"), file_format, json_compression=codec)
    assert _sorted(reader.load(str(tmp_path / "whole"))) == _sorted(df)
    names = {re.sub(r"^part-[^.]*", "", p.name) for k in ("few", "whole") for p in (tmp_path / k).glob("part-*")}
    assert len(names) == 1, names
    if kind == "parquet":
        assert spark.read.parquet(str(tmp_path / "few")).schema == spark.read.parquet(str(tmp_path / "whole")).schema


def test_small_files_of_an_empty_table_and_of_a_write_that_fails(spark, tmp_path):
    folder = str(tmp_path / "rights")
    for file_format in ("jsonl", "parquet"):
        write_table(spark.createDataFrame([], table_schema("rights")), folder, file_format, max_records_per_file=3)
    assert spark.read.parquet(folder).schema == table_schema("rights")
    assert spark.read.parquet(folder).count() == 0
    write_table(_mixed(spark, 10, 2), folder, max_records_per_file=3)
    bad = _mixed(spark, 100, 2).withColumn("s", F.when(F.col("n") == 90, F.raise_error(F.lit("broken"))).otherwise(F.col("s")))
    with pytest.raises(Exception, match="broken"):
        write_table(bad, folder, max_records_per_file=3)
    assert spark.read.parquet(folder).count() == 10
    assert not list((tmp_path / "rights").glob("_staging*"))


@pytest.mark.parametrize("own", [False, True])
def test_a_run_leaves_no_working_copy(spark, docs, tmp_path, own):
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.rglob("*.parquet"))
    summary = run_extract(docs, str(tmp_path / "out"), work_folder=str(tmp_path / "work") if own else None)
    assert set(base.rglob("*.parquet")) == before
    assert not (tmp_path / "work").exists()
    assert summary.first().processed_files == len(golden.DOCS)
    assert read_tables(spark, str(tmp_path / "out"))["records"].count() == len(golden.DOCS)

