"""The stages one after the other, each on all that the last one kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm.near_dedup import near_duplicates
from recordloom.llm.work import work_table

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("row", F.lit("other"))
    columns, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = work_table(stage(spark, docs, SF_DIR))
        seen[name] = before, docs
        assert name == "packing" or docs.columns == columns

    def ids(df):
        return sorted(r.doc_id for r in df.collect())

    before, after = seen["toxicity"]
    assert 0 < after.count() < before.count()
    before, after = seen["near_dedup"]
    found = near_duplicates(before, 5, 80)
    assert ids(after) == sorted(r.component_id for r in found.select("component_id").distinct().collect())
    assert near_duplicates(after, 5, 80).where("not kept").count() == 0
    before, after = seen["substring_dedup"]
    assert ids(after) == ids(before)
    assert after.where(F.col("n_chars") != F.length("text")).count() == 0
    sentences = after.select("doc_id", F.explode(F.split("text", r"(?<=[.!?])\s+|\n\s*")).alias("s"))
    long = sentences.where(F.size(F.split("s", r"\s+")) >= 50).groupBy("s").count().where("count > 1")
    assert long.count() == 0
    before, after = seen["mixing"]
    words = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert set(ids(after)) < set(ids(before)) and len(ids(after)) == len(set(ids(after)))
    assert 0.6 * words(before) < words(after) <= 0.9 * words(before)
    before, after = seen["packing"]
    assert sorted(r.doc_id for r in after.select("doc_id").distinct().collect()) == ids(before)


def test_run_on_awkward_rows(spark, tmp_path):
    data = [(None, None, None, None, None), (1, "", "en", "src0", 0), (2, "idiot " * 3, "en", "src1", 18), (2, "x y z", "en", "src1", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("some", data), ("none", [])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    # Every leaf has one document at most, which is more than nine tenths of it.
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() == 0
