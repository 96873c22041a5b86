"""Raw JSON records and API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.functions.json import read_object, read_page, record_id_of
from recordloom.functions.text import has_text

_RECORD = "record_"


def parse_jsonl(lines: DataFrame, keep_null_ids: bool = False, record_col: str | None = None) -> DataFrame:
    """Text lines (column ``value``, and any others) with their record's ``id`` as a string.

    Blank lines and lines that are not one JSON object are skipped. Records without an id are
    skipped too, unless ``keep_null_ids`` is set. The id is the text that the line has:
    ``1.0`` is not ``1``, and long whole numbers keep all their digits. ``record_col`` names a column for
    the record as ``read_object`` reads it, so that ids, fields and keys come from one scan of a line.
    """
    # Exploded, as the optimizer would repeat the scan in every filter that it moves below a projection.
    once = F.explode(F.filter(F.array(read_object(F.col("value"))), F.isnotnull))
    valid = lines.where(has_text(F.col("value"))).select("*", once.alias(_RECORD)).withColumn("id", record_id_of(F.col(_RECORD)))
    kept = valid if keep_null_ids else valid.where(F.col("id").isNotNull())
    return kept.withColumnRenamed(_RECORD, record_col) if record_col else kept.drop(_RECORD)


def read_jsonl_tolerant(
    spark: SparkSession,
    path: str,
    keep_null_ids: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """JSON Lines files, plain or compressed.

    A gzip file is one task. ``partitions`` spreads its lines before parsing.
    """
    lines = spark.read.text(path)
    if partitions:
        lines = lines.repartition(partitions)
    return parse_jsonl(lines, keep_null_ids)


def line_quality(lines: DataFrame) -> DataFrame:
    """One row: how many lines were read, blank, malformed, or had no id."""
    read = lines.select(has_text(F.col("value")).alias("filled"), F.explode(F.array(read_object(F.col("value")))).alias(_RECORD))
    checked = read.select("filled", F.col(_RECORD).isNotNull().alias("valid"), F.isnull(record_id_of(F.col(_RECORD))).alias("no_id"))
    return checked.agg(
        F.count("*").alias("lines"),
        F.count_if(~F.coalesce("filled", F.lit(False))).alias("blank_lines"),
        F.count_if(F.col("filled") & ~F.col("valid")).alias("bad_lines"),
        F.count_if(F.col("filled") & F.col("valid") & F.col("no_id")).alias("lines_without_id"),
    )


def explode_api_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """One row per record in ``hits.hits`` of a page's text, with the record's text in ``record``.

    A page without hits, or that is not one JSON object, gives no row.
    """
    return pages.withColumn("record", F.explode(read_page(F.col(page))["hits"])).drop(page)
