"""A store of raw JSON records that grows by batches without repeating an id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from recordloom.operators.dedupe import dedupe_against_existing, dedupe_first
from recordloom.sinks.tables import BATCH_COLUMN

STORE_DDL = f"id string, value string, {BATCH_COLUMN} long"


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """Everything stored so far: ``id``, the raw line ``value``, ``batch_id``.

    The id is stored as a column of its own, so looking for known ids reads no JSON.
    """
    try:
        return spark.read.schema(STORE_DDL).parquet(root)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORE_DDL)


def store_records(
    incoming: DataFrame, root: str, batch_id: int, order_by: str | list[str], append: bool = True
) -> None:
    """Store the first record of every id that no other batch holds; null ids all.

    ``incoming`` has ``id`` and ``value``. Each batch has its own folder, replaced as a
    whole, so a batch that is run again leaves the same result. Without ``append`` the
    store starts afresh.
    """
    spark = incoming.sparkSession
    if append:
        # Of all that is stored only ids that came in again matter. While the incoming ids are
        # few enough to be sent to every task, the store is read in place and not shuffled.
        ids = incoming.select("id").where(F.col("id").isNotNull()).distinct()
        others = read_store(spark, root).where(F.col(BATCH_COLUMN) != batch_id).select("id").join(ids, "id", "left_semi")
        fresh = dedupe_against_existing(incoming, others, "id", order_by)
    else:
        fresh = dedupe_first(incoming, "id", order_by)
        spark.createDataFrame([], STORE_DDL).write.mode("overwrite").partitionBy(
            BATCH_COLUMN
        ).parquet(root)
    fresh.select("id", "value").write.mode("overwrite").parquet(f"{root}/{BATCH_COLUMN}={batch_id}")
