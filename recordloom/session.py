"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the library relies on. UTC makes every rendered timestamp
# independent of where a job runs; AQE splits skewed joins and sizes shuffles.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State beyond memory, and the store that stateful processors need.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "recordloom", **conf: str) -> SparkSession:
    """A session for scripts and tests; on a cluster the submitter supplies the master."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    A session that names none has no such folder: data put on one machine dies with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/recordloom/{uuid.uuid4()}"


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and continue from the files.

    Used where several outputs read the same costly input: lineage ends here, a
    lost executor costs a file read instead of a recomputation, and every
    consumer gets column pruning on the nested data.
    """
    path = folder or shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
