"""Work tables in the folder that driver and executors share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from recordloom.session import shared_folder

def work_folder(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a session that names none raises, as no other folder is shared."""
    return f"{shared_folder(spark)}/llm"


def work_table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read back: lineage ends, a lost executor costs a read."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_by_worker(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gave the first task of this worker process that asked for ``name``.

    Functions come to a worker anew with every task, so what they are to remember from one
    to the next has a module of its own. Only the last name asked for is kept.
    """
    held = sys.modules.setdefault("recordloom_kept", types.ModuleType("recordloom_kept")).__dict__
    if held.get("name") != name:
        held["value"] = None
        held["value"], held["name"] = make(), name
    return held["value"]
