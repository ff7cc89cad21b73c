"""Tables between steps of a job."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.  Only where all tasks run on the driver's machine, a folder under the warehouse stands in for it."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def scratch(df: DataFrame, tag: str) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` written to the shared folder and read back, and a function that empties the table once what was made of it is written too."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)

    def drop() -> None:
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)

    return spark.read.schema(df.schema).parquet(path), drop


def durable(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows sees one and the same result, and lineage ends there."""
    return scratch(df, tag)[0]


def observed(df: DataFrame, tag: str, metrics: dict[str, Column], keep: Column | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``durable`` (of the rows for which ``keep`` holds) and aggregates of all rows of ``df``, counted while they are written instead of by a second run.  They belong to the tasks that write, so a task that
    is tried again counts once; ``df`` itself may shuffle before, not after."""
    seen = Observation()
    rows = df.observe(seen, *(c.alias(n) for n, c in metrics.items()))
    return durable(rows if keep is None else rows.where(keep), tag), seen.get
