"""Batch sinks.

No output is coalesced: that would run the stage before it in as many tasks as files.
A sorted summary comes out of a shuffle, whose small partitions Spark merges at run time,
so a small table is one file anyway, and a large one stays many.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.operators.delivery import with_event_date

ROWS_PER_FILE = 20_000_000
# Values hardly ever repeat here: a dictionary would be built and thrown away.
_DISTINCT = ["transaction_id", "total", "log_total"]


def write_featured(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    for column in _DISTINCT:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_by_date(events: DataFrame, path: str) -> None:
    """Events in ``year=/month=/day=`` folders.

    Rebalancing by day gives few files per day, and splits a day that holds most of the
    rows over several tasks.
    """
    dated = with_event_date(events)
    days = ["year", "month", "day"]
    dated.hint("rebalance", *[F.col(c) for c in days]).write.mode("overwrite").partitionBy(*days).parquet(path)


def write_metrics(spark: SparkSession, metrics: dict[str, Any], path: str) -> None:
    """One JSON object."""
    spark.createDataFrame([metrics], _schema_of(metrics)).coalesce(1).write.mode("overwrite").json(path)


def _schema_of(values: dict[str, Any]) -> T.StructType:
    kinds = {int: T.LongType(), float: T.DoubleType(), str: T.StringType()}
    return T.StructType(
        [
            T.StructField(k, _schema_of(v) if isinstance(v, dict) else kinds[type(v)])
            for k, v in values.items()
        ]
    )


def preview(spark: SparkSession, path: str) -> None:
    """Show a written summary."""
    spark.read.option("header", True).csv(path).show(truncate=False)
