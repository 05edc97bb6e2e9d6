"""Transactions from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txflow.schemas import TRANSACTION_SCHEMA


def scan_transactions(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """CSV files with a header, bound to the fixed schema by position.

    A cell that does not parse becomes null; cleaning removes the row if the field is
    critical.  Spark splits plain CSV by size on its own, so ``partitions`` (an extra
    shuffle of every row) is only for input that cannot be split, such as one gzip file.
    """
    rows = spark.read.schema(TRANSACTION_SCHEMA).option("header", True).csv(path)
    return rows if partitions is None else rows.repartition(partitions)


def count_while_running(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows in whatever action runs them, instead of in a pass of its own.

    Use it in the stage that ends in the action: tasks of a shuffle stage that run again
    after a lost executor would be counted again.
    """
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen
