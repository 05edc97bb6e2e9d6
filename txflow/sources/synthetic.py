"""Made-up transactions, one per row id.

Every value depends on the seed and the row id only, so the table is the same however it
is partitioned, and any part of it can be made again on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.schemas import PAYMENT_METHODS, PRODUCT_CATEGORIES, REGIONS

USERS = 100_000
FRAUD_PER_MILLE = 20
_DRAWS_PER_HASH = 4


def _draw(seed: int, number: int, n: int) -> Column:
    """An integer in [0, n): eight hex digits of an md5, four draws per md5."""
    block, slot = divmod(number, _DRAWS_PER_HASH)
    digest = F.md5(F.concat(F.lit(f"{seed}:{block}:"), F.col("transaction_id").cast("string")))
    bits = F.conv(F.substring(digest, slot * 8 + 1, 8), 16, 10).cast("long")
    return F.shiftright(bits * n, 32)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def synthesize(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Transactions for a frame with a ``transaction_id`` column."""
    cents = _draw(seed, 0, 99_900) + 100
    quantity = _draw(seed, 1, 20) + 1
    return ids.select(
        "transaction_id",
        (_draw(seed, 2, USERS) + 1).alias("user_id"),
        _pick(PRODUCT_CATEGORIES, _draw(seed, 3, len(PRODUCT_CATEGORIES))).alias("product_category"),
        _pick(REGIONS, _draw(seed, 4, len(REGIONS))).alias("region"),
        (cents / F.lit(100.0)).alias("amount"),
        quantity.cast("int").alias("quantity"),
        (cents * quantity / F.lit(100.0)).alias("total"),
        _pick(PAYMENT_METHODS, _draw(seed, 5, len(PAYMENT_METHODS))).alias("payment_method"),
        _draw(seed, 6, 7).cast("int").alias("day_of_week"),
        _draw(seed, 7, 24).cast("int").alias("hour_of_day"),
        F.when(_draw(seed, 8, 1000) < FRAUD_PER_MILLE, "True").otherwise("False").alias("is_fraud"),
    )


def synthesize_range(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    return synthesize(spark.range(rows).withColumnRenamed("id", "transaction_id"), seed)
