"""Summary tables of featured transactions.

Every summary is finished from *sales cells*: sums per group that can be added up again.
Tasks add up their rows before the shuffle, so a group that holds a third of all rows
still sends one row per task; and one table of cells can serve several summaries, as the
batch job does.  Ties in the sort are broken by the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions.money import aliased_parts, money_average, money_total, parts_of, split_amount, sum_parts

_COUNTS = ["n", "total_n", "quantity_sum", "quantity_n", "fraud_sum", "fraud_n"]


def sales_cells(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and exact sums per combination of ``keys``."""
    fraud = F.col("is_fraud").cast("int")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("total").alias("total_n"),
        *aliased_parts(sum_parts(split_amount(F.col("total"))), "total"),
        F.sum("quantity").alias("quantity_sum"),
        F.count("quantity").alias("quantity_n"),
        F.sum(fraud).alias("fraud_sum"),
        F.count(fraud).alias("fraud_n"),
    )


def _merged(cells: DataFrame, key: str, *more: Column) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in _COUNTS]
    return cells.groupBy(key).agg(*sums, *aliased_parts(sum_parts(parts_of("total")), "total"), *more)


def _revenue() -> Column:
    return money_total(parts_of("total"))


def _mean_value() -> Column:
    return money_average(parts_of("total"), F.col("total_n"))


def _mean_quantity() -> Column:
    return F.round(F.try_divide("quantity_sum", "quantity_n"), 2)


def region_from_cells(cells: DataFrame) -> DataFrame:
    """From cells whose keys include ``region``.  The fraud rate is over the rows whose
    flag is known."""
    return (
        _merged(cells, "region")
        .select(
            "region",
            F.col("n").alias("transaction_count"),
            _mean_value().alias("avg_transaction_value"),
            _revenue().alias("total_revenue"),
            _mean_quantity().alias("avg_quantity"),
            F.col("fraud_sum").alias("fraud_count"),
            F.round(F.try_divide("fraud_sum", "fraud_n") * 100, 4).alias("fraud_rate_pct"),
        )
        .orderBy(F.desc("total_revenue"), "region")
    )


def category_from_cells(cells: DataFrame) -> DataFrame:
    """From cells by user and category: each buyer of a category is one cell, so counting
    cells counts buyers exactly."""
    return (
        _merged(cells, "product_category", F.count("user_id").alias("unique_buyers"))
        .select(
            "product_category",
            F.col("n").alias("transaction_count"),
            _mean_value().alias("avg_transaction_value"),
            _revenue().alias("total_revenue"),
            _mean_quantity().alias("avg_quantity"),
            "unique_buyers",
        )
        .orderBy(F.desc("total_revenue"), "product_category")
    )


def time_from_cells(cells: DataFrame) -> DataFrame:
    """From cells whose keys include ``time_of_day``."""
    return (
        _merged(cells, "time_of_day")
        .select(
            "time_of_day",
            F.col("n").alias("transaction_count"),
            _mean_value().alias("avg_transaction_value"),
            _revenue().alias("total_revenue"),
        )
        .orderBy(F.desc("transaction_count"), "time_of_day")
    )


def user_from_cells(cells: DataFrame) -> DataFrame:
    """From cells whose keys include ``user_id``; users with one transaction are left out."""
    return (
        _merged(cells, "user_id")
        .filter(F.col("n") > 1)
        .select(
            "user_id",
            F.col("n").alias("total_transactions"),
            _revenue().alias("total_spent"),
            _mean_value().alias("avg_transaction"),
            F.col("fraud_sum").alias("fraud_count"),
        )
        .orderBy(F.desc("total_spent"), "user_id")
    )


def region_stats(df: DataFrame) -> DataFrame:
    """Per region: volume, value, revenue and fraud; highest revenue first."""
    return region_from_cells(sales_cells(df, ["region"]))


def category_stats(df: DataFrame) -> DataFrame:
    """Per product category: volume, value, revenue and exact number of buyers."""
    return category_from_cells(sales_cells(df, ["user_id", "product_category"]))


def approximate_buyers(df: DataFrame, error: float = 0.02) -> DataFrame:
    """Per product category the number of buyers, off by ``error`` (a standard deviation): one
    small sketch per category instead of a row per buyer.  An opt-in; never chosen by size."""
    return df.groupBy("product_category").agg(F.approx_count_distinct("user_id", error).alias("unique_buyers"))


def time_stats(df: DataFrame) -> DataFrame:
    """Per part of the day: volume, value and revenue; busiest first."""
    return time_from_cells(sales_cells(df, ["time_of_day"]))


def user_stats(df: DataFrame) -> DataFrame:
    """Per user with more than one transaction: volume, spending and fraud."""
    return user_from_cells(sales_cells(df, ["user_id"]))


SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "region_stats": region_stats,
    "category_stats": category_stats,
    "time_stats": time_stats,
    "user_stats": user_stats,
}

# Which cells the batch job makes, and the summaries that come from them.
SHARED_CELLS: dict[str, tuple[list[str], dict[str, Callable[[DataFrame], DataFrame]]]] = {
    "by_region_and_time": (
        ["region", "time_of_day"],
        {"region_stats": region_from_cells, "time_stats": time_from_cells},
    ),
    "by_user_and_category": (
        ["user_id", "product_category"],
        {"category_stats": category_from_cells, "user_stats": user_from_cells},
    ),
}
