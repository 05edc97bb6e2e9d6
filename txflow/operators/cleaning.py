"""Which transactions are valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL = ["transaction_id", "user_id", "amount", "total"]


def _present(name: str) -> Column:
    # NaN is missing too; NaN > 0 holds in Spark, so the sign rules would let it pass.
    field = F.col(name)
    return field.isNotNull() & ~F.isnan(field) if name in ("amount", "total") else field.isNotNull()


def drop_missing(df: DataFrame) -> DataFrame:
    return df.dropna(subset=CRITICAL)


def parse_fraud_flag(df: DataFrame) -> DataFrame:
    """``is_fraud`` as a boolean: only the exact text ``True`` is true, null stays null."""
    return df.withColumn("is_fraud", F.col("is_fraud") == "True")


def rules() -> dict[str, Column]:
    """The named conditions a transaction has to meet."""
    return {
        "critical_fields": _all([_present(name) for name in CRITICAL]),
        "amount": F.col("amount") > 0,
        "quantity": F.col("quantity") > 0,
        "total": F.col("total") > 0,
        "hour_of_day": F.col("hour_of_day").between(0, 23),
        "day_of_week": F.col("day_of_week").between(0, 6),
    }


def _all(conditions: list[Column]) -> Column:
    met = conditions[0]
    for condition in conditions[1:]:
        met = met & condition
    return met


def keep_where(df: DataFrame, rule: str) -> DataFrame:
    return df.filter(rules()[rule])


def clean_transactions(df: DataFrame) -> DataFrame:
    """Valid transactions with a boolean fraud flag, in one filter over the scan.

    Null region, category, payment method and fraud flag are valid.
    """
    return parse_fraud_flag(df.filter(_all(list(rules().values()))))


def clean_report(df: DataFrame) -> DataFrame:
    """Rows before, after and removed, and how many rows break each rule (a row may break
    several); one pass, one row."""
    failed = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules().items()}
    valid = F.coalesce(_all(list(rules().values())), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(valid).alias("rows_after"),
        F.count_if(~valid).alias("rows_removed"),
        *[F.count_if(broken).alias(f"failed_{name}") for name, broken in failed.items()],
    )
