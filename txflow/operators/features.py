"""The ten features of a clean transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.schemas import (
    BULK_QUANTITY,
    DAY_PARTS,
    HIGH_VALUE_ABOVE,
    LAST_DAY_PART,
    LAST_PRICE_TIER,
    LATE_NIGHT_HOURS,
    PEAK_HOURS,
    PRICE_TIERS,
    WEEKEND_DAYS,
)

FEATURE_NAMES = [
    "is_weekend",
    "is_peak_hour",
    "time_of_day",
    "price_tier",
    "is_high_value",
    "bulk_purchase",
    "amount_per_item",
    "log_total",
    "is_late_night",
    "high_risk_flag",
]


def _bucket(value: Column, upper_bounds: list[tuple[int, str]], last: str) -> Column:
    """Label of the first bound that ``value`` is below."""
    (bound, label), *rest = upper_bounds
    labels = F.when(value < bound, label)
    for bound, label in rest:
        labels = labels.when(value < bound, label)
    return labels.otherwise(last)


def features() -> dict[str, Column]:
    hour, total, quantity = F.col("hour_of_day"), F.col("total"), F.col("quantity")
    late_night = hour.isin(LATE_NIGHT_HOURS)
    high_value = total > HIGH_VALUE_ABOVE
    return {
        "is_weekend": F.col("day_of_week").isin(WEEKEND_DAYS),
        "is_peak_hour": hour.between(*PEAK_HOURS),
        "time_of_day": _bucket(hour, DAY_PARTS, LAST_DAY_PART),
        "price_tier": _bucket(F.col("amount"), PRICE_TIERS, LAST_PRICE_TIER),
        "is_high_value": high_value,
        "bulk_purchase": quantity >= BULK_QUANTITY,
        "amount_per_item": F.round(F.try_divide(total, quantity), 2),
        "log_total": F.ln(total + 1),
        "is_late_night": late_night,
        "high_risk_flag": late_night & high_value,
    }


def engineer_features(df: DataFrame) -> DataFrame:
    """All input columns and the ten features, in a single projection."""
    return df.withColumns(features())
