import math

import pytest
from pyspark.sql import functions as F

from tests.test_cleaning import variants
from txflow.operators.cleaning import clean_transactions
from txflow.operators.features import FEATURE_NAMES, engineer_features, features


def by_value(spark, column, values, feature):
    rows = engineer_features(variants(spark, column, values)).orderBy("transaction_id").collect()
    return [r[feature] for r in rows]


@pytest.mark.parametrize(
    "column, feature, cases",
    [
        ("day_of_week", "is_weekend", {0: False, 4: False, 5: True, 6: True}),
        ("hour_of_day", "is_peak_hour", {9: False, 10: True, 20: True, 21: False}),
        (
            "hour_of_day",
            "time_of_day",
            {0: "Night", 5: "Night", 6: "Morning", 11: "Morning", 12: "Afternoon", 17: "Afternoon", 18: "Evening"},
        ),
        (
            "amount",
            "price_tier",
            {
                24.99: "Budget",
                25.0: "Mid-Range",
                99.99: "Mid-Range",
                100.0: "Premium",
                499.99: "Premium",
                500.0: "Luxury",
            },
        ),
        ("total", "is_high_value", {500.0: False, 500.01: True}),
        ("quantity", "bulk_purchase", {9: False, 10: True}),
        ("hour_of_day", "is_late_night", {0: True, 4: True, 5: False, 23: False}),
        ("total", "amount_per_item", {10.0: 5.0, 0.01: 0.01, 20.01: 10.01}),
    ],
)
def test_boundaries(spark, column, feature, cases):
    assert by_value(spark, column, list(cases), feature) == list(cases.values())


def test_logarithm(spark):
    assert by_value(spark, "total", [math.e - 1, 0.01], "log_total") == pytest.approx([1.0, math.log(1.01)])


def test_risk_needs_both(spark):
    hours = variants(spark, "hour_of_day", [3, 3, 12])
    totals = F.element_at(F.array(F.lit(600.0), F.lit(500.0), F.lit(600.0)), (F.col("transaction_id") + 1).cast("int"))
    rows = engineer_features(hours.withColumn("total", totals)).orderBy("transaction_id").collect()
    assert [r.high_risk_flag for r in rows] == [True, False, False]


def test_zero_quantity_gives_no_price_instead_of_an_error(spark):
    assert by_value(spark, "quantity", [0], "amount_per_item") == [None]


def test_shape(spark):
    clean = clean_transactions(variants(spark, "amount", [1.0, 2.0]))
    featured = engineer_features(clean)
    assert featured.columns == [*clean.columns, *FEATURE_NAMES]
    assert len(featured.columns) == 21
    assert list(features()) == FEATURE_NAMES
    assert featured.count() == clean.count()
