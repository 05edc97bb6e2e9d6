import math

from txflow.operators.cleaning import clean_report, clean_transactions, drop_missing, keep_where, parse_fraud_flag, rules
from txflow.schemas import TRANSACTION_SCHEMA

GOOD = (1, 7, "Food", "North", 10.0, 2, 20.0, "Cash", 3, 12, "False")
COLUMNS = TRANSACTION_SCHEMA.fieldNames()


def variants(spark, column, values):
    """One good row per value, with ``column`` replaced; transaction_id numbers them."""
    rows = []
    for i, value in enumerate(values):
        row = dict(zip(COLUMNS, GOOD)) | {"transaction_id": i} | {column: value}
        rows.append(tuple(row[c] for c in COLUMNS))
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def kept(df, column):
    return [r[column] for r in df.orderBy("transaction_id").collect()]


def test_missing_critical_fields_are_dropped(spark):
    assert kept(clean_transactions(variants(spark, "transaction_id", [None, 5])), "transaction_id") == [5]
    assert kept(clean_transactions(variants(spark, "user_id", [None, 5])), "user_id") == [5]
    for column in ("amount", "total"):
        df = variants(spark, column, [None, math.nan, 0.0, -1.0, 0.01, math.inf])
        assert kept(clean_transactions(df), column) == [0.01, math.inf]
        assert kept(drop_missing(df), column) == [0.0, -1.0, 0.01, math.inf]


def test_range_rules(spark):
    assert kept(clean_transactions(variants(spark, "quantity", [None, 0, -1, 1, 9, 10])), "quantity") == [1, 9, 10]
    hours = [None, -1, 0, 4, 23, 24]
    assert kept(clean_transactions(variants(spark, "hour_of_day", hours)), "hour_of_day") == [0, 4, 23]
    days = [None, -1, 0, 6, 7]
    assert kept(clean_transactions(variants(spark, "day_of_week", days)), "day_of_week") == [0, 6]


def test_fraud_flag_is_case_sensitive_and_keeps_null(spark):
    df = variants(spark, "is_fraud", ["True", "true", "False", "", None])
    expected = [True, False, False, False, None]
    assert kept(parse_fraud_flag(df), "is_fraud") == expected
    assert kept(clean_transactions(df), "is_fraud") == expected


def test_null_dimensions_are_kept(spark):
    for column in ("region", "product_category", "payment_method"):
        assert kept(clean_transactions(variants(spark, column, [None, "x"])), column) == [None, "x"]


def test_whole_stage_is_the_rules_together(spark):
    df = variants(spark, "amount", [None, math.nan, -1.0, 1.0])
    step = df
    for rule in rules():
        step = keep_where(step, rule)
    assert parse_fraud_flag(step).collect() == clean_transactions(df).collect()


def test_report_counts_each_broken_rule(spark):
    df = variants(spark, "amount", [None, math.nan, -1.0, 1.0]).unionByName(variants(spark, "hour_of_day", [24, 5]))
    report = clean_report(df).first().asDict()
    assert report == {
        "rows_before": 6,
        "rows_after": 2,
        "rows_removed": 4,
        "failed_critical_fields": 2,
        # NaN > 0 holds in Spark; NaN is caught as a missing field.
        "failed_amount": 2,
        "failed_quantity": 0,
        "failed_total": 0,
        "failed_hour_of_day": 1,
        "failed_day_of_week": 0,
    }
