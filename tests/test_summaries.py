import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tests.compare import spark_rows
from tests.test_cleaning import variants
from txflow.functions.money import money_mean, money_sum
from txflow.operators.cleaning import clean_transactions
from txflow.operators.features import engineer_features
from txflow.operators.summaries import approximate_buyers, SHARED_CELLS, SUMMARIES, region_stats, sales_cells, user_stats
from txflow.sources.synthetic import synthesize_range


def cents(value: Decimal) -> float:
    return float(value.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_money_is_exact(spark):
    rng = random.Random(3)
    rows, groups = [], {}
    for g in range(60):
        for _ in range(rng.randint(1, 40)):
            text = f"{rng.choice([-1, 1, 1]) * rng.randint(0, 99_999_999)}.{rng.randint(0, 999):03d}"
            rows.append((g, float(text)))
            groups.setdefault(g, []).append(Decimal(text))
    df = spark.createDataFrame(rows, "g int, x double").repartition(7)
    for r in df.groupBy("g").agg(money_sum(F.col("x")).alias("s"), money_mean(F.col("x")).alias("m")).collect():
        values = groups[r.g]
        assert r.s == cents(sum(values))
        assert r.m == cents(sum(values) / len(values))


def test_money_ties_round_up(spark):
    df = spark.createDataFrame([(0.01,), (0.02,)], "x double")
    assert df.agg(money_mean(F.col("x"))).first()[0] == 0.02
    assert spark.createDataFrame([(1.005,)], "x double").agg(money_sum(F.col("x"))).first()[0] == 1.01


def test_money_with_values_that_do_not_fit(spark):
    def of(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return tuple(df.agg(money_sum(F.col("x")), money_mean(F.col("x"))).first())

    assert of(None, None) == (None, None)
    assert of(1.5, None, 2.0) == (3.5, 1.75)
    assert of(math.inf, 1.0) == (math.inf, math.inf)
    assert math.isnan(of(math.nan, 1.0)[0])
    assert of(1e20, 1e20) == (2e20, 1e20)
    assert of(9e14, 9e14, 9e14) == (2.7e15, 9e14)


def featured(spark, column, values):
    return engineer_features(clean_transactions(variants(spark, column, values)))


def test_unknown_fraud_flags_do_not_count(spark):
    row = region_stats(featured(spark, "is_fraud", ["True", "False", None, None])).first()
    assert (row.transaction_count, row.fraud_count, row.fraud_rate_pct) == (4, 1, 50.0)
    row = region_stats(featured(spark, "is_fraud", [None, None])).first()
    assert (row.transaction_count, row.fraud_count, row.fraud_rate_pct) == (2, None, None)


def test_null_region_is_a_group(spark):
    rows = region_stats(featured(spark, "region", [None, "North", None])).collect()
    assert [(r.region, r.transaction_count, r.total_revenue) for r in rows] == [(None, 2, 40.0), ("North", 1, 20.0)]


def test_users_with_one_transaction_are_left_out(spark):
    rows = user_stats(featured(spark, "user_id", [1, 2, 2, 3, 3, 3])).collect()
    assert [(r.user_id, r.total_transactions, r.total_spent) for r in rows] == [(3, 3, 60.0), (2, 2, 40.0)]


def test_summaries_do_not_depend_on_partitioning(spark):
    df = engineer_features(clean_transactions(synthesize_range(spark, 5000)))
    for summarize in SUMMARIES.values():
        assert summarize(df.coalesce(1)).collect() == summarize(df.repartition(13)).collect()


def test_shared_cells_give_the_same_summaries(spark):
    df = engineer_features(clean_transactions(synthesize_range(spark, 5000)))
    for keys, finishers in SHARED_CELLS.values():
        cells = sales_cells(df, keys)
        for name, finish in finishers.items():
            assert spark_rows(finish(cells)) == spark_rows(SUMMARIES[name](df))


def test_sorted_by_the_leading_measure(spark):
    df = engineer_features(clean_transactions(synthesize_range(spark, 5000)))
    for name, measure in {
        "region_stats": "total_revenue",
        "category_stats": "total_revenue",
        "time_stats": "transaction_count",
        "user_stats": "total_spent",
    }.items():
        values = [r[measure] for r in SUMMARIES[name](df).collect()]
        assert values == sorted(values, reverse=True)


def test_money_has_no_limit_and_loses_no_digits(spark):
    def total(values, partitions):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
        return df.agg(money_sum(F.col("x")), money_mean(F.col("x"))).first()

    for partitions in (1, 7):
        assert tuple(total([9e14] * 20_000, partitions)) == (1.8e19, 9e14)
        assert total([1e-7] * 1_000_000, partitions)[0] == 0.1
        mixed = [1e15, 0.01, -1e15, 0.02, 123456789.99, -0.03]
        assert total(mixed, partitions)[0] == 123456789.99
        assert total(mixed[::-1], partitions)[0] == 123456789.99
        assert total([1e25, 1.0, -1e25, 0.25], partitions)[0] == 1.25
    assert total([-1.0, 0.005], 1)[0] == -1.0  # -0.995, half away from zero


def test_approximate_buyers_are_close(spark):
    df = spark.range(40_000).select((F.col("id") % 20_000).alias("user_id"), F.lit("Food").alias("product_category"))
    assert abs(approximate_buyers(df).first().unique_buyers - 20_000) < 2_000
