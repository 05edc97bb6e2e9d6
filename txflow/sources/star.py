"""Transactions and events assembled from the test tables (a star schema and ``events``).

Joins carry no hints: Spark broadcasts a dimension only when its measured size is below
the threshold, sorts and merges otherwise, and splits a hot key's partition at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions.timing import micros_to_seconds, ntz_micros
from txflow.schemas import MICROS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; some values are broken on purpose so that cleaning
    has something to do."""
    buyers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    sold = (
        table(spark, sf_dir, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderpriority", "r_name")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    cents = F.floor(F.col("l_extendedprice") * 5 / F.col("l_quantity")).cast("long")
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("uc", cents)
        .join(sold, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("p_type").alias("product_category"),
            F.when(F.col("l_suppkey") != 7, F.col("r_name")).alias("region"),
            F.when(F.col("l_partkey") % 97 != 0, F.col("uc") / F.lit(100.0)).alias("amount"),
            F.when(F.col("l_partkey") % 89 == 1, 0)
            .otherwise(F.col("l_quantity").cast("int"))
            .alias("quantity"),
            (F.col("uc") * F.col("l_quantity").cast("long") / F.lit(100.0)).alias("total"),
            F.col("o_orderpriority").alias("payment_method"),
            F.weekday("l_shipdate").alias("day_of_week"),
            F.when(F.col("l_suppkey") == 13, 24)
            .otherwise(((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5 + F.col("l_partkey")) % 24).cast("int"))
            .alias("hour_of_day"),
            F.when(
                F.col("l_partkey") % 83 != 2,
                F.when((F.col("l_orderkey") * 31 + F.col("l_partkey")) % 50 == 0, "True").otherwise("False"),
            ).alias("is_fraud"),
        )
    )


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``event_us`` and ``arrival_us``; every 20th arrives 90 minutes late."""
    event_id, unit = F.col("event_id"), F.round(F.col("value") * 100).cast("long")
    delay = F.when(event_id % 20 == 0, 5400).otherwise(event_id % 7) * MICROS + event_id % 1000
    return (
        table(spark, sf_dir, "events")
        .withColumn("event_us", ntz_micros(F.col("ts")))
        .select(
            "event_id",
            "user_id",
            F.col("event_type").alias("product_category"),
            F.when(event_id % 41 != 3, F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string"))).alias("region"),
            (unit / F.lit(100.0)).alias("amount"),
            (event_id % 20 + 1).cast("int").alias("quantity"),
            (unit * (event_id % 20 + 1) / F.lit(100.0)).alias("total"),
            F.concat(F.lit("M"), (event_id % 3).cast("string")).alias("payment_method"),
            (event_id % 50 == 0).alias("is_fraud"),
            "event_us",
            (F.col("event_us") + delay).alias("arrival_us"),
        )
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON lines with ``timestamp`` and ``arrival`` in seconds.

    Null fields are left out of the JSON object, as a producer would.
    """
    events = timed_events(spark, sf_dir)
    fields = [c for c in events.columns if c not in ("event_us", "arrival_us")]
    record = F.struct(
        *fields,
        micros_to_seconds(F.col("event_us")).alias("timestamp"),
        micros_to_seconds(F.col("arrival_us")).alias("arrival"),
    )
    return events.select("event_id", "arrival_us", F.to_json(record).alias("value"))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines with some of them cut, mistyped, doubled, continued or blank."""
    line, event_id = F.col("value"), F.col("event_id")
    return event_lines(spark, sf_dir).select(
        F.when(event_id % 31 == 1, F.substring(line, 1, 25))
        .when(event_id % 37 == 2, F.regexp_replace(line, '"event_id":', '"event_id":"x","id":'))
        .when(event_id % 43 == 3, F.lit("5"))
        .when(event_id % 47 == 4, F.concat(line, line))
        .when(event_id % 53 == 5, F.lit("   "))
        .when(event_id % 59 == 6, F.regexp_replace(line, '"total":', '"total":true,"was":'))
        .when(event_id % 61 == 7, F.concat(line, F.lit(',"x":1')))
        .when(event_id % 67 == 8, F.concat(line, F.lit(',"record":'), line))
        .otherwise(line)
        .alias("value")
    )
