"""Places of rows in an order over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.llm.common import stored

#: ``monotonically_increasing_id`` has the partition above these bits and the row below.
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str, number: str = "number") -> DataFrame:
    """``df`` with 1, 2, 3... in the given order as the column ``number``.

    Ranges of the order are sorted side by side and written; only their sizes, one row for each
    range, are summed up in one place. The order has to tell rows apart where a great many would
    share a key, as rows with one key stay in one range.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    sizes = rows.groupBy(F.shiftright("_at", _ROW_BITS).alias("_range")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    joined = rows.withColumn("_range", F.shiftright("_at", _ROW_BITS)).join(F.broadcast(before), "_range")
    return joined.withColumn(number, F.col("_before") + own + 1).select(*df.columns, number)
