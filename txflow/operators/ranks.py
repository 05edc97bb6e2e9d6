"""Running totals and exact percentiles without putting one group into one task.

A group's values are cut into blocks of adjacent values.  Totals per block are few, so a
window over them is cheap even for a group that holds most of the table; the rows
themselves are only ever ordered inside one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 20
#: Blocks of one coarse block: the windows over block totals never hold more of them.
COARSE_BITS = 12


def _by(keys: list[str]) -> list:
    return list(keys) or [F.lit(0)]


def required(value: Column, kind: T.DataType, name: str) -> Column:
    """``value``, known to the optimizer not to be null: an error is raised if it is.  The last
    alternative is never reached."""
    missing = F.raise_error(F.lit(f"{name} is null")).cast(kind)
    return F.coalesce(value, missing, F.lit(0).cast(kind))


def block_of(value: str, bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(F.col(value), bits)


def _not_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    """State that join columns are never null; a null ends the job with an error.  Otherwise
    Spark filters nulls out of one side of the self-join only, takes the sides for different
    plans and computes both."""
    types = rows.schema
    return rows.withColumns({c: required(F.col(c), types[c].dataType, c) for c in columns})


def block_totals(rows: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Per key and block: the block's weight, the weight before it and the key's weight.

    Blocks are added up once more in coarse blocks, so that a key whose values span many
    blocks (a year of latencies) is not ordered in one task: that task orders coarse blocks
    only, and blocks are ordered inside their coarse one.
    """
    blocks = rows.groupBy(*keys, "block").agg(F.sum(weight).alias("block_weight"))
    blocks = blocks.withColumn("coarse", F.shiftright("block", COARSE_BITS))
    ordered = Window.partitionBy(*_by(keys)).orderBy("coarse")
    coarse = (
        blocks.groupBy(*keys, "coarse")
        .agg(F.sum("block_weight").alias("coarse_weight"))
        .withColumns(
            {
                "coarse_before": F.coalesce(
                    F.sum("coarse_weight").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "key_weight": F.sum("coarse_weight").over(Window.partitionBy(*_by(keys))),
            }
        )
    )
    inside = Window.partitionBy(*_by(keys), "coarse").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("coarse_before") + F.coalesce(F.sum("block_weight").over(inside), F.lit(0))
    return (
        blocks.join(coarse, [*keys, "coarse"])
        .withColumn("before", before)
        .select(*keys, "block", "block_weight", "before", "key_weight")
    )


def running_within_blocks(rows: DataFrame, totals: DataFrame, keys: list[str], order: str, weight: str) -> DataFrame:
    """``running``: total weight up to and including each row, by ``order``."""
    inside = (
        Window.partitionBy(*keys, "block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = rows.join(totals, [*keys, "block"])
    return joined.withColumn("running", F.col("before") + F.sum(weight).over(inside))


def running_total(rows: DataFrame, order: str, weight: str, bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` (one per ``order`` value, none null) with ``running``, over the whole table."""
    blocked = _not_null(rows, [order]).withColumn("block", block_of(order, bits))
    totals = block_totals(blocked, [], weight)
    return running_within_blocks(blocked, totals, [], order, weight).drop(
        "block", "block_weight", "before", "key_weight"
    )


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, float],
    weight: str | None = None,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Per key, the value at 0-based position ``min(floor(p * n), n - 1)`` for each rank.

    ``value`` is a long; it and the keys hold no nulls.  Input that is already counted, one row per key and
    value, names its count in ``weight``.
    """
    known = _not_null(df, [*keys, value])
    counted = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")) if weight is None else known
    counted = counted.select(*keys, value, F.col(weight or "n").alias("n"), block_of(value, bits).alias("block"))

    def position(rank: float) -> Column:
        return F.least(F.floor(F.lit(rank) * F.col("key_weight")), F.col("key_weight") - 1)

    wanted = F.lit(False)
    for rank in ranks.values():
        spot = position(rank)
        wanted = wanted | ((spot >= F.col("before")) & (spot < F.col("before") + F.col("block_weight")))
    # Only the blocks that hold a wanted position go on; the others are never ordered.
    totals = block_totals(counted, keys, "n").filter(wanted)
    ordered = running_within_blocks(counted, totals, keys, value, "n")
    return ordered.groupBy(*keys).agg(
        *[F.min(F.when(F.col("running") > position(rank), F.col(value))).alias(name) for name, rank in ranks.items()]
    )


def approximate_percentiles(
    df: DataFrame, keys: list[str], value: str, ranks: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Per key, a value whose rank is off by at most ``1 / accuracy`` of the rows: one shuffle
    of small sketches.  For windows so large that exact ranks cost too much; never chosen for
    the caller.  A rank of 1 is the exact maximum."""
    picked = F.percentile_approx(value, [min(1.0, r) for r in ranks.values()], accuracy).alias("picked")
    found = df.groupBy(*keys).agg(picked, F.max(value).alias("most"))
    columns = [
        (F.col("most") if rank >= 1 else F.col("picked")[i]).alias(name) for i, (name, rank) in enumerate(ranks.items())
    ]
    return found.select(*keys, *columns)
