"""Money sums that do not depend on partitioning.

A sum of doubles changes in its last bits with the order of the rows, so the same job
can round to another cent on another cluster.  Here an amount is split into five whole
parts - multiples of 2**60 and 2**30, units, millionths and what is left in 1e-15 - each
summed as a long: exact, order-free and mergeable, from 1e-15 up to 2**90 (1.2e27), for
2**33 rows of any size.  NaN, infinity and still larger doubles, which are no money, go to
a sixth, double sum, which is null when there are none and makes the result their sum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMIT = float(1 << 90)
_BIG, _MID = float(1 << 60), float(1 << 30)
#: What is left below a millionth counts if it exceeds the error of the double itself.
_NOISE = 1e-15
PARTS = ("big", "mid", "whole", "millionths", "rest", "odd")


def split_amount(amount: Column) -> dict[str, Column]:
    """One amount as the columns that ``money_sum`` and ``money_mean`` add up.  Divisions by
    powers of two and what they leave are exact in doubles."""
    fits = F.abs(amount) < _LIMIT
    held = F.when(fits, amount)
    big = (held / F.lit(_BIG)).cast("long")
    below = held - big * F.lit(_BIG)
    mid = (below / F.lit(_MID)).cast("long")
    units = below - mid * F.lit(_MID)
    whole = units.cast("long")
    millionths = F.rint((units - whole) * 1e6)
    left = (units - whole) - millionths * 1e-6
    return {
        "big": big,
        "mid": mid,
        "whole": whole,
        "millionths": millionths.cast("long"),
        "rest": F.when(F.abs(left) > F.abs(held) * _NOISE, F.rint(left * 1e15)).otherwise(F.when(fits, 0.0)).cast("long"),
        "odd": F.when(~fits, amount),
    }


def sum_parts(parts: dict[str, Column]) -> dict[str, Column]:
    return {name: F.sum(parts[name]) for name in PARTS}


def parts_of(prefix: str) -> dict[str, Column]:
    """The parts as stored under ``prefix`` in a partly aggregated table."""
    return {name: F.col(f"{prefix}_{name}") for name in PARTS}


def aliased_parts(parts: dict[str, Column], prefix: str) -> list[Column]:
    return [parts[name].alias(f"{prefix}_{name}") for name in PARTS]


def _whole(sums: dict[str, Column]) -> Column:
    """Units of the total, as a decimal without a fraction."""
    wide = "decimal(38,0)"
    big = (sums["big"].cast("decimal(19,0)") * Decimal(1 << 60)).cast(wide)
    mid = (sums["mid"].cast("decimal(19,0)") * Decimal(1 << 30)).cast(wide)
    return (big + mid + sums["whole"].cast(wide)).cast(wide)


def _fraction(sums: dict[str, Column]) -> Column:
    """What the parts below one add up to, in 1e-15."""
    millionths = (sums["millionths"].cast("decimal(19,0)") * Decimal(10**9)).cast("decimal(29,0)")
    return (millionths + sums["rest"].cast("decimal(19,0)")).cast("decimal(30,0)")


#: Below this, cents matter in a double and the whole total fits in 38 digits of 1e-15.
_EXACT = Decimal(10**20)


def _units(sums: dict[str, Column]) -> Column:
    """The total in 1e-15, for totals below ``_EXACT``."""
    whole = _whole(sums)
    held = F.when(F.abs(whole) < _EXACT, whole).cast("decimal(20,0)")
    return ((held * Decimal(10**15)).cast("decimal(36,0)") + _fraction(sums)).cast("decimal(37,0)")


def _double(sums: dict[str, Column]) -> Column:
    """The total as a double, where cents are far below its precision."""
    return _whole(sums).cast("double") + _fraction(sums).cast("double") * 1e-15


def _with_odd(sums: dict[str, Column]) -> Column:
    return F.coalesce(_double(sums), F.lit(0.0)) + sums["odd"]


def money_total(sums: dict[str, Column]) -> Column:
    """Summed parts as a double rounded half-up to cents."""
    return _cents(sums, F.lit(1).cast("long"))


def money_average(sums: dict[str, Column], n: Column) -> Column:
    """Summed parts over ``n`` as a double rounded half-up to cents.

    The quotient is taken on integers, since a double quotient loses exact ties.
    """
    return F.when(n > 0, _cents(sums, n))


def _cents(sums: dict[str, Column], n: Column) -> Column:
    total = _units(sums)
    per_cent = (n.cast("decimal(19,0)") * Decimal(10**13)).cast("decimal(33,0)")
    size = F.abs(total).cast("decimal(37,0)")
    over = (size % per_cent).cast("decimal(33,0)")
    down = ((size - over).cast("decimal(37,0)") / per_cent).cast("decimal(24,0)")
    cents = F.when(over * 2 >= per_cent, down + 1).otherwise(down).cast("double")
    exact = F.signum(total) * cents / F.lit(100.0)
    return (
        F.when(sums["odd"].isNotNull(), F.round(_with_odd(sums) / n, 2))
        .when(total.isNotNull(), exact)
        .otherwise(F.round(_double(sums) / n, 2))
    )


def money_sum(amount: Column) -> Column:
    """Aggregate: exact sum of ``amount``, rounded to cents; nulls are skipped."""
    return money_total(sum_parts(split_amount(amount)))


def money_mean(amount: Column) -> Column:
    """Aggregate: exact mean of ``amount``, rounded to cents; nulls are skipped."""
    return money_average(sum_parts(split_amount(amount)), F.count(amount))
