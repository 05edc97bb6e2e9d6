"""Time as whole microseconds since the epoch, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txflow.schemas import MICROS


def size_micros(seconds: float) -> int:
    micros = round(seconds * MICROS)
    if micros <= 0:
        raise ValueError(f"window size must be positive, got {seconds}")
    return micros


#: The latest and, negated, the earliest second whose microseconds fit in 64 bits.
MOST_SECONDS = 9.223372036854775e12


def holds_time(seconds: Column) -> Column:
    """The seconds are missing or can be held as microseconds; NaN and infinity cannot."""
    return seconds.isNull() | (F.abs(seconds) <= MOST_SECONDS)


def seconds_to_micros(seconds: Column) -> Column:
    """Fractional seconds to the nearest microsecond; null if they cannot be held."""
    return F.when(F.abs(seconds) <= MOST_SECONDS, F.rint(seconds * MICROS)).cast("long")


def micros_to_seconds(micros: Column) -> Column:
    return micros / F.lit(float(MICROS))


def window_index(micros: Column, size: float) -> Column:
    """Number of the tumbling window, epoch-aligned; truncates toward zero."""
    return F.call_function("div", micros, F.lit(size_micros(size)))


def ntz_micros(ts: Column) -> Column:
    """Wall-clock micros of a ``timestamp_ntz`` without a detour through any zone."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * MICROS + (F.date_part(F.lit("SECOND"), ts) * MICROS).cast("long")
