"""Events from JSON lines, bounded or as a stream.

Lines are read as text and parsed once.  The JSON reader would judge only the columns a
query happens to select, so the same line could be corrupt for one query and fine for the
next; and it accepts anything after the first object.  Here a line is valid when it is
one whole JSON object whose known fields have the right types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.functions.timing import holds_time, seconds_to_micros
from txflow.schemas import EVENT_SCHEMA
from txflow.sources.growing import RANGE_BYTES, GrowingLines


def _parsed(line: Column, schema: T.StructType) -> Column:
    """Array with the line's record, empty if the line is corrupt.

    The line is parsed inside an outer object that has a field after it, so that a cut
    line or a line with something behind its object breaks the outer one. A line that closes
    its object early and opens more fields would add to the outer object's keys, which are
    checked. A time that cannot be held as 64-bit microseconds makes the line corrupt too.
    """
    outer = T.StructType(
        [
            T.StructField("record", schema),
            T.StructField("complete", T.BooleanType()),
            T.StructField("bad", T.StringType()),
        ]
    )
    options = {"columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false"}
    text = F.concat(F.lit('{"record":'), line, F.lit(',"complete":true}'))
    times = [f.name for f in schema.fields if f.name in ("timestamp", "arrival")]

    def whole(e: Column) -> Column:
        held = e["bad"].isNull() & e["record"].isNotNull() & F.coalesce(e["complete"], F.lit(False))
        for name in times:
            held = held & holds_time(e["record"][name])
        return held & F.coalesce(F.json_object_keys(text) == F.array(F.lit("record"), F.lit("complete")), F.lit(False))

    kept = F.filter(F.array(F.from_json(text, outer, options)), whole)
    return F.transform(kept, lambda e: e["record"])


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    return _nonblank(spark.read.text(path))


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New files of a directory, as they appear."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _nonblank(reader.text(path))


def tail_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines as they are appended to a file, or to the files of a directory."""
    spark.dataSource.register(GrowingLines)
    return _nonblank(spark.readStream.format("growing_lines").option("rangeBytes", range_bytes).load(path))


def _nonblank(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").rlike(r"\S"))


def parse_events(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The valid events.  ``inline`` keeps the parse at one per line: a filter on the parsed
    struct would be pushed below the projection and parse again."""
    return lines.select(F.inline(_parsed(F.col("value"), schema)))


def mark_corrupt(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Every raw line with ``is_corrupt``."""
    return lines.select(
        F.col("value").alias("line"),
        (F.size(_parsed(F.col("value"), schema)) == 0).alias("is_corrupt"),
    )


def split_lines(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Every raw line with ``is_corrupt`` and its fields, which a corrupt line has not.

    Both sides of the split come from one parse; write it partitioned by ``is_corrupt``
    to have them apart.
    """
    parsed = lines.select(F.col("value").alias("line"), _parsed(F.col("value"), schema).alias("event"))
    return parsed.select("line", (F.size("event") == 0).alias("is_corrupt"), "event").select(
        "line", "is_corrupt", F.inline_outer("event")
    )


def line_quality(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Number of lines, number of corrupt ones and their share."""
    return (
        mark_corrupt(lines, schema)
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if("is_corrupt").alias("corrupt_lines"))
        .withColumn("error_rate", F.try_divide("corrupt_lines", "lines"))
    )


def scan_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    return parse_events(scan_lines(spark, path), schema)


def stream_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENT_SCHEMA,
    files_per_batch: int | None = None,
) -> DataFrame:
    return parse_events(stream_lines(spark, path, files_per_batch), schema)


def tail_events(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Events as they are appended to a file, or to the files of a directory."""
    return parse_events(tail_lines(spark, path, range_bytes), schema)


def with_clock(events: DataFrame) -> DataFrame:
    """Replace ``timestamp`` and ``arrival`` by ``event_us`` and ``arrival_us``.

    A live stream has no ``arrival``: it is the time of the micro-batch then.  A recorded
    event without one arrived when it happened.
    """
    event, now = seconds_to_micros(F.col("timestamp")), F.unix_micros(F.current_timestamp())
    recorded = "arrival" in events.columns
    arrival = F.coalesce(seconds_to_micros(F.col("arrival")), event, now) if recorded else now
    return events.withColumns({"event_us": event, "arrival_us": arrival}).drop("timestamp", "arrival")
