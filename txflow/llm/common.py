"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.sinks.scratch import scratch_dir

#: Java pattern of the white space that separates words: space, tab, LF, VT, FF, CR.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Removes the shuffle files of a query at its end; else they stay until the driver's JVM collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries run here leave no shuffle files, unless the session has a setting of its own."""
    if spark.conf.get(SHUFFLES_GO, None) is not None:
        yield
        return
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: cuts the lineage, and a
    lost executor costs only its running tasks. What was shuffled for it is removed once it is
    written, so disk holds the tables and one query's shuffles, not those of all before it."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with _shuffles_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove ``stored`` tables that nothing reads any more: what was made of them is written."""
    for table_ in tables:
        jvm = table_.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table_.stored_at)
        path.getFileSystem(table_.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str | Column, most: int) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` labelled rows to learn from, the same at each run: of the
    ids in ``docs`` that have a label those that hash lowest. Held-out ids, null ids and null labels
    are left out. Of several labels of an id the greatest counts, of several texts the least.

    The rows to take are chosen on narrow tables; their number is bounded by ``most``, so the
    join may broadcast them, and the texts never reach the driver.
    """
    y = F.col(label) if isinstance(label, str) else label
    chosen = (
        labels.select("doc_id", y.alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: runs without ASCII white space, unchanged, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def texts_in_bites(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches whose texts have about ``most`` bytes together (a longer text
    comes alone), with those texts; bounds what a task holds at once."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        start = size = 0
        for i in range(len(col)):
            value = col[i]
            now = value.as_buffer().size if value.is_valid else 0
            if i > start and size + now > most:
                part = batch.slice(start, i - start)
                yield part, part.column(part.schema.get_field_index(column)).to_pylist()
                start, size = i, 0
            size += now
        if len(col) > start:
            part = batch.slice(start)
            yield part, part.column(part.schema.get_field_index(column)).to_pylist()
