"""Homomorphic fingerprints of documents (native).

A fingerprint is a sum of wide vectors, one per paragraph, lane by lane modulo 2**32:

* lane 0 counts the words,
* 4 lanes sum a 128-bit hash of the whole paragraph (equality),
* 64 lanes sum signs: each word with its two followers in the paragraph is a shingle, whose
  hash picks a lane and adds or takes one there (likeness).

The order of paragraphs does not matter, and a paragraph is added or removed by adding or
subtracting its own vector. The likeness lanes are a linear sketch: the sum of the squared
differences of two fingerprints' lanes estimates in how many shingles the texts differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.llm.common import SPACES

SEEDS = [11, 23, 37, 53]
SIGNS = 64
MODULUS = 1 << 32
_LOW = MODULUS - 1


def _sums(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``lanes`` for each row of ``texts`` (keys and text), whose keys are unique.
    Words are summed by lane where the text is; what is gathered is at most a row per lane."""
    has_words = lambda p: p.rlike(r"[^\x20\x09-\x0D]")
    words = F.array_remove(F.split("paragraph", SPACES), "")
    shingles = F.arrays_zip("w", F.slice("w", 2, F.size("w")).alias("x"), F.slice("w", 3, F.size("w")).alias("y"))
    ids = [f"id{s}" for s in SEEDS]
    rows = (
        texts.select(*keys, F.explode_outer(F.filter(F.split("text", "\n"), has_words)).alias("paragraph"))
        .select(*keys, *[F.xxhash64("paragraph", F.lit(s)).bitwiseAND(_LOW).alias(f"id{s}") for s in SEEDS], words.alias("w"))
        .select(*keys, *ids, F.posexplode_outer(shingles).alias("pos", "s"))
        .withColumn("hashed", F.xxhash64("s.w", "s.x", "s.y"))
    )
    there, h = F.col("pos").isNotNull(), F.col("hashed")
    by_lane = (
        rows.groupBy(*keys, F.when(there, h.bitwiseAND(SIGNS - 1).cast("int")).otherwise(0).alias("lane"))
        .agg(
            F.count("pos").alias("n"),
            F.sum(F.when(there, F.when(h < 0, -1).otherwise(1)).otherwise(0)).alias("sign"),
            *[F.sum(F.when(F.col("pos") == 0, F.col(i)).otherwise(0)).alias(i) for i in ids],
        )
    )
    gathered = by_lane.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[F.sum(i).alias(i) for i in ids],
        F.map_from_entries(F.collect_list(F.struct("lane", "sign"))).alias("signs"),
    )
    signs = F.transform(F.sequence(F.lit(0), F.lit(SIGNS - 1)), lambda i: F.coalesce(F.try_element_at("signs", i), F.lit(0)))
    lanes = F.concat(F.array("n", *ids), signs)
    return gathered.select(*keys, F.transform(lanes, lambda x: x.bitwiseAND(_LOW)).alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the union of two texts' paragraphs; with ``sign`` -1, of ``a`` without ``b``'s."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))


def fingerprint(lanes: Column) -> Column:
    """The lanes as one string of hexadecimal digits."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _squares(lanes: Column) -> Column:
    """Estimated sum of the squared shingle counts: that of the signed lanes."""
    signed = F.transform(
        F.slice(lanes, 2 + len(SEEDS), SIGNS),
        lambda x: (x - F.when(x >= MODULUS // 2, MODULUS).otherwise(0)).cast("double"),
    )
    return F.aggregate(signed, F.lit(0.0), lambda a, x: a + x * x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the share of shingles two texts have in common (Dice), estimated from their
    lanes alone; 1 for equal fingerprints."""
    whole = _squares(a) + _squares(b)
    estimate = 1.0 - _squares(combine(a, b, -1)) / whole
    return F.when(a == b, 1.0).when(whole > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate))).otherwise(0.0)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text; other columns ignored) with doc_id, n_chars, lanes. One row per
    distinct id and text; a null text is empty and has the zero fingerprint."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    unique = base.dropDuplicates(["doc_id", "h"])
    return _sums(unique.withColumn("n_chars", F.length("text").cast("long")), ["doc_id", "h", "n_chars"]).drop("h")


def edited_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last third replaced by the first characters of the next document
    in descending order of doc_id; after the last comes the first. Returns doc_id, n_chars,
    edited_sha256, lanes, edited_lanes, next_lanes.

    One row per input row. Null ids come last; rows of one id follow each other by the hash of
    their text, so repeated rows are each other's next. A null text is empty. A single row is
    its own next; no rows give no rows. Other columns are ignored.

    ``buckets`` ranges of ids, cut at approximate quantiles, are ordered one by one; each also
    holds a copy of the next range's first row. So texts are shuffled once and all further
    steps stay in the bucket's task. Without ``buckets`` there are four for each of the session's
    shuffle partitions, 64 at least; what the driver holds is a cut and a first id of each.
    """
    buckets = buckets or max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("order"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = base.agg(F.percentile_approx("order", shares, max(20_000, 20 * buckets))).first()[0]
    cuts = sorted(set(cuts or []), reverse=True)
    # The bucket of an id is the number of cuts above it.
    base = base.withColumn("bucket", _rank(cuts))
    ordered = lambda: F.struct((-F.col("order").cast("decimal(20,0)")).alias("o"), "h")
    heads = base.groupBy("bucket").agg(F.min(ordered()).alias("head")).orderBy("bucket").collect()  # at most ``buckets`` rows
    follow = [
        (heads[i]["bucket"], int(-heads[(i + 1) % len(heads)]["head"]["o"]), heads[(i + 1) % len(heads)]["head"]["h"])
        for i in range(len(heads))
    ]
    spark = docs.sparkSession
    firsts = spark.createDataFrame(follow, "into int, order long, h long")
    ghosts = (
        base.join(F.broadcast(firsts), ["order", "h"])
        .dropDuplicates(["into"])
        .select("order", "doc_id", "text", "h", F.col("into").alias("bucket"), F.lit(True).alias("ghost"))
    )
    own = base.select("order", "doc_id", "text", "h", "bucket", F.lit(False).alias("ghost"))
    along = Window.partitionBy("bucket").orderBy("ghost", F.desc("order"), "h")
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - k), F.substring(F.lead("text", 1, "").over(along), F.lit(1), k))
    rows = own.unionByName(ghosts).select(
        "bucket",
        F.row_number().over(along).alias("at"),
        "ghost",
        "doc_id",
        n.cast("long").alias("n_chars"),
        "text",
        edited.alias("edited"),
    )
    keys = ["bucket", "at", "ghost", "doc_id", "n_chars", "edited_sha256", "variant"]
    both = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).select(
        *keys[:-1],
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("variant"), F.col("text").alias("text")),
                F.struct(F.lit(1).alias("variant"), F.col("edited").alias("text")),
            )
        ).alias("v"),
    )
    summed = _sums(both.select(*keys[:-1], F.col("v.variant").alias("variant"), F.col("v.text").alias("text")), keys)
    by_row = Window.partitionBy("bucket").orderBy("at", "variant")
    return (
        summed.withColumn("edited_lanes", F.lead("lanes", 1).over(by_row))
        .withColumn("next_lanes", F.lead("lanes", 2).over(by_row))
        .where((F.col("variant") == 0) & ~F.col("ghost"))
        .select("doc_id", "n_chars", "edited_sha256", "lanes", "edited_lanes", "next_lanes")
    )


def _rank(cuts: list[int]) -> Column:
    """How many of the descending ``cuts`` are above the id, found by halving."""
    known = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<long>")

    def halve(acc: Column, _: Column) -> Column:
        mid = F.call_function("div", acc.lo + acc.hi, F.lit(2)).cast("int")
        above = F.get(known, mid) > F.col("order")
        open_ = acc.lo < acc.hi
        return F.struct(
            F.when(open_ & above, mid + 1).otherwise(acc.lo).alias("lo"),
            F.when(open_ & ~above, mid).otherwise(acc.hi).alias("hi"),
        )

    steps = F.sequence(F.lit(0), F.lit(max(1, len(cuts)).bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halve, lambda acc: acc.lo)
