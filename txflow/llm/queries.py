"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm import chat, decontamination, extraction, fingerprints, jaccard, language, mixing, periodicity, quality, resampling, substrings, suffixes, toxicity
from txflow.llm.common import SPACES, held_out, table

Query = Callable[[SparkSession, str], DataFrame]

#: A conversation that says what chat templates use as markers.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.fingerprint(F.col("lanes")).alias("fingerprint"),
        fingerprints.fingerprint(F.col("edited_lanes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        fingerprints.likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0), lambda a, s: a + s.end - s.start)
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        removed.cast("long").alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract_pages(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(rows.unionByName(extra))
    told = F.array_join(F.transform("recovered", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return done.withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_mask"))).select(
        "conv_id",
        F.size("recovered").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "n_tokens", "domain", "rate")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


#: A document with a lower score is rejected.
KEEP_FROM = 0.3


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document, by its id's checksum, is given a periodic tail first; one without an id is not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", SPACES, -1), lambda w: w != "")
    marked = docs.withColumn("g", F.when(h % 10 == 0, F.floor(h / 10))).withColumn("w", F.when(F.col("g").isNotNull(), words))
    n, a = F.size("w"), F.col("a")
    marked = marked.withColumn("a", F.when(n > 0, F.pmod("g", n)).cast("int"))
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    tailed = F.array_join(F.concat(F.slice("w", F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    found = periodicity.find_runs(marked.select("doc_id", F.when(a.isNotNull(), tailed).otherwise(F.col("text")).alias("text")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start)
    return suffixes.remove_later_copies(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_fingerprints,
            op2_substring_dedup,
            op3_html_extraction,
            op4_toxicity,
            op5_jaccard_join,
            op6_language_id,
            op7_chat_formatting,
            op8_mixing,
            op9_decontamination,
            op10_quality,
            op11_importance_resampling,
            op12_periodic_runs,
            op13_suffix_array_dedup,
        )
    }
