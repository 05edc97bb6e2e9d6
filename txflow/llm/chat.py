"""Chat formatting with a loss mask, proved by reading the output back (native).

Grammar of the output, read from left to right without ambiguity::

    conversation = "<s>" turn* "</s>"
    turn         = "[" role "]" body "</>"      no "[", "]", "<" in role; no "[", "<" in body

A text goes in unchanged if the parser gives it back; only a turn that conflicts with the
grammar is escaped (``\\`` to ``\\s``, ``[`` to ``\\l``, ``]`` to ``\\r``, ``<`` to ``\\a``).
Three renderings are tried in order until the recovered turns equal the source: all plain,
conflicting turns escaped, all escaped. The last one always round-trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands for each character that the grammar uses.
ESCAPES = [("\\", "\\s"), ("[", "\\l"), ("]", "\\r"), ("<", "\\a")]
TURN = r"\[([^\[\]<]*)\]([^\[<]*)</>"
OPEN, CLOSE = "<s>", "</s>"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """Undo ``escape``; the backslash goes last, as no other code contains one twice."""
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit("["), role, F.lit("]"), body, F.lit("</>"))


def parse(rendered: Column) -> Column:
    """The turns (role, text) that the grammar finds in a rendered conversation."""
    roles = F.regexp_extract_all(rendered, F.lit(TURN), F.lit(1))
    bodies = F.regexp_extract_all(rendered, F.lit(TURN), F.lit(2))
    return F.zip_with(
        roles, bodies, lambda r, b: F.struct(unescape(r).alias("role"), unescape(b).alias("text"))
    )


def _joined(turns: Column, render) -> Column:
    return F.concat(F.lit(OPEN), F.array_join(F.transform(turns, render), ""), F.lit(CLOSE))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text; other columns ignored).

    Returns conv_id, turns (array of role and text, the source), formatted, recovered (the
    turns read back from ``formatted``), loss_mask (for each turn: skip so many code points,
    then keep so many) and round_trip (always true).

    Turns are ordered by turn, role and text, nulls first; equal rows stay apart. Null roles
    and texts are empty. Rows without conv_id are conversations of their own, equal ones
    together. No rows give no rows. A conversation is one output string, so its turns meet
    in one task; conversations themselves spread freely.
    """
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    plain = lambda t: _turn(t.role, t.text)
    coded = lambda t: _turn(escape(t.role), escape(t.text))
    fits = lambda t: parse(plain(t)) == F.array(F.struct(t.role.alias("role"), t.text.alias("text")))
    grouped = (
        rows.select("conv_id", alone.alias("alone"), "turn", "role", "text")
        .groupBy("conv_id", "alone")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("source"))
        .select(
            "conv_id",
            F.transform(
                "source",
                lambda t: F.struct(
                    F.coalesce(t.role, F.lit("")).alias("role"), F.coalesce(t.text, F.lit("")).alias("text")
                ),
            ).alias("turns"),
        )
    )
    turns = F.col("turns")
    tried = grouped.withColumn("formatted", _joined(turns, plain))
    for render in (lambda t: F.when(fits(t), plain(t)).otherwise(coded(t)), coded):
        same = parse(F.col("formatted")) == turns
        tried = tried.withColumn("formatted", F.when(same, F.col("formatted")).otherwise(_joined(turns, render)))
    return (
        tried.withColumn("recovered", parse(F.col("formatted")))
        .withColumn(
            "loss_mask",
            # "[" role "]" is skipped, the body of an assistant is kept, "</>" belongs to what follows.
            F.zip_with(
                F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1)),
                F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2)),
                lambda r, b: F.struct(
                    (F.length(r) + F.when(r == "assistant", 5).otherwise(F.length(b) + 5)).alias("skip"),
                    F.when(r == "assistant", F.length(b)).otherwise(0).alias("keep"),
                ),
            ),
        )
        .withColumn("round_trip", F.col("recovered") == turns)
    )


def under_mask(formatted: Column, loss_mask: Column) -> Column:
    """The unescaped text that the mask keeps. The mask's first skip also covers the opening
    marker less one turn end, as each skip counts the end of the turn before it. Each kept
    slice is unescaped alone: one that ends in a backslash makes no escape with the next."""
    begin = F.struct(F.lit(len(OPEN) - len("</>")).alias("at"), F.lit("").alias("text"))
    step = lambda acc, m: F.struct(
        (acc.at + m.skip + m.keep).alias("at"),
        F.when(m.keep > 0, F.concat(acc.text, unescape(F.substring(formatted, acc.at + m.skip + 1, m.keep))))
        .otherwise(acc.text)
        .alias("text"),
    )
    return F.aggregate(loss_mask, begin, step, lambda acc: acc.text)
