"""Rows that every operator has to take: nulls, empty and long texts, repeats, clashing columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, tag long, word string, "
    "pos int, n long, component long, y int, w string, bits binary, terms int, filed boolean, ghost int"
)
LONG = " ".join(f"w{i % 911}x{i % 13}" for i in range(60_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, "one word after another, and the same one word after another"),
    (3, "one word after another, and the same one word after another"),
    (4, "  \n\t "),
    (None, "no id here\nbut two lines"),
    (5, LONG),
    (6, "ünï çödé — 漢字 ELSE"),
    (7, "a"),
    (8, "!!! ??? 123"),
]


def rows(pairs):
    return [(i, t, "en", "s", None, 0.5, 1, "x", 2, 3, 4, 1, "w", b"b", 5, True, 6) for i, t in pairs]


def edge(spark):
    return spark.createDataFrame(rows(TEXTS), SCHEMA).repartition(3)


def frame(spark, pairs):
    return spark.createDataFrame(rows(pairs), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, triples=()):
    return spark.createDataFrame(list(triples), "doc_id long, quality int, toxic int, text string")
