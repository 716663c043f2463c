"""Small corpora with every awkward case."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, size string, label string"
LONG = " ".join(f"wort{i % 977}" for i in range(60_000))
BASE = " ".join(f"token{i}" for i in range(100))


def edge_rows():
    rows = [
        (1, BASE, "en", "b"),
        (1, BASE, "en", "b"),  # a repeated row
        (2, BASE.replace("token50 ", "other "), "en", "a"),
        (3, BASE.replace(" ", "\n\t "), "en", None),  # equal without white space
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \t\n", "de", "a"),
        (None, "a null id with some words", None, "c"),
        (None, None, None, None),
        (7, LONG, "en", "c"),
        (8, "x" * 300_000, "fr", "c"),
        (9, "12345 67890 !!!", "fr", "c"),
        (10, "İstanbul ΣΑΣ naïve é ͅ 日本語 <|endoftext|>x", "de", "\U0001f600"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), 0.5, "x", "y", "z") for i, t, lang, s in rows]


def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int"
    )


def benchmark(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
