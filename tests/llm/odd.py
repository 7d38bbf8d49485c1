"""Odd documents that every text operator must bear, and small helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, size int"


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))


ODD_TEXTS = {
    1: words(60, 1), 2: words(60, 1), 3: None, 4: "", 5: "  \n\t ", 6: "one", 7: "Ünïcödé Straße naïve 東京 ßß 🙂 it's 12.5% <|endoftext|>", 8: words(9000, 8),
    9: "x" * 5000, 10: words(40, 10) + "\n" + words(60, 1), 11: words(60, 1).upper(), 12: "a b c d", 13: "a b c d", 14: "the " * 200,
}


def odd_documents(spark, ids=None):
    """Odd texts with clashing extra columns, a null source, a null id and a repeated row."""
    rows = [(i, t, "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), 0.5, "k", 1) for i, t in ODD_TEXTS.items() if ids is None or i in ids]
    if ids is None:
        rows += [rows[0], (None, "no id here", None, "s1", 10, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
