"""Repeated windows against a table of all windows; the symbols' promise on random words."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cliploom.llm import recompression
from cliploom.llm.queries import QUERIES, SQL
from cliploom.llm.words import mix
from tests.compare import difference
from tests.llm.odd import no_documents, odd_documents, words


def brute(rows, width):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, split, strict=True):
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


def planted(seed=2):
    """Texts with shared passages at other places, runs, periods, and few distinct words."""
    rng = random.Random(seed)
    passages = [words(n, f"x{n}") for n in (34, 35, 36, 70, 120)] + ["la " * 50, "do re mi " * 20]
    rows = []
    for k in range(40):
        parts = [words(rng.randrange(0, 60), rng.random())]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), words(rng.randrange(0, 40), rng.random())]
        rows.append((k, rng.choice([" ", "\n"]).join(parts)))
    rows += [(100 + k, " ".join(rng.choice("ab") for _ in range(150))) for k in range(4)]
    return rows


@pytest.mark.parametrize("width", [35, 8, 3])
def test_equals_all_windows(spark, width):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(recompression.without_repeats(df, width)) == brute(rows, width)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    result = recompression.without_repeats(docs)
    assert found(result) == brute(rows, 35)
    assert set(docs.columns) <= set(result.columns)
    assert all(r["text"] == dict(rows)[r["doc_id"]] for r in result.where("n_removed = 0").collect())
    assert recompression.without_repeats(no_documents(spark)).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    for letters in (2, 3, 50):
        word = mix(rng.integers(1, letters + 1, 3000).astype(np.uint64))
        word[2000:2400] = word[100:500]
        word[900:960] = word[900]
        first = np.array([0, 1000, 1000, 2100, 3000])
        text, at, count, name, _ = recompression.stretches(word, first)
        anchor = {}
        for t, a, n, h in zip(text, at, count, name, strict=True):
            for i in range(first[t] + a, first[t] + a + n):
                anchor[i] = h
        assert sorted(anchor) == [i for t in range(4) for i in range(first[t], first[t + 1] - 34)]
        by_words = {}
        for i, h in anchor.items():
            assert by_words.setdefault(word[i : i + 35].tobytes(), h) == h


def test_query_equals_sql(spark, folder, sql):
    assert difference(QUERIES["op10_recompression"](spark, folder), sql, SQL["op10_recompression"]) is None
