"""N-gram Jaccard join against all pairs."""

import random
import re

import pytest

from cliploom.llm import ngram_join
from cliploom.llm.queries import QUERIES, SQL
from tests.compare import difference
from tests.llm.odd import SCHEMA, no_documents, odd_documents, words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} - {()} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """doc_id, set size and smallest linked id of each row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        known = [x for x in (least.get(find(k)), i) if x is not None]
        least[find(k)] = min(known) if known else None
    return sorted(((i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def edited(text, n, rng):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = words(1, rng.random())
    return " ".join(w)


def variants(seed=5):
    """Families of near copies on both sides of the threshold, a shared passage, and many variants of one text."""
    rng, rows = random.Random(seed), []
    passage = words(50, "passage")
    for family in range(6):
        base = words(80, family)
        rows += [edited(base, n, rng) for n in (0, 1, 2, 3, 4, 5, 6)] + [base + " " + words(n, n + family) for n in (3, 10, 20, 30)] + [words(60, f"p{family}") + " " + passage]
    rows += [edited(words(100, "many"), rng.randrange(8), rng) for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [1024, 6])
def test_equals_all_pairs(spark, block):
    rows = variants()
    found = ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute(rows)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = ngram_join.near_copies(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute(rows)
    assert ngram_join.near_copies(no_documents(spark)).count() == 0


def test_one_of_each(spark):
    docs = odd_documents(spark)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    # 2, 11 and the repeated row go with 1; 13 goes with 12
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, None], key=str)
    rows = variants()
    kept = ngram_join.one_of_each(spark.createDataFrame([(i, t, "en", "s", 1, 0.0, "k", 1) for i, t in rows], SCHEMA))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_query_equals_sql(spark, folder, sql):
    assert difference(QUERIES["op7_ngram_join"](spark, folder), sql, SQL["op7_ngram_join"]) is None
