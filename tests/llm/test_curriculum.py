"""Curriculum mixing: targets by repeated resharing, taken words by a walk over each source."""

import hashlib
import re

import pytest

from cliploom.llm import curriculum, queries
from tests.compare import difference
from tests.llm.odd import no_documents, odd_documents


def reshared(sizes, weights, share, repeats):
    """Targets as the rule says it: deal by weight, stop sources at their caps, deal the excess again."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = share * sum(sizes.values())
    while open_ and left > 1e-9:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if target[s] + weights[s] * unit >= repeats * sizes[s]}
        if not over:
            for s in open_:
                target[s] += weights[s] * unit
            break
        for s in over:
            left -= repeats * sizes[s] - target[s]
            target[s] = float(repeats * sizes[s])
        open_ -= over
    return target


def test_query_equals_sql(spark, folder, sql):
    assert difference(queries.QUERIES["op8_curriculum"](spark, folder), sql, queries.SQL["op8_curriculum"]) is None


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = curriculum.shares(docs).collect()
    assert len(rows) == docs.count()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    given = [(r["doc_id"], size(r["text"]), r["source"]) for r in docs.collect()]
    sources = sorted({s for *_, s in given}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(n for _, n, x in given if x == s) for s in sources}
    target = reshared(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}, 1.5, 2)
    taken = {}
    for s in sources:
        order = sorted(((hashlib.md5(str("" if i is None else i).encode()).hexdigest(), n, i) for i, n, x in given if x == s), key=lambda x: x[:2])
        goal, before = int(target[s] + 0.5), 0
        for _, n, i in order:
            taken[i] = taken.get(i, 0) + sum(max(0, min(n, goal - k * sizes[s] - before)) for k in (0, 1))
            before += n
    found = {}
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["taken"]
    assert found == taken


def test_positions_invert_the_schedule(spark):
    rows = curriculum.placements(curriculum.shares(odd_documents(spark))).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    for r in rows:
        t, tilt = r["position"], r["tilt"]
        assert 0 <= t <= 1
        assert r["target"] * ((1 - tilt) * t + tilt * t * t) == pytest.approx(r["before"] + r["pass"] * r["source_size"], abs=1e-6)


def test_mixed_documents_keep_their_columns(spark):
    docs = odd_documents(spark)
    mixed = curriculum.mixed(docs)
    assert mixed.schema.names == docs.schema.names
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(words(r["text"]) for r in mixed.collect()) == sum(r["taken"] for r in curriculum.shares(docs).collect())


def test_empty_table_and_texts(spark):
    assert curriculum.shares(no_documents(spark)).count() == 0
    assert [r["taken"] for r in curriculum.shares(odd_documents(spark, ids=[3, 4, 5])).collect()] == [0, 0, 0]
