"""Embedding links and nearest neighbours against brute force, with odd vectors."""

import math

import numpy as np
import pytest

from cliploom.llm import ann, embedding_links
from cliploom.llm.queries import QUERIES, SQL
from tests.compare import difference

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, key string, vector string, score double"


def odd_vectors(spark, seed=1):
    """Clusters around the threshold, copies, chains, a repeated id and vectors that take no part."""
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for base in rng.standard_normal((6, 16)):
        for noise in (0.0, 0.0, 0.02, 0.05, 0.07, 0.08, 0.3):
            rows.append((n, (base * rng.uniform(0.5, 3) + noise * rng.standard_normal(16) * np.linalg.norm(base) / 2).tolist()))
            n += 1
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (3, rows[20][1])]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [NAN] + [1.0] * 15), (904, [INF] + [1.0] * 15), (905, [None] + [1.0] * 15), (906, [1.0, 2.0])]
    return [(i, v, 0, "k", "v", 0.5) for i, v in rows]


def valid(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, threshold=0.95):
    good = [k for k, r in enumerate(rows) if valid(r[1])]
    near = {k: [] for k in range(len(rows))}
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1]), np.array(rows[b][1])
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                near[a].append(b)
    out = []
    for k, r in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        out.append((r[0], len(near[k]), min(rows[j][0] for j in seen)))
    return sorted(out)


@pytest.mark.parametrize("block", [1024, 3])
def test_links_equal_brute_force(spark, block):
    rows = odd_vectors(spark)
    settings = embedding_links.Settings(block=block, recall=0.99999)
    found = embedding_links.near_duplicates(spark.createDataFrame(rows, SCHEMA), settings).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == brute_links(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_links_query_equals_sql(spark, folder, sql):
    assert difference(QUERIES["op3_embedding_links"](spark, folder), sql, SQL["op3_embedding_links"]) is None


def test_links_of_no_rows(spark):
    assert embedding_links.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_nearest(rows, query, k=10):
    """Best (distance, id) for a query among the rows with other ids."""
    x = np.array(query[1])
    found = sorted((float(np.sqrt(((np.array(v) - x) ** 2).sum())), i) for i, v, *_ in rows if valid(v) and len(v) == len(x) and i != query[0])
    return found[:k]


@pytest.mark.parametrize("settings", [ann.Settings(), ann.Settings(block=7, query_block=2), ann.Settings(recall=0.01, tables=1, per_bucket=1), ann.Settings(first=1, most=1)])
def test_small_tables_are_searched_well(spark, settings):
    rows = [r for r in odd_vectors(spark) if r[0] is not None]
    found = ann.search(spark.createDataFrame(rows, SCHEMA), lambda i: i % 7 == 0, settings).collect()
    queries = [r for r in rows if r[0] % 7 == 0 and valid(r[1]) and len(r[1]) == 16]
    hits = total = 0
    for q in queries:
        own = sorted((r for r in found if r["query_id"] == q[0]), key=lambda r: r["rank"])
        expected = brute_nearest(rows, q)
        assert [r["rank"] for r in own] == list(range(1, len(expected) + 1))
        assert [(r["score"], r["vec_id"]) for r in own] == sorted((r["score"], r["vec_id"]) for r in own)
        hits += len({i for _, i in expected} & {r["vec_id"] for r in own})
        total += len(expected)
    assert {r["query_id"] for r in found} == {q[0] for q in queries}
    assert hits / total >= (0.9 if settings.recall > 0.5 else 0.1)


def test_fewer_rows_than_neighbours(spark):
    rows = [r for r in odd_vectors(spark)[:5]]
    found = ann.search(spark.createDataFrame(rows, SCHEMA), lambda i: i == 0).collect()
    assert [(r["score"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(pytest.approx(d), i) for d, i in brute_nearest(rows, rows[0])]
    assert ann.search(spark.createDataFrame([], SCHEMA), lambda i: i == 0).count() == 0


def test_recall_on_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op6_multiprobe_ann"](spark, folder).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        distance[q] = np.inf
        best = ids[np.lexsort((ids, distance))[:10]]
        own = {r["vec_id"]: r["score"] for r in found if r["query_id"] == ids[q]}
        assert all(score == pytest.approx(float(distance[ids == v][0]), rel=1e-12) for v, score in own.items())
        hits, total = hits + len(own.keys() & set(best.tolist())), total + 10
    assert hits / total >= 0.9


@pytest.mark.parametrize("per_cluster", [20, 500])
def test_clustered_rows_are_found_without_visiting_most(spark, per_cluster):
    rng = np.random.default_rng(per_cluster)
    x = np.repeat(rng.standard_normal((50_000 // per_cluster, 32)), per_cluster, axis=0) + 0.15 * rng.standard_normal((50_000, 32))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = ann.search(rows, lambda i: i % 250 == 0).collect()
    hits = 0
    for q in range(0, len(x), 250):
        distance = ((x - x[q]) ** 2).sum(1)
        distance[q] = np.inf
        hits += len(set(np.argsort(distance)[:10].tolist()) & {r["vec_id"] for r in found if r["query_id"] == q})
    visited = {r["query_id"]: r["visited"] for r in found}
    assert len(found) == 2000 and len(visited) == 200
    assert hits / 2000 >= 0.9
    assert sum(visited.values()) / len(visited) <= 0.1 * len(x)  # all tables together
