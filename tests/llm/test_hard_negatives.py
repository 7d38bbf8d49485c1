"""Hard negatives: exact scores, SQL on the given rows, brute force on odd ones."""

import numpy as np
import pytest

from cliploom.llm import hard_negatives as H
from tests.compare import difference

SCHEMA = "vec_id long, embedding array<float>, label int, score double, codes string, shard int, positives int, kind int"


def rows_of(spark, vectors):
    """Rows with clashing extra columns."""
    return spark.createDataFrame([(i, v, y, 0.5, "c", 1, 2, 3) for i, v, y in vectors], SCHEMA)


def brute(rows, is_anchor, settings):
    """The definition, pair by pair in Python's integers."""
    valid = {}
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        codes = [int(np.floor(float(np.float32(x)) * settings.scale)) for x in v]
        valid[i] = min(valid.get(i, (y, codes)), (y, codes), key=lambda x: (x[0], np.array(x[1], '<i8').tobytes()))
    sizes = [len(c) for _, c in valid.values()]
    size = min(sorted(set(sizes)), key=lambda s: (-sizes.count(s), s))
    valid = {i: x for i, x in valid.items() if len(x[1]) == size}
    out = set()
    for a in filter(is_anchor, valid):
        scored = sorted((-sum(p * q for p, q in zip(valid[a][1], c, strict=True)), i, y) for i, (y, c) in valid.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == valid[a][0]][: settings.positives]:
            fit = [x for x in scored if x[2] != valid[a][0] and settings.low * -s <= 100 * -x[0] <= settings.high * -s]
            out |= {(a, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fit[: settings.negatives])}
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for dim, top in ((1, 3), (64, 300), (700, 1 << 20)):
        a, b = rng.integers(-top, top + 1, (9, dim)), rng.integers(-top, top + 1, (11, dim))
        a[0], b[0], b[1] = top, top, -top
        primes = H.primes_for(dim * top * top)
        assert len(primes) >= 2 and np.prod([float(p) for p in primes]) > 2.0 * dim * top * top
        assert (max(primes) // 2) ** 2 * H.PART < H.EXACT
        assert np.array_equal(H.exact_scores(a, b, primes), a @ b.T)


def test_given_rows_as_sql(spark, folder, sql):
    from cliploom.llm import queries

    assert difference(queries.QUERIES["op11_hard_negatives"](spark, folder), sql, queries.SQL["op11_hard_negatives"]) is None


@pytest.mark.parametrize("blocks", [(8192, 4096), (16, 3)])
def test_hot_label_ties_and_odd_rows(spark, blocks):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(150, 6)), 2)
    x[40:90] = x[40]  # one very common vector
    rows = [(i, v.tolist(), 1 if i % 3 == 0 else int(rng.integers(4))) for i, v in enumerate(x)]
    rows += [(200, None, 1), (201, [None] * 6, 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] + [0.0] * 5, 1), (204, [0.0] * 6, 1), (205, [1.0], 1), (206, [], 2), (207, x[3].tolist(), None), (None, x[3].tolist(), 1)]
    rows += [(10, x[10].tolist(), rows[10][2]), (11, x[12].tolist(), 0)]  # repeated ids
    settings = H.Settings(block=blocks[0], anchor_block=blocks[1], low=-50)
    got = found(H.hard_negatives(rows_of(spark, rows), lambda i: i % 10 == 0, settings))
    assert got == brute(rows, lambda i: i % 10 == 0, settings) and got


def test_large_numbers(spark):
    rows = [(i, [1000.0 * (i + 1), -777.5 * i, 3.0], i % 2) for i in range(12)]
    settings = H.Settings(scale=1 << 10, low=1, high=100)
    assert found(H.hard_negatives(rows_of(spark, rows), lambda i: i % 5 == 0, settings)) == brute(rows, lambda i: i % 5 == 0, settings)
    with pytest.raises(ValueError):
        H.hard_negatives(rows_of(spark, [(1, [1e12], 1), (2, [2.0], 1)]), lambda i: i == 1)


def test_nothing_to_find(spark):
    assert H.hard_negatives(rows_of(spark, []), lambda i: i == 1).count() == 0
    assert H.hard_negatives(rows_of(spark, [(1, [1.0], 1), (2, [1.0], 2)]), lambda i: i == 1).count() == 0  # no positive
    assert H.hard_negatives(rows_of(spark, [(1, [1.0], 1), (2, [1.0], 1)]), lambda i: i == 1).count() == 0  # no negative
