"""Embedding near-duplicates by Euclidean p-stable hashing.

Unit vectors are projected on Gaussian directions and cut into steps; a table's bucket is the
tuple of a few steps, and several tables are kept. Vectors that share a bucket of any table
are compared by their exact cosine. The number of projections grows with the logarithm of the
rows, so that chance meetings stay rare, and the number of tables follows from the recall that
is asked for at the threshold itself; pairs above it are found more surely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm.graph import components, written
from cliploom.llm.runs import group_slices
from cliploom.llm.words import mix


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.95
    #: Probability to find a pair whose cosine is just the threshold.
    recall: float = 0.98
    #: Width of a step as a multiple of the distance at the threshold.
    step: float = 4.0
    #: Expected chance meetings of a vector in a bucket.
    chance: float = 0.1
    #: Vectors of a block; buckets with more are compared block by block.
    block: int = 1024
    seed: int = 7


def collision(width: float, distance: float) -> float:
    """Probability that two points at this distance fall into one step of a random projection."""
    c = width / distance
    below = 0.5 * math.erfc(c / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def shape(rows: int, settings: Settings) -> tuple[float, int, int]:
    """Step width, projections of a table and tables."""
    near = math.sqrt(2 - 2 * settings.threshold)
    width = settings.step * near
    apart = collision(width, math.sqrt(2))  # independent directions
    projections = max(2, math.ceil(math.log(max(rows, 2) / settings.chance) / -math.log(apart)))
    hit = collision(width, near) ** projections
    return width, projections, max(1, math.ceil(math.log(1 - settings.recall) / math.log(1 - hit)))


def vector_matrix(column: pa.Array) -> np.ndarray:
    """Rows of bytes of equally many doubles as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def vector_bytes(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``vector``: the column's doubles as bytes, null unless all are finite and not all zero."""
    schema = df.select("*").schema.add("vector", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null is NaN
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            full = np.concatenate(([0], np.cumsum(values != 0)))
            good = (bad[ends] == bad[ends - sizes]) & (full[ends] > full[ends - sizes])
            raw = values.tobytes()
            cut = [raw[(e - s) * 8 : e * 8] if ok else None for e, s, ok in zip(ends.tolist(), sizes.tolist(), good.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, pa.binary())], names=[*batch.schema.names, "vector"])

    return df.mapInArrow(run, schema)


def directions(dimension: int, projections: int, tables: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions (dimension x tables * projections) and offsets as shares of a step."""
    rng = np.random.default_rng([seed, dimension])
    return rng.standard_normal((dimension, tables * projections)), rng.random(tables * projections)


def buckets(unit: np.ndarray, width: float, projections: int, tables: int, seed: int) -> np.ndarray:
    """Hash of the bucket of each vector (rows) in each table (columns); differs between dimensions."""
    a, b = directions(unit.shape[1], projections, tables, seed)
    steps = np.floor(unit @ a / width + b).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, projections)
    code = np.full(steps.shape[:2], unit.shape[1], np.uint64)
    for k in range(projections):
        code = mix(code * np.uint64(0x9E3779B97F4A7C15) + steps[:, :, k])
    return code


def distinct_vectors(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """All rows with the key of their vector, and one row for each distinct valid vector with its count and smallest id."""
    rows = vector_bytes(embeddings.select(F.col(id_column).alias("vec_id"), F.col(column).cast("array<double>").alias("embedding")), "embedding").drop("embedding")
    rows = rows.withColumn("key", F.unhex(F.md5("vector")))
    classes = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector"))
    return rows.select("vec_id", "key"), classes


def linked(classes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Links between distinct vectors: rows ``key, links`` (copies linked, to be summed) and ``key, other`` edges.

    A pair that meets in several tables is reported by the first of them only. Each block pair
    reports one row for each vector and the edges of a spanning forest, not its pairs.
    """
    total = classes.count()
    width, projections, tables = shape(total, settings)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector").to_pylist()])
            step = max(1, 2_000_000 // (tables * projections))
            for rows in (r[a : a + step] for s in np.unique(sizes) for r in [np.flatnonzero(sizes == s)] for a in range(0, len(r), step)):
                own = batch.take(pa.array(rows))
                x = vector_matrix(own.column("vector"))
                x = x / np.abs(x).max(axis=1, keepdims=True)
                code = buckets(x / np.linalg.norm(x, axis=1, keepdims=True), width, projections, tables, settings.seed)
                yield pa.RecordBatch.from_arrays(
                    [own.column("key"), own.column("copies"), own.column("vector"), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * tables, pa.int32()), pa.array(code.view(np.int64).ravel()))],
                    names=["key", "copies", "vector", "buckets"],
                )

    index = written(classes.select("key", "copies", "vector").mapInArrow(hashed, "key binary, copies long, vector binary, buckets array<long>"), "vectors")
    places = index.select("key", F.posexplode("buckets").alias("tab", "bucket"))
    met = places.groupBy("tab", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / settings.block).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    spread = (
        places.join(met, ["tab", "bucket"]).withColumn("blocks", blocks).withColumn("own", own)
        .select("key", "tab", "own", "bucket", F.explode(pairs).alias("p"))
        .select("key", "tab", "own", "p.i", "p.j", F.xxhash64("tab", "bucket", "p.i", "p.j").alias("grp"))
    )
    # distinct block pairs fall together under one 64-bit name so rarely that it only costs comparisons of other tables' pairs
    work = spread.join(index, "key").repartition("grp").sortWithinPartitions("grp", "tab", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_slices(batches, "grp"):
            n = group.num_rows
            sizes = {len(v) for v in group.column("vector").to_pylist()}
            if n < 2 or len(sizes) > 1:
                continue
            tab, i, j, own = (group.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "i", "j", "own"))
            x = vector_matrix(group.column("vector"))
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            near = x @ x.T >= settings.threshold
            np.fill_diagonal(near, False)
            if i[0] != j[0]:
                near &= own[:, None] != own[None, :]
            a, b = np.nonzero(near)
            if not len(a):
                continue
            codes = group.column("buckets").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            same = codes[a, tab[0]] == codes[b, tab[0]]
            for t in range(tab[0]):
                same &= codes[a, t] != codes[b, t]
            a, b = a[same], b[same]
            keys, copies = group.column("key"), group.column("copies").to_numpy(zero_copy_only=False)
            links = np.bincount(a, copies[b], n).astype(np.int64)
            label = np.arange(n)
            while len(a):  # smallest label over links, until nothing changes
                new = label.copy()
                np.minimum.at(new, a, label[b])
                new = new[new]
                if (new == label).all():
                    break
                label = new
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(some)), pa.array(links[some]), keys.take(pa.array(label[some]))], names=["key", "links", "other"])

    return written(work.mapInArrow(compare, "key binary, links long, other binary"), "links")


def near_duplicates(embeddings: DataFrame, settings: Settings = Settings(), id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of the table.

    Equal vectors are one vector with a count and link with each other. Vectors that are null,
    empty, zero or hold a null or non-finite number link with nothing, as do vectors of
    different dimensions. A repeated id is as many vectors; its component is named by the
    smallest id in it. An empty table gives no rows; other columns are ignored.
    """
    rows, classes = distinct_vectors(embeddings, id_column, column)
    classes = written(classes, "distinct")
    found = linked(classes, settings)
    member = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "copies", "least_id").join(links, "key", "left").join(member.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    named = written(named, "members")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), n AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
