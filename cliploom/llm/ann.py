"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every vector is projected on a few Gaussian directions and cut into steps, for several tables.
A query first visits a fixed number of buckets around its own. The distance of the k-th nearest
row found there bounds the distance that its true neighbours have, and a displacement of known
length is Gaussian along a Gaussian direction: that gives the probability of every bucket for
this query. It then visits further buckets in the order of that probability until they hold the
share that the recall asks for. Queries among close neighbours stop early, those without any go
on. Candidates of all tables are ranked by their exact distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cliploom.llm.embedding_links import vector_bytes, vector_matrix
from cliploom.llm.graph import written
from cliploom.llm.runs import group_slices
from cliploom.llm.words import mix


@dataclass(frozen=True)
class Settings:
    k: int = 10
    tables: int = 3
    #: Probability that a neighbour as far as the farthest wanted one lies in a visited bucket.
    recall: float = 0.96
    #: Vectors of an occupied bucket, on average, and steps across the spread of the projections.
    per_bucket: int = 12
    steps: float = 4.5
    #: Buckets of a table visited first, and at most; queries that need more meet all rows.
    first: int = 32
    most: int = 32768
    #: Vectors that centre and spread are measured on, and those of them that bound distances.
    sample: int = 4096
    anchors: int = 512
    #: Vectors, and queries, that meet in one task.
    block: int = 8192
    query_block: int = 2048
    seed: int = 11


@dataclass(frozen=True)
class Index:
    """Directions of all tables; projections are taken from the centre and divided by ``deviation``."""

    a: np.ndarray
    offset: np.ndarray
    centre: np.ndarray
    deviation: np.ndarray
    anchors: np.ndarray
    width: float
    projections: int
    tables: int

    def projected(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) @ self.a / self.deviation).reshape(len(x), self.tables, self.projections)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Name of each vector's bucket in each table, as longs."""
        return bucket_names(np.floor(self.projected(x) / self.width + self.offset).astype(np.int64))

    def bound(self, query: np.ndarray, k: int) -> float:
        """A distance within which ``k`` rows beside the query itself are known, or infinity."""
        if len(self.anchors) <= k:
            return math.inf
        return float(np.sqrt(np.partition(((self.anchors - query) ** 2).sum(1), k)[k]))

    def law(self, query: np.ndarray, distance: float) -> tuple[float, np.ndarray]:
        """Share of the query's projection that a row at this distance keeps, and its spread about that, by direction.

        Such a row is taken to lie as far from the centre as the query, as rows of a cloud do;
        around a query nearer to the centre than that allows, square to it.
        """
        own, d2 = float(((query - self.centre) ** 2).sum()), distance**2
        follow, rest = (1 - d2 / (2 * own), d2 * (1 - d2 / (4 * own))) if d2 < 2 * own else (0.0, d2 - own)
        length = np.sqrt((self.a**2).mean(0)).reshape(self.tables, -1)
        return follow, np.maximum(math.sqrt(rest) * length / self.deviation.reshape(self.tables, -1), 1e-6)


def bucket_names(steps: np.ndarray) -> np.ndarray:
    """Hash over the last axis of whole-numbered steps."""
    code = np.full(steps.shape[:-1], 1, np.uint64)
    for k in range(steps.shape[-1]):
        code = mix(code * np.uint64(0x9E3779B97F4A7C15) + steps[..., k].astype(np.uint64))
    return code.view(np.int64)


def fit(sample: np.ndarray, total: int, settings: Settings) -> Index:
    """Index for ``total`` vectors of which ``sample`` are some."""
    m = max(1, round(math.log(max(total / settings.per_bucket, 2)) / math.log(settings.steps)))
    rng = np.random.default_rng([settings.seed, sample.shape[1]])
    a = rng.standard_normal((sample.shape[1], settings.tables * m))
    centre = sample.mean(axis=0)
    deviation = ((sample - centre) @ a).std(axis=0)
    deviation[deviation < 1e-9] = 1.0
    return Index(a, rng.random((settings.tables, m)), centre, deviation, sample[: settings.anchors], 4.0 / settings.steps, m, settings.tables)


_below = np.vectorize(lambda x: 0.5 * math.erfc(-x / math.sqrt(2)), otypes=[float])


def probes(mean: np.ndarray, spread: np.ndarray, offset: np.ndarray, width: float, share: float, most: int) -> tuple[np.ndarray, bool]:
    """Steps of at most ``most`` buckets of one table, likeliest first, until they hold ``share`` of a Gaussian; whether they do.

    The best ``keep`` prefixes are extended direction by direction; since a longer one is never
    likelier than its prefix these hold the best buckets, and ``keep`` doubles until it is enough.
    """
    by_direction = []
    for middle, deep, shift in zip(mean, spread, offset, strict=True):
        reach = min(6 * deep, 64 * width)
        at = np.arange(math.floor((middle - reach) / width + shift), math.floor((middle + reach) / width + shift) + 1)
        by_direction.append((at, np.diff(_below(((np.append(at, at[-1] + 1) - shift) * width - middle) / deep))))
    keep = min(512, most)
    while True:
        steps, chance = np.zeros((1, 0), np.int64), np.ones(1)
        for at, p in by_direction:
            both = (chance[:, None] * p[None, :]).ravel()
            best = np.argpartition(-both, keep - 1)[:keep] if len(both) > keep else np.arange(len(both))
            steps, chance = np.concatenate((steps[best // len(p)], at[best % len(p)][:, None]), axis=1), both[best]
        order = np.argsort(-chance, kind="stable")
        total = np.cumsum(chance[order])
        if total[-1] >= share:
            return steps[order[: int(np.searchsorted(total, share)) + 1]], True
        if len(chance) < keep or keep == most:
            return steps[order], len(chance) < keep and total[-1] >= share - 1e-6
        keep = min(2 * keep, most)


def nearest(query: np.ndarray, own: int | None, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``k`` nearest of the rows, ties to smaller ids."""
    rows = rows[ids[rows] != own]
    distance = np.sqrt(((vectors[rows] - query) ** 2).sum(axis=1))
    if len(rows) > k:
        some = distance <= np.partition(distance, k - 1)[k - 1]
        rows, distance = rows[some], distance[some]
    order = np.lexsort((ids[rows], distance))[:k]
    return ids[rows[order]], distance[order]


_FOUND = "query_id long, vec_id long, score double, visited long"


def met(vectors: DataFrame, asked: DataFrame, settings: Settings) -> DataFrame:
    """Each query's best rows of every group ``tab, shard`` that it visits, and one row that counts the visited ones.

    A shard of more vectors or queries than a block is dealt into parts that meet each other.
    """
    parts = vectors.groupBy("tab", "shard").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("salts"))
    asks = asked.groupBy("tab", "shard").agg(F.ceil(F.count("*") / settings.query_block).cast("int").alias("turns"))
    groups = written(parts.join(asks, ["tab", "shard"]), "ann-groups")
    name = F.xxhash64("tab", "shard", "salt", "turn").alias("grp")
    blank = F.lit(None).cast("binary")
    left = (
        vectors.join(groups, ["tab", "shard"]).withColumn("salt", F.pmod(F.xxhash64("vec_id", "vector"), F.col("salts")).cast("int"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).select(name, F.lit(0).alias("kind"), "vec_id", "vector", "bucket", blank.alias("buckets"))
    )
    right = (
        asked.join(groups, ["tab", "shard"]).withColumn("turn", F.pmod(F.xxhash64("vec_id", "vector"), F.col("turns")).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select(name, F.lit(1).alias("kind"), "vec_id", "vector", F.lit(0).cast("long").alias("bucket"), "buckets")
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_slices(batches, "grp"):
            kind = group.column("kind").to_numpy(zero_copy_only=False)
            own, asks = group.filter(pa.array(kind == 0)), group.filter(pa.array(kind == 1))
            if not own.num_rows or not asks.num_rows:
                continue
            bucket = own.column("bucket").to_numpy(zero_copy_only=False)
            order = np.argsort(bucket, kind="stable")
            bucket, ids, x = bucket[order], own.column("vec_id").to_numpy(zero_copy_only=False)[order], vector_matrix(own.column("vector"))[order]
            out: list[list] = [[], [], [], []]
            for query, vector, visits in zip(asks.column("vec_id").to_pylist(), vector_matrix(asks.column("vector")), asks.column("buckets").to_pylist(), strict=True):
                if visits is None:
                    rows = np.arange(len(ids))
                else:
                    wanted = np.frombuffer(visits, np.int64)
                    first, last = np.searchsorted(bucket, wanted), np.searchsorted(bucket, wanted, "right")
                    n = last - first
                    rows = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
                found, distance = nearest(vector, query, x, ids, rows, settings.k)
                count = np.arange(len(found) + 1) == len(found)  # the last row counts
                out[0].append(np.full(len(count), query))
                out[1].append(np.append(found, 0))
                out[2].append(np.append(distance, 0.0))
                out[3].append(np.where(count, len(rows), -1))
            query, found, distance, visited = (np.concatenate(c) for c in out)
            count = visited >= 0
            yield pa.RecordBatch.from_arrays([
                pa.array(query, pa.int64()), pa.array(found, pa.int64(), mask=count), pa.array(distance, mask=count), pa.array(visited, pa.int64(), mask=~count),
            ], names=["query_id", "vec_id", "score", "visited"])

    return left.union(right).repartition("grp").sortWithinPartitions("grp", "kind").mapInArrow(rank, _FOUND)


def search(embeddings: DataFrame, is_query, settings: Settings = Settings(), id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score, visited``: the nearest rows found for each row for which ``is_query`` holds.

    Score is the Euclidean distance of the original vectors in double precision; ties go to
    smaller ids. Rows with a null id, and vectors that are null, empty, zero or hold a null or
    non-finite number, take no part, nor do vectors of another dimension than most. Rows with
    the query's id are its own. ``visited`` counts the rows that the query was compared with,
    once for every table. A query for which the visited buckets hold fewer than ``k`` others, or
    that would have to visit more than ``most``, is compared with all rows, so it gets the true
    ones. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    valid = vector_bytes(embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("embedding")), "embedding").drop("embedding").where("vector is not null and vec_id is not null")
    sizes = valid.groupBy(F.length("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, visited long")
    valid = valid.where(F.length("vector") == sizes["size"])
    # at most settings.sample vectors
    sample = [r["vector"] for r in valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).collect()]
    index = fit(np.stack([np.frombuffer(v) for v in sample]), sizes["count"], settings)
    shards = max(1, -(-sizes["count"] // settings.block))
    share = 1 - (1 - settings.recall) ** (1 / settings.tables)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = index.buckets(vector_matrix(batch.column("vector")))
                n, t = names.shape
                twice = pa.array(np.repeat(np.arange(n), t))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(t, dtype=np.int32), n)), pa.array((names.ravel() % shards).astype(np.int32)),
                    batch.column("vec_id").take(twice), batch.column("vector").take(twice), pa.array(names.ravel()),
                ], names=["tab", "shard", "vec_id", "vector", "bucket"])

    def around(z: np.ndarray, t: int) -> np.ndarray:
        """Buckets visited first: by how near the query is to the steps' ends."""
        return bucket_names(probes(z[t], np.full(index.projections, index.width / 2), index.offset[t], index.width, 1.0, settings.first)[0])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets of the first visit, or, with the distance it found in ``reach``, the others that are needed.

        A row with ``buckets`` null stands for a query that needs more than there may be.
        """
        for batch in batches:
            reaches = batch.column("reach").to_pylist()
            for one, (query, z) in enumerate(zip(vector_matrix(batch.column("vector")), index.projected(vector_matrix(batch.column("vector"))), strict=True)):
                wanted: list = [around(z, t) for t in range(index.tables)]
                if reaches[one] >= 0:
                    distance = min(reaches[one], index.bound(query, settings.k))
                    more = []
                    if math.isfinite(distance):
                        follow, spread = index.law(query, distance)
                        more = [probes(follow * z[t], spread[t], index.offset[t], index.width, share, settings.most) for t in range(index.tables)]
                    if not more or not all(enough for _, enough in more):
                        wanted = [None]
                    else:
                        wanted = [np.setdiff1d(bucket_names(steps), seen) for (steps, _), seen in zip(more, wanted, strict=True)]
                for t, names in enumerate(wanted):
                    to = np.arange(shards) if names is None else names % shards
                    hit = np.unique(to)
                    again = pa.array(np.full(len(hit), one))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(hit), t, np.int32)), pa.array(hit.astype(np.int32)), batch.column("vec_id").take(again), batch.column("vector").take(again),
                        pa.array([None if names is None else names[to == h].tobytes() for h in hit], pa.binary()),
                    ], names=["tab", "shard", "vec_id", "vector", "buckets"])

    asking = "tab int, shard int, vec_id long, vector binary, buckets binary"
    vectors = written(valid.mapInArrow(placed, "tab int, shard int, vec_id long, vector binary, bucket long"), "ann-index")
    queries = valid.where(is_query(F.col("vec_id")))
    asked = written(queries.select("vec_id", "vector", F.lit(-1.0).alias("reach")).mapInArrow(visits, asking), "ann-probes")
    first = written(met(vectors, asked, settings), "ann-found")
    reach = _best(first, settings.k).groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") == settings.k, F.max("score")).alias("d"))
    near = queries.join(reach, "vec_id", "left").select("vec_id", "vector", F.coalesce("d", F.lit(math.inf)).alias("reach"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: not one task
    asked = written(near.repartition(parts, F.xxhash64("vec_id")).mapInArrow(visits, asking), "ann-probes")
    found = first.unionByName(written(met(vectors, asked.where("buckets is not null"), settings), "ann-found"))
    whole = asked.where("buckets is null").select("vec_id").distinct()
    few = queries.select("vec_id").distinct().join(found.where("vec_id is not null").groupBy(F.col("query_id").alias("vec_id")).agg(F.countDistinct("vec_id", "score").alias("n")), "vec_id", "left").where(F.coalesce("n", F.lit(0)) < settings.k).select("vec_id")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    rest = queries.join(few.union(whole).distinct(), "vec_id")
    rest = written(rest.select(F.lit(0).alias("tab"), everywhere, "vec_id", "vector", F.lit(None).cast("binary").alias("buckets")), "ann-few")
    if not rest.isEmpty():
        found = found.unionByName(met(vectors.where("tab = 0"), rest, settings))
    found = written(found, "ann-found")
    counts = found.groupBy("query_id").agg(F.sum("visited").alias("visited"))
    return _best(found, settings.k).join(counts, "query_id").select("query_id", "rank", "vec_id", "score", "visited")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of the rows found for each query, each once, numbered from 1."""
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.where("vec_id is not null").select("query_id", "vec_id", "score").distinct().withColumn("rank", order).where(F.col("rank") <= k)
