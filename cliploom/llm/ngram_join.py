"""N-gram Jaccard join with a prefix tree over globally ordered sets.

Texts become sets of hashed word n-grams; texts with equal sets are one class from here on.
The global order is by the number of classes that hold an n-gram, rarest first, counted over
all texts: ranges of the hash space meet in one task each, which counts, and hands back to
every class those of its n-grams that some other class holds too. A class links with another
only if an n-gram is common to their prefixes in this order, and prefixes consist mostly of
n-grams that nobody shares, so only near copies remain. Classes connected through prefix
n-grams form a cluster; within a cluster the ordered sets are stored in a trie, and each set
walks it with the overlap so far, leaving subtrees whose remaining lengths cannot suffice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.llm.graph import components, written
from cliploom.llm.runs import group_slices
from cliploom.llm.words import mix, text_chunks, text_words, window_hashes

WORDS = 5
#: Two sets link when PERCENT of their union, at least, is common to both.
PERCENT = 75
#: Classes of a cluster that one task holds; larger clusters are joined block by block.
BLOCK = 1024
#: Classes a task remembers in order not to send equal sets twice.
MEMO = 200_000
#: n-grams of a range, whose copies meet in one task, and of a bucket of classes.
RANGE_NGRAMS = 3_000_000
BUCKET_NGRAMS = 6_000_000
#: Parts of a range that are counted one after another, to bound what a task holds.
TURNS = 8


def ngram_sets(texts: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending, the n + 1 bounds of the texts, and a hash of each set.

    A text of fewer words than ``width`` has its whole sequence as its one n-gram.
    """
    words, first = text_words(texts, lower=True)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    hashes = window_hashes(words, width)
    inside = np.arange(len(hashes)) + width <= first[1:][owner[: len(hashes)]]
    hashes, owner = hashes[inside], owner[: len(inside)][inside]
    for few in range(1, width):
        texts_of = np.flatnonzero(n_words == few)
        hashes = np.concatenate((hashes, window_hashes(words, few)[first[texts_of]] ^ np.uint64(few)))
        owner = np.concatenate((owner, texts_of))
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(n_words) + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes), dtype=np.uint64)))
    names = mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return hashes, bounds, names.view(np.int64)


def set_names(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """``docs`` with ``n_shingles`` and ``class``, a 64-bit name of the set (null for the empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            _, bounds, names = ngram_sets(chunk.column("text"), width)
            n = np.diff(bounds)
            rest = [c for c in chunk.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(chunk.column(c) for c in rest), pa.array(n), pa.array(names, mask=n == 0)], names=[*rest, "n_shingles", "class"])

    fields = [f for f in docs.schema if f.name != "text"]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("n_shingles", T.LongType()), T.StructField("class", T.LongType())]))


def by_range(docs: DataFrame, ranges: int, width: int) -> DataFrame:
    """The sets cut by ranges of the hash space: for each range and chunk of texts the low 48 bits of the hashes, class by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for chunk in text_chunks(batches, "text"):
            hashes, bounds, names = ngram_sets(chunk.column("text"), width)
            fresh = np.zeros(len(names), bool)
            for i, name in enumerate(names.tolist()):
                if name not in sent:
                    fresh[i] = True
                    if len(sent) < MEMO:
                        sent.add(name)
            sizes = np.diff(bounds)
            owner = np.repeat(np.arange(len(names)), sizes)
            keep = fresh[owner]
            hashes, owner = hashes[keep], owner[keep]
            of = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(of.astype(np.uint16) if ranges < 1 << 16 else of, kind="stable")
            hashes, owner, of = hashes[order], owner[order], of[order]
            low = hashes.view(np.uint8).reshape(-1, 8)[:, :6]
            cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1], [True]))) if len(of) else np.zeros(1, int)
            rows: list[list] = [[], [], [], [], []]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                at = np.flatnonzero(np.concatenate(([True], owner[a + 1 : b] != owner[a : b - 1])))
                who = owner[a:b][at]
                for column, value in zip(rows, (of[a], low[a:b].tobytes(), names[who].tobytes(), sizes[who].astype(np.uint32).tobytes(), np.diff(np.append(at, b - a)).astype(np.uint32).tobytes()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(rows[0], np.int64)), *(pa.array(r, pa.binary()) for r in rows[1:])], names=["part", "low", "classes", "sizes", "counts"]
            )

    return docs.mapInArrow(run, "part long, low binary, classes binary, sizes binary, counts binary")


def held_twice(low: np.ndarray, who: np.ndarray, classes: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Order keys of the n-grams that several classes hold, and for each the row of a class that does."""
    h = np.zeros((len(low), 8), np.uint8)
    h[:, :6] = low
    h = h.view(np.uint64).ravel()
    order = np.argsort(h)
    h, who = h[order], who[order]
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[:-1] |= again[1:]
    h, who = h[again], who[again]
    order = np.lexsort((classes[who], h))
    h, who = h[order], who[order]
    new = np.ones(len(h), bool)  # equal sets from several tasks count once
    new[1:] = (h[1:] != h[:-1]) | (classes[who[1:]] != classes[who[:-1]])
    h, who = h[new], who[new]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
    held = np.repeat(np.diff(np.append(start, len(h))), np.diff(np.append(start, len(h))))
    h, who, held = h[held > 1], who[held > 1], held[held > 1]
    rare = np.minimum(255, np.log2(np.maximum(held, 1)) * 6).astype(np.uint64)
    return (rare << np.uint64(56)) | (mix(h + (np.uint64(part) << np.uint64(48))) >> np.uint64(8)), who


def shared_items(parts: DataFrame, buckets: int) -> DataFrame:
    """For each range and bucket of classes the n-grams that other classes hold too, as order keys, class by class.

    An order key is an unsigned 64-bit number: eight bits for the number of classes on a
    logarithmic scale, then a hash of the n-gram; comparing keys compares in the global order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_slices(batches, "part"):
            part = group.column("part")[0].as_py()
            low = np.frombuffer(b"".join(group.column("low").to_pylist()), np.uint8).reshape(-1, 6)
            classes, sizes, counts = (np.frombuffer(b"".join(group.column(c).to_pylist()), kind) for c, kind in (("classes", np.int64), ("sizes", np.uint32), ("counts", np.uint32)))
            del group
            whose = np.repeat(np.arange(len(classes), dtype=np.int32), counts)
            turn, found = low[:, 5] // (256 // TURNS), []
            for t in range(TURNS):
                rows = np.flatnonzero(turn == t)
                found.append(held_twice(low[rows], whose[rows], classes, part))
            keys, who = (np.concatenate(x) for x in zip(*found, strict=True))
            del low, whose, turn, found
            own, n = classes[who], sizes[who]
            bucket = (mix(own.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            keys, own, n, bucket = keys[order], own[order], n[order], bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(own) else np.zeros(1, int)
            ends = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]]), *(pa.array([x[a:b].tobytes() for a, b in ends], pa.binary()) for x in (keys, own, n))], names=["bucket", "items", "classes", "sizes"]
            )

    return parts.repartition("part").sortWithinPartitions("part").mapInArrow(run, "bucket long, items binary, classes binary, sizes binary")


def least_common(n: np.ndarray | int) -> np.ndarray | int:
    """Elements that a set of ``n`` must share with a partner, at least."""
    return -(-PERCENT * n // 100)


def candidate_sets(items: DataFrame) -> DataFrame:
    """``class, n, items, prefix``: the classes that can link, with their shared n-grams in global order and those of the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_slices(batches, "bucket"):
            keys, classes, sizes = (np.frombuffer(b"".join(group.column(c).to_pylist()), kind) for c, kind in (("items", np.uint64), ("classes", np.int64), ("sizes", np.uint32)))
            order = np.lexsort((keys, classes))
            keys, classes, sizes = keys[order], classes[order], sizes[order].astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1], [True])))
            first, shared = cuts[:-1], np.diff(cuts)
            n = sizes[first]
            lead = n - least_common(n) + 1 - (n - shared)  # n-grams that nobody shares come first
            some = np.flatnonzero(lead > 0)
            lists = [keys[a : a + m] for a, m in zip(first[some].tolist(), shared[some].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(classes[first[some]]), pa.array(n[some]), pa.array([x.tobytes() for x in lists], pa.binary()),
                pa.array([x[:m].view(np.int64) for x, m in zip(lists, lead[some].tolist(), strict=True)], pa.list_(pa.int64())),
            ], names=["class", "n", "items", "prefix"])

    return items.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "class long, n long, items binary, prefix array<long>")


class Trie:
    """Prefix tree of ascending sets; a node's segment lies between two depths of one of its sets."""

    def __init__(self, sets: list[np.ndarray], n: np.ndarray):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.n = n[self.order]
        lengths = np.array([len(x) for x in self.sets])
        common = np.zeros(len(sets), np.int64)
        for k in range(1, len(sets)):
            a, b = self.sets[k - 1], self.sets[k]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[k] = differ[0] if len(differ) else m
        self.nodes: list[tuple] = []
        todo = [(0, len(sets), 0, -1)]
        self.children: list[list[int]] = []
        while todo:
            low, high, depth, parent = todo.pop()
            end = int(common[low + 1 : high].min()) if high - low > 1 else int(lengths[low])
            me = len(self.nodes)
            longest = int(lengths[low:high].max()) - end
            self.nodes.append((low, high, self.sets[low][depth:end], longest, int(self.n[low:high].min()), int(self.n[low:high].max())))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(me)
            if high - low > 1:
                cuts = [low, *(low + 1 + np.flatnonzero(common[low + 1 : high] == end)).tolist(), high]
                todo += [(a, b, end, me) for a, b in zip(cuts, cuts[1:], strict=False)]

    def partners(self, at: int) -> Iterator[int]:
        """Places behind ``at`` in the tree's order whose sets link with the set there."""
        x, n = self.sets[at], int(self.n[at])
        shortest, longest = least_common(n), 100 * n // PERCENT
        todo = [(0, 0)]
        while todo:
            node, overlap = todo.pop()
            low, high, segment, rest, n_low, n_high = self.nodes[node]
            if high <= at + 1 or n_high < shortest or n_low > longest:
                continue
            left = len(x)
            if len(segment):
                where = np.searchsorted(x, segment)
                overlap += int((x[np.minimum(where, len(x) - 1)] == segment).sum()) if len(x) else 0
                left = len(x) - int(where[-1])
            elif node == 0 or not rest:
                left = len(x)
            most = overlap + min(left, rest)
            smaller = max(n_low, shortest)
            if (100 + PERCENT) * most < PERCENT * (n + smaller):
                continue
            if high - low == 1:
                other = int(self.n[low])
                if 100 * overlap >= PERCENT * (n + other - overlap):
                    yield low
            else:
                todo += [(child, overlap) for child in self.children[node]]


def joined_blocks(work: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all linked classes of each group of ``work(grp, class, n, items)``, as stars.

    Groups of two blocks report links between the blocks and inside them alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_slices(batches, "grp"):
            if group.num_rows < 2:
                continue
            classes = group.column("class").to_numpy(zero_copy_only=False)
            trie = Trie([np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()], group.column("n").to_numpy(zero_copy_only=False))
            root = list(range(group.num_rows))

            def find(i: int, root: list[int] = root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for at in range(group.num_rows):
                for other in trie.partners(at):
                    i, j = find(at), find(other)
                    root[max(i, j)] = min(i, j)
            label = np.array([find(i) for i in range(group.num_rows)])
            classes = classes[trie.order]
            least = np.full(len(label), np.iinfo(np.int64).max)
            np.minimum.at(least, label, classes)
            some = np.flatnonzero(classes != least[label])
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(classes[some]), pa.array(least[label[some]])], names=["a", "b"])

    return work.repartition("grp").sortWithinPartitions("grp").select("grp", "class", "n", "items").mapInArrow(run, "a long, b long")


def class_components(docs: DataFrame, named: DataFrame, width: int = WORDS, block: int = BLOCK) -> DataFrame:
    """``node, component`` for every class of ``docs(text)`` that links with another one.

    Ranges of hashes, and buckets of classes, are as many as the n-grams counted in ``named``
    need, so tasks hold as much whatever the number of partitions.
    """
    total = named.agg(F.sum("n_shingles")).first()[0] or 0
    ranges, buckets = max(1, -(-total // RANGE_NGRAMS)), max(1, -(-total // BUCKET_NGRAMS))
    sets = written(candidate_sets(shared_items(by_range(docs.select("text"), ranges, width), buckets)), "sets")
    entries = sets.select("class", F.explode("prefix").alias("item"))
    pivots = entries.groupBy("item").agg(F.min("class").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    meets = entries.join(pivots, "item").where(F.col("class") != F.col("pivot")).select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()
    clusters = components(meets).select(F.col("node").alias("class"), F.col("component").alias("cluster"))
    blocks = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = written(clusters.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).join(sets.drop("prefix"), "class"), "clusters")

    def met(rows: DataFrame, wanted) -> DataFrame:
        """Every block pair (i, j) for which ``wanted`` holds, as a group."""
        pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
        spread = rows.withColumn("p", F.explode(F.filter(pair, wanted)))
        return joined_blocks(spread.select(F.xxhash64("cluster", "p.i", "p.j").alias("grp"), "class", "n", "items"))

    # first each block with itself and with block 0; most clusters are one component then
    links = written(met(placed, lambda p: (p["i"] == 0) | (p["i"] == p["j"])), "links")
    found = components(links)
    large = placed.where("blocks > 2").select("class", "cluster").join(found.withColumnRenamed("node", "class"), "class", "left")
    split = large.groupBy("cluster").agg(F.min(F.coalesce("component", "class")).alias("low"), F.max(F.coalesce("component", "class")).alias("high")).where("low <> high").select("cluster")
    split = written(split, "split")
    if split.isEmpty():
        return found
    more = met(placed.join(split, "cluster", "left_semi"), lambda p: (p["i"] > 0) & (p["i"] < p["j"]))
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))


def near_copies(docs: DataFrame, width: int = WORDS, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, class, component_id`` for each row of ``docs(doc_id, text)``.

    Null text and text without words has the empty set, no class, and its own id as component.
    Rows with equal sets are linked; a repeated id is as many documents, and a component is
    named by its smallest id. An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    named = written(set_names(docs, width), "set-names")
    member = class_components(docs, named, width, block).select(F.col("node").alias("class"), "component")
    classes = named.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    classes = classes.join(member, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    found = classes.join(least, "component").select("class", "component_id")
    return named.join(found, "class", "left").select("doc_id", "n_shingles", "class", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WORDS, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` with one row left of each group of near copies, that of the smallest id.

    Rows without words stay. Of rows that agree in every column one stays; a null id counts as
    the smallest.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))  # so that no name clashes
    rows = docs.select(own.alias("own"), "doc_id", F.col("text").cast("string").alias("text")).withColumns({"row_one": F.xxhash64("own"), "row_two": F.xxhash64(F.lit(1), "own")})
    named = written(set_names(rows.drop("own"), width), "set-names")
    member = class_components(rows.select("text"), named, width, block).select(F.col("node").alias("class"), "component")
    told = named.where("class is not null").join(member, "class", "left").withColumn("component", F.coalesce("component", "class"))
    first = told.groupBy("component").agg(F.min(F.struct("doc_id", "row_one", "row_two")).alias("first")).select("first.row_one", "first.row_two")
    stay = first.union(named.where("class is null").select("row_one", "row_two").distinct())
    linked = rows.select("own", "row_one", "row_two").join(stay, ["row_one", "row_two"], "left_semi")
    return linked.dropDuplicates(["row_one", "row_two"]).select(*(F.col(f"own.`{c}`").alias(c) for c in docs.columns))


COMPONENTS_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words
), items AS (
  SELECT doc_id, unnest(s) AS item FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b WHERE 100 * p.n >= 75 * (len(x.s) + len(y.s) - p.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM sets s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
