"""Cross-tokenizer alignment with a fast path for tokens of the same bytes.

Two tokenizers cut the same bytes; places where both cut divide a text into groups. An array
over the first vocabulary names, for each of its ids, the id of the second one with the same
bytes. Pairs of that array are counted in one vector as long as the vocabulary; only the other,
irregular pairs are shuffled to be counted and their counts are sent back to the texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm.graph import written
from cliploom.llm.runs import group_slices
from cliploom.llm.words import mix, text_chunks, tool

#: Segments whose alignment a Python worker remembers, and the longest of them; others are aligned where they occur.
MEMO_SEGMENTS = 60_000
MEMO_CHARS = 64
#: Segments that are encoded in one go.
GROUP = 500
#: Distinct irregular pairs whose counts one task looks up.
BUCKET_PAIRS = 250_000

_SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# white space other than space and line feed, in front of one of these: there the text is not cut
_UNSAFE = re.compile(r"[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000][ \n]")
_GUARD = " ."

TOTALS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_TOTALS_ARROW = pa.struct([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
])
CHUNKS = f"chunk long, docs array<struct<{TOTALS.replace(' long', ':long').replace(' string', ':string')}>>, same binary, pairs binary, codes binary, code_docs binary"
_SAME = np.dtype([("doc", "<u4"), ("a", "<u4"), ("n", "<u4")])
_PAIR = np.dtype([("doc", "<u4"), ("at", "<u4"), ("n", "<u4")])


def byte_level_bytes(token: str, table: dict[str, int] = {}) -> bytes:
    """Bytes of an entry of a byte-level vocabulary, where unprintable bytes are letters from U+0100 on."""
    if not table:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        table |= {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: U+2581 is a space, ``<0xHH>`` a byte."""
    return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("\u2581", " ").encode()


@dataclass
class Segments:
    """Alignment of some segments: tokens of both sides and groups, groups as text, and where each one's links lie in ``pool``."""

    good: np.ndarray  # whether both tokenizers give the bytes back
    counts: np.ndarray
    first: np.ndarray
    links: np.ndarray
    pool: np.ndarray
    shown: list[bytes]

    @classmethod
    def blank(cls, n: int) -> Segments:
        return cls(np.zeros(n, bool), np.zeros((n, 3), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.empty(0, "<u4"), [b""] * n)

    def codes(self, which: np.ndarray) -> np.ndarray:
        """Links of the named segments on end."""
        n = self.links[which]
        ends = np.cumsum(n)
        return self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[which] - ends + n, n)]

    def some(self, which: np.ndarray) -> Segments:
        n = self.links[which]
        return Segments(self.good[which], self.counts[which], np.cumsum(n) - n, n, self.codes(which), [self.shown[i] for i in which.tolist()])

    def __add__(self, other: Segments) -> Segments:
        return Segments(
            np.concatenate((self.good, other.good)), np.concatenate((self.counts, other.counts)), np.concatenate((self.first, other.first + len(self.pool))),
            np.concatenate((self.links, other.links)), np.concatenate((self.pool, other.pool)), self.shown + other.shown,
        )


class Aligner:
    """Both tokenizers and the map from ids of the first to same-bytes ids of the second."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        names = {i: token for token, i in self.a.get_vocab().items()}
        a_bytes = [byte_level_bytes(names[i]) if i in names else b"" for i in range(max(names) + 1)]
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        # a piece of its own goes before the byte of the same value
        order = sorted(range(len(self.b_bytes)), key=lambda i: (self.b.is_byte(i), i), reverse=True)
        at = {self.b_bytes[i]: i for i in order if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))}
        self.width = len(self.b_bytes)
        self.same = np.array([at.get(x, -1) for x in a_bytes], np.int64)
        self.a_sizes = np.array([len(x) for x in a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        decimal = np.array([str(i) for i in range(max(len(a_bytes), self.width))], "S")
        self.digits = np.pad(decimal.view(np.uint8).reshape(len(decimal), -1), ((0, 0), (0, 1)))
        self.n_digits = np.char.str_len(decimal)
        self.memo: dict[str, int] = {}
        self.known = Segments.blank(0)

    def is_same(self, codes: np.ndarray) -> np.ndarray:
        """Which pairs of ``a * width + b`` are pairs of the map."""
        codes = codes.astype(np.int64)
        return self.same[codes // self.width] == codes % self.width

    def cut(self, text: str) -> list[str]:
        """Space and text in segments that neither tokenizer looks across; none where the second can't give the bytes back."""
        if "\u2581" in text:  # a piece has no such bytes
            return []
        text = " " + text
        return [text] if _UNSAFE.search(text) else _SEGMENT.findall(text)

    def align(self, segments: list[str]) -> Segments:
        """Alignment of each segment, whatever stands around it.

        Segments that may stand side by side without a change are encoded together behind a
        guard, others alone; so are those of a group whose bytes do not come back.
        """
        found = Segments.blank(len(segments))
        joint = [i for i, s in enumerate(segments) if not s[-1].isspace()]
        groups = [joint[i : i + GROUP] for i in range(0, len(joint), GROUP)] + [[i] for i, s in enumerate(segments) if s[-1].isspace()]
        while groups:
            texts = [_GUARD + "".join([segments[i] for i in g]) for g in groups]
            a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            b = self.b.encode([t[1:] for t in texts], num_threads=1)  # it adds the space
            good = [b"".join([self.b_bytes[i] for i in ids]) == t.encode() for ids, t in zip(b, texts, strict=True)]
            kept = [i for i, ok in enumerate(good) if ok]
            if kept:
                self._measure(found, segments, [groups[i] for i in kept], [a[i] for i in kept], [b[i] for i in kept])
            groups = [[i] for g, ok in zip(groups, good, strict=True) if not ok and len(g) > 1 for i in g]
        return found

    def _measure(self, found: Segments, segments: list[str], groups: list[list[int]], a: list[list[int]], b: list[list[int]]) -> None:
        order = np.fromiter(chain.from_iterable([-1, *g] for g in groups), np.int64)
        sizes = np.fromiter((len(segments[i].encode()) if i >= 0 else len(_GUARD) for i in order.tolist()), np.int64, len(order))
        ends = np.cumsum(sizes)
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at_a, at_b = np.zeros(ends[-1] + 1, bool), np.zeros(ends[-1] + 1, bool)
        at_a[a_ends] = at_b[b_ends] = True
        cuts, both = np.flatnonzero(at_a | at_b), np.flatnonzero(at_a & at_b)  # a link is a stretch between two cuts
        codes = (a[np.searchsorted(a_ends, cuts)] * self.width + b[np.searchsorted(b_ends, cuts)]).astype("<u4")
        # groups as text: ids of the first side, those of the second, each with the mark behind it
        of_a, of_b = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        to_a, to_b = np.searchsorted(a_ends, both, "right"), np.searchsorted(b_ends, both, "right")
        ids, marks = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        in_a, in_b = np.arange(len(a)) + np.concatenate(([0], to_b))[of_a], np.arange(len(b)) + to_a[of_b]
        ids[in_a], ids[in_b] = a, b
        marks[in_a], marks[in_b] = np.where(at_b[a_ends], ord("|"), ord(",")), np.where(at_a[b_ends], ord(";"), ord(","))
        rows, n = self.digits[ids], self.n_digits[ids]
        rows[np.arange(len(ids)), n] = marks
        raw = rows[np.arange(rows.shape[1]) <= n[:, None]].tobytes()
        upto = [np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, both, cuts)]
        text = np.concatenate(([0], np.cumsum(n + 1)))[upto[0] + upto[1]]
        n_a, n_b, n_groups, n_links, n_text = (np.diff(x, prepend=0) for x in (*upto, text))
        own = order >= 0
        to = order[own]
        found.good[to] = True
        found.counts[to] = np.stack((n_a, n_b, n_groups), 1)[own]
        found.first[to], found.links[to] = (upto[3] - n_links)[own] + len(found.pool), n_links[own]
        found.pool = np.concatenate((found.pool, codes))
        for i, start, end in zip(to.tolist(), (text - n_text)[own].tolist(), text[own].tolist(), strict=True):
            found.shown[i] = raw[start:end]

    def looked_up(self, segments: list[str]) -> tuple[Segments, np.ndarray]:
        """Alignment of the distinct segments, and the place of each segment there."""
        keys = list(dict.fromkeys(segments))
        new = [k for k in keys if k not in self.memo]
        held, found = len(self.memo), self.align(new)
        index = self.memo | {k: held + i for i, k in enumerate(new)}
        which = np.fromiter(map(index.__getitem__, segments), np.int64, len(segments))
        every = self.known + found
        learn = [i for i, k in enumerate(new) if len(k) <= MEMO_CHARS][: max(0, MEMO_SEGMENTS - held)]
        if learn:
            self.memo |= {new[i]: held + n for n, i in enumerate(learn)}
            self.known = self.known + found.some(np.array(learn))
        return every, which

    def chunk(self, doc_ids: list, texts: list) -> tuple:
        """Totals of each text, its pairs with their occurrences, and all irregular pairs with the number of texts that hold them."""
        cut = [self.cut(t) if t else [] for t in texts]
        found, which = self.looked_up(list(chain.from_iterable(cut)))
        n = np.array([len(c) for c in cut], np.int64)
        of_doc, bounds = np.repeat(np.arange(len(cut)), n), np.concatenate(([0], np.cumsum(n)))
        usable = (n > 0) & (np.bincount(of_doc, ~found.good[which], len(cut)) == 0)
        counts = np.stack([np.bincount(of_doc, found.counts[which, k], len(cut)) for k in range(3)], 1).astype(np.int64)
        totals, places, starts = [], which.tolist(), bounds.tolist()
        for d, (doc_id, ok, (n_a, n_b, n_groups)) in enumerate(zip(doc_ids, usable.tolist(), counts.tolist(), strict=True)):
            if not ok:
                totals.append((doc_id, 0, 0, 0, 0, ""))
                continue
            shown = b"".join([found.shown[i] for i in places[starts[d] : starts[d + 1]]])
            totals.append((doc_id, n_a, n_b, n_groups, n_a + n_b - n_groups, hashlib.sha256(shown[:-1]).hexdigest()))
        which, of_doc = which[usable[of_doc]], of_doc[usable[of_doc]]
        links = found.codes(which).astype(np.uint64) | (np.repeat(of_doc, found.links[which]).astype(np.uint64) << np.uint64(32))
        links.sort()
        start = np.flatnonzero(np.concatenate((np.ones(min(len(links), 1), bool), links[1:] != links[:-1])))
        held, times = links[start], np.diff(start, append=len(links))
        doc, code = (held >> np.uint64(32)).astype(np.uint32), held.astype(np.uint32)
        fast = self.is_same(code)
        same = np.empty(int(fast.sum()), _SAME)
        same["doc"], same["a"], same["n"] = doc[fast], code[fast] // self.width, times[fast]
        codes, at, code_docs = np.unique(code[~fast], return_inverse=True, return_counts=True)
        pairs = np.empty(len(at), _PAIR)
        pairs["doc"], pairs["at"], pairs["n"] = doc[~fast], at, times[~fast]
        return totals, same, pairs, codes, code_docs


def aligner_at(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner, read once for all of its tasks."""
    return tool(("alignment", a_path, b_path), lambda: Aligner(a_path, b_path))


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for about 1 MB of texts, or for one longer text: see ``Aligner.chunk``.  ``code_docs`` are texts, not occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, part = aligner_at(a_path, b_path), TaskContext.get().partitionId()
        for nth, batch in enumerate(text_chunks(batches, "text")):
            totals, same, pairs, codes, code_docs = aligner.chunk(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            docs_ = pa.array([[dict(zip(_TOTALS_ARROW.names, t, strict=True)) for t in totals]], pa.list_(_TOTALS_ARROW))
            binaries = [pa.array([x.tobytes()], pa.binary()) for x in (same, pairs, codes.astype("<u4"), code_docs.astype("<u4"))]
            yield pa.RecordBatch.from_arrays([pa.array([(part << 32) | nth], pa.int64()), docs_, *binaries], names=["chunk", "docs", "same", "pairs", "codes", "code_docs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, CHUNKS)


def pair_documents(chunks: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``a, b, same, n_docs``: documents that hold each pair linked; ``same`` marks pairs of the identity map.

    Pairs of the map are added up in one vector for each task; only others are rows for each chunk.
    """
    schema = "a int, b int, same boolean, n long"

    def rows(aligner: Aligner, codes: np.ndarray, n: np.ndarray, same: bool) -> pa.RecordBatch:
        codes = codes.astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array((codes // aligner.width).astype(np.int32)), pa.array((codes % aligner.width).astype(np.int32)),
            pa.array(np.full(len(codes), same)), pa.array(n.astype(np.int64)),
        ], names=["a", "b", "same", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_at(a_path, b_path)
        vector = np.zeros(len(aligner.same), np.int64)
        for batch in batches:
            for same, codes, code_docs in zip(*(batch.column(c).to_pylist() for c in ("same", "codes", "code_docs")), strict=True):
                vector += np.bincount(np.frombuffer(same, _SAME)["a"], minlength=len(vector))
                codes = np.frombuffer(codes, "<u4")
                if len(codes):
                    yield rows(aligner, codes, np.frombuffer(code_docs, "<u4"), False)
        held = np.flatnonzero(vector)
        if len(held):
            yield rows(aligner, held * aligner.width + aligner.same[held], vector[held], True)

    return chunks.select("same", "codes", "code_docs").mapInArrow(run, schema).groupBy("a", "b", "same").agg(F.sum("n").alias("n_docs"))


def vocabulary_vectors(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each id of the first vocabulary: the documents of its pair in the map, and of its most frequent pair."""
    same, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    # one row for each id of the vocabulary, whatever the number of documents
    for row in counts.groupBy("a").agg(F.max(F.when(F.col("same"), F.col("n_docs"))).alias("same"), F.max("n_docs").alias("best")).collect():
        same[row["a"]], best[row["a"]] = row["same"] or 0, row["best"]
    return same, best


def answered(chunks: DataFrame, counts: DataFrame, width: int, buckets: int) -> DataFrame:
    """``chunk, bucket, n``: for each chunk the documents of its irregular pairs, those of one bucket of pairs on end."""
    blank = F.lit(None).cast("binary")

    def bucket_of(codes: np.ndarray) -> np.ndarray:
        return (mix(codes.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, codes in zip(batch.column("chunk").to_pylist(), batch.column("codes").to_pylist(), strict=True):
                codes = np.frombuffer(codes, "<u4")
                bucket = bucket_of(codes)
                order = np.argsort(bucket, kind="stable")
                named, at = np.unique(bucket[order], return_index=True)
                parts = np.split(codes[order], at[1:])
                yield pa.RecordBatch.from_arrays([
                    pa.array(named), pa.array(np.ones(len(named), np.int32)), pa.array(np.full(len(named), chunk, np.int64)),
                    pa.array([p.tobytes() for p in parts[: len(named)]], pa.binary()), pa.nulls(len(named), pa.binary()),
                ], names=["bucket", "kind", "chunk", "codes", "n"])

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy(zero_copy_only=False).astype("<u4")
            n, bucket = batch.column("n_docs").to_numpy(zero_copy_only=False), bucket_of(codes)
            order = np.argsort(bucket, kind="stable")
            named, at = np.unique(bucket[order], return_index=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(named), pa.array(np.zeros(len(named), np.int32)), pa.nulls(len(named), pa.int64()),
                *(pa.array([p.tobytes() for p in np.split(x[order], at[1:])[: len(named)]], pa.binary()) for x in (codes, n)),
            ], names=["bucket", "kind", "chunk", "codes", "n"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, codes, n = None, np.empty(0, "<u4"), np.empty(0, np.int64)
        parts: list[tuple[bytes, bytes]] = []
        for batch in batches:
            out: list[tuple] = []
            for bucket, kind, chunk, some, counted in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "chunk", "codes", "n")), strict=True):
                if bucket != at:
                    at, parts = bucket, []
                if kind == 0:
                    parts.append((some, counted))
                    continue
                if parts:
                    codes, n = np.frombuffer(b"".join(p[0] for p in parts), "<u4"), np.frombuffer(b"".join(p[1] for p in parts), np.int64)
                    order = np.argsort(codes)
                    codes, n, parts = codes[order], n[order], []
                out.append((chunk, bucket, n[np.searchsorted(codes, np.frombuffer(some, "<u4"))].astype("<u8").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["chunk", "bucket", "n"])

    schema = "bucket long, kind int, chunk long, codes binary, n binary"
    offers = counts.where(~F.col("same")).select((F.col("a").cast("long") * width + F.col("b")).alias("code"), "n_docs").mapInArrow(offered, schema)
    asks = chunks.select("chunk", "codes").where(F.length("codes") > 0).mapInArrow(asked, schema)
    return offers.union(asks).repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(look_up, "chunk long, bucket long, n binary")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """What links the tokens of both tokenizers in each row of ``docs(doc_id, text)``.

    Space and text are encoded by A (a byte-level vocabulary of ``tokenizers``), text by B (a
    ``sentencepiece`` model, which adds the space); control strings are plain text to both.
    Columns: doc_id, n_a, n_b, n_groups, n_links (token pairs whose bytes overlap), n_best
    (links whose pair is held by as many documents as any pair of that A id), count_sum
    (documents of the pair, summed over links), groups_sha256. Null and empty texts, and those
    whose bytes a tokenizer does not give back, have no tokens: zeros and an empty digest.
    Each row is a document: repeated rows and ids, also null ones, count as often as they
    occur. Ties for the best pair count for all of them. Other columns are ignored; an empty
    table gives no rows. Texts are worked on one chunk at a time, a long one by itself.
    """
    spark = docs.sparkSession
    chunks = written(aligned_chunks(docs, a_path, b_path), "aligned")
    counts = written(pair_documents(chunks, a_path, b_path), "pairs")
    width, size = Aligner(a_path, b_path).width, 0
    top = counts.agg(F.max("a").alias("a"), F.count(F.when(~F.col("same"), 1)).alias("irregular")).first()
    size = (top["a"] if top["a"] is not None else -1) + 1
    same_docs, best = vocabulary_vectors(counts, size)
    vectors = spark.sparkContext.broadcast((same_docs, best))  # as long as the vocabulary
    answers = answered(chunks, counts, width, max(1, -(-top["irregular"] // BUCKET_PAIRS)))
    buckets = max(1, -(-top["irregular"] // BUCKET_PAIRS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same_docs, best = vectors.value
        for group in group_slices(batches, "chunk"):
            rows = group.to_pylist()  # one chunk and its answers, in the order of their buckets
            own = rows[0]
            codes, same, pairs = np.frombuffer(own["codes"], "<u4"), np.frombuffer(own["same"], _SAME), np.frombuffer(own["pairs"], _PAIR)
            order = np.argsort((mix(codes.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64), kind="stable")
            n = np.empty(len(codes), np.int64)
            n[order] = np.frombuffer(b"".join(r["n"] for r in rows[1:]), "<u8")
            top = n == best[codes // width] if len(codes) else np.empty(0, bool)
            sums, hits = np.zeros(len(own["docs"]), np.int64), np.zeros(len(own["docs"]), np.int64)
            np.add.at(sums, same["doc"], same["n"] * same_docs[same["a"]])
            np.add.at(hits, same["doc"], same["n"] * (same_docs[same["a"]] == best[same["a"]]))
            np.add.at(sums, pairs["doc"], pairs["n"] * n[pairs["at"]])
            np.add.at(hits, pairs["doc"], pairs["n"] * top[pairs["at"]])
            columns = {c: [d[c] for d in own["docs"]] for c in _TOTALS_ARROW.names}
            yield pa.RecordBatch.from_arrays([
                *(pa.array(columns[c], _TOTALS_ARROW.field(c).type) for c in _TOTALS_ARROW.names), pa.array(hits), pa.array(sums),
            ], names=[*_TOTALS_ARROW.names, "n_best", "count_sum"])

    blank = F.lit(None)
    left = chunks.select("chunk", F.lit(-1).cast("long").alias("bucket"), "docs", "same", "pairs", "codes", blank.cast("binary").alias("n"))
    right = answers.select("chunk", "bucket", blank.cast(chunks.schema["docs"].dataType).alias("docs"), *(blank.cast("binary").alias(c) for c in ("same", "pairs", "codes")), "n")
    out = left.union(right).repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, f"{TOTALS}, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``a, b, same, n_docs`` of every linked pair of ids: the table that maps one vocabulary to the other."""
    return pair_documents(written(aligned_chunks(docs, a_path, b_path), "aligned"), a_path, b_path)
