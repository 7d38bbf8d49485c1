"""Packing by power-of-two decomposition.

A document of L tokens is cut by the binary digits of L: pieces of ``capacity`` tokens first,
then one piece for each set bit below it, longest first. Pieces of equal length form a bucket
and every piece is a sequence by itself, so no sequence crosses documents and none is padded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cliploom.llm.graph import written
from cliploom.llm.words import text_chunks, tool

CAPACITY = 4096
END_ID = 2
#: Words whose ids a Python worker remembers; further ones are encoded where they occur.
MEMO_WORDS = 100_000
#: Bytes of text that a worker encodes at once.
ENCODE_BYTES = 1 << 20
_PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-įı-ɏ]*)(?P<rest>[!-&(-/:-@\[-`{-~]*)$"

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, part int, nth long"
_PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()),
])


class WordTokenizer:
    """Ids of whole texts from ids of their white-space separated chunks.

    The vocabulary's rules never look across white space, so a chunk's ids do not depend on
    its neighbours and each distinct one is encoded once. Letters below U+0250 with ASCII
    marks behind them, most chunks by far, are encoded as two parts many at a time, without the
    rules that cannot apply to them; each part ends with a token that ends a word. All other
    chunks take the tokenizer as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.whole.model)  # one vocabulary for both
        self.letters.normalizer = normalizers.Lowercase()
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {"": b""}
        self.extra: dict[str, bytes] = {"": b""}

    def letter_ids(self, words: list[str]) -> list[bytes]:
        groups = [words[at : at + 100] for at in range(0, len(words), 100)]
        found = []
        for coded in self.letters.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False):
            ids = np.array(coded.ids, "<u4")
            raw, cuts = ids.tobytes(), (np.flatnonzero(self.ends[ids]) * 4 + 4).tolist()
            found += [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        return found

    def other_ids(self, chunks: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.whole.encode_batch(chunks, add_special_tokens=False)]

    @staticmethod
    def looked_up(values: pa.Array, memo: dict[str, bytes], learn: Callable[[list[str]], list[bytes]]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Ids of the distinct values on end; for each value the index of its first id there and their number."""
        coded = values.dictionary_encode()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(memo.get, keys))
        new = [i for i, x in enumerate(known) if x is None]
        for i, x in zip(new, learn([keys[i] for i in new]), strict=True):
            known[i] = x
            if len(memo) < MEMO_WORDS:
                memo[keys[i]] = x
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = coded.indices.to_numpy(zero_copy_only=False)
        return b"".join(known), (np.cumsum(lengths) - lengths)[which], lengths[which]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end and the n + 1 bounds of the texts."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = split.flatten().dictionary_encode()
        parts = pc.extract_regex(coded.dictionary, _PLAIN)
        word = pc.fill_null(pc.utf8_lower(pc.struct_field(parts, [0])), "")
        rest = pc.coalesce(pc.struct_field(parts, [1]), coded.dictionary)
        ids1, first1, n1 = self.looked_up(word, self.memo, self.letter_ids)
        ids2, first2, n2 = self.looked_up(rest, self.extra, self.other_ids)
        pool = np.frombuffer(ids1 + ids2, "<u4")
        which = coded.indices.to_numpy(zero_copy_only=False)
        first = np.stack((first1, first2 + len(ids1) // 4), 1)[which].ravel()
        n = np.stack((n1, n2), 1)[which].ravel()
        ends = np.cumsum(n)
        ids = pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + n, n)]
        words = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))))
        return ids, np.concatenate(([0], ends))[2 * words]


def tokenizer_at(path: str) -> WordTokenizer:
    """The worker's tokenizer, read once for all of its tasks."""
    return tool(("packing", path), lambda: WordTokenizer(path))


def binary_pieces(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document its pieces: index of the document, start, length."""
    bits = int(capacity).bit_length() - 1
    full = lengths >> bits
    sizes = np.concatenate((full[:, None], (lengths[:, None] >> np.arange(bits - 1, -1, -1)) & 1), axis=1)
    owner = np.repeat(np.arange(len(lengths)), sizes.sum(axis=1))
    length = np.repeat(np.tile(1 << np.arange(bits, -1, -1), len(lengths)), sizes.ravel())
    ends = np.cumsum(length)
    before = np.cumsum(lengths) - lengths
    return owner, ends - length - before[owner], length


def decompose(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every row of ``docs(doc_id, text)`` with their ids (unsigned 32-bit, little-endian).

    ``nth`` counts the pieces of one length within the task ``part``. Null text is an empty
    document: one piece with the end id. Repeated rows are packed as often as they occur.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity.bit_length(), np.int64)
        tokens = tokenizer_at(tokenizer_path)
        for chunk in text_chunks(batches, "text", ENCODE_BYTES):
            ids, bounds = tokens.encode(chunk.column("text"))
            bounds = bounds + np.arange(len(bounds))  # room for the end ids
            lengths = np.diff(bounds)
            whole = np.full(bounds[-1], end_id, "<u4")
            own = np.ones(len(whole), bool)
            own[bounds[1:] - 1] = False
            whole[own] = ids
            owner, start, length = binary_pieces(lengths, capacity)
            nth = np.empty(len(owner), np.int64)
            bucket = np.log2(length).astype(np.int64)
            for b in np.unique(bucket):
                of = bucket == b
                nth[of] = seen[b] + np.arange(of.sum())
                seen[b] += of.sum()
            cuts = pa.array(np.concatenate(([0], np.cumsum(length) * 4)).astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([
                chunk.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(length),
                pa.Array.from_buffers(pa.binary(), len(owner), [None, cuts.buffers()[1], pa.py_buffer(whole)]),
                pa.array(lengths[owner]), pa.array(np.full(len(owner), part, np.int32)), pa.array(nth),
            ], schema=_PIECES_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Sequences of ``docs(doc_id, text)``: doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket.

    Sequence ids are gapless from 0 and ascend bucket by bucket, longest first, so a reader
    that batches by length takes ranges of ids. Pieces are written once to the shared folder;
    numbering adds to each piece the count of earlier pieces of its length, a table of one row
    for each task and length. An empty table gives no rows; other columns are ignored.
    """
    pieces = written(decompose(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = pieces.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    per_length = counts.groupBy("length").agg(F.sum("n").alias("all"))
    longer = per_length.select("length", F.coalesce(F.sum("all").over(Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("longer"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for each task and length; written, so that Spark broadcasts the table or not by its size
    bases = counts.join(longer, "length").select("length", "part", (F.col("longer") + earlier).alias("base"))
    bases = written(bases, "piece-bases")
    return pieces.join(bases, ["length", "part"]).select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("bucket"),
    )
