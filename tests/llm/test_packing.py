"""Packing: exact round trip of the ids and the shape of the sequences."""

import zlib

import numpy as np
import pytest

from cliploom.llm import packing
from tests.llm.odd import no_documents, odd_documents

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encode():
    whole = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@pytest.mark.parametrize("capacity", [4096, 8, 1])
def test_round_trip(spark, encode, capacity):
    docs = odd_documents(spark)
    rows = packing.pack(docs, PATH, capacity).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert all(r["offset"] == 0 and r["length"] <= capacity and r["length"] & (r["length"] - 1) == 0 for r in rows)
    by_length = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_length] == sorted((r["length"] for r in rows), reverse=True)
    for doc_id, text in {(r["doc_id"], r["text"]) for r in docs.collect()}:
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["start"])
        copies = docs.where("doc_id <=> " + ("null" if doc_id is None else str(doc_id))).count()
        ids = encode(text)
        assert all(r["doc_tokens"] == len(ids) for r in own)
        pieces = {(r["start"], r["length"]): np.frombuffer(r["ids"], "<u4").tolist() for r in own}
        assert len(own) == copies * len(pieces)
        assert [x for k in sorted(pieces) for x in pieces[k]] == ids
        assert len([n for _, n in pieces if n < capacity]) == bin(len(ids) % capacity).count("1")


def test_given_documents(spark, folder, encode):
    from cliploom.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_packing"](spark, folder).collect()
    ids = {i: encode(t) for i, t in docs.items()}
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])


def test_empty_table_and_wrong_capacity(spark):
    assert packing.pack(no_documents(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.decompose(no_documents(spark), PATH, capacity=100)
