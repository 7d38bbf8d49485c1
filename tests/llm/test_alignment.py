"""Alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter
from functools import cache

import pytest

from cliploom.llm import alignment as A
from tests.llm.odd import no_documents, odd_documents, words

P = pytest.importorskip("public_tokenizers")
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = list("abc  \n\n\t\r.,'s1é東🙂 <|endoftext|>") + [
    "　", "\xa0", "\x1c", "́", "ﬁ", "​", "\x00", "▁", "  ", "\r\n", "'ll", "<s>", "<0x41>", "<unk>", "Ǆ", "﻿", "𝔘", "한국", " ", "\x85",
]


@pytest.fixture(scope="module")
def tokens():
    aligner = A.Aligner(*PATHS)
    names = {i: t for t, i in aligner.a.get_vocab().items()}

    def spans(sizes):
        at = 0
        for n in sizes:
            yield at, at + n
            at += n

    def walk(text):
        """Tokens of A and B, the groups' text, and all overlapping pairs."""
        if not text:
            return 0, 0, 0, "", []
        a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
        a_bytes, b_bytes = [A.byte_level_bytes(names[i]) for i in a], [A.piece_bytes(aligner.b.id_to_piece(i)) for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return 0, 0, 0, "", []
        sa, sb = list(spans(map(len, a_bytes))), list(spans(map(len, b_bytes)))
        links = [(i, j) for i, p in enumerate(sa) for j, q in enumerate(sb) if p[0] < q[1] and q[0] < p[1]]
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own, strict=True) if start <= s and e <= end) for ids, own in ((a, sa), (b, sb))))
            start = end
        return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), [(a[i], b[j]) for i, j in links]

    return walk


def expected(texts, walk):
    walked = {i: walk(t) for i, t in texts.items()}
    docs = Counter(p for *_, links in walked.values() for p in set(links))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    return {
        i: (n_a, n_b, n_groups, len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links), digest)
        for i, (n_a, n_b, n_groups, digest, links) in walked.items()
    }, docs


def test_random_texts(spark, tokens, monkeypatch):
    rng = random.Random(5)
    texts = {i: "".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 40))) for i in range(600)}
    texts |= {600 + i: words(30, i % 40) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    want, pairs = expected(texts, tokens)
    assert {r[0]: tuple(r)[1:] for r in A.align(docs, *PATHS).collect()} == want
    counts = A.pair_counts(docs, *PATHS).collect()
    assert {(r["a"], r["b"]): r["n_docs"] for r in counts} == dict(pairs)
    aligner = A.Aligner(*PATHS)
    assert all(r["same"] == (aligner.same[r["a"]] == r["b"]) for r in counts) and {r["same"] for r in counts} == {True, False}
    monkeypatch.setattr(A, "BUCKET_PAIRS", 40)  # many buckets of pairs
    assert {r[0]: tuple(r)[1:] for r in A.align(docs, *PATHS).collect()} == want


def test_segments_stand_alone(tokens, monkeypatch):
    """Without memo, with a full one, and in groups of one segment: the same totals."""
    rng = random.Random(6)
    texts = ["".join(rng.choice(PARTS) for _ in range(60)) for _ in range(300)]
    want = [tokens(t)[:4] for t in texts]
    for group, memo in ((500, 60_000), (1, 0), (7, 50)):
        monkeypatch.setattr(A, "GROUP", group)
        monkeypatch.setattr(A, "MEMO_SEGMENTS", memo)
        aligner = A.Aligner(*PATHS)
        for _ in range(2):
            totals = aligner.chunk(list(range(len(texts))), texts)[0]
            assert [(t[1], t[2], t[3], t[5]) for t in totals] == want


def test_odd_documents(spark, tokens):
    docs = odd_documents(spark)
    rows = {(r["doc_id"], r["n"]): r["text"] for r in docs.selectExpr("doc_id", "text", "row_number() over (partition by doc_id order by text) n").collect()}
    want, _ = expected(rows, cache(tokens))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), *tuple(r)[1:]) for r in A.align(docs, *PATHS).collect())
    assert got == sorted(((k[0] is None, k[0] or 0), *v) for k, v in want.items())


def test_given_documents(spark, folder, tokens):
    from cliploom.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_token_alignment"](spark, folder).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        if t and len(t) < 1000:
            n_a, n_b, n_groups, digest, links = tokens(t)
            assert (got[i]["n_a"], got[i]["n_b"], got[i]["n_groups"], got[i]["groups_sha256"], got[i]["n_links"]) == (n_a, n_b, n_groups, digest, len(links))


def test_empty_table(spark):
    assert A.align(no_documents(spark), *PATHS).count() == 0
