"""The pipeline against its stages by brute force on the smallest tables, and on odd documents."""

import re
from collections import Counter

import pytest

from cliploom.llm import packing, toxicity
from cliploom.llm.queries import tokenizer_path
from tests.llm import test_ngram_join, test_recompression
from tests.llm.odd import no_documents, odd_documents

pipeline = pytest.importorskip("corpus_pipeline")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Documents before the first stage and after each one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], folder).cache())
    return out


def test_columns(steps):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]
    assert all(s.columns == steps[0].columns for s in steps[1:5])


def test_toxic_documents_go(spark, folder, steps):
    scores = toxicity.toxic_scores(steps[0], spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert {r["doc_id"] for r in steps[1].collect()} == {r["doc_id"] for r in scores if not r["predicted"]}


def test_one_of_each_group_stays(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    assert sorted(r["doc_id"] for r in steps[2].collect()) == sorted({c for _, _, c in test_ngram_join.brute(rows)})


def test_long_repeats_go(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    expected = {i: (n - gone, digest) for i, n, gone, digest in test_recompression.brute(rows, 35)}
    for r in steps[3].collect():
        assert len(words(r["text"])) == expected[r["doc_id"]][0]
        assert r["n_chars"] == len(r["text"])


def test_sources_reach_their_targets(steps):
    before, after = Counter(), Counter()
    for r in steps[3].collect():
        before[r["source"]] += len(words(r["text"]))
    for r in steps[4].collect():
        after[r["source"]] += len(words(r["text"]))
    assert all(after[s] <= 2 * before[s] for s in before)
    assert abs(sum(after.values()) - 1.5 * sum(before.values())) <= len(before)


def test_packing_keeps_every_token(steps):
    whole = packing.WordTokenizer(tokenizer_path())
    import pyarrow as pa

    rows = steps[4].collect()
    ids, _ = whole.encode(pa.array([r["text"] for r in rows]))
    assert sum(r["length"] for r in steps[5].collect()) == len(ids) + len(rows)


CLASHING = ("key", "bytes", "ranges", "row_one", "row_two", "score", "own", "class", "n_removed", "n_words", "size", "text_", "before", "taken")


def test_odd_documents_pass_all_stages(spark, tmp_path):
    """Also with columns named as the operators name their own: all but the last stage return them as they were."""
    from pyspark.sql import functions as F

    labels = [(i, 0, int(i in (9, 14))) for i in range(1, 15)]
    for k, docs in enumerate((odd_documents(spark), no_documents(spark))):
        own = {c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING}
        docs = docs.select("doc_id", "text", "lang", "source", docs["n_chars"], *(v.alias(c) for c, v in own.items()))
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs.write.parquet(f"{folder}/documents.parquet")
        rows = pipeline.run(spark, folder).count()
        assert rows > 0 if k == 0 else rows == 0
        now = spark.read.parquet(f"{folder}/documents.parquet")
        for n, (_, stage) in enumerate(pipeline.STAGES[:-1]):
            stage(spark, now, folder).write.parquet(f"{folder}/{n}")
            now = spark.read.parquet(f"{folder}/{n}")
            assert now.columns == docs.columns
            for r in now.collect():
                assert all(r[c] == c + str("-" if r["doc_id"] is None else r["doc_id"]) for c in CLASHING)
