"""Toxicity, quality and URL models: held-out accuracy, rules, odd input."""

import pytest

from cliploom.llm import quality, toxicity, urls
from cliploom.llm.queries import QUERIES, URL_RULES
from tests.llm.odd import no_documents, odd_documents


@pytest.mark.parametrize(("name", "label", "least"), [("op5_toxicity", "toxic", 0.95), ("op4_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, folder).collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50
    assert sum(a == b for a, b in held) / len(held) >= least


@pytest.mark.parametrize("scores", [toxicity.toxic_scores, quality.quality_scores])
def test_odd_documents(spark, scores):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 1), (8, 0, 0), (9, 0, 0), (10, 1, 1), (7, None, None), (14, 2, 2)], "doc_id long, quality int, toxic int")
    one_class = spark.createDataFrame([(i, 1, 1) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    for labels in (none, some, one_class):
        rows = scores(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["predicted"] for r in scores(docs, one_class).collect()} == {1}
    assert scores(no_documents(spark), none).count() == 0


def test_toxic_rows_go_and_columns_stay(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame([(i, i % 2) for i in range(1, 15)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    model = toxicity.train(docs, labels)
    assert kept.count() == toxicity.score(docs, model).where("score < 0.5").count()


PAGES = {
    1: ("http://a.example.com/x", "a.example.com", "/x", "com/", "allow"), 2: ("https://EXAMPLE.com/en/1?q=/x", "example.com", "/en/1", "example.com/en/", "block"),
    3: ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"), 4: ("http://m.www.example.com/en/a#b", "m.www.example.com", "/en/a", "www.example.com/en/", "allow"),
    5: ("ftp://x.net/fr/?a", "x.net", "/fr/", "net/fr/", "block"), 6: ("http://com", "com", "", None, None), 7: (None, "", "", None, None), 8: ("no address", "", "", None, None),
    9: ("a://b://c/d", "b:", "//c/d", None, None), 10: ("http://dotcom/x", "dotcom", "/x", None, None), 11: ("http://x.net/es", "x.net", "/es", None, None), 12: ("", "", "", None, None),
    13: ("http://h.com?a/b", "h.com", "", None, None), 14: ("http://Ä.NET/es/é", "Ä.net", "/es/é", "net/es/", "block"),
}


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, x[0], "h", 1.0, "r") for i, x in PAGES.items()], "page_id long, url string, host string, score double, rule string")
    rows = {r["page_id"]: r for r in urls.judge(pages, URL_RULES).collect()}
    assert rows.keys() == PAGES.keys()
    for i, (_, host, path, rule, verdict) in PAGES.items():
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == verdict if verdict else rows[i]["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, {}).collect()} == {"allow"}


def test_url_model_learns_from_a_table(spark):
    label = lambda i: "block" if i % 2 else "allow"
    url = lambda i: f"http://{'spam-win' if i % 2 else 'daily-news'}{i}.org/{'casino' if i % 2 else 'story'}/{i}"
    known = spark.createDataFrame([(url(i), label(i)) for i in range(80)], "url string, verdict string")
    pages = spark.createDataFrame([(i, url(i)) for i in range(100, 160)], "page_id long, url string")
    rows = urls.judge(pages, {}, known).collect()
    assert all(r["verdict"] == label(r["page_id"]) for r in rows)


def test_broken_bytes_do_not_shift_other_texts():
    import pyarrow as pa

    from cliploom.llm.ngrams import held_ngrams

    raw = [b"good text", b"bad \xff\xfe bytes", "später".encode(), b""]
    broken = pa.Array.from_buffers(pa.string(), 4, [None, pa.array([0, 9, 21, 28, 28], pa.int32()).buffers()[1], pa.py_buffer(b"".join(raw))])
    together, bounds = held_ngrams(broken, (1, 3), 12)
    for k, text in enumerate(raw):
        alone, _ = held_ngrams(pa.array([text.decode("utf-8", "replace")]), (1, 3), 12)
        assert together[bounds[k] : bounds[k + 1]].tolist() == alone.tolist()


@pytest.mark.parametrize("name, folds, held", [("op4_quality", 3, 1), ("op5_toxicity", 5, 0)])
def test_folds_and_predictions_row_by_row(spark, folder, name, folds, held):
    """Every document once, its fold by crc32 of the id as text, its prediction by the score."""
    import zlib

    from cliploom.llm import queries

    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect())
    rows = queries.QUERIES[name](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == ids
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_a_caller_keeps_a_score_of_its_own(spark, folder):
    from pyspark.sql import functions as F

    from cliploom.llm import toxicity

    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("score", F.lit(0.123))
    left = toxicity.drop_toxic(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert left.columns == docs.columns and {r["score"] for r in left.select("score").distinct().collect()} == {0.123}
