"""Manifest and verification queries over documents (files), labels (copies on disk), part and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import is_unsafe
from cliploom.operators import integrity as ops
from cliploom.plans.common import FACTS_SQL, MANIFEST_SQL, facts, manifest
from cliploom.plans.registry import Tables, query

BOTH = f"WITH manifest AS ({MANIFEST_SQL}), facts AS ({FACTS_SQL})"
VERDICT = """CASE WHEN f.path IS NULL THEN 'missing' WHEN m.bytes IS DISTINCT FROM f.bytes THEN 'size'
  WHEN m.sha256 IS DISTINCT FROM f.sha256 THEN 'hash' ELSE 'ok' END"""


@query("missing_refs", """SELECT o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def missing_refs(t: Tables) -> DataFrame:
    inventory = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return ops.missing_refs(t.orders.select("o_orderkey"), inventory, "o_orderkey")


@query("verify_files", BOTH + f" SELECT m.path, m.archive, {VERDICT} AS verdict FROM manifest m LEFT JOIN facts f ON f.path = m.path")
def verify_files(t: Tables) -> DataFrame:
    return ops.verify_files(manifest(t), facts(t)).select("path", "archive", "verdict")


@query("release_pins", """WITH m AS (SELECT source AS path, count(*) AS n, sum(n_chars) AS b FROM documents GROUP BY source),
f AS (SELECT path, sha256(CAST(n AS VARCHAR) || ':' || CAST(b AS VARCHAR)) AS sha256 FROM m),
pins(path, sha256) AS (VALUES ('src0', 'none'), ('src1', 'none'), ('absent', 'none'))
SELECT p.path, CASE WHEN f.path IS NULL THEN 'missing' WHEN f.sha256 <> p.sha256 THEN 'hash' ELSE 'ok' END AS verdict
FROM pins p LEFT JOIN f ON f.path = p.path""")
def release_pins(t: Tables) -> DataFrame:
    per_source = t.documents.groupBy(F.col("source").alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("bytes")
    )
    found = per_source.select(
        "path", F.lit(True).alias("exists"), "bytes",
        F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("bytes").cast("string")), 256).alias("sha256"),
    )
    return ops.validate_release(found, {"src0": "none", "src1": "none", "absent": "none"}).select("path", "verdict")


CLOSURE = f"""WITH manifest AS ({MANIFEST_SQL}),
needed AS (SELECT CAST(doc_id AS VARCHAR) AS path FROM labels WHERE toxic = 1),
anchors AS (SELECT CAST(doc_id AS VARCHAR) AS path FROM labels WHERE toxic = 1 AND quality = 0),
selected AS (SELECT * FROM manifest WHERE path IN (SELECT path FROM needed)
  UNION SELECT * FROM manifest WHERE archive IN (SELECT archive FROM manifest WHERE path IN (SELECT path FROM anchors)))"""


def _closure(t: Tables):
    toxic = t.labels.filter("toxic = 1")
    path = F.col("doc_id").cast("string").alias("path")
    return ops.subset_closure(manifest(t), toxic.select(path), toxic.filter("quality = 0").select(path))


@query("subset_files", CLOSURE + " SELECT archive, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM selected GROUP BY archive")
def subset_files(t: Tables) -> DataFrame:
    return _closure(t)[0].groupBy("archive").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


@query("subset_archives", CLOSURE + " SELECT DISTINCT archive FROM selected")
def subset_archives(t: Tables) -> DataFrame:
    return _closure(t)[1]


@query("capacity", """SELECT CAST(sum(n_chars) + 5368709120 AS BIGINT) AS needed_bytes, CAST(5370000000 AS BIGINT) AS free_bytes,
  sum(n_chars) + 5368709120 <= 5370000000 AS fits FROM documents""")
def capacity(t: Tables) -> DataFrame:
    return ops.capacity(t.documents.select(F.col("n_chars").alias("uncompressed_bytes")), 5_370_000_000)


@query("hash_drift", f"""{BOTH}, old AS (SELECT archive AS record, path, sha256 FROM manifest),
new AS (SELECT m.archive AS record, f.path, f.sha256 FROM facts f JOIN manifest m ON m.path = f.path)
SELECT coalesce(o.record, n.record) AS record, coalesce(o.path, n.path) AS path,
  CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM old o FULL JOIN new n ON o.record = n.record AND o.path = n.path WHERE o.sha256 IS DISTINCT FROM n.sha256""")
def hash_drift(t: Tables) -> DataFrame:
    listed = manifest(t).select(F.col("archive").alias("record"), "path", "sha256")
    now = facts(t).select("path", "sha256").join(listed.select("record", "path"), "path")
    return ops.hash_drift(listed, now).select("record", "path", "change")


@query("manifest_contract", """SELECT count(*) AS n, count(DISTINCT doc_id) AS keys,
  count(*) FILTER (lang NOT IN ('en', 'fr', 'de', 'es')) AS bad_lang,
  count(*) = count(DISTINCT doc_id) AND count(*) FILTER (lang NOT IN ('en', 'fr', 'de', 'es')) = 0 AS holds FROM documents""")
def manifest_contract(t: Tables) -> DataFrame:
    return ops.assert_contract(t.documents, "doc_id", allowed={"lang": ("en", "fr", "de", "es")})


@query("catalog_contract", """WITH c AS (SELECT doc_id, sha1(text) AS fingerprint, sha1(lang || source || text) AS signature FROM documents)
SELECT count(*) AS n, count(DISTINCT doc_id) AS distinct_doc_id, count(DISTINCT fingerprint) AS distinct_fingerprint,
  count(DISTINCT signature) AS distinct_signature,
  count(*) >= 100 AND count(DISTINCT doc_id) = count(*) AND count(DISTINCT fingerprint) = count(*)
    AND count(DISTINCT signature) = count(*) AS holds FROM c""")
def catalog_contract(t: Tables) -> DataFrame:
    rows = t.documents.select(
        "doc_id", F.sha1("text").alias("fingerprint"), F.sha1(F.concat("lang", "source", "text")).alias("signature")
    )
    return ops.catalog_contract(rows, ["doc_id", "fingerprint", "signature"], 100)


@query("repeated_fingerprints", """SELECT sha1(text) AS fingerprint, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1""")
def repeated_fingerprints(t: Tables) -> DataFrame:
    return ops.repeated_keys(t.documents.select(F.sha1("text").alias("fingerprint")), "fingerprint")


TEXTURES = """files AS (SELECT p_brand || '-' || CAST(p_size AS VARCHAR) AS asset,
   'd' || CAST(p_partkey AS VARCHAR) || '/' || p_name || '.png' AS path FROM part),
refs AS (SELECT p_partkey, p_brand || '-' || CAST(p_size AS VARCHAR) AS asset, CASE p_type
   WHEN 'PROMO' THEN 'd' || CAST(p_partkey AS VARCHAR) || '/' || p_name || '.png'
   WHEN 'SMALL' THEN 'lost/' || upper(p_name) || '.PNG' WHEN 'LARGE' THEN 'lost/other.png'
   ELSE 'lost/' || p_name || '.png' END AS requested FROM part)"""


@query("resolve_basenames", f"""WITH {TEXTURES},
named AS (SELECT *, regexp_extract(path, '[^/]*$') AS nm FROM files),
ex AS (SELECT asset, nm, count(*) AS n, min(path) AS p FROM named GROUP BY 1, 2),
fo AS (SELECT asset, lower(nm) AS nm, count(*) AS n, min(path) AS p FROM named GROUP BY 1, 2),
v AS (SELECT r.*, EXISTS (SELECT 1 FROM files f WHERE f.asset = r.asset AND f.path = r.requested) AS present,
  coalesce(ex.n, fo.n, 0) AS hits, coalesce(ex.p, fo.p) AS p
  FROM refs r LEFT JOIN ex ON ex.asset = r.asset AND ex.nm = regexp_extract(r.requested, '[^/]*$')
  LEFT JOIN fo ON fo.asset = r.asset AND fo.nm = lower(regexp_extract(r.requested, '[^/]*$')))
SELECT p_partkey, CASE WHEN present THEN 'present' WHEN hits = 0 THEN 'unresolved' WHEN hits > 1 THEN 'ambiguous' ELSE 'repaired' END AS verdict,
  CASE WHEN present THEN requested WHEN hits = 1 THEN p END AS path FROM v""")
def resolve_basenames(t: Tables) -> DataFrame:
    asset = F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("asset")
    path = F.concat(F.lit("d"), F.col("p_partkey").cast("string"), F.lit("/"), F.col("p_name"), F.lit(".png"))
    requested = (
        F.when(F.col("p_type") == "PROMO", path)
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("lost/"), F.upper("p_name"), F.lit(".PNG")))
        .when(F.col("p_type") == "LARGE", F.lit("lost/other.png"))
        .otherwise(F.concat(F.lit("lost/"), F.col("p_name"), F.lit(".png")))
    )
    refs = t.part.select("p_partkey", asset, requested.alias("requested"))
    return ops.resolve_basenames(refs, t.part.select(asset, path.alias("path"))).select("p_partkey", "verdict", "path")


@query("sequence_audit", """WITH seen AS (SELECT l_orderkey AS clip, count(*) AS files, count(DISTINCT l_linenumber) AS frames,
  min(l_linenumber) AS first, max(l_linenumber) AS last FROM lineitem GROUP BY 1),
plan AS (SELECT o_orderkey AS clip, CAST(1 + o_custkey % 5 AS BIGINT) AS frame_count FROM orders)
SELECT p.clip, p.frame_count, coalesce(files, 0) AS files, coalesce(frames, 0) AS frames, first, last,
  coalesce(files = frame_count AND frames = frame_count AND first = 1 AND last = frame_count, false) AS complete
FROM plan p LEFT JOIN seen s ON s.clip = p.clip""")
def sequence_audit(t: Tables) -> DataFrame:
    return ops.sequence_audit(_frames(t), _plan(t))


def _frames(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("frame"))


def _plan(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("clip"), (1 + F.col("o_custkey") % 5).alias("frame_count"))


@query("missing_frames", """WITH plan AS (SELECT o_orderkey AS clip, 1 + o_custkey % 5 AS n FROM orders),
wanted AS (SELECT clip, unnest(generate_series(1, n)) AS frame FROM plan)
SELECT clip, frame FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = w.clip AND l_linenumber = w.frame)""")
def missing_frames(t: Tables) -> DataFrame:
    return ops.missing_frames(_frames(t), _plan(t))


@query("unsafe_paths", """WITH u AS (SELECT page_id, replace(substr(url, strpos(url, '://') + 3), '.example.', '/../') AS path FROM pages
  UNION ALL SELECT page_id, substr(url, strpos(url, ':') + 1) FROM pages UNION ALL SELECT page_id, url FROM pages)
SELECT page_id, path, starts_with(path, '/') OR list_contains(string_split(path, '/'), '..') AS is_unsafe FROM u""")
def unsafe_paths(t: Tables) -> DataFrame:
    variants = t.pages.select("page_id", F.explode(F.array(
        F.replace(F.expr("substring(url, instr(url, '://') + 3)"), F.lit(".example."), F.lit("/../")),
        F.expr("substring(url, instr(url, ':') + 1)"),
        F.col("url"),
    )).alias("path"))
    return variants.withColumn("is_unsafe", is_unsafe(F.col("path")))
