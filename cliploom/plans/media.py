"""Pixel, camera and image queries: lineitem as pixels, document texts as grey frames, embeddings as surfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions.media import PNG_SIGNATURE
from cliploom.operators import media as M
from cliploom.operators import proximity as P
from cliploom.plans.registry import Tables, query

PIXELS_SQL = """px AS (SELECT l_returnflag AS image, CAST(l_quantity * 5 AS INTEGER) AS r, CAST(round(l_discount * 2000) AS INTEGER) AS g,
  CAST(round(l_tax * 3000) AS INTEGER) AS b FROM lineitem),
lum AS (SELECT *, 0.2126::DOUBLE * (r / 255.0::DOUBLE) + 0.7152::DOUBLE * (g / 255.0::DOUBLE) + 0.0722::DOUBLE * (b / 255.0::DOUBLE) AS l FROM px),
rk AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY l, r, g, b) - 1 AS i, count(*) OVER (PARTITION BY image) AS n FROM lum),
agg AS (SELECT image, max(n) AS pixels, max(l) FILTER (i = CAST(floor(0.1::DOUBLE * (n - 1)) AS BIGINT)) AS p10,
  max(l) FILTER (i = CAST(floor(0.5::DOUBLE * (n - 1)) AS BIGINT)) AS p50, max(l) FILTER (i = CAST(floor(0.9::DOUBLE * (n - 1)) AS BIGINT)) AS p90,
  avg(r / 255.0::DOUBLE) FILTER (i >= CAST(floor(n * 0.2::DOUBLE) AS BIGINT) AND i < CAST(floor(n * 0.65::DOUBLE) AS BIGINT)) AS mr,
  avg(g / 255.0::DOUBLE) FILTER (i >= CAST(floor(n * 0.2::DOUBLE) AS BIGINT) AND i < CAST(floor(n * 0.65::DOUBLE) AS BIGINT)) AS mg,
  avg(b / 255.0::DOUBLE) FILTER (i >= CAST(floor(n * 0.2::DOUBLE) AS BIGINT) AND i < CAST(floor(n * 0.65::DOUBLE) AS BIGINT)) AS mb FROM rk GROUP BY image)"""


def pixels(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_returnflag").alias("image"), (F.col("l_quantity") * 5).cast("int").alias("r"),
        F.round(F.col("l_discount") * 2000).cast("int").alias("g"), F.round(F.col("l_tax") * 3000).cast("int").alias("b"),
    )


@query("image_stats", f"""WITH {PIXELS_SQL} SELECT image, pixels, round(p10, 8) AS p10, round(p50, 8) AS p50, round(p90, 8) AS p90,
  round((p90 - p10) / greatest(0.05, p90 + p10), 8) AS contrast, round(greatest(0.65, mr / greatest(mr, mg, mb, 0.001)), 8) AS tint_r,
  round(greatest(0.65, mg / greatest(mr, mg, mb, 0.001)), 8) AS tint_g, round(greatest(0.65, mb / greatest(mr, mg, mb, 0.001)), 8) AS tint_b FROM agg""")
def image_stats(t: Tables) -> DataFrame:
    out = M.image_stats(pixels(t), ["image"])
    return out.select("image", "pixels", *[F.round(c, 8).alias(c) for c in ("p10", "p50", "p90", "contrast", "tint_r", "tint_g", "tint_b")])


@query("lighting_response", """WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN l_discount * 5 END AS p50, CASE WHEN l_tax > 0 THEN l_discount * 8 END AS p90,
  l_tax * 15 AS contrast, CASE l_returnflag WHEN 'A' THEN 'diffuse' WHEN 'N' THEN 'left' END AS direction FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN p90 IS NULL THEN 'missing_background_reference' WHEN p90 < 0.06 THEN 'background_too_dark_for_reliable_statistics' END AS reason,
  CASE WHEN p90 >= 0.06 THEN round(greatest(0.45, least(1.0, 1.5 * p50 / greatest(0.05, p90))), 8) END AS fill_gain,
  CASE WHEN p90 >= 0.06 THEN round(CASE WHEN coalesce(direction, 'unknown') IN ('diffuse', 'unknown')
    THEN greatest(0.85, greatest(0.5, 1 - 0.5 * greatest(0, least(1, contrast)))) ELSE greatest(0.5, 1 - 0.5 * greatest(0, least(1, contrast))) END, 8) END AS size_gain FROM s""")
def lighting_response(t: Tables) -> DataFrame:
    lit = F.col("l_tax") > 0
    stats = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(lit, F.col("l_discount") * 5).alias("p50"), F.when(lit, F.col("l_discount") * 8).alias("p90"),
        (F.col("l_tax") * 15).alias("contrast"), F.when(F.col("l_returnflag") == "A", "diffuse").when(F.col("l_returnflag") == "N", "left").alias("direction"),
    )
    out = M.lighting_response(stats, F.col("direction"))
    return out.select("l_orderkey", "l_linenumber", "reason", F.round("fill_gain", 8).alias("fill_gain"), F.round("size_gain", 8).alias("size_gain"))


FRAME_PIXELS = M.WIDTH * M.HEIGHT


def text_frames(t: Tables) -> DataFrame:
    """Whole texts cut into frames of 2,304 characters; code points are grey values.

    Every document has a frame at least; the last one is filled up with spaces, grey value 32.
    """
    frames = F.greatest(F.lit(1), F.ceil(F.length("_t") / FRAME_PIXELS)).cast("int")
    filled = t.documents.select(F.col("doc_id").alias("clip"), F.coalesce("text", F.lit("")).alias("_t")).select("clip", F.expr("_t"), frames.alias("_n")).select(
        "clip", F.rpad("_t", F.col("_n") * FRAME_PIXELS, F.lit(" ")).alias("_t")
    )
    # one pass of the pattern over the text cuts all of its frames
    pieces = F.regexp_extract_all("_t", F.lit(f"(?s).{{{FRAME_PIXELS}}}"), F.lit(0))
    cut = filled.select("clip", F.posexplode(pieces).alias("frame", "_s"))
    return cut.select("clip", F.col("frame").cast("long").alias("frame"), F.transform(F.split("_s", ""), lambda c: F.ascii(c) % 256).alias("pixels"))


CAMERA_SQL = """WITH filled AS (SELECT doc_id AS clip, greatest(1, CAST(ceil(length(coalesce(text, '')) / 2304) AS INTEGER)) AS n, coalesce(text, '') AS t FROM documents),
cut AS (SELECT clip, f AS frame, substr(rpad(t, n * 2304, ' '), f * 2304 + 1, 2304) AS s FROM filled, generate_series(0, n - 1) AS g(f)),
px AS MATERIALIZED (SELECT clip, frame, unnest(generate_series(0, 2303)) AS p, unnest(list_transform(string_split(s, ''), lambda c: ord(c) % 256)) AS g FROM cut),
off AS (SELECT dy, dx, (dy + 4) * 9 + dx + 4 AS o FROM generate_series(-4, 4) AS a(dy), generate_series(-4, 4) AS b(dx)),
lat AS (SELECT y * 64 + x AS p FROM generate_series(6, 29, 2) AS a(y), generate_series(8, 55, 2) AS b(x)),
l AS MATERIALIZED (SELECT a.clip, a.frame, a.p, a.g FROM px a JOIN lat ON lat.p = a.p),
lo AS MATERIALIZED (SELECT clip, frame, frame + 1 AS nf, p + dy * 64 + dx AS q, g, dx, dy, o FROM l CROSS JOIN off),
sc AS (SELECT lo.clip, lo.frame, dx, dy, o, avg(abs(lo.g - b.g)) AS score FROM lo JOIN px b ON b.clip = lo.clip AND b.frame = lo.nf AND b.p = lo.q GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY clip, frame ORDER BY score, o) AS rn FROM sc)"""


@query("frame_shifts", CAMERA_SQL + " SELECT clip, frame, CAST(dx AS INTEGER) AS dx, CAST(dy AS INTEGER) AS dy, round(score, 6) AS score FROM best WHERE rn = 1")
def frame_shifts(t: Tables) -> DataFrame:
    return M.frame_shifts(text_frames(t), ["clip"], "frame").select("clip", "frame", "dx", "dy", F.round("score", 6).alias("score"))


@query("camera_motion", CAMERA_SQL + """, m AS (SELECT clip, avg(dx) AS dx, avg(dy) AS dy, avg(score) / 255 AS activity, count(*) AS n FROM best WHERE rn = 1 GROUP BY clip),
c AS (SELECT DISTINCT clip FROM cut)
SELECT c.clip, CASE WHEN n IS NULL THEN 'unknown' WHEN sqrt(dx * dx + dy * dy) < 0.35 THEN 'static' WHEN sqrt(dx * dx + dy * dy) < 1.5 THEN 'slow_pan' ELSE 'fast_pan' END AS motion_class,
  round(coalesce(greatest(-1.0, least(1.0, dx / 4)), 0), 6) AS pan_x, round(coalesce(greatest(-1.0, least(1.0, dy / 4)), 0), 6) AS pan_y,
  round(coalesce(activity, 0), 8) AS activity, coalesce(n, 0) AS measured_frame_pairs FROM c LEFT JOIN m ON m.clip = c.clip""")
def camera_motion(t: Tables) -> DataFrame:
    out = M.camera_motion(text_frames(t), ["clip"], "frame")
    return out.select("clip", "motion_class", F.round("pan_x", 6).alias("pan_x"), F.round("pan_y", 6).alias("pan_y"), F.round("activity", 8).alias("activity"), "measured_frame_pairs")


@query("pack_frames", """WITH px AS (SELECT vec_id // 36 AS frame, (vec_id % 36) * 64 + i - 1 AS p, CAST(floor((embedding[i]::DOUBLE + 1) * 100) AS BIGINT) AS g
  FROM embeddings, generate_series(1, 64) AS k(i))
SELECT frame, count(*) = 2304 AS complete, count(*) AS pixels, CAST(sum(g) AS BIGINT) AS total, CAST(sum(g * (p + 1)) AS BIGINT) AS weighted FROM px GROUP BY frame""")
def pack_frames(t: Tables) -> DataFrame:
    """36 embeddings of 64 numbers are one grey frame; a shorter group is reported as incomplete."""
    gray = t.embeddings.select(
        F.lit("vectors").alias("clip"), F.floor(F.col("vec_id") / M.HEIGHT).alias("frame"), (F.col("vec_id") % M.HEIGHT).alias("y"), F.posexplode("embedding").alias("x", "v")
    ).select("clip", "frame", "y", "x", F.floor((F.col("v").cast("double") + 1) * 100).alias("gray"))
    packed = M.frame_pixels(gray, ["clip"], "frame")
    zero = F.lit(0).cast("long")
    weighted = F.aggregate(F.transform("pixels", lambda g, i: g * (i + 1)), zero, lambda a, v: a + v)
    return packed.select("frame", "complete", F.size("pixels").cast("long").alias("pixels"), F.aggregate("pixels", zero, lambda a, v: a + v).alias("total"), weighted.alias("weighted"))


# Image files: a line is a frame of its order; its numbers are the header fields.
def image_files(t: Tables) -> DataFrame:
    hex_of = lambda c, digits: F.lpad(F.hex(c.cast("long")), digits, "0")
    signature = F.when(F.col("l_returnflag") == "R", "00").otherwise(PNG_SIGNATURE[:2])
    content = F.unhex(F.concat(
        signature, F.lit(PNG_SIGNATURE[2:]), F.lit("0" * 16), hex_of(F.lit(1920), 8), hex_of(F.when(F.col("l_quantity") > 40, 1080).otherwise(F.col("l_quantity")), 8),
        hex_of(F.lit(16), 2), hex_of(F.when(F.col("l_linestatus") == "O", 6).otherwise(0), 2), F.lit("0000"),
    ))
    return t.lineitem.select(F.col("l_orderkey").alias("clip"), F.format_string("%05d", "l_linenumber").alias("stem"), content.alias("content"))


IMAGES_SQL = """im AS (SELECT l_orderkey AS clip, l_linenumber AS f, l_returnflag <> 'R' AS valid, CASE WHEN l_quantity > 40 THEN 1080 ELSE l_quantity END AS h,
  CASE l_linestatus WHEN 'O' THEN 6 ELSE 0 END AS kind FROM lineitem)"""


@query("png_header", f"WITH {IMAGES_SQL} SELECT clip, f AS frame, valid, CASE WHEN valid THEN CAST(1920 AS BIGINT) END AS width, CASE WHEN valid THEN CAST(h AS BIGINT) END AS height, CASE WHEN valid THEN CAST(16 AS BIGINT) END AS depth, CASE WHEN valid THEN CAST(kind AS BIGINT) END AS color_type FROM im")
def png_header(t: Tables) -> DataFrame:
    return M.png_header(image_files(t)).select("clip", F.col("stem").cast("int").alias("frame"), "valid", "width", "height", "depth", "color_type")


@query("verify_images", f"""WITH {IMAGES_SQL}, s AS (SELECT clip, count(*) AS files, count(DISTINCT f) AS fr, min(f) AS a, max(f) AS z, count(*) FILTER (NOT valid) AS invalid,
  count(*) FILTER (valid AND NOT (h = 1080 AND kind = 6)) AS unexpected FROM im GROUP BY clip),
p AS (SELECT o_orderkey AS clip, 1 + o_custkey % 5 AS n FROM orders)
SELECT p.clip, p.n AS frame_count, coalesce(files, 0) AS files, coalesce(invalid, 0) AS invalid, coalesce(unexpected, 0) AS unexpected,
  CASE WHEN coalesce(files, 0) <> n THEN 'frame_count' WHEN NOT (fr = n AND a = 1 AND z = n) THEN 'non_contiguous' WHEN invalid > 0 THEN 'invalid_image'
    WHEN unexpected > 0 THEN 'unexpected_format' ELSE 'ok' END AS verdict FROM p LEFT JOIN s ON s.clip = p.clip""")
def verify_images(t: Tables) -> DataFrame:
    plan = t.orders.select(F.col("o_orderkey").alias("clip"), (1 + F.col("o_custkey") % 5).alias("frame_count"))
    return M.verify_images(image_files(t), plan, 1920, 1080, 16, 6)


@query("throughput", """WITH s AS (SELECT user_id AS run, max(value) AS peak, avg(value % 100) AS mean, min(CASE event_type WHEN 'error' THEN 0 ELSE 1 END) AS good,
  count(*) AS n FROM events GROUP BY 1)
SELECT run, round(CASE WHEN good = 1 THEN n * 3600 / (n * 7.5) ELSE 0 END, 6) AS completed_per_hour, peak AS peak_memory_mib, round(mean, 6) AS mean_utilization FROM s""")
def throughput(t: Tables) -> DataFrame:
    runs = t.events.groupBy(F.col("user_id").alias("run")).agg(
        F.count(F.lit(1)).alias("concurrency"), (F.count_if(F.col("event_type") == "error") == 0).alias("success"), (F.count(F.lit(1)) * 7.5).alias("wall_seconds")
    )
    samples = t.events.select(F.col("user_id").alias("run"), F.col("value").alias("memory_used_mib"), (F.col("value") % 100).alias("utilization"))
    return M.throughput(runs, samples).select("run", F.round("completed_per_hour", 6).alias("completed_per_hour"), "peak_memory_mib", F.round("mean_utilization", 6).alias("mean_utilization"))


# Surface points: embeddings of a label are one frame; the sign of one component names the region.
SURFACE_SQL = """pt AS (SELECT label AS frame, vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z,
  CASE WHEN embedding[4] > 0.1 THEN 'left_hand' WHEN embedding[4] < -0.1 THEN 'right_hand' ELSE 'torso_and_legs' END AS region FROM embeddings),
h AS (SELECT frame, greatest(max(z) - min(z), 1e-6) AS h FROM pt GROUP BY frame),
pr(pair, q, o) AS (VALUES ('left_hand_to_body', 'left_hand', 'torso_and_legs'), ('right_hand_to_body', 'right_hand', 'torso_and_legs'), ('left_to_right_hand', 'left_hand', 'right_hand')),
d AS (SELECT a.frame, pair, a.vec_id, min(sqrt(pow((a.x - b.x) / h, 2) + pow((a.y - b.y) / h, 2) + pow((a.z - b.z) / h, 2))) AS d
  FROM pr JOIN pt a ON a.region = pr.q JOIN pt b ON b.region = pr.o AND b.frame = a.frame JOIN h ON h.frame = a.frame GROUP BY ALL),
fr AS (SELECT frame, pair, min(d) AS minimum, count(*) FILTER (d <= 0.15) AS close_points, count(*) AS points FROM d GROUP BY 1, 2)"""


def surface(t: Tables) -> DataFrame:
    e = F.col("embedding")
    side = F.when(e[3] > 0.1, "left_hand").when(e[3] < -0.1, "right_hand").otherwise("torso_and_legs")
    return t.embeddings.select(
        F.lit("all").alias("clip"), F.col("label").alias("frame"), side.alias("region"), *[e[i].cast("double").alias(a) for i, a in enumerate("xyz")]
    )


@query("proximity_frames", f"WITH {SURFACE_SQL} SELECT frame, pair, round(minimum, 8) AS minimum, close_points, points, round(close_points / points, 8) AS close_fraction FROM fr")
def proximity_frames(t: Tables) -> DataFrame:
    out = P.proximity_frames(surface(t), close=0.15)
    return out.select("frame", "pair", F.round("minimum", 8).alias("minimum"), "close_points", "points", F.round("close_fraction", 8).alias("close_fraction"))


@query("proximity_qc", f"""WITH {SURFACE_SQL} SELECT pair, round(min(minimum), 8) AS minimum, max(close_points) AS max_close_points,
  min(minimum) < 0.0015 AND max(close_points / points) > 0.03 AS severe FROM fr GROUP BY pair""")
def proximity_qc(t: Tables) -> DataFrame:
    out = P.proximity_qc(P.proximity_frames(surface(t), close=0.15))
    return out.select("pair", F.round("minimum", 8).alias("minimum"), "max_close_points", "severe")
