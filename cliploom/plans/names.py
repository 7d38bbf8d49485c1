"""Name and hierarchy queries: parts as bones, objects and tree nodes; customers as people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import material_role
from cliploom.operators import gates, tree
from cliploom.operators import names as N
from cliploom.plans.registry import Tables, query

# Names in four styles, some with a namespace or unknown, spread over the parts.
SAMPLE_NAMES = (
    "rig:LeftUpLeg", "DEF-thigh.L", "thigh_l", "thigh.l", "c_foot.r", "Foot_R", "spine_01.x", "DEF-spine.002", "Pelvis", "hand-ik.L",
    "upperarm_twist_l", "UpperArm L", "ball_r", "toes_01.l", "def-head", "neck_01", "root", "Prop Sword", "mixamorig:RightForeArm", "calf_l",
)
NAME_SQL = "[" + ", ".join(f"'{n}'" for n in SAMPLE_NAMES) + f"][p_partkey % {len(SAMPLE_NAMES)} + 1]"


def bone_name():
    return F.element_at(F.array(*[F.lit(n) for n in SAMPLE_NAMES]), (F.col("p_partkey") % len(SAMPLE_NAMES) + 1).cast("int"))


CANON_SQL = """CASE {0} WHEN 'rig:LeftUpLeg' THEN 'leftupleg' WHEN 'DEF-thigh.L' THEN 'leftupleg' WHEN 'thigh_l' THEN 'leftupleg' WHEN 'thigh.l' THEN 'leftupleg'
  WHEN 'Foot_R' THEN 'rightfoot' WHEN 'spine_01.x' THEN 'spine' WHEN 'DEF-spine.002' THEN 'spine1' WHEN 'Pelvis' THEN 'hips' WHEN 'UpperArm L' THEN 'leftarm'
  WHEN 'ball_r' THEN 'righttoebase' WHEN 'toes_01.l' THEN 'lefttoebase' WHEN 'neck_01' THEN 'neck' WHEN 'root' THEN 'hips'
  WHEN 'mixamorig:RightForeArm' THEN 'rightforearm' WHEN 'calf_l' THEN 'leftleg' END"""


@query("canonical_names", f"""SELECT p_partkey, {CANON_SQL.format(NAME_SQL)} AS semantic,
  CASE {NAME_SQL} WHEN 'Prop Sword' THEN 'propsword' WHEN 'def-head' THEN 'defhead' WHEN 'Pelvis' THEN 'hips' ELSE NULL END AS sample_clean FROM part""")
def canonical_names(t: Tables) -> DataFrame:
    name = bone_name()
    shown = F.when(name.isin("Prop Sword", "def-head", "Pelvis"), N.clean_name(name))
    return t.part.select("p_partkey", N.canonical_name(name).alias("semantic"), shown.alias("sample_clean"))


@query("best_bone", f"""WITH b AS (SELECT p_brand AS rig, p_partkey AS o, {NAME_SQL} AS name, p_size > 25 AS deform FROM part),
s AS (SELECT *, {CANON_SQL.format('name')} AS semantic, lower(name) AS raw FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY rig, semantic ORDER BY deform DESC,
  (CASE WHEN contains(raw, '_ik') THEN 1 ELSE 0 END + CASE WHEN contains(raw, '_fk') THEN 1 ELSE 0 END + CASE WHEN contains(raw, 'twist') THEN 1 ELSE 0 END
   + CASE WHEN contains(raw, 'pole') THEN 1 ELSE 0 END + CASE WHEN contains(raw, 'stretch') THEN 1 ELSE 0 END + CASE WHEN contains(raw, 'track') THEN 1 ELSE 0 END
   + CASE WHEN starts_with(raw, 'c_') THEN 2 ELSE 0 END), length(raw), o) AS rn FROM s WHERE semantic IS NOT NULL)
SELECT rig, semantic, name AS bone FROM r WHERE rn = 1""")
def best_bone(t: Tables) -> DataFrame:
    bones = t.part.select(F.col("p_brand").alias("rig"), F.col("p_partkey").alias("ordinal"), bone_name().alias("name"), (F.col("p_size") > 25).alias("deform"))
    return N.best_bone(bones, ["rig"])


@query("best_rig", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY floor(s_acctbal / 1000) DESC, s_suppkey % 5 DESC, s_suppkey) AS rn FROM supplier)
SELECT s_nationkey AS scene, s_name AS rig FROM r WHERE rn = 1""")
def best_rig(t: Tables) -> DataFrame:
    rigs = t.supplier.select(F.col("s_nationkey").alias("scene"), F.floor(F.col("s_acctbal") / 1000).alias("bound"), (F.col("s_suppkey") % 5).alias("named"), "s_suppkey", "s_name")
    return N.best_rig(rigs, ["scene"], ["bound", "named"], "s_suppkey", "s_name")


FLAG_NAMES = "replace(replace(replace(p_name, 'widget', 'Dress'), 'ring', 'hair Braid'), 'rod', 'eyebrow_hair')"


@query("keyword_flags", f"""WITH n AS (SELECT p_partkey, lower({FLAG_NAMES}) AS s FROM part)
SELECT p_partkey, regexp_matches(s, 'skirt|dress|gown|robe|kimono') AS is_garment,
  regexp_matches(s, 'hair|wig|ponytail|pony|braid|bang|strand|tress') AND NOT regexp_matches(s, 'eyebrow|eyelash|beard|mustache|moustache|brow|lash') AS is_hair,
  regexp_matches(s, 'eyebrow|eyelash|beard|mustache|moustache|brow|lash') AS is_facial, regexp_matches(s, 'outline|lineart|stroke') AS is_outline FROM n""")
def keyword_flags(t: Tables) -> DataFrame:
    return N.keyword_flags(t.part.select("p_partkey", F.expr(FLAG_NAMES).alias("name")), "name").select("p_partkey", "is_garment", "is_hair", "is_facial", "is_outline")


@query("text_keywords", """SELECT doc_id, regexp_matches(lower(text), 'the|and') AS is_english, regexp_matches(lower(text), 'license|copyright') AND NOT regexp_matches(lower(text), 'http') AS is_license FROM documents""")
def text_keywords(t: Tables) -> DataFrame:
    lexicon = {"english": (("the", "and"), ()), "license": (("license", "copyright"), ("http",))}
    return N.keyword_flags(t.documents, "text", lexicon).select("doc_id", "is_english", "is_license")


MATERIALS = "replace(replace(p_name, 'widget', 'skin'), 'ring', 'Scalp_top')"


@query("material_roles", f"""WITH n AS (SELECT p_partkey, lower({MATERIALS} || ' ' || p_type) AS s FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(s, '(^|[ _-])(skin|face|torso|arms?|legs?|ears?|lips)([ _.-]|$)') THEN 'skin'
  WHEN regexp_matches(s, 'hair|scalp|wisps|ponytail|braid') THEN 'hair' ELSE 'unknown' END AS role FROM n""")
def material_roles(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", material_role(F.concat_ws(" ", F.expr(MATERIALS), F.col("p_type"))).alias("role"))


@query("helper_meshes", f"""WITH n AS (SELECT p_partkey, lower(replace(replace(p_name, 'widget', 'outline'), 'blue ', 'shadow_')) AS s FROM part)
SELECT p_partkey, s = 'shadow' OR starts_with(s, 'shadow_') OR ends_with(s, '_shadow') OR regexp_matches(s, 'outline|lineart|stroke') OR contains(s, '_rim_') OR contains(s, 'rim_hero') AS is_helper FROM n""")
def helper_meshes(t: Tables) -> DataFrame:
    name = F.expr("replace(replace(p_name, 'widget', 'outline'), 'blue ', 'shadow_')")
    return gates.helper_meshes(t.part.select("p_partkey", name.alias("name"), name.alias("label"))).select("p_partkey", "is_helper")


PEOPLE = """p AS (SELECT c_custkey, c_name || ' ' || CASE c_mktsegment WHEN 'BUILDING' THEN 'Long Sleeve Robe' WHEN 'MACHINERY' THEN 'plate armor' WHEN 'HOUSEHOLD' THEN 'ponytail' ELSE c_mktsegment END AS names,
  CASE WHEN c_acctbal > 0 THEN c_acctbal / 40000 END AS sw, 0.2 + greatest(c_acctbal, 0) / 50000 AS ar, 0.3 + greatest(c_acctbal, 0) / 30000 AS lr FROM customer)"""


@query("motion_profile", f"""WITH {PEOPLE}, f AS (SELECT *, lower(names) AS s, coalesce(sw, 0.18) AS w FROM p),
g AS (SELECT *, regexp_matches(s, 'skirt|dress|gown|robe|kimono') AS skirt, regexp_matches(s, 'sleeve|coat|cape|cloak') AS sleeve,
  regexp_matches(s, 'armor|armour|plate') OR w > 0.23 AS bulky, regexp_matches(s, 'long hair|ponytail|braid|twin tail') AS hair,
  ('0x' || substr(sha1(s), 1, 8))::BIGINT AS seed FROM f)
SELECT c_custkey, skirt AS has_skirt_or_robe, bulky AS has_armor_or_bulky_shoulders,
  round(greatest(0.62, least(1.02, (0.92::DOUBLE - CASE WHEN sleeve THEN 0.10 ELSE 0 END - CASE WHEN bulky THEN 0.08 ELSE 0 END) * greatest(0.82, least(1.08, 0.31 / greatest(ar, 0.20))))), 8) AS arm_motion_gain,
  round(greatest(0.58, least(1.02, 0.94 * greatest(0.84, least(1.08, 0.45 / greatest(lr, 0.30))) * CASE WHEN skirt THEN 0.76 ELSE 1 END)), 8) AS leg_motion_gain,
  round(greatest(0.62, least(0.96, 0.90::DOUBLE - CASE WHEN hair THEN 0.10 ELSE 0 END - CASE WHEN bulky THEN 0.08 ELSE 0 END)), 8) AS turn_gain,
  round(0.13::DOUBLE + CASE WHEN bulky OR sleeve THEN 0.035 ELSE 0 END, 8) AS body_clearance_ratio, round(-0.06 + 0.12 * (seed % 1009) / 1008, 8) AS gesture_asymmetry,
  CASE WHEN seed % 2 = 0 THEN 'left' ELSE 'right' END AS leading_side FROM g""")
def motion_profile(t: Tables) -> DataFrame:
    style = (
        F.when(F.col("c_mktsegment") == "BUILDING", "Long Sleeve Robe").when(F.col("c_mktsegment") == "MACHINERY", "plate armor")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "ponytail").otherwise(F.col("c_mktsegment"))
    )
    rich = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    people = t.customer.select(
        "c_custkey", F.concat_ws(" ", "c_name", style).alias("names"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 40000).alias("shoulder_width_ratio"),
        F.lit(None).cast("double").alias("hip_width_ratio"), (0.2 + rich / 50000).alias("arm_length_ratio"), (0.3 + rich / 30000).alias("leg_length_ratio"),
    )
    out = N.motion_profile(people, "names")
    return out.select("c_custkey", "has_skirt_or_robe", "has_armor_or_bulky_shoulders", *[F.round(c, 8).alias(c) for c in
                      ("arm_motion_gain", "leg_motion_gain", "turn_gain", "body_clearance_ratio", "gesture_asymmetry")], "leading_side")


OBJECTS = """ob AS (SELECT p_brand || '-' || CAST(p_size AS VARCHAR) AS person, CASE p_type WHEN 'PROMO' THEN 'Hair_' || p_name WHEN 'SMALL' THEN 'Braid.' || upper(p_name) ELSE p_name || '_Outfit' END AS name,
  p_partkey % 3 <> 0 AS visible FROM part)"""


@query("match_variants", f"""WITH {OBJECTS},
w AS (SELECT DISTINCT person, name, visible, unnest(string_split(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'), ' ')) AS word FROM ob),
k AS (SELECT * FROM w WHERE length(word) > 1 AND word NOT IN ('hair', 'braid', 'outfit', 'top', 'base')),
outfit AS (SELECT DISTINCT person, word FROM k WHERE visible AND NOT regexp_matches(lower(name), 'hair|ponytail|braid|bang|cheveux|kami')),
v AS (SELECT DISTINCT person, name, visible FROM ob WHERE regexp_matches(lower(name), 'hair|ponytail|braid|bang|cheveux|kami')),
s AS (SELECT v.person, v.name, v.visible, count(DISTINCT o.word) AS score FROM v LEFT JOIN k ON k.person = v.person AND k.name = v.name
  LEFT JOIN outfit o ON o.person = k.person AND o.word = k.word GROUP BY ALL)
SELECT person, name AS variant, score, max(score) OVER (PARTITION BY person) AS best,
  CASE WHEN max(score) OVER (PARTITION BY person) > 0 THEN 'matched' ELSE 'preserved_source_visibility' END AS status,
  CASE WHEN max(score) OVER (PARTITION BY person) > 0 THEN score = max(score) OVER (PARTITION BY person) ELSE visible END AS enabled FROM s""")
def match_variants(t: Tables) -> DataFrame:
    name = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Hair_"), "p_name")).when(F.col("p_type") == "SMALL", F.concat(F.lit("Braid."), F.upper("p_name")))
        .otherwise(F.concat("p_name", F.lit("_Outfit")))
    )
    objects = t.part.select(F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("person"), name.alias("name"), (F.col("p_partkey") % 3 != 0).alias("visible"))
    return N.match_variants(objects)


@query("missing_controls", """WITH h AS (SELECT c_custkey, list_distinct(list(l)) AS have FROM (SELECT o_custkey AS c_custkey, ['torso', 'head', 'foot_ik.L', 'foot_ik.R', 'thigh_ik_target.L',
   'thigh_ik_target.R', 'hand_ik.L', 'hand_ik.R', 'upper_arm_ik_target.L', 'upper_arm_ik_target.R'][o_orderkey % 10 + 1] AS l FROM orders) GROUP BY 1)
SELECT c_custkey, array_to_string(list_sort(list_filter(['torso', 'head', 'foot_ik.L', 'foot_ik.R', 'thigh_ik_target.L', 'thigh_ik_target.R', 'hand_ik.L', 'hand_ik.R',
  'upper_arm_ik_target.L', 'upper_arm_ik_target.R'], lambda x: NOT list_contains(have, x))), ',') AS missing FROM h""")
def missing_controls(t: Tables) -> DataFrame:
    control = F.element_at(F.array(*[F.lit(c) for c in N.REQUIRED_CONTROLS]), (F.col("o_orderkey") % 10 + 1).cast("int"))
    have = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set(control).alias("have"))  # at most ten names
    return N.missing_items(have, "have").select("c_custkey", F.array_join("missing", ",").alias("missing"))


@query("shared_semantics", f"""WITH a AS (SELECT DISTINCT p_brand AS rig, {CANON_SQL.format(NAME_SQL)} AS s FROM part WHERE p_size > 25),
b AS (SELECT DISTINCT p_brand AS rig, {CANON_SQL.format(NAME_SQL)} AS s FROM part WHERE p_type <> 'PROMO'),
c AS (SELECT a.rig, list_sort(list(a.s)) AS l FROM a JOIN b ON a.rig = b.rig AND a.s = b.s WHERE a.s IS NOT NULL GROUP BY a.rig)
SELECT r.rig, coalesce(array_to_string(l, ','), '') AS shared, coalesce(len(l), 0) >= 12 AS enough FROM (SELECT DISTINCT rig FROM a) r LEFT JOIN c ON c.rig = r.rig""")
def shared_semantics(t: Tables) -> DataFrame:
    named = t.part.select(F.col("p_brand").alias("rig"), N.canonical_name(bone_name()).alias("semantic"), "p_size", "p_type")
    out = N.shared_semantics(named.filter("p_size > 25"), named.filter("p_type <> 'PROMO'"), ["rig"], 12)
    return out.select("rig", F.array_join("shared", ",").alias("shared"), "enough")


# A binary tree over the parts: the parent of key k is k // 2.
TREE = """tree AS (SELECT p_partkey AS name, CASE WHEN p_partkey > 0 THEN p_partkey // 2 END AS parent, p_size, p_type FROM part)"""


def nodes(t: Tables) -> DataFrame:
    return t.part.select(
        F.lit("tree").alias("rig"), F.col("p_partkey").alias("name"), F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 2)).alias("parent"), "p_size", "p_type"
    )


@query("tree_depth", f"""WITH RECURSIVE {TREE}, d AS (SELECT name, 0 AS depth FROM tree WHERE parent IS NULL UNION ALL
  SELECT t.name, d.depth + 1 FROM d JOIN tree t ON t.parent = d.name) SELECT name, CAST(depth AS BIGINT) AS depth FROM d""")
def tree_depth(t: Tables) -> DataFrame:
    return tree.depth(nodes(t), ["rig"]).select("name", "depth")


STRAND = """st AS (SELECT CASE WHEN a.p_size < 8 THEN 'cap_' ELSE 'strand_' END || CAST(a.p_partkey AS VARCHAR) AS name,
  CASE WHEN a.p_partkey > 0 THEN CASE WHEN b.p_size < 8 THEN 'cap_' ELSE 'strand_' END || CAST(b.p_partkey AS VARCHAR) END AS parent, a.p_size / 100.0 AS len
  FROM part a JOIN part b ON b.p_partkey = a.p_partkey // 2 WHERE a.p_type <> 'PROMO')"""
STRANDS = STRAND + """, fx AS (SELECT name FROM st WHERE parent IS NULL OR contains(name, 'cap')),
br AS (SELECT name, name AS branch, 1 AS depth, len::DOUBLE AS length FROM st WHERE name NOT IN (SELECT name FROM fx) AND (parent IN (SELECT name FROM fx) OR parent NOT IN (SELECT name FROM st))
  UNION ALL SELECT s.name, br.branch, br.depth + 1, br.length + s.len FROM br JOIN st s ON s.parent = br.name WHERE s.name NOT IN (SELECT name FROM fx))"""


def strands(t: Tables) -> DataFrame:
    text = lambda key, size: F.concat(F.when(size < 8, "cap_").otherwise("strand_"), key.cast("string"))
    up = t.part.select(F.col("p_partkey").alias("_up"), F.col("p_size").alias("_size"))
    rows = t.part.filter("p_type <> 'PROMO'").withColumn("_up", F.floor(F.col("p_partkey") / 2)).join(up, "_up")
    return rows.select(
        F.lit("tree").alias("rig"), text(F.col("p_partkey"), F.col("p_size")).alias("name"),
        F.when(F.col("p_partkey") > 0, text(F.col("_up"), F.col("_size"))).alias("parent"), (F.col("p_size") / 100.0).alias("length"),
    )


@query("tree_branches", f"WITH RECURSIVE {STRANDS} SELECT name, branch, CAST(depth AS BIGINT) AS depth, round(length, 6) AS length FROM br")
def tree_branches(t: Tables) -> DataFrame:
    return tree.branches(strands(t), ["rig"], "length")[0].select("name", "branch", "depth", F.round("length", 6).alias("length"))


@query("branch_lengths", f"WITH RECURSIVE {STRANDS} SELECT branch, CAST(max(depth) AS BIGINT) AS bones, round(max(length), 6) AS length FROM br GROUP BY branch")
def branch_lengths(t: Tables) -> DataFrame:
    return tree.branches(strands(t), ["rig"], "length")[1].select("branch", "bones", F.round("length", 6).alias("length"))


@query("depth_share", f"""WITH RECURSIVE {STRANDS}, m AS (SELECT branch, max(depth) AS bones FROM br GROUP BY branch),
tot AS (SELECT branch, bones, list_sum(list_transform(generate_series(1, bones), lambda i: pow(i / bones, 1.6))) AS total FROM m)
SELECT name, round(pow(depth / bones, 1.6) / total, 8) AS share FROM br JOIN tot ON tot.branch = br.branch""")
def depth_share(t: Tables) -> DataFrame:
    per_node, per_branch = tree.branches(strands(t), ["rig"], "length")
    return tree.depth_share(per_node, per_branch, ["rig"]).select("name", F.round("share", 8).alias("share"))


LABELLED = """nm AS (SELECT p_partkey AS k, CASE WHEN p_type = 'PROMO' THEN 'hip_' ELSE 'n_' END || CAST(p_partkey AS VARCHAR) AS name FROM part)"""


@query("common_ancestor", f"""WITH RECURSIVE {LABELLED}, up AS (SELECT k AS seed, k, 0 AS d FROM nm UNION ALL SELECT seed, k // 2, d + 1 FROM up WHERE k > 0),
pr AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem),
c AS (SELECT a, b, nm.name, x.d, row_number() OVER (PARTITION BY a, b ORDER BY CASE WHEN contains(nm.name, 'hip') THEN 0 ELSE 1 END, x.d) AS rn
  FROM pr JOIN up x ON x.seed = a JOIN up y ON y.seed = b AND y.k = x.k JOIN nm ON nm.k = x.k)
SELECT na.name AS left, nb.name AS right, c.name AS ancestor FROM c JOIN nm na ON na.k = a JOIN nm nb ON nb.k = b WHERE rn = 1""")
def common_ancestor(t: Tables) -> DataFrame:
    """Pairs go by number, which is short; the result has the names."""
    label = t.part.select(F.col("p_partkey").alias("k"), F.concat(F.when(F.col("p_type") == "PROMO", "hip_").otherwise("n_"), F.col("p_partkey").cast("string")).alias("label"))
    up = label.select(F.col("k").alias("_up"), F.col("k").alias("parent")).distinct()
    named = label.withColumn("_up", F.when(F.col("k") > 0, F.floor(F.col("k") / 2))).join(up, "_up", "left").select(F.lit("tree").alias("rig"), "k", "parent", "label")
    pairs = t.lineitem.select(F.lit("tree").alias("rig"), F.col("l_partkey").alias("left"), F.col("l_suppkey").alias("right"))
    return tree.common_ancestor(named, pairs, ["rig"], "k", label="label").select("left", "right", "ancestor")


@query("close_upward", f"""WITH RECURSIVE {TREE}, c AS (SELECT name, parent FROM tree WHERE p_size = 50 UNION
  SELECT t.name, t.parent FROM c JOIN tree t ON t.name = c.parent WHERE t.p_size > 10) SELECT name FROM c""")
def close_upward(t: Tables) -> DataFrame:
    return tree.close_upward(nodes(t), ["rig"], F.col("p_size") == 50, F.col("p_size") > 10).select("name")


@query("hair_verdict", f"""WITH RECURSIVE {STRANDS}, l AS (SELECT CAST(regexp_extract(branch, '[0-9]+') AS BIGINT) AS clip, max(length) AS m, count(DISTINCT branch) AS n FROM br GROUP BY 1),
c AS (SELECT c_custkey AS clip, 1 + c_custkey % 20 AS h, CASE WHEN c_acctbal > 0 THEN c_acctbal / 10000 END AS ext FROM customer)
SELECT c.clip, coalesce(n, 0) AS branches, round(coalesce(m, 0) / h, 6) AS longest_chain, coalesce(m, 0) / h >= 0.06 AS dynamic_expected,
  CASE WHEN n IS NULL AND ext IS NOT NULL AND ext / h >= 0.22 THEN 'needs_hair_adapter' ELSE 'passed' END AS hair_motion_qc_status FROM c LEFT JOIN l ON l.clip = c.clip""")
def hair_verdict(t: Tables) -> DataFrame:
    """A branch of the part tree belongs to the customer of its number."""
    clips = t.customer.select(
        F.col("c_custkey").alias("clip"), (1 + F.col("c_custkey") % 20).alias("height"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 10000).alias("visible_extent"),
    )
    per_branch = tree.branches(strands(t), ["rig"], "length")[1]
    rows = per_branch.select(F.regexp_extract("branch", "[0-9]+", 0).cast("long").alias("clip"), "length")
    return gates.hair_verdict(clips, rows).select("clip", "branches", F.round("longest_chain", 6).alias("longest_chain"), "dynamic_expected", "hair_motion_qc_status")
