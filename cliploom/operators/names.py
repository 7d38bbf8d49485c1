"""Bone, object and variant names: canonical forms, traits and best candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import (
    ARMOR_WORDS, GARMENT_WORDS, LEXICON, LONG_HAIR_WORDS, SLEEVE_WORDS, contains_any, keyword_flag, lookup,
)

# Semantic bones and the alias tables, in lookup order.
CORE_BONES = (
    "hips", "spine", "spine1", "spine2", "neck", "head",
    "leftshoulder", "leftarm", "leftforearm", "lefthand",
    "rightshoulder", "rightarm", "rightforearm", "righthand",
    "leftupleg", "leftleg", "leftfoot", "lefttoebase",
    "rightupleg", "rightleg", "rightfoot", "righttoebase",
)
COMPACT_ALIASES = {
    "pelvis": "hips", "root": "hips",
    "upperarml": "leftarm", "lowerarml": "leftforearm", "handl": "lefthand",
    "upperarmr": "rightarm", "lowerarmr": "rightforearm", "handr": "righthand",
    "thighl": "leftupleg", "calfl": "leftleg", "footl": "leftfoot",
    "thighr": "rightupleg", "calfr": "rightleg", "footr": "rightfoot",
}
CONTROL_ALIASES = {
    "root.x": "hips", "spine_01.x": "spine", "spine_02.x": "spine1",
    "spine_03.x": "spine2", "neck.x": "neck", "head.x": "head",
    "shoulder.l": "leftshoulder", "arm.l": "leftarm",
    "forearm.l": "leftforearm", "hand.l": "lefthand",
    "thigh.l": "leftupleg", "leg.l": "leftleg", "foot.l": "leftfoot",
    "toes_01.l": "lefttoebase",
    "shoulder.r": "rightshoulder", "arm.r": "rightarm",
    "forearm.r": "rightforearm", "hand.r": "righthand",
    "thigh.r": "rightupleg", "leg.r": "rightleg", "foot.r": "rightfoot",
    "toes_01.r": "righttoebase",
}
ENGINE_ALIASES = {
    "pelvis": "hips", "spine_01": "spine", "spine_02": "spine1",
    "spine_03": "spine2", "neck_01": "neck", "head": "head",
    "clavicle_l": "leftshoulder", "upperarm_l": "leftarm",
    "lowerarm_l": "leftforearm", "hand_l": "lefthand",
    "thigh_l": "leftupleg", "calf_l": "leftleg", "foot_l": "leftfoot",
    "ball_l": "lefttoebase",
    "clavicle_r": "rightshoulder", "upperarm_r": "rightarm",
    "lowerarm_r": "rightforearm", "hand_r": "righthand",
    "thigh_r": "rightupleg", "calf_r": "rightleg", "foot_r": "rightfoot",
    "ball_r": "righttoebase",
}
DEFORM_ALIASES = {
    "def_spine": "hips", "def_spine.001": "spine", "def_spine.002": "spine1",
    "def_spine.003": "spine2", "def_spine.006": "neck", "def_spine.007": "head",
    "def_shoulder.l": "leftshoulder", "def_upper_arm.l": "leftarm",
    "def_forearm.l": "leftforearm", "def_hand.l": "lefthand",
    "def_thigh.l": "leftupleg", "def_shin.l": "leftleg",
    "def_foot.l": "leftfoot", "def_toe.l": "lefttoebase",
    "def_shoulder.r": "rightshoulder", "def_upper_arm.r": "rightarm",
    "def_forearm.r": "rightforearm", "def_hand.r": "righthand",
    "def_thigh.r": "rightupleg", "def_shin.r": "rightleg",
    "def_foot.r": "rightfoot", "def_toe.r": "righttoebase",
}
PENALTY_WORDS = ("_ik", "_fk", "twist", "pole", "stretch", "track")
MIN_SHARED = 18
REQUIRED_CONTROLS = (
    "torso", "head", "foot_ik.L", "foot_ik.R", "thigh_ik_target.L", "thigh_ik_target.R",
    "hand_ik.L", "hand_ik.R", "upper_arm_ik_target.L", "upper_arm_ik_target.R",
)


def clean_name(name: Column) -> Column:
    """Namespace stripped, lowercase, separators dropped, short aliases resolved."""
    compact = F.translate(F.lower(F.substring_index(name, ":", -1)), " _-.", "")
    return F.coalesce(lookup(compact, COMPACT_ALIASES), compact)


def canonical_name(name: Column) -> Column:
    """Semantic bone behind a name in any of four naming styles, else null."""
    raw = F.replace(F.lower(F.substring_index(name, ":", -1)), F.lit("-"), F.lit("_"))
    compact = clean_name(name)
    return F.coalesce(
        F.when(compact.isin(*CORE_BONES), compact),
        lookup(raw, CONTROL_ALIASES), lookup(raw, ENGINE_ALIASES), lookup(raw, DEFORM_ALIASES),
    )


def keyword_flags(df: DataFrame, name: str, lexicon: Mapping[str, tuple[Sequence[str], Sequence[str]]] = LEXICON) -> DataFrame:
    """One flag per lexicon entry: any of its words, none of its exclusions."""
    return df.withColumns({f"is_{key}": keyword_flag(F.col(name), words, out) for key, (words, out) in lexicon.items()})


def motion_profile(df: DataFrame, names: str) -> DataFrame:
    """Traits and bounded gains of a person from joined names and body ratios.

    Ratios may be null and then take usual values. Asymmetry and leading side come from a
    hash of the names.
    """
    text = F.lower(F.col(names))
    ratio = lambda c, usual: F.coalesce(F.col(c), F.lit(usual))
    base = df.withColumns({
        "shoulder_width_ratio": ratio("shoulder_width_ratio", 0.18), "hip_width_ratio": ratio("hip_width_ratio", 0.14),
        "arm_length_ratio": ratio("arm_length_ratio", 0.30), "leg_length_ratio": ratio("leg_length_ratio", 0.45),
        "has_skirt_or_robe": contains_any(text, GARMENT_WORDS),
        "has_long_sleeve_or_cape": contains_any(text, SLEEVE_WORDS),
        "_armor": contains_any(text, ARMOR_WORDS),
        "has_long_hair": contains_any(text, LONG_HAIR_WORDS),
        "_seed": F.conv(F.substring(F.sha1(text), 1, 8), 16, 10).cast("long"),
    })
    base = base.withColumn("has_armor_or_bulky_shoulders", F.col("_armor") | (F.col("shoulder_width_ratio") > 0.23))
    skirt, sleeve, bulky, hair = (F.col(c) for c in (
        "has_skirt_or_robe", "has_long_sleeve_or_cape", "has_armor_or_bulky_shoulders", "has_long_hair"))
    minus = lambda flag, amount: F.when(flag, F.lit(amount)).otherwise(0.0)
    bounded = lambda value, low, high: F.greatest(F.lit(low), F.least(F.lit(high), value))
    arm = (F.lit(0.92) - minus(sleeve, 0.10) - minus(bulky, 0.08)) * bounded(F.lit(0.31) / F.greatest("arm_length_ratio", F.lit(0.20)), 0.82, 1.08)
    leg = F.lit(0.94) * bounded(F.lit(0.45) / F.greatest("leg_length_ratio", F.lit(0.30)), 0.84, 1.08) * F.when(skirt, 0.76).otherwise(1.0)
    return base.withColumns({
        "arm_motion_gain": bounded(arm, 0.62, 1.02),
        "leg_motion_gain": bounded(leg, 0.58, 1.02),
        "turn_gain": bounded(F.lit(0.90) - minus(hair, 0.10) - minus(bulky, 0.08), 0.62, 0.96),
        "root_motion_gain": F.when(skirt | bulky, 0.86).otherwise(0.94),
        "body_clearance_ratio": F.lit(0.13) + minus(bulky | sleeve, 0.035),
        "gesture_asymmetry": F.lit(-0.06) + F.lit(0.12) * ((F.col("_seed") % 1009) / 1008.0),
        "leading_side": F.when(F.col("_seed") % 2 == 0, "left").otherwise("right"),
    }).drop("_armor", "_seed")


def best_bone(bones: DataFrame, rig: Sequence[str], name: str = "name", deform: str = "deform", order: str = "ordinal") -> DataFrame:
    """Best bone per rig and semantic: deforming, least penalised, shortest; the first wins ties."""
    raw = F.lower(F.col(name))
    penalty = F.when(raw.startswith("c_"), 2).otherwise(0)
    for word in PENALTY_WORDS:
        penalty = penalty + raw.contains(word).cast("int")
    scored = bones.withColumn("semantic", canonical_name(F.col(name))).filter(F.col("semantic").isNotNull())
    key = F.struct(
        F.when(F.col(deform), 0).otherwise(1).alias("d"), penalty.alias("p"), F.length(raw).alias("l"), F.col(order).alias("o"), F.col(name).alias("bone")
    )
    return scored.groupBy(*rig, "semantic").agg(F.min(key).alias("_k")).select(*rig, "semantic", "_k.bone")


def best_rig(rigs: DataFrame, scene: Sequence[str], scores: Sequence[str], order: str, name: str) -> DataFrame:
    """Rig with the largest scores, compared in order; the first wins ties."""
    key = F.struct(*[(-F.col(s).cast("long")).alias(f"s{i}") for i, s in enumerate(scores)], F.col(order).alias("o"), F.col(name).alias("rig"))
    return rigs.groupBy(*scene).agg(F.min(key).alias("_k")).select(*scene, "_k.rig")


# Hair words and words that say nothing about an outfit.
VARIANT_HAIR_WORDS = ("hair", "ponytail", "braid", "bang", "cheveux", "kami")
IGNORED_WORDS = (
    "accessory", "accessories", "alt", "base", "body", "boots", "bottom",
    "bottoms", "cape", "default", "dress", "earring", "earrings", "glove",
    "gloves", "hair", "jacket", "kami", "necklace", "of", "outfit", "pants",
    "ponytail", "braid", "bang", "cheveux", "shirt", "shoe", "shoes", "skirt",
    "swimsuit", "top", "underwear",
)


def name_tokens(name: Column) -> Column:
    """Distinct telling words of a name: alphanumeric, longer than one, not ignored."""
    words = F.split(F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]", " ")), " +")
    telling = F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*IGNORED_WORDS))
    return F.array_distinct(telling)


def match_variants(objects: DataFrame, person: Sequence[str] = ("person",), name: str = "name", visible: str = "visible") -> DataFrame:
    """Hair variants matching the visible outfit of a person.

    The score of a variant is the number of its words among the words of visible non-hair
    objects. All variants at the best score are enabled; with no overlap nothing changes.
    Words are joined as rows, so a person with many objects is not gathered.
    """
    person = list(person)
    hair = contains_any(F.lower(F.col(name)), VARIANT_HAIR_WORDS)
    words = lambda df: df.select(*person, F.col(name).alias("_object"), F.explode(name_tokens(F.col(name))).alias("_word"))
    variants = objects.filter(hair)
    outfit = words(objects.filter(~hair & F.col(visible))).select(*person, "_word").distinct()
    scores = words(variants).distinct().join(outfit, [*person, "_word"], "left_semi").groupBy(*person, "_object").agg(F.count(F.lit(1)).alias("score"))
    best = scores.groupBy(*person).agg(F.max("score").alias("best"))
    rows = (
        variants.select(*person, F.col(name).alias("_object"), F.col(visible).alias("_visible")).distinct()
        .join(scores, [*person, "_object"], "left").join(best, person, "left").fillna(0, ["score", "best"])
    )
    enabled = F.when(F.col("best") > 0, F.col("score") == F.col("best")).otherwise(F.col("_visible"))
    return rows.select(
        *person, F.col("_object").alias("variant"), "score", "best",
        F.when(F.col("best") > 0, "matched").otherwise("preserved_source_visibility").alias("status"), enabled.alias("enabled"),
    )


def missing_items(df: DataFrame, have: str, required: Sequence[str] = REQUIRED_CONTROLS) -> DataFrame:
    """Required names absent from an array column, sorted."""
    return df.withColumn("missing", F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), F.col(have))))


def shared_semantics(a: DataFrame, b: DataFrame, by: Sequence[str], minimum: int = MIN_SHARED) -> DataFrame:
    """Core semantics two rigs have in common, and whether they are enough.

    Both sides hold (by, semantic); they meet as sets of rows.
    """
    core = F.col("semantic").isin(*CORE_BONES)
    common = a.filter(core).select(*by, "semantic").distinct().join(b.filter(core).select(*by, "semantic").distinct(), [*by, "semantic"], "left_semi")
    counted = common.groupBy(*by).agg(F.array_sort(F.collect_set("semantic")).alias("shared"))  # at most the core bones
    everyone = a.select(*by).distinct()
    return everyone.join(counted, list(by), "left").withColumn("shared", F.coalesce("shared", F.array().cast("array<string>"))).withColumn(
        "enough", F.size("shared") >= minimum
    )
