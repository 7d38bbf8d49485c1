"""Text, path and JSON columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_unsafe(path: Column) -> Column:
    """Absolute, or with a parent component."""
    return path.startswith("/") | F.array_contains(F.split(path, "/", -1), "..")


def framing_of(index: Column) -> Column:
    """Framing class of an action index 0-11; anything else is an error."""
    return (
        F.when(index.between(0, 5), "fullbody")
        .when(index.between(6, 8), "halfbody")
        .when(index.between(9, 11), "closeup_hair")
        .otherwise(F.raise_error(F.concat(F.lit("action index outside [0, 11]: "), index.cast("string"))))
    )


def framing_or_null(index: Column) -> Column:
    """As ``framing_of`` but null outside the range, for verdict queries."""
    return F.when(index.between(0, 11), framing_of(index))


# Failure markers and the job status each leads to.
FAILURE_MARKERS = {"GARMENT_QC:": "failed_prepass", "PREPASS:": "failed_prepass"}
OTHER_FAILURE = "failed"


def failure_class(detail: Column) -> Column:
    """Marker class of a failure text: garment, prepass or other."""
    return (
        F.when(detail.contains("GARMENT_QC:"), "garment_qc")
        .when(detail.contains("PREPASS:"), "prepass")
        .otherwise("other")
    )


def failure_status(detail: Column) -> Column:
    chain = None
    for marker, status in FAILURE_MARKERS.items():
        hit = detail.contains(marker)
        chain = F.when(hit, status) if chain is None else chain.when(hit, status)
    return chain.otherwise(OTHER_FAILURE)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Literal substring test against a word list, as one alternation."""
    return text.rlike("|".join("\\Q" + w + "\\E" for w in words))


# Keyword lists on lowercased names.
GARMENT_WORDS = ("skirt", "dress", "gown", "robe", "kimono", "裙", "袍")
SLEEVE_WORDS = ("long sleeve", "sleeve", "coat", "cape", "cloak", "袖", "披风")
ARMOR_WORDS = ("armor", "armour", "plate", "甲", "铠")
LONG_HAIR_WORDS = ("long hair", "ponytail", "braid", "twin tail", "长发", "马尾", "辫")
HAIR_WORDS = ("hair", "wig", "ponytail", "pony", "braid", "bang", "strand", "tress")
FACIAL_HAIR_WORDS = ("eyebrow", "eyelash", "beard", "mustache", "moustache", "brow", "lash")
BODY_WORDS = (
    "head", "neck", "spine", "chest", "shoulder", "clavicle", "arm", "hand",
    "pelvis", "hip", "thigh", "leg", "foot", "toe", "face", "eye", "jaw",
    "tongue", "breast",
)
OUTLINE_WORDS = ("outline", "lineart", "stroke")

LEXICON: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "garment": (GARMENT_WORDS, ()),
    "hair": (HAIR_WORDS, FACIAL_HAIR_WORDS),
    "facial": (FACIAL_HAIR_WORDS, ()),
    "body": (BODY_WORDS, ()),
    "outline": (OUTLINE_WORDS, ()),
}


def keyword_flag(name: Column, words: Sequence[str], excluded: Sequence[str] = ()) -> Column:
    text = F.lower(name)
    hit = contains_any(text, words)
    return hit & ~contains_any(text, excluded) if excluded else hit


def is_helper_outline(name: Column, label: Column | None = None) -> Column:
    """Outline and shadow helper objects; ``label`` adds material names to the text."""
    low = F.lower(name)
    text = F.lower(label) if label is not None else low
    return (
        (low == "shadow")
        | low.startswith("shadow_")
        | low.endswith("_shadow")
        | contains_any(text, OUTLINE_WORDS)
        | text.contains("_rim_")
        | text.contains("rim_hero")
    )


# Material patterns on lowercased names.
SKIN_PATTERN = r"(^|[ _-])(skin|face|torso|arms?|legs?|ears?|lips)([ _.-]|$)"
HAIR_MATERIAL_WORDS = ("hair", "scalp", "wisps", "ponytail", "braid")


def material_role(name: Column) -> Column:
    text = F.lower(name)
    return (
        F.when(text.rlike(SKIN_PATTERN), "skin")
        .when(contains_any(text, HAIR_MATERIAL_WORDS), "hair")
        .otherwise("unknown")
    )


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of ``key`` in a small fixed table, else null."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*entries), key)


def json_field(text: Column, path: str) -> Column:
    """One field of a JSON text; null when the text is malformed or the field is absent."""
    return F.get_json_object(text, path)


def first_json(text: Column) -> Column:
    """From the first opening brace to the last closing brace of free text, else null."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def frame_name(number: Column) -> Column:
    return F.format_string("%05d", number)


def utc_stamp(moment: Column) -> Column:
    """Compact stamp such as 20260131T235959000000Z (session time zone UTC)."""
    return F.date_format(moment, "yyyyMMdd'T'HHmmssSSSSSS'Z'")
