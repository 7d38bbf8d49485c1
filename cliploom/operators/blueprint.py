"""Compatibility repair of four-channel action blueprints.

Rules are data: each has a condition, channel replacements, caps and a note. They are
applied in order as column updates, since later rules read what earlier ones changed.
Conditions that must see the blueprint as it came in name ``was_*`` columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.hashing import stable_mod

# Channel names and the groups the rules speak of.
LOWER_CHANNELS = (
    "weight_shift", "side_step", "forward_step", "back_step", "walk_cycle",
    "brisk_walk", "jog_cycle", "march", "squat", "side_lunge", "pivot_step",
    "soft_jump", "dance_step", "controlled_kick", "crouch_shift", "heel_tap",
    "diagonal_step", "step_touch", "toe_tap", "knee_lift", "calf_raise",
    "split_stance_rock", "shuffle_step", "box_step", "skater_step",
    "low_side_kick", "hamstring_curl", "crossover_step", "pendulum_step",
    "chasse_step", "turn_step", "quick_step",
)
TORSO_CHANNELS = (
    "neutral", "sway", "twist", "bow", "athletic_lean", "side_lean",
    "counter_rotate", "rise_fall", "body_wave", "look_back_twist",
    "chest_open", "chest_contract", "diagonal_lean", "pelvic_shift",
    "shoulder_roll", "torso_circle", "recoil", "reach_follow", "spiral",
    "breathing",
)
ARM_CHANNELS = (
    "natural_swing", "single_reach", "double_reach", "overhead_open", "wave",
    "clap", "cross_body", "near_face", "outward_sweep", "downward_sweep",
    "alternating_pump", "presentation", "balance_open", "push", "pull",
    "celebration", "dance_flow", "compact_gesture", "arm_circle", "guarded_extension",
    "single_overhead_reach", "alternating_reach", "diagonal_reach",
    "lateral_reach", "forward_scoop", "chest_open", "elbow_open",
    "shoulder_roll", "forearm_wave", "double_wave", "point_gesture",
    "salute", "hands_to_hips", "boxer_guard", "low_windmill",
    "high_low_opposition", "rowing", "offering", "side_punch",
    "wrist_flourish",
)
HEAD_CHANNELS = (
    "follow_torso", "look_side", "look_back", "nod", "counterbalance",
    "scan", "soft_tilt", "rhythmic_follow", "glance_up", "glance_down",
    "double_take", "chin_tuck", "gaze_track", "small_circle",
    "stabilize_gaze", "nod_turn",
)
RHYTHMS = ("single", "double", "triple", "cyclic_slow", "cyclic_medium", "accented")
DEEP_LOWER = ("squat", "side_lunge", "crouch_shift", "skater_step")
DYNAMIC_LOWER = (
    "brisk_walk", "jog_cycle", "soft_jump", "controlled_kick", "dance_step", "shuffle_step",
    "skater_step", "low_side_kick", "chasse_step", "quick_step",
)
TURNING_LOWER = ("pivot_step", "dance_step", "box_step", "crossover_step", "turn_step")
WIDE_ARMS = (
    "double_reach", "overhead_open", "outward_sweep", "balance_open", "arm_circle", "celebration",
    "lateral_reach", "chest_open", "elbow_open", "low_windmill", "high_low_opposition",
)
CROSSING_ARMS = (
    "clap", "cross_body", "near_face", "push", "pull", "guarded_extension", "forward_scoop",
    "boxer_guard", "rowing", "offering", "side_punch",
)
HIGH_ARMS = (
    "overhead_open", "celebration", "arm_circle", "single_overhead_reach", "diagonal_reach",
    "high_low_opposition",
)
FORWARD_ARMS = (
    "single_reach", "double_reach", "push", "guarded_extension", "alternating_reach",
    "diagonal_reach", "forward_scoop", "point_gesture", "rowing", "offering", "side_punch",
)
TORSO_EXTREMES = (
    "bow", "body_wave", "side_lean", "look_back_twist", "diagonal_lean", "torso_circle", "spiral",
)
GARMENT_UNSAFE_LOWER = (
    "squat", "side_lunge", "soft_jump", "controlled_kick", "crouch_shift", "skater_step",
    "low_side_kick", "crossover_step", "chasse_step",
)
GARMENT_UNSAFE_ARMS = CROSSING_ARMS + HIGH_ARMS + (
    "double_reach", "shoulder_roll", "forearm_wave", "double_wave", "low_windmill",
)
NARROW_HIP_UNSAFE_LOWER = DEEP_LOWER + (
    "controlled_kick", "low_side_kick", "knee_lift", "hamstring_curl",
    "crossover_step", "chasse_step", "soft_jump",
)
LOW_RISK_LOWER = tuple(c for c in LOWER_CHANNELS if c not in GARMENT_UNSAFE_LOWER + ("jog_cycle", "quick_step"))
LOW_RISK_ARMS = tuple(c for c in ARM_CHANNELS if c not in GARMENT_UNSAFE_ARMS + ("lateral_reach",))
LOW_RISK_TORSO = ("sway", "twist", "athletic_lean", "rise_fall", "neutral")
# Stand-ins for a measurement a profile lacks.
DEFAULT_HIP_RATIO = 0.14
DEFAULT_ARM_RATIO = 0.30


@dataclass(frozen=True)
class Test:
    """A condition on one column, as data: names it is among or not, a limit it stays below, or its truth."""

    column: str
    names: tuple[str, ...] = ()
    among: bool = True
    limit: float | None = None
    default: float | None = None

    def holds(self) -> Column:
        value = F.col(self.column)
        if self.limit is not None:
            return F.coalesce(value, F.lit(self.default)) < self.limit
        if not self.names:
            return F.coalesce(value, F.lit(False))
        return value.isin(*self.names) if self.among else ~value.isin(*self.names)


def one_of(column: str, *groups: Sequence[str]) -> Test:
    return Test(column, tuple(n for g in groups for n in g))


def none_of(column: str, names: Sequence[str]) -> Test:
    return Test(column, tuple(names), among=False)


def below(column: str, limit: float, default: float) -> Test:
    return Test(column, limit=limit, default=default)


def trait(column: str) -> Test:
    return Test(column)


@dataclass(frozen=True)
class Rule:
    """``when`` (all must hold) → replace channels, cap numbers, scale-then-cap, add a note."""

    when: tuple[Test, ...]
    put: Mapping[str, str] = field(default_factory=dict)
    cap: Mapping[str, float] = field(default_factory=dict)
    boost: Mapping[str, tuple[float, float]] = field(default_factory=dict)  # factor, ceiling
    draw: tuple[str, tuple[str, ...], str, str] | None = None  # channel, choices, hash suffix, id default
    note: str | None = None


@dataclass(frozen=True)
class Groups:
    """Channels that the rules of an edition speak of."""

    deep: tuple[str, ...]
    dynamic: tuple[str, ...]
    turning: tuple[str, ...]
    wide: tuple[str, ...]
    crossing: tuple[str, ...]
    high: tuple[str, ...]
    forward: tuple[str, ...]
    torso: tuple[str, ...]
    unsafe_lower: tuple[str, ...] = ()
    unsafe_arms: tuple[str, ...] = ()
    safe_lower: tuple[str, ...] = ()
    safe_arms: tuple[str, ...] = ()


CURRENT = Groups(
    DEEP_LOWER, DYNAMIC_LOWER, TURNING_LOWER, WIDE_ARMS, CROSSING_ARMS, HIGH_ARMS, FORWARD_ARMS, TORSO_EXTREMES,
    GARMENT_UNSAFE_LOWER, GARMENT_UNSAFE_ARMS, LOW_RISK_LOWER, LOW_RISK_ARMS,
)

# The groups of the third and fourth editions.
EARLIER = Groups(
    deep=("squat", "side_lunge", "crouch_shift"),
    dynamic=("brisk_walk", "jog_cycle", "soft_jump", "controlled_kick", "dance_step"),
    turning=("pivot_step", "dance_step"),
    wide=("double_reach", "overhead_open", "outward_sweep", "balance_open", "arm_circle", "celebration"),
    crossing=("clap", "cross_body", "near_face", "push", "pull", "guarded_extension"),
    high=("overhead_open", "celebration", "arm_circle"),
    forward=("single_reach", "double_reach", "push", "guarded_extension"),
    torso=("bow", "body_wave", "side_lean", "look_back_twist"),
    unsafe_lower=("squat", "side_lunge", "soft_jump", "controlled_kick", "crouch_shift"),
    unsafe_arms=(
        "double_reach", "overhead_open", "clap", "cross_body", "near_face", "push", "pull", "celebration",
        "arm_circle", "guarded_extension",
    ),
    safe_lower=(
        "weight_shift", "side_step", "forward_step", "back_step", "walk_cycle", "brisk_walk", "march", "pivot_step", "heel_tap",
    ),
    safe_arms=(
        "natural_swing", "single_reach", "wave", "outward_sweep", "downward_sweep", "alternating_pump", "presentation",
        "balance_open", "dance_flow", "compact_gesture",
    ),
)


# The ordered compatibility rules, in the parts that editions share or exchange.
def channel_conflicts(g: Groups) -> tuple[Rule, ...]:
    """Channels against each other; in all editions."""
    return (
        Rule((one_of("was_lower", g.deep), one_of("was_torso", ("bow", "body_wave"))),
             put={"torso_channel": "athletic_lean"}, note="deep_lower_with_flexion->athletic_lean"),
        Rule((one_of("was_lower", g.deep),), cap={"lower_intensity": 0.78, "torso_intensity": 0.66}),
        Rule((one_of("was_lower", g.deep), one_of("was_arms", g.forward)),
             cap={"arm_intensity": 0.58}, note="deep_lower_caps_forward_reach"),
        Rule((one_of("was_lower", g.deep), none_of("was_arms", g.forward), one_of("was_arms", g.wide)),
             cap={"arm_intensity": 0.62}, note="deep_lower_caps_wide_arms"),
        Rule((one_of("was_lower", ("soft_jump",)), one_of("was_arms", g.crossing)),
             put={"arms": "balance_open"}, note="jump_with_crossing_arms->balance_open"),
        Rule((one_of("was_lower", g.dynamic), one_of("was_arms", g.high)),
             cap={"arm_intensity": 0.72}, note="dynamic_lower_caps_high_arms"),
        Rule((one_of("was_lower", g.dynamic), one_of("was_arms", g.wide)),
             cap={"arm_intensity": 0.66}, note="dynamic_lower_caps_wide_arms"),
        Rule((one_of("was_lower", g.turning), one_of("torso_channel", ("counter_rotate",))),
             put={"torso_channel": "neutral"}, note="opposed_turn_channels->neutral_torso"),
        Rule((one_of("was_arms", g.crossing), one_of("torso_channel", ("twist", "look_back_twist"))),
             cap={"arm_intensity": 0.68}, note="cross_body_with_twist_caps_arms"),
        Rule((one_of("was_arms", g.high), one_of("torso_channel", g.torso)),
             cap={"torso_intensity": 0.58, "arm_intensity": 0.64}, note="high_arms_caps_extreme_torso"),
    )


def exchanges(g: Groups) -> tuple[Rule, ...]:
    """Legs and torso that take other arms or legs; since the fourth edition."""
    return (
        Rule((one_of("was_lower", ("controlled_kick", "side_lunge")), one_of("was_arms", g.crossing, g.high)),
             put={"arms": "balance_open"}, cap={"arm_intensity": 0.66},
             note="single_leg_excursion_replaces_conflicting_arms"),
        Rule((one_of("was_lower", g.deep), one_of("was_arms", g.crossing)),
             put={"arms": "presentation"}, cap={"arm_intensity": 0.60}, note="deep_lower_replaces_crossing_arms"),
        Rule((one_of("was_lower", g.dynamic), one_of("torso_channel", ("body_wave",))),
             draw=("lower", ("weight_shift", "side_step", "heel_tap"), ":lower", "body_wave"),
             cap={"lower_intensity": 0.82, "stride": 0.112, "lift": 0.055, "torso_intensity": 0.72},
             note="body_wave_replaces_dynamic_lower->"),
    )


def narrow_hips(g: Groups) -> tuple[Rule, ...]:
    """Narrow hips choose other legs; the current edition."""
    return (
        Rule((one_of("lower", NARROW_HIP_UNSAFE_LOWER), below("hip_width_ratio", 0.115, DEFAULT_HIP_RATIO)),
             draw=("lower", ("step_touch", "side_step", "heel_tap", "split_stance_rock"), ":hip", "narrow_hip"),
             cap={"lower_intensity": 0.82, "stride": 0.102, "lift": 0.050},
             note="narrow_hip_profile_replaces_lateral_or_deep_lower->"),
        Rule((trait("hit_narrow_hip"), one_of("arms", ("double_reach", "push", "guarded_extension"))),
             put={"arms": "presentation"}, cap={"arm_intensity": 0.55}, note="narrow_hip_replaces_symmetric_forward_arms"),
    )


def narrow_stance(g: Groups) -> tuple[Rule, ...]:
    """Narrow hips stand still instead; the third and fourth editions. Intensities are not negative."""
    return (
        Rule((one_of("was_lower", g.deep), below("hip_width_ratio", 0.11, DEFAULT_HIP_RATIO)),
             put={"lower": "stable_stance", "torso_channel": "neutral"}, cap={"lower_intensity": 0.0},
             note="narrow_hip_profile_replaces_deep_lower_with_stable_stance"),
        Rule((trait("hit_narrow_hip"), one_of("arms", ("double_reach", "push", "guarded_extension"))),
             put={"arms": "presentation"}, cap={"arm_intensity": 0.55}, note="narrow_hip_deep_lower_replaces_symmetric_forward_arms"),
    )


def garments(g: Groups) -> tuple[Rule, ...]:
    """Skirts and sleeves choose other channels; since the fourth edition."""
    return (
        Rule((trait("has_skirt_or_robe"), one_of("lower", g.unsafe_lower)),
             draw=("lower", ("weight_shift", "side_step", "pivot_step", "heel_tap"), "", "garment"),
             cap={"lower_intensity": 0.84, "stride": 0.105, "lift": 0.052}, note="skirt_replaces_leg_excursion->"),
        Rule((trait("has_long_sleeve_or_cape"), one_of("arms", g.unsafe_arms)),
             draw=("arms", ("natural_swing", "presentation", "outward_sweep", "compact_gesture"), ":arms", "sleeve"),
             cap={"arm_intensity": 0.70}, note="long_sleeve_replaces_collision_prone_arms->"),
    )


def garment_caps(g: Groups) -> tuple[Rule, ...]:
    """Skirts and sleeves limit what they keep; the third edition."""
    return (
        Rule((trait("has_skirt_or_robe"), one_of("was_lower", ("side_lunge", "controlled_kick"))),
             cap={"stride": 0.105, "lift": 0.060}, note="skirt_caps_leg_excursion"),
        Rule((trait("has_long_sleeve_or_cape"), one_of("arms", g.wide)),
             cap={"arm_intensity": 0.72}, note="long_sleeve_caps_wide_arms"),
        Rule((trait("has_armor_or_bulky_shoulders"),), cap={"arm_intensity": 0.68}),
        Rule((trait("has_armor_or_bulky_shoulders"), one_of("arms", g.crossing)),
             put={"arms": "presentation"}, note="bulky_replaces_crossing_arms"),
    )


def shoulders(g: Groups) -> tuple[Rule, ...]:
    """Bulky shoulders; since the fourth edition."""
    return (
        Rule((trait("has_armor_or_bulky_shoulders"),), cap={"arm_intensity": 0.68}),
        Rule((trait("has_armor_or_bulky_shoulders"), one_of("arms", g.crossing, g.high)),
             put={"arms": "presentation"}, note="bulky_replaces_crossing_or_high_arms"),
    )


def short_arms(g: Groups) -> tuple[Rule, ...]:
    """Short arms; in all editions."""
    return (
        Rule((below("arm_length_ratio", 0.27, DEFAULT_ARM_RATIO), one_of("arms", g.forward, g.wide)),
             cap={"arm_intensity": 0.56}, note="short_arm_profile_caps_reach"),
    )


def boosts(g: Groups) -> tuple[Rule, ...]:
    """More of what is safe, last of all; since the fourth edition."""
    return (
        Rule((one_of("lower", g.safe_lower),), boost={"lower_intensity": (1.08, 0.98), "stride": (1.06, 0.158)}),
        Rule((one_of("arms", g.safe_arms),), boost={"arm_intensity": (1.08, 0.96)}),
        Rule((one_of("torso_channel", LOW_RISK_TORSO),), boost={"torso_intensity": (1.06, 0.94)}),
        Rule((), boost={"head_intensity": (1.04, 0.92)}),
    )


#: Rule tables by edition of the catalogue.
EDITIONS: Mapping[str, tuple[Rule, ...]] = {
    "v3": channel_conflicts(EARLIER) + narrow_stance(EARLIER) + garment_caps(EARLIER) + short_arms(EARLIER),
    "v4": (
        channel_conflicts(EARLIER) + exchanges(EARLIER) + narrow_stance(EARLIER) + garments(EARLIER)
        + shoulders(EARLIER) + short_arms(EARLIER) + boosts(EARLIER)
    ),
    "v4-expanded": (
        channel_conflicts(CURRENT) + exchanges(CURRENT) + narrow_hips(CURRENT) + garments(CURRENT)
        + shoulders(CURRENT) + short_arms(CURRENT) + boosts(CURRENT)
    ),
}
RULES = EDITIONS["v4-expanded"]


NUMBERS = ("lower_intensity", "torso_intensity", "arm_intensity", "head_intensity", "stride", "lift")


def _stages(rules: Sequence[Rule]) -> list[list[int]]:
    """Runs of rules whose conditions read nothing that an earlier rule of the run replaced."""
    stages: list[list[int]] = [[]]
    dirty: set[str] = set()
    for number, rule in enumerate(rules):
        if any(test.column in dirty for test in rule.when):
            stages.append([])
            dirty = set()
        stages[-1].append(number)
        dirty |= set(rule.put) | ({rule.draw[0]} if rule.draw else set()) | ({"hit_narrow_hip"} if _marks_narrow_hip(rule) else set())
    return stages


def _marks_narrow_hip(rule: Rule) -> bool:
    return bool(rule.note and rule.note.startswith("narrow_hip_profile"))


def _apply(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Run rules stage by stage; leaves a ``_hit`` flag per rule and ``_drawn`` choices."""
    for stage in _stages(rules):
        hits = {}
        for number in stage:
            hit = F.lit(True)
            for test in rules[number].when:
                hit = hit & test.holds()
            hits[f"_hit{number}"] = hit
        df = _settled(df, hits)
        drawn = {}
        for number in stage:
            if rules[number].draw:
                _, choices, suffix, default = rules[number].draw
                seed = F.concat(F.coalesce(F.col("preset_id").cast("string"), F.lit(default)), F.lit(suffix))
                choice = F.element_at(F.array(*[F.lit(c) for c in choices]), stable_mod(seed, len(choices)) + 1)
                drawn[f"_drawn{number}"] = F.when(F.col(f"_hit{number}"), choice)
        if drawn:
            df = _settled(df, drawn)
        changed: dict[str, Column] = {}
        for number in stage:
            rule, on = rules[number], F.col(f"_hit{number}")
            for channel, value in rule.put.items():
                changed[channel] = F.when(on, F.lit(value)).otherwise(changed.get(channel, F.col(channel)))
            if rule.draw:
                channel = rule.draw[0]
                changed[channel] = F.coalesce(F.col(f"_drawn{number}"), changed.get(channel, F.col(channel)))
            if _marks_narrow_hip(rule):
                changed["hit_narrow_hip"] = on
        if changed:
            df = _settled(df, changed)
    return df


def _settled(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` whose results are computed once a row.

    Each stage reads the previous one's columns several times; projections that the optimizer
    merges would repeat the whole chain in every branch. A generator of one row is not merged.
    """
    one = F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c not in columns), one)


def _cap(rules: Sequence[Rule], name: str) -> Column | None:
    caps = [F.when(F.col(f"_hit{i}"), F.lit(rule.cap[name])) for i, rule in enumerate(rules) if name in rule.cap]
    return F.least(*caps) if len(caps) > 1 else caps[0] if caps else None


def _notes(rules: Sequence[Rule]) -> Column:
    found = [
        F.when(F.col(f"_hit{i}"), F.concat(F.lit(rule.note), F.col(f"_drawn{i}")) if rule.draw else F.lit(rule.note))
        for i, rule in enumerate(rules) if rule.note
    ]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def repair_blueprints(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Apply the rules in order and list the repairs made.

    Needs the four channels, their intensities, ``stride``, ``lift`` and ``preset_id``;
    profile columns that are absent count as unknown. Channels change stage by stage; caps
    commute, so numbers are settled once at the end, before the boosts. Rules that boost
    have to come last.
    """
    for name, kind in {
        "hip_width_ratio": "double", "arm_length_ratio": "double", "has_skirt_or_robe": "boolean",
        "has_long_sleeve_or_cape": "boolean", "has_armor_or_bulky_shoulders": "boolean",
    }.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    kept = list(df.columns)
    df = df.withColumns({"was_lower": F.col("lower"), "was_torso": F.col("torso_channel"), "was_arms": F.col("arms")})
    df = _apply(df, rules)

    numbers = {}
    for name in NUMBERS:
        cap = _cap(rules, name)
        numbers[name] = F.col(name) if cap is None else F.least(F.col(name), cap)
    df = df.withColumns(numbers)
    boosted = {}
    for i, rule in enumerate(rules):
        for name, (factor, top) in rule.boost.items():
            boosted[name] = F.when(F.col(f"_hit{i}"), F.least(F.lit(top), F.col(name) * F.lit(factor))).otherwise(F.col(name))
    return df.select(*[boosted.get(c, F.col(c)).alias(c) for c in kept], _notes(rules).alias("compatibility_repairs"))
