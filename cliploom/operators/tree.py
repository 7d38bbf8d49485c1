"""Operators on name hierarchies: (rig, name, parent) rows, root with null parent.

Ancestors are found by pointer doubling: every round replaces a node's pointer by its
pointer's pointer, so a tree of depth d needs about log2(d) equi-joins, each over rows that
are already keyed. Each round is written out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.operators.kernels import number_rows
from cliploom.session import pin, remove_path, scratch_path

MAX_ROUNDS = 40  # a depth beyond 2^40 means a cycle


def _stored(df: DataFrame, earlier: list[str] | None = None) -> DataFrame:
    """``df`` as a table in the shared folder; the table in ``earlier``, which it was made from, is removed."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "tree")
    df.write.parquet(path)
    if earlier is not None:
        for old in earlier:
            remove_path(spark, old)
        earlier[:] = [path]
    return spark.read.schema(df.schema).parquet(path)


def climb(nodes: DataFrame, key: Sequence[str], name: str, parent: str, stop: Column, amount: Column) -> DataFrame:
    """For every node the stop node it climbs to and the amounts summed on the way.

    ``stop`` marks nodes where climbing ends, besides nodes without parent. The sum covers
    the node itself and all nodes up to, not including, the stop node; a stop node sums to 0.
    """
    key = list(key)
    state = nodes.select(
        *key, F.col(name).alias("node"),
        F.when(stop | F.col(parent).isNull(), F.lit(None)).otherwise(F.col(parent)).alias("up"),
        F.when(stop | F.col(parent).isNull(), F.lit(0.0)).otherwise(amount.cast("double")).alias("total"),
        F.when(stop | F.col(parent).isNull(), F.lit(0)).otherwise(1).cast("long").alias("steps"),
        F.col(name).alias("top"),
    )
    tables: list[str] = []
    state = _stored(state, tables)
    for _ in range(MAX_ROUNDS):
        if not state.filter(F.col("up").isNotNull()).limit(1).count():
            return state.drop("up")
        settled, moving = state.filter(F.col("up").isNull()), state.filter(F.col("up").isNotNull())
        ahead = state.select(
            *key, F.col("node").alias("up"), F.col("up").alias("_up"), F.col("total").alias("_total"),
            F.col("steps").alias("_steps"), F.col("top").alias("_top"),
        )
        # A node whose pointer is settled takes that pointer's stop node and stops moving; settled nodes take no part in the join.
        state = _stored(
            settled.select(*key, "node", "up", "total", "steps", "top").unionByName(moving.join(ahead, [*key, "up"], "left").select(
                *key, "node", F.col("_up").alias("up"),
                (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total"),
                (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
                F.coalesce("_top", "up").alias("top"),
            )), tables
        )
    raise RuntimeError("hierarchy has a cycle")


def depth(nodes: DataFrame, key: Sequence[str], name: str = "name", parent: str = "parent") -> DataFrame:
    """Steps from each node to its root."""
    climbed = climb(nodes, key, name, parent, F.lit(False), F.lit(1.0))
    return climbed.select(*key, F.col("node").alias(name), F.col("steps").alias("depth"), F.col("top").alias("root"))


# Words that mark the fixed base of a strand.
ROOT_WORDS = ("socket", "scalp", "cap", "hair_root")


def branches(nodes: DataFrame, key: Sequence[str], length: str, name: str = "name", parent: str = "parent") -> tuple[DataFrame, DataFrame]:
    """Branches of a strand hierarchy below its fixed roots.

    ``nodes`` are the strand's own bones; a bone is a fixed root when it has no parent or
    its name says so. Returns per node (branch, depth from 1, length to the
    branch start) and per branch (bones deep, longest length).
    """
    key = list(key)
    own = nodes.select(*key, F.col(name).alias(parent)).distinct().withColumn("_inside", F.lit(True))
    word = F.lower(F.col(name)).rlike("|".join(ROOT_WORDS))
    marked = nodes.join(own, [*key, parent], "left").withColumn("_fixed", F.col(parent).isNull() | word)
    fixed = marked.filter("_fixed").select(*key, F.col(name).alias(parent)).withColumn("_below_fixed", F.lit(True))
    # The first bone below a fixed root, or one whose parent is no strand bone, starts a branch.
    linked = marked.filter(~F.col("_fixed")).join(fixed, [*key, parent], "left")
    start = F.col("_below_fixed").isNotNull() | F.col("_inside").isNull()
    climbed = climb(linked.withColumn("_start", start), key, name, parent, F.col("_start"), F.col(length))
    first = linked.filter(start).select(*key, F.col(name).alias("top"), F.col(length).cast("double").alias("_first"))
    per_node = climbed.join(first, [*key, "top"]).select(
        *key, F.col("node").alias(name), F.col("top").alias("branch"), (F.col("steps") + 1).alias("depth"), (F.col("total") + F.col("_first")).alias("length")
    )
    per_branch = per_node.groupBy(*key, "branch").agg(F.max("depth").alias("bones"), F.max("length").alias("length"))
    return per_node, per_branch


def depth_share(per_node: DataFrame, per_branch: DataFrame, key: Sequence[str], power: float = 1.6) -> DataFrame:
    """Share of a branch's motion at each depth: (depth / bones)^power over its sum."""
    weight = lambda i: F.pow(i / F.col("bones"), F.lit(power))
    total = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("bones")), F.lit(0.0), lambda acc, i: acc + weight(i))
    sizes = per_branch.select(*key, "branch", "bones", total.alias("_total"))
    share = weight(F.col("depth")) / F.greatest(F.col("_total"), F.lit(1e-6))
    return per_node.join(sizes, [*key, "branch"]).withColumn("share", share).drop("_total", "bones")


def jump_tables(nodes: DataFrame, key: Sequence[str], name: str = "name", parent: str = "parent") -> list[DataFrame]:
    """Tables (node, up) of the ancestors 1, 2, 4, ... steps up, as far as any node has one."""
    key = list(key)
    tables = [pin(nodes.filter(F.col(parent).isNotNull()).select(*key, F.col(name).alias("node"), F.col(parent).alias("up")))]
    for _ in range(MAX_ROUNDS):
        last = tables[-1]
        if last.isEmpty():
            return tables[:-1]
        tables.append(pin(last.join(last.select(*key, F.col("node").alias("up"), F.col("up").alias("_next")), [*key, "up"]).select(*key, "node", F.col("_next").alias("up"))))
    raise RuntimeError("hierarchy has a cycle")


# Words preferred for a common ancestor.
PELVIS_WORDS = ("pelvis", "hip")


PAIRS = 500_000      # pairs told apart in one task
HOT = 512            # nodes at most that are looked up in a broadcast
HOT_ROWS = 100_000   # rows of a node below which it is joined like any other
TOP = 2**18          # nodes next to the roots at most that every task holds


def _look_up(rows: DataFrame, table: DataFrame, key: Sequence[str], sides: Mapping[str, str], how: str, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` with the ``up`` that ``table`` (node, up) has for the node in each of ``sides``, side -> new column.

    Near a root a few nodes stand in most rows. A sketch, one pass without a shuffle, names the most
    frequent ones; their rows stay where they are and meet a broadcast of those nodes, and only the
    others are shuffled. Which nodes it names changes the work, never the result, so ``counted`` may
    stand for the rows.
    """
    at = lambda side: F.xxhash64(*key, side)
    counted = (rows if counted is None else counted).select(*[at(side).alias(side) for side in sides])
    frequent = counted.selectExpr(*[f"approx_top_k(`{side}`, {HOT}, {32 * HOT}) AS `{side}`" for side in sides]).first()
    parts = [rows]
    for side, out in sides.items():
        found = table.select(*key, F.col("node").alias(side), F.col("up").alias(out))
        hot = [e["item"] for e in frequent[side] if e["count"] >= HOT_ROWS]
        if hot:
            inside = at(side).isin(hot)
            near = F.broadcast(found.filter(inside))
            parts = [x for p in parts for x in (p.filter(inside).join(near, [*key, side], how), p.filter(~inside).join(found, [*key, side], how))]
        else:
            parts = [p.join(found, [*key, side], how) for p in parts]
    return reduce(DataFrame.unionByName, parts)


def _meeting(depths: np.ndarray, jumps: Sequence[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the nearest common ancestors of the nodes at places ``a`` and ``b``, -1 without one.

    ``jumps`` has the place of the ancestor 1, 2, 4, ... steps up; the last place stands for none.
    """
    low = depths[a] < depths[b]
    a, b = np.where(low, b, a), np.where(low, a, b)
    gap = depths[a] - depths[b]
    for k, up in enumerate(jumps):
        a = np.where(gap >> k & 1, up[a], a)
    for up in reversed(jumps):
        apart = up[a] != up[b]
        a, b = np.where(apart, up[a], a), np.where(apart, up[b], b)
    if jumps:
        a, b = np.where(a == b, a, jumps[0][a]), np.where(a == b, b, jumps[0][b])
    return np.where((a == b) & (a < len(depths) - 1), a, -1)


def _meeting_at_top(top: DataFrame, key: Sequence[str]):
    """A column function of two places in ``top`` (key, node, parent, depth, _at), for the place where they meet."""
    up = top.select(*key, F.col("node").alias("parent"), F.col("_at").alias("_up"))
    rows = top.join(up, [*key, "parent"], "left").select("_at", "_up", "depth").toPandas().sort_values("_at")
    none = len(rows)
    depths, jumps = np.append(rows["depth"].to_numpy(np.int64), 0), []
    up = np.append(rows["_up"].fillna(none).to_numpy(np.int64), none)
    for _ in range(int(depths.max()).bit_length()):
        jumps.append(up.astype(np.int32))
        up = up[up]
    held = top.sparkSession.sparkContext.broadcast((depths.astype(np.int32), jumps))

    @F.pandas_udf("long")
    def meeting(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_meeting(*held.value, *(np.where(x.to_numpy() < 0, none, x.to_numpy()) for x in (a, b))))

    return meeting


def _lifted(nodes: DataFrame, pairs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Nearest common ancestors of distinct pairs in ``nodes`` (key, node, parent).

    The deeper side jumps to the other's depth, then both jump while they differ, the widest
    jumps first: a pair stays one row and takes two joins for each power of two of the depth.
    """
    jumps = jump_tables(nodes, key, "node")
    deep = depth(nodes, key, "node").select(*key, "node", "depth")
    at = pairs.select(*key, "left", "right").withColumns({"_l": F.col("left"), "_r": F.col("right")})
    for side in ("_l", "_r"):
        at = at.join(deep.select(*key, F.col("node").alias(side), F.col("depth").alias(f"{side}d")), [*key, side], "left").fillna(0, [f"{side}d"])
    at = at.withColumns({"_low": F.col("_ld") < F.col("_rd"), "_gap": F.abs(F.col("_ld") - F.col("_rd"))})
    # the deeper side is _a from here on
    tables: list[str] = []
    at = _stored(at.select(*key, "left", "right", F.when(F.col("_low"), F.col("_r")).otherwise(F.col("_l")).alias("_a"), F.when(F.col("_low"), F.col("_l")).otherwise(F.col("_r")).alias("_b"), "_gap"), tables)
    for k in reversed(range(len(jumps))):
        moving, rest = at.filter(F.col("_gap") >= 2**k), at.filter(F.col("_gap") < 2**k)
        moved = _look_up(moving, jumps[k], key, {"_a": "_up"}, "inner").select(*key, "left", "right", F.col("_up").alias("_a"), "_b", (F.col("_gap") - 2**k).alias("_gap"))
        at = _stored(rest.unionByName(moved), tables)
    met = at.filter(F.col("_a") == F.col("_b")).select(*key, "left", "right", F.col("_a").alias("ancestor"))
    apart, tables = at.filter(F.col("_a") != F.col("_b")), []
    for k in reversed(range(len(jumps))):
        ahead = _look_up(apart, jumps[k], key, {"_a": "_ua", "_b": "_ub"}, "left")
        jump = F.coalesce(F.col("_ua") != F.col("_ub"), F.lit(False))
        apart = _stored(ahead.select(*key, "left", "right", F.when(jump, F.col("_ua")).otherwise(F.col("_a")).alias("_a"), F.when(jump, F.col("_ub")).otherwise(F.col("_b")).alias("_b")), tables)
    if jumps:
        last = _look_up(apart, jumps[0], key, {"_a": "ancestor", "_b": "_other"}, "inner").filter(F.col("ancestor") == F.col("_other"))
        met = met.unionByName(last.select(*key, "left", "right", "ancestor"))
    return _stored(met)


def common_ancestor(
    nodes: DataFrame, pairs: DataFrame, key: Sequence[str], name: str = "name", parent: str = "parent",
    preferred: Sequence[str] = PELVIS_WORDS, label: str | None = None,
) -> DataFrame:
    """Nearest common ancestor of (left, right) pairs, each once; a nearest preferred name comes first.

    With ``label`` pairs and parents go by ``name``, and the result, which then has the pairs of known
    nodes only, shows that column of the nodes instead, where preferred words are looked for, too; a
    pair comes as often as its two nodes do.

    Every task holds the ``TOP`` nodes next to the roots, whole levels. A pair meets the places there
    of its sides, one join for each side, and where these differ it is done: its ancestor is one of
    them. Pairs below the same node are left to jumps among the nodes below it.
    """
    key, at = list(key), [*key, "_at"]
    given = nodes.select(*key, F.col(name).alias("node"), F.col(parent).alias("parent"), F.col(label or name).alias("_shown"))
    wanted = F.lower(F.col("_shown").cast("string")).rlike("|".join(preferred))
    nodes = given.groupBy(*key, "node").agg(F.min("parent").alias("parent"), F.min_by("_shown", F.struct(~F.coalesce(wanted, F.lit(False)), "_shown")).alias("_shown"))
    nodes = _stored(nodes.join(depth(nodes, key, "node").select(*key, "node", "depth"), [*key, "node"]))
    last, held = -1, 0
    for level in nodes.filter(F.col("depth") < TOP).groupBy("depth").count().orderBy("depth").collect():
        held += level["count"]
        if held > TOP:
            break
        last = level["depth"]
    top = _stored(number_rows(nodes.filter(F.col("depth") <= last), [], [*key, "node"], "_at", start=0))
    nearest = climb(top, key, "node", "parent", wanted, F.lit(1.0)).select(*key, "node", "top")
    known = top.filter(wanted).select(*key, F.col("node").alias("top"), F.col("_shown").alias("_best"))
    answers = _stored(top.join(nearest, [*key, "node"]).join(known, [*key, "top"], "left").select(F.col("_at").alias("_met"), "_shown", "_best"))
    # the place at the top that a node is or lies below, -1 without one
    climbed = climb(nodes, key, "node", "parent", F.col("depth") <= last, F.lit(1.0)).select(*key, "node", "top", "steps")
    places = top.select(*key, F.col("node").alias("top"), "_at")
    nodes = _stored(nodes.join(climbed, [*key, "node"]).join(places, [*key, "top"], "left").select(
        *key, "node", "parent", "_shown", F.coalesce("_at", F.lit(-1)).alias("_at"), (F.col("_at").isNotNull() & (F.col("steps") == 0)).alias("_own"),
    ))
    table = nodes if label is None else nodes.drop("_shown").join(given.select(*key, "node", "_shown"), [*key, "node"])
    table = table.select(*key, "node", F.struct("_at", "_own", "_shown").alias("up"))
    some = pairs.select(*key, "left", "right")
    rows = some.repartition(math.ceil(some.count() / PAIRS) or 1, *key, "left", "right").distinct()  # hash tables of a bounded size
    rows = _look_up(rows, table, key, {"left": "_l", "right": "_r"}, "inner" if label else "left", counted=some)
    rows = rows.select(
        *key, *(F.col(c) for c in ("left", "right")), *(F.coalesce(f"{c}._at", F.lit(-1)).alias(f"{c}_at") for c in ("_l", "_r")),
        *(F.col(f"{c}._shown" if label else side).alias(f"{c}_shown") for c, side in (("_l", "left"), ("_r", "right"))),
        (F.coalesce("_l._own", F.lit(False)) | F.coalesce("_r._own", F.lit(False))).alias("_own"),
    )
    below = (F.col("_l_at") == F.col("_r_at")) & ~F.col("_own")
    rows = _stored(rows.select(
        *key, "_l_shown", "_r_shown", F.when(~below, _meeting_at_top(top, key)("_l_at", "_r_at")).alias("_met"),
        *(F.when(below, F.col(c)).alias(c) for c in ("left", "right")), F.when(below, F.col("_l_at")).alias("_at"),
    ))
    shown = [*key, F.col("_l_shown").alias("left"), F.col("_r_shown").alias("right")]
    done = rows.join(F.broadcast(answers), "_met").select(*shown, F.coalesce("_best", "_shown").alias("ancestor"))
    rest = rows.filter("_at IS NOT NULL")
    if rest.isEmpty():
        return done
    folds = rest.select(*at).distinct()
    inside = _stored(nodes.filter(~F.col("_own")).join(folds, at, "left_semi").select(*at, "node", "parent", "_shown").unionByName(
        top.join(folds, at, "left_semi").select(*at, "node", F.lit(None).cast(nodes.schema["parent"].dataType).alias("parent"), "_shown")
    ))
    known = inside.filter(wanted).select(*at, F.col("node").alias("top"), F.col("_shown").alias("_best"))
    nearest = inside.join(climb(inside, at, "node", "parent", wanted, F.lit(1.0)).select(*at, "node", "top"), [*at, "node"]).join(known, [*at, "top"], "left")
    nearest = nearest.join(F.broadcast(answers.select(F.col("_met").alias("_at"), F.col("_best").alias("_above"))), "_at", "left")
    nearest = nearest.select(*at, "node", F.coalesce("_best", "_above", "_shown").alias("up"))
    found = _look_up(_lifted(inside, rest.select(*at, "left", "right").distinct(), at), nearest, at, {"ancestor": "_best"}, "left")
    if label:
        found = found.join(rest.drop("_met"), [*at, "left", "right"])
        return done.unionByName(found.select(*shown, F.col("_best").alias("ancestor")))
    return done.unionByName(found.select(*key, "left", "right", F.coalesce("_best", "ancestor").alias("ancestor")))


def close_upward(nodes: DataFrame, key: Sequence[str], seed: Column, accepted: Column, name: str = "name", parent: str = "parent") -> DataFrame:
    """Seeds plus every ancestor reached through accepted parents only.

    Jump tables hold the links to accepted parents, 1, 2, 4, ... of them in a row; a number of
    steps is a sum of such jumps, so the reached nodes take each table once, the widest first,
    and a hierarchy of depth d needs about 2 log2(d) joins.
    """
    key = list(key)
    rows = pin(nodes.select(*key, F.col(name).alias("node"), F.col(parent).alias("up"), F.coalesce(seed, F.lit(False)).alias("seed"), F.coalesce(accepted, F.lit(False)).alias("ok")))
    gate = rows.filter("ok").select(*key, F.col("node").alias("up")).distinct()
    links = rows.select(*key, "node", "up").join(gate, [*key, "up"], "left_semi").distinct()
    reached = rows.filter("seed").select(*key, "node").distinct()
    for jump in reversed(jump_tables(links, key, "node", "up")):
        reached = pin(reached.unionByName(reached.join(jump, [*key, "node"]).select(*key, F.col("up").alias("node"))).distinct())
    return reached.withColumnRenamed("node", name)
