"""Frame recurrences that no window expresses: step clamp, contact anchors.

``chunked_scan`` runs a recurrence chunk by chunk. Chunks first start from a guess, then
every chunk whose true start state (the end of the chunk before) differs is run again.
Recurrences that forget their start settle after one repeat; where a clip has not settled
after a few, chunks are read in order as far as their start differs. All versions of the chunks lie in one table, of which the
newest count, so plan and number of rounds do not grow with the clip; the result is always
the sequential one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.functions.vectors import lerp, smooth01
from cliploom.operators import kernels as K
from cliploom.operators.series import clip_length
from cliploom.session import pin, scratch_path

Step = Callable[[pd.DataFrame, "np.ndarray | None"], "tuple[pd.DataFrame, np.ndarray]"]
_END, _START, _VERSION = "_end", "_start", "_version"
REPEATS = 3  # rounds of repeated chunks before chunks are read in order
REACH = 64  # chunks read in order behind each wrong one, before the rest of such a clip is
CALL_ROWS = 50_000  # rows of whole chunks handed to one pandas call


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def chunked_scan(
    df: DataFrame, clip: Sequence[str], frame: str, columns: Sequence[str], step: Step, outputs: str, size: int | None = None
) -> DataFrame:
    """Run ``step(rows, start)`` over the chunks of each clip in order.

    ``step`` gets one chunk sorted by frame and the state before it (None at the start of
    a clip or as the first guess); it returns the output columns and the end state.
    """
    clip, size = list(clip), size or K.CHUNK
    names = [part.split()[0] for part in outputs.split(", ")]
    rows = df.select(*clip, frame, *columns).withColumn(K.CHUNK_COL, K.chunk_of(frame, size))
    keys = [*clip, K.CHUNK_COL]
    kept = [*clip, frame, K.CHUNK_COL]
    schema = f"{_ddl(rows, kept)}, {outputs}, {_END} array<double>"

    def run(pdf: pd.DataFrame, start) -> pd.DataFrame:
        pdf = pdf.sort_values(frame, ignore_index=True)
        made, end = step(pdf, start)
        out = pd.concat([pdf[kept], made.reset_index(drop=True)], axis=1)
        out[_END] = [None] * (len(out) - 1) + [[float(v) for v in end]]
        return out[[*kept, *names, _END]]

    def repeat(_, pdf: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=[*kept, *names, _END])
        return run(pdf, np.array(starts[_START].iloc[0], dtype=float))

    def run_all(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([run(part, None) for _, part in pdf.groupby(keys, sort=False)], ignore_index=True)

    facts = df.agg(F.max(frame).alias("last"), F.count(F.lit(1)).alias("rows")).first()
    # Short clips share a call: chunks are dealt into groups of about CALL_ROWS rows.
    calls = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-facts["rows"] // CALL_ROWS))
    dealt = lambda r: r.groupBy(F.pmod(F.xxhash64(*keys), F.lit(calls)).alias("_call")).applyInPandas(run_all, schema)
    if facts["last"] is None or facts["last"] < size:
        return dealt(rows).drop(K.CHUNK_COL, _END)

    rows = pin(rows)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "scan")
    layer = f"{_ddl(rows, kept)}, {outputs}, {_END} array<double>, {_VERSION} int"

    def keep(made: DataFrame, version: int) -> DataFrame:
        """Add a version of some chunks to the table; each chunk's end state is in its last row."""
        made.withColumn(_VERSION, F.lit(version)).write.mode("append").parquet(path)
        return pin(spark.read.schema(layer).parquet(path).filter((F.col(_VERSION) == version) & F.col(_END).isNotNull()).select(*keys, _END))

    ends = keep(dealt(rows), 0)
    used = ends.select(*keys, F.lit(None).cast("array<double>").alias("_used"))
    for version in range(1, REPEATS + 3):
        now = ends.select(*clip, (F.col(K.CHUNK_COL) + 1).alias(K.CHUNK_COL), F.col(_END).alias(_START))
        changed = pin(used.join(now, keys).filter(~F.col("_used").eqNullSafe(F.col(_START))).select(*keys, _START))
        if changed.isEmpty():
            break
        if version > REPEATS:
            reach = REACH if version == REPEATS + 1 else None
            fresh = keep(_onward(rows, changed, used.join(ends, keys), reach, clip, frame, step, kept, names, schema), version)
            if reach is None:
                break
            ends = pin(ends.join(fresh, keys, "left_anti").unionByName(fresh))
            begun = ends.select(*clip, (F.col(K.CHUNK_COL) + 1).alias(K.CHUNK_COL), F.col(_END).alias("_used"))
            used = pin(used.join(fresh, keys, "left_anti").unionByName(fresh.select(*keys).join(begun, keys)))
            continue
        fresh = keep(
            rows.join(changed.select(*keys), keys, "left_semi").groupBy(*keys)
            .cogroup(changed.groupBy(*keys)).applyInPandas(repeat, schema), version
        )
        ends = pin(ends.join(changed, keys, "left_anti").unionByName(fresh))
        used = pin(used.join(changed, keys, "left_anti").unionByName(changed.select(*keys, F.col(_START).alias("_used"))))
    every = spark.read.schema(layer).parquet(path)
    newest = every.filter(F.col(_END).isNotNull()).groupBy(*keys).agg(F.max(_VERSION).alias(_VERSION))
    return every.join(newest, [*keys, _VERSION]).select(*clip, frame, *names)


def _onward(
    rows: DataFrame, changed: DataFrame, known: DataFrame, reach: int | None, clip: list[str], frame: str, step: Step, kept: list[str], names: list[str], schema: str
) -> DataFrame:
    """Chunks in order from each wrong one on, ``reach`` of them or all: those whose start differs from the one used.

    ``known`` has the used start and the end of every chunk; a chunk that began from the carried
    state stays as it is. Chunks in a row are read by one task; rows pass through in batches
    and only the state is held.
    """
    chunk, keys = K.CHUNK_COL, [*clip, K.CHUNK_COL]
    if reach is None:
        first = changed.groupBy(*clip).agg(F.min(chunk).alias("_from"))
        cover = known.select(*keys).join(first, clip).filter(F.col(chunk) >= F.col("_from")).drop("_from")
    else:
        cover = changed.select(*clip, F.explode(F.sequence(F.col(chunk), F.col(chunk) + (reach - 1))).alias(chunk)).distinct()
    ahead = Window.partitionBy(*clip).orderBy(chunk)  # one row for a chunk
    gap = F.coalesce(F.col(chunk) - F.lag(chunk).over(ahead) != 1, F.lit(True))
    cover = cover.withColumn("_gap", gap.cast("long")).withColumn("_walk", F.sum("_gap").over(ahead)).drop("_gap")
    bounds = rows.groupBy(*keys).agg(F.min(frame).alias("_lo"), F.max(frame).alias("_hi"))
    facts = cover.join(known.withColumnRenamed(_END, "_had"), keys).join(bounds, keys).join(changed, keys, "left")
    head = F.col(frame) == F.col("_lo")
    todo = rows.join(facts, keys).select(
        *rows.columns, "_walk", head.alias("_first"), (F.col(frame) == F.col("_hi")).alias("_last"), *[F.when(head, F.col(c)).alias(c) for c in (_START, "_used", "_had")]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, state, agrees = None, None, False
        for batch in batches:
            cuts = batch[keys].ne(batch[keys].shift()).any(axis=1).cumsum()
            for _, part in batch.groupby(cuts, sort=False):
                top = part.iloc[0]
                if top["_first"]:
                    if before != (*top[clip], top[chunk] - 1):
                        state = np.array(top[_START], dtype=float)
                    before = (*top[clip], top[chunk])
                    agrees = top["_used"] is not None and np.array_equal(state, np.array(top["_used"], dtype=float), equal_nan=True)
                    if agrees:
                        state = np.array(top["_had"], dtype=float)
                if agrees:
                    continue
                part = part.reset_index(drop=True)
                made, state = step(part, state)
                out = pd.concat([part[kept], made.reset_index(drop=True)], axis=1)
                out[_END] = [None] * (len(out) - 1) + [[float(v) for v in state] if part["_last"].iloc[-1] else None]
                yield out[[*kept, *names, _END]]

    return todo.repartition(*clip, "_walk").sortWithinPartitions(*clip, frame).mapInPandas(run, schema)


# ---- step clamp --------------------------------------------------------------------

def clamp_series(points: np.ndarray, limit: float, previous: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Limit each step against the already limited point before it."""
    out = points.copy()
    hit = np.zeros(len(points), dtype=bool)
    before = points[:-1] if previous is None else np.vstack([previous, points[:-1]])
    offset = 1 if previous is None else 0
    jumps = np.flatnonzero(np.linalg.norm(points[offset:] - before, axis=1) > limit) + offset
    i = 0
    for jump in jumps:
        if jump < i:
            continue
        i = jump
        while i < len(points):
            last = previous if i == 0 else out[i - 1]
            delta = points[i] - last
            length = float(np.linalg.norm(delta))
            if length <= limit:
                break
            out[i], hit[i] = last + delta / length * limit, True
            i += 1
    return out, hit


def clamp_steps(df: DataFrame, clip: Sequence[str], frame: str, vector: str, limit: str, size: int | None = None) -> DataFrame:
    """Clamped positions and a flag per repaired frame; ``limit`` is a column constant per clip."""
    def step(pdf: pd.DataFrame, start):
        points = np.array(pdf[vector].tolist(), dtype=float)
        out, hit = clamp_series(points, float(pdf[limit].iloc[0]), start)
        return pd.DataFrame({"clamped": out.tolist(), "repaired": hit}), out[-1]

    return chunked_scan(df, clip, frame, [vector, limit], step, "clamped array<double>, repaired boolean", size)


def clamp_report(clamped: DataFrame, clip: Sequence[str]) -> DataFrame:
    return clamped.groupBy(*clip).agg(F.count_if("repaired").alias("repairs"), F.count(F.lit(1)).alias("frames"))


# ---- contact runs ------------------------------------------------------------------

BLEND = 2  # frames blended on either side of a contact


def _gain(offset: Column) -> Column:
    return smooth01((F.lit(BLEND + 1) - offset) / F.lit(float(BLEND + 1)))


def contact_runs(df: DataFrame, clip: Sequence[str], frame: str, contact: str, vector: str, dims: int = 3, size: int | None = None) -> DataFrame:
    """Hold each maximal contact run at its mean position and blend two frames either side.

    Runs are taken in order: a run one frame after another sees its first position already
    pulled toward the earlier anchor, so an anchor is an affine map of the one before it, and
    anchors are a scan that composes these maps (``kernels.affine_scan``).
    """
    clip = list(clip)
    far = 1.0 / (BLEND + 1)
    reach = far * far * (3.0 - 2.0 * far)  # blend weight at two frames

    begun = K.in_chunks(
        df, clip, frame,
        lambda w: {"_begin": (F.col(contact) & ~F.coalesce(F.lag(contact).over(w), F.lit(False))).cast("double")},
    )
    # Frames are read several times below, so they are written once; so are the spans.
    rows = pin(K.series_running_sum(begun, clip, frame, "_begin", "_run", size).withColumn("_run", F.col("_run").cast("long")))
    runs = rows.filter(contact).groupBy(*clip, "_run").agg(
        F.min(frame).cast("long").alias("_from"), F.max(frame).cast("long").alias("_to"), F.count(F.lit(1)).alias("_n"),
        F.array(*[F.sum(F.col(vector)[i]) for i in range(dims)]).alias("_sum"), F.min_by(vector, frame).alias("_first"),
    )
    # The anchor is total / n, and total follows the anchor of a run that ended BLEND frames before.
    runs = K.in_chunks(
        runs.withColumn("_order", F.col("_run") - 1), clip, "_order",
        lambda w: {"_near": F.coalesce(F.col("_from") - F.lag("_to").over(w) == BLEND, F.lit(False))}, size=size,
    )
    pull = F.when(F.col("_near"), F.lit(reach)).otherwise(0.0)
    apart = F.transform("_sum", lambda total: total / F.col("_n"))
    pulled = F.zip_with("_sum", "_first", lambda total, first: (total - reach * first) / F.col("_n"))
    maps = runs.withColumns({"_pull": pull / F.col("_n"), "_rest": F.when(F.col("_near"), pulled).otherwise(apart)})
    longest = rows.agg(F.max("_run")).first()[0] or 0
    anchored = K.affine_scan(maps, clip, "_order", "_pull", "_rest", "_anchor", max(longest - 1, 0), size)
    spans = pin(anchored.select(*clip, "_run", "_from", "_to", "_anchor"))
    following = spans.select(*clip, (F.col("_run") - 1).alias("_run"), F.col("_from").alias("_next"), F.col("_anchor").alias("_next_anchor"))
    nothing = F.lit(None)
    lead_in = spans.filter("_run = 1 AND _from > 0").select(
        *clip, F.lit(0).cast("long").alias("_run"), F.lit(0).cast("long").alias("_from"),
        nothing.cast("long").alias("_to"), nothing.cast("array<double>").alias("_anchor"),
    )
    spans = spans.unionByName(lead_in).join(following, [*clip, "_run"], "left").join(
        clip_length(rows, clip, frame).select(*clip, "last"), clip
    )
    upto = F.coalesce(F.col("_next") - 1, F.col("last"))
    spans = spans.withColumn(K.CHUNK_COL, F.explode(F.sequence(K.chunk_of("_from", size), K.chunk_of(upto, size)))).drop("_from", "last")
    met = rows.withColumn(K.CHUNK_COL, K.chunk_of(frame, size)).join(spans, [*clip, K.CHUNK_COL, "_run"], "left")
    since, until = F.col(frame) - F.col("_to"), F.col("_next") - F.col(frame)
    held = F.when(F.col(contact), F.col("_anchor")).otherwise(F.col(vector))
    after = F.when(~F.col(contact) & since.between(1, BLEND), lerp(F.col("_held"), F.col("_anchor"), _gain(since))).otherwise(F.col("_held"))
    before = F.when(until.between(1, BLEND), lerp(F.col("_after"), F.col("_next_anchor"), _gain(until))).otherwise(F.col("_after"))
    return (
        met.withColumn("_held", held).withColumn("_after", after).withColumn("stabilized", before)
        .select(*df.columns, "stabilized")
    )
