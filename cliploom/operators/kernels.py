"""Shared kernels that stay exact when one key holds a large part of all rows.

Plain ``Window.partitionBy(key)`` puts a whole key into one task. The helpers here
split that work:

* ``running_total`` / ``number_rows`` order rows by range slices when a key is large;
* ``order_stats`` picks exact ranks from value counts, in large groups by radix selection;
* ``spread`` / ``in_chunks`` cut frame series into fixed-length chunks with a halo,
  so lags, leads and short filters see their neighbours and no task sees a whole clip;
* ``series_running_sum`` adds chunk totals to in-chunk running sums;
* ``affine_scan`` follows x -> a * x + b over the rows of a key by composing the maps;
* ``attach_per_clip`` joins one row per clip to its frames on (clip, chunk).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from cliploom.session import pin

GROUP_ROWS = 1_000_000  # most rows one window task may hold
CHUNK = 4096            # frames per chunk of a series
CELLS = 1024            # steps a range of values is counted in
CHUNK_COL = "_chunk"
OWN_COL = "_own"


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest key (of the whole table without keys)."""
    if not keys:
        return df.count()
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("m")).first()
    return int(top["m"] or 0)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    amount: str | Column,
    out: str,
    group_rows: int | None = None,
) -> DataFrame:
    """Inclusive running sum of ``amount`` per key; ``order`` must be a total order.

    The largest key is counted first. Up to ``group_rows`` rows an ordinary window is
    used. Beyond that the table is range-partitioned on (keys, order), each slice keeps
    its own running sum, and the totals of earlier slices are added. A slice continues
    at most one key from the slice before it, so the table of carried totals has fewer
    rows than there are slices and is safe to broadcast.
    """
    group_rows = group_rows or GROUP_ROWS
    amount = F.col(amount) if isinstance(amount, str) else amount
    keys = list(keys)
    upto = (Window.unboundedPreceding, Window.currentRow)
    if largest_group(df, keys) <= group_rows:
        by = keys or [F.lit(0)]
        return df.withColumn(out, F.sum(amount).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*upto)))

    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pin(
        df.withColumn("_amount", amount)
        .repartitionByRange(slices, *[F.col(k) for k in keys], *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    totals = placed.groupBy(*keys, "_slice").agg(F.sum("_amount").alias("_total"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.withColumn("_carried", F.sum("_total").over(earlier))
        .filter(F.col("_carried").isNotNull())
        .drop("_total")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(*upto)
    zero = F.lit(0)
    return (
        placed.join(F.broadcast(carried), [*keys, "_slice"], "left")
        .withColumn(out, F.sum("_amount").over(inside) + F.coalesce(F.col("_carried"), zero))
        .drop("_amount", "_slice", "_carried")
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str,
    start: int = 1,
    group_rows: int | None = None,
) -> DataFrame:
    """Dense row numbers per key in a total order, starting at ``start``."""
    numbered = running_total(df, keys, order, F.lit(1).cast("long"), out, group_rows)
    return numbered.withColumn(out, F.col(out) + F.lit(start - 1))


def order_stats(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    picks: Mapping[str, Callable[[Column], Column]],
    group_rows: int | None = None,
) -> DataFrame:
    """Exact order statistics under caller-chosen index rules.

    ``picks`` maps an output name to a rule taking the row count n and giving a 0-based
    rank in ascending order. Repeated values are counted before anything is ordered, so
    a value that fills a group is one row. The element at rank i is the smallest value
    whose cumulative count exceeds i. Groups of at most ``group_rows`` values are ordered;
    beyond that the value is narrowed down by counts (``_narrowed_stats``).
    """
    by = list(by)
    group_rows = group_rows or GROUP_ROWS
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    whole = largest_group(counts, by)
    if whole > group_rows and isinstance(df.schema[value].dataType, NumericType):
        return _narrowed_stats(pin(counts), by, value, picks, group_rows)
    running = running_total(counts, by, [F.col(value)], "_n", "_upto", group_rows)
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_rows"))
    # Totals repeat once per ``group_rows`` rows and join on (group, part), so a large
    # group is neither gathered by the join nor by the aggregation after it.
    running = running.withColumn("_part", F.floor(F.col("_upto") / group_rows))
    totals = totals.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_rows") / group_rows))))
    joined = running.join(totals, [*by, "_part"])
    return joined.groupBy(*by).agg(
        F.max("_rows").alias("n"),
        *[
            F.min(F.when(F.col("_upto") > rule(F.col("_rows")), F.col(value))).alias(name)
            for name, rule in picks.items()
        ],
    )


def _cell(x: Column, low: Column, high: Column, cells: int) -> Column:
    """Which of ``cells`` steps between two values a value lies in; it never falls as the value rises, and NaN is the largest."""
    half = F.lit(0.5)  # differences of halves stay finite
    place = F.floor((x * half - low * half) / (high * half - low * half) * cells)
    inside = F.when(low >= high, 0).otherwise(F.least(F.greatest(place, F.lit(0)), F.lit(cells - 1)))
    return F.when(F.isnan(x), cells + 1).when(x > high, cells).when(x < low, -1).otherwise(inside).cast("long")


def _narrowed_stats(counts: DataFrame, by: list[str], value: str, picks: Mapping[str, Callable[[Column], Column]], group_rows: int, cells: int = CELLS) -> DataFrame:
    """Ranks by radix selection: counts by cell, then by cell of the cells that hold a wanted rank; only what is left there is sorted.

    A pass is one aggregation that combines before its shuffle; a group has ``cells`` rows
    behind it, however many values it holds. The bounds of a cell are values of it, so two
    passes leave a share of about 1 / cells^2 of an even spread, and a cell of one value is done.
    """
    x = F.col(value).cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    groups = counts.groupBy(*by).agg(F.sum("_n").alias("n"), F.min(finite).alias("_low"), F.max(finite).alias("_high"))
    wanted = F.array(*[F.struct(F.lit(name).alias("pick"), rule(F.col("n")).cast("long").alias("rest")) for name, rule in picks.items()])
    bounds = lambda low, high: (F.coalesce(F.col(low), F.lit(0.0)), F.coalesce(F.col(high), F.lit(0.0)))
    meet = lambda left, right, keys: left.join(right, keys) if keys else left.crossJoin(F.broadcast(right))

    def narrowed(rows: DataFrame, keys: list[str], goals: DataFrame, cell: str) -> DataFrame:
        """For each goal the cell that holds its rank, the rank inside the cell and the cell's least and largest value."""
        tally = rows.groupBy(*keys, cell).agg(F.sum("_n").alias("_m"), F.min(value).alias("_least"), F.max(value).alias("_most"))
        order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        tally = tally.withColumn("_before", F.sum("_m").over(order) - F.col("_m"))
        hit = (F.col("rest") >= F.col("_before")) & (F.col("rest") < F.col("_before") + F.col("_m"))
        return meet(tally, goals, keys).filter(hit).withColumn("rest", F.col("rest") - F.col("_before")).drop("_m", "_before")

    placed = meet(counts, groups, by).select(*by, value, "_n", _cell(x, *bounds("_low", "_high"), cells).alias("_c1"))
    goals = groups.select(*by, "n", F.explode(wanted).alias("_g")).select(*by, "n", "_g.*")
    first = pin(narrowed(placed, by, goals, "_c1"))
    settled = lambda df: df.filter(F.col("_least").eqNullSafe(F.col("_most"))).select(*by, "n", "pick", F.col("_least").alias("_value"))
    open_ = lambda df: df.filter(~F.col("_least").eqNullSafe(F.col("_most")))
    left = open_(first).select(*by, "_c1", "_least", "_most").distinct()
    inside = placed.join(F.broadcast(left) if not by else left, [*by, "_c1"]).select(
        *by, "_c1", value, "_n", _cell(x, F.col("_least").cast("double"), F.col("_most").cast("double"), cells).alias("_c2")
    )
    second = pin(narrowed(inside, [*by, "_c1"], open_(first).drop("_least", "_most"), "_c2"))
    rest = open_(second).select(*by, "n", "pick", "_c1", "_c2", "rest")
    few = inside.join(rest.select(*by, "_c1", "_c2").distinct(), [*by, "_c1", "_c2"])
    keys = [*by, "_c1", "_c2"]
    upto = running_total(few, keys, [F.col(value)], "_n", "_upto", group_rows)
    last = upto.join(rest, keys).filter(F.col("_upto") > F.col("rest")).groupBy(*by, "n", "pick").agg(F.min(value).alias("_value"))
    found = settled(first).unionByName(settled(second)).unionByName(last)
    return found.groupBy(*by).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("pick") == name, F.col("_value"))).alias(name) for name in picks])


# Index rules used by the operators (0-based rank from a row count n).
def middle(n: Column) -> Column:
    return F.floor(n / 2)


def upper_quartile(n: Column) -> Column:
    return F.floor(3 * n / 4)


def lower_quartile(n: Column) -> Column:
    return F.floor(n / 4)


def p95_rank(n: Column) -> Column:
    return F.least(n - 1, F.floor(n * F.lit(0.95)))


def fraction_rank(q: float) -> Callable[[Column], Column]:
    return lambda n: F.least(n - 1, F.floor(F.lit(q) * (n - 1)))


def chunk_of(frame: str | Column, size: int | None = None) -> Column:
    frame = F.col(frame) if isinstance(frame, str) else frame
    return F.floor(frame / F.lit(size or CHUNK)).cast("long")


def spread(df: DataFrame, frame: str, before: int, after: int, size: int | None = None) -> DataFrame:
    """Copy rows near a chunk edge into the neighbouring chunk as halo.

    Frames must be dense integers from 0. Rows carry ``_own`` = false in chunks they
    only serve as halo; filter on it after the windows ran.
    """
    size = size or CHUNK
    if max(before, after) > size:
        raise ValueError("halo longer than a chunk")
    own = chunk_of(frame, size)
    offset = F.col(frame) - own * size
    homes = F.array_compact(
        F.array(
            own,
            F.when(offset >= size - before, own + 1) if before else F.lit(None).cast("long"),
            F.when((offset < after) & (own > 0), own - 1) if after else F.lit(None).cast("long"),
        )
    )
    return df.withColumn(CHUNK_COL, F.explode(homes)).withColumn(OWN_COL, F.col(CHUNK_COL) == own)


def chunk_window(clip: Sequence[str], frame: str) -> Window:
    return Window.partitionBy(*clip, CHUNK_COL).orderBy(frame)


def owned(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OWN_COL)).drop(OWN_COL, CHUNK_COL)


def in_chunks(
    df: DataFrame,
    clip: Sequence[str],
    frame: str,
    columns: Callable[[Window], Mapping[str, Column]],
    before: int = 1,
    after: int = 0,
    size: int | None = None,
) -> DataFrame:
    """Add window columns computed inside haloed chunks."""
    spreaded = spread(df, frame, before, after, size)
    return owned(spreaded.withColumns(dict(columns(chunk_window(clip, frame)))))


def series_running_sum(
    df: DataFrame, clip: Sequence[str], frame: str, value: str | Column, out: str, size: int | None = None
) -> DataFrame:
    """Inclusive running sum over frames of a clip.

    Chunk totals (one row per chunk) are summed per clip, then added to the running sum
    inside each chunk.
    """
    clip = list(clip)
    value = F.col(value) if isinstance(value, str) else value
    rows = df.withColumn("_v", value).withColumn(CHUNK_COL, chunk_of(frame, size))
    totals = rows.groupBy(*clip, CHUNK_COL).agg(F.sum("_v").alias("_total"))
    earlier = Window.partitionBy(*clip).orderBy(CHUNK_COL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*clip, CHUNK_COL, F.coalesce(F.sum("_total").over(earlier), F.lit(0.0)).alias("_before"))
    inside = chunk_window(clip, frame).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.join(offsets, [*clip, CHUNK_COL])
        .withColumn(out, F.sum("_v").over(inside) + F.col("_before"))
        .drop("_v", "_before", CHUNK_COL)
    )


def _after(a: Column, b: Column, earlier_a: Column, earlier_b: Column) -> tuple[Column, Column]:
    """The map ``earlier`` and then ``a, b``; a row without an earlier map stays as it is, and so does one that forgets it."""
    apart = earlier_a.isNull() | (a == 0)
    both = F.zip_with(b, earlier_b, lambda x, y: x + a * y)
    return F.when(apart, a).otherwise(a * earlier_a), F.when(apart, b).otherwise(both)


def affine_scan(df: DataFrame, keys: Sequence[str], order: str, a: str, b: str, out: str, last: int, size: int | None = None) -> DataFrame:
    """The state after each row of the recurrence state = ``a`` * state + ``b``, with ``b`` an array, from a state of zeros.

    ``order`` counts the rows of a key from 0 without a gap, ``last`` is the largest of all
    keys. Maps compose, so every chunk of ``size`` rows is scanned alone: pass k composes each
    row with what the row 2^k before it covers, all passes over one sorted shuffle. The last
    map of each chunk is the chunk's own; these are scanned the same way, level by level, and
    the state before a chunk is joined to its rows. ``a`` = 0 begins anew, whatever was before.
    """
    size, keys = size or CHUNK, list(keys)
    inside = Window.partitionBy(*keys, CHUNK_COL).orderBy(order)
    rows = df.withColumn(CHUNK_COL, chunk_of(order, size)).withColumns({"_scale": F.col(a).cast("double"), "_shift": F.col(b)})
    scale, shift, reach = F.col("_scale"), F.col("_shift"), 1
    while reach <= min(last, size - 1):
        rows = rows.withColumns({"_scale_before": F.lag(scale, reach).over(inside), "_shift_before": F.lag(shift, reach).over(inside)})
        both = _after(scale, shift, F.col("_scale_before"), F.col("_shift_before"))
        # under other names first: in a select a name would mean the new column
        rows = rows.select(*df.columns, CHUNK_COL, both[0].alias("_scale_now"), both[1].alias("_shift_now"))
        rows = rows.withColumnsRenamed({"_scale_now": "_scale", "_shift_now": "_shift"})
        reach *= 2
    if last < size:
        return rows.withColumnRenamed("_shift", out).drop(CHUNK_COL, "_scale")
    rows = pin(rows)
    final = (F.col(order) % size == size - 1) & (F.col(CHUNK_COL) < last // size)
    ends = rows.filter(final).select(*keys, F.col(CHUNK_COL).alias("_at"), scale.alias("_end_scale"), shift.alias("_end_shift"))
    before = affine_scan(ends, keys, "_at", "_end_scale", "_end_shift", "_end_state", last // size - 1, size)
    before = before.select(*keys, (F.col("_at") + 1).alias(CHUNK_COL), F.lit(1.0).alias("_one"), F.col("_end_state").alias("_carried"))
    state = _after(scale, shift, F.col("_one"), F.col("_carried"))[1]
    return rows.join(before, [*keys, CHUNK_COL], "left").withColumn(out, state).drop(CHUNK_COL, "_scale", "_shift", "_one", "_carried")


def attach_per_clip(
    df: DataFrame, per_clip: DataFrame, clip: Sequence[str], frame: str, last: str, size: int | None = None
) -> DataFrame:
    """Join one row per clip to all frames of the clip without gathering the clip.

    ``per_clip`` holds ``last``, the clip's last frame; it is repeated once per chunk and
    the join key becomes (clip, chunk), which bounds the rows behind one key.
    """
    small = per_clip.withColumn(
        CHUNK_COL, F.explode(F.sequence(F.lit(0).cast("long"), chunk_of(last, size)))
    )
    return df.withColumn(CHUNK_COL, chunk_of(frame, size)).join(small, [*clip, CHUNK_COL]).drop(CHUNK_COL)
