"""Manifest contracts, referential audits, verification and drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESERVE_BYTES = 5 * 1024**3  # fixed value: free space kept beside unpacked archives


def missing_refs(refs: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """References that the inventory lacks."""
    return refs.join(inventory.select(key), key, "left_anti")


def verify_files(manifest: DataFrame, facts: DataFrame, size: bool = True) -> DataFrame:
    """Verdict per manifest row: missing, size, hash or ok."""
    found = facts.select(
        "path", F.col("exists").alias("_exists"), F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha256")
    )
    verdict = F.when(~F.coalesce(F.col("_exists"), F.lit(False)), "missing")
    if size:
        verdict = verdict.when(~F.col("bytes").eqNullSafe(F.col("_bytes")), "size")
    verdict = verdict.when(~F.col("sha256").eqNullSafe(F.col("_sha256")), "hash")
    return manifest.join(found, "path", "left").withColumn("verdict", verdict.otherwise("ok")).drop(
        "_exists", "_bytes", "_sha256"
    )


def validate_release(facts: DataFrame, pins: Mapping[str, str]) -> DataFrame:
    """Verdict per pinned manifest: missing, hash or ok. Pins are a settings document."""
    rows = [(path, digest) for path, digest in pins.items()]
    pinned = facts.sparkSession.createDataFrame(rows, "path string, sha256 string")
    wanted = facts.filter(F.col("path").isin(*pins)).select("path", "exists", "bytes", "sha256")
    return verify_files(pinned, wanted, size=False)


def subset_closure(files: DataFrame, needed: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files to unpack for a subset.

    The needed paths plus every file in the archives that hold the anchor paths.
    Returns (selected files, archives to read, needed paths absent from the manifest).
    """
    wanted = needed.select("path").distinct()
    listed = files.join(wanted, "path", "left_semi")
    anchor_archives = files.join(anchors.select("path").distinct(), "path", "left_semi").select("archive").distinct()
    selected = listed.unionByName(files.join(anchor_archives, "archive", "left_semi").select(*files.columns)).distinct()
    return selected, selected.select("archive").distinct(), missing_refs(wanted, files, "path")


def capacity(archives: DataFrame, free_bytes: int, reserve: int = RESERVE_BYTES) -> DataFrame:
    """One row: bytes needed with the reserve, and whether they fit."""
    need = (F.coalesce(F.sum("uncompressed_bytes"), F.lit(0)) + F.lit(reserve)).alias("needed_bytes")
    return archives.agg(need).select(
        "needed_bytes", F.lit(free_bytes).alias("free_bytes"), (F.col("needed_bytes") <= F.lit(free_bytes)).alias("fits")
    )


def hash_drift(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("record", "path")) -> DataFrame:
    """Rows of two (record, path, sha256) tables that were added, removed or changed.

    Both sides are stacked and aggregated once; no outer join.
    """
    keys = list(keys)
    stacked = old.select(*keys, F.col("sha256").alias("old"), F.lit(None).cast("string").alias("new")).unionByName(
        new.select(*keys, F.lit(None).cast("string").alias("old"), F.col("sha256").alias("new"))
    )
    both = stacked.groupBy(*keys).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).withColumn("change", change)


def hash_map_rows(records: DataFrame, key: str, column: str) -> DataFrame:
    """A map column of hashes as (record, path, sha256) rows."""
    return records.select(F.col(key).alias("record"), F.explode(column).alias("path", "sha256"))


def assert_contract(
    df: DataFrame, key: str, rows: int | None = None, allowed: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One row: row count, distinct keys, values outside the allowed sets, and the verdict."""
    allowed = allowed or {}
    outside = [F.count_if(~F.coalesce(F.col(c).isin(*values), F.lit(False))).alias(f"bad_{c}") for c, values in allowed.items()]
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("keys"), *outside)
    holds = F.col("n") == F.col("keys")
    if rows is not None:
        holds = holds & (F.col("n") == rows)
    for column in allowed:
        holds = holds & (F.col(f"bad_{column}") == 0)
    return counted.withColumn("holds", holds)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def catalog_contract(df: DataFrame, keys: Sequence[str], minimum: int) -> DataFrame:
    """One row: every key unique on its own and enough rows."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.countDistinct(k).alias(f"distinct_{k}") for k in keys])
    holds = F.col("n") >= minimum
    for key in keys:
        holds = holds & (F.col(f"distinct_{key}") == F.col("n"))
    return counted.withColumn("holds", holds)


def resolve_basenames(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Repair broken references (asset, requested) by file name inside the asset's folder.

    An existing path stays. Otherwise the exact name is looked up, then the case-folded
    name; one hit repairs, several are ambiguous, none is unresolved. Files are counted
    per name before the joins, so each join meets one row per name.
    """
    name = lambda c: F.element_at(F.split(F.regexp_replace(c, r"\\", "/"), "/"), -1)
    named = files.select("asset", "path", name("path").alias("_name"))
    one = [F.count(F.lit(1)).alias("n"), F.min("path").alias("p")]
    exact = named.groupBy("asset", "_name").agg(*one).select("asset", "_name", F.col("n").alias("_n1"), F.col("p").alias("_p1"))
    folded = (
        named.groupBy("asset", F.lower("_name").alias("_folded")).agg(*one)
        .select("asset", "_folded", F.col("n").alias("_n2"), F.col("p").alias("_p2"))
    )
    present = files.select("asset", F.col("path").alias("requested")).distinct().withColumn("_present", F.lit(True))
    joined = (
        refs.withColumn("_name", name("requested")).withColumn("_folded", F.lower("_name"))
        .join(present, ["asset", "requested"], "left")
        .join(exact, ["asset", "_name"], "left")
        .join(folded, ["asset", "_folded"], "left")
    )
    hits = F.coalesce(F.col("_n1"), F.col("_n2"), F.lit(0))
    verdict = (
        F.when(F.col("_present").isNotNull(), "present")
        .when(hits == 0, "unresolved").when(hits > 1, "ambiguous").otherwise("repaired")
    )
    out = joined.withColumn("verdict", verdict)
    path = F.when(F.col("verdict") == "present", F.col("requested")).when(
        F.col("verdict") == "repaired", F.coalesce("_p1", "_p2")
    )
    return out.withColumn("path", path).select(*refs.columns, "verdict", "path")


def sequence_audit(files: DataFrame, plan: DataFrame, clip: str = "clip", frame: str = "frame") -> DataFrame:
    """Per planned clip: files, distinct frames, lowest and highest, and whether they are exactly 1..n."""
    seen = files.groupBy(clip).agg(
        F.count(F.lit(1)).alias("files"), F.countDistinct(frame).alias("frames"),
        F.min(frame).alias("first"), F.max(frame).alias("last"),
    )
    joined = plan.join(seen, clip, "left").fillna(0, ["files", "frames"])
    complete = (
        (F.col("files") == F.col("frame_count")) & (F.col("frames") == F.col("frame_count"))
        & (F.col("first") == 1) & (F.col("last") == F.col("frame_count"))
    )
    return joined.withColumn("complete", F.coalesce(complete, F.lit(False)))


def missing_frames(files: DataFrame, plan: DataFrame, clip: str = "clip", frame: str = "frame") -> DataFrame:
    """Planned frames without a file."""
    wanted = plan.filter("frame_count > 0").select(clip, F.explode(F.sequence(F.lit(1).cast("long"), F.col("frame_count").cast("long"))).alias(frame))
    return wanted.join(files.select(clip, F.col(frame).cast("long").alias(frame)), [clip, frame], "left_anti")
