"""File listings and content fingerprints."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.sources.snapshots import folder_of, many_folders

WHOLE_FILE_BYTES = 256 * 1024 * 1024  # above this a file is hashed in blocks
BLOCK_BYTES = 8 * 1024 * 1024
FOLDER_FILES = 4096  # files in one folder, about, where this module lays them out
FACT_SCHEMA = "path string, exists boolean, bytes long, mtime_ns long, sha256 string"


def _scan(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def _in_few_tasks(files: DataFrame) -> DataFrame:
    """A scan gives a task some 30 files, however small; here no more tasks than a shuffle has."""
    spark = files.sparkSession
    return files.coalesce(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and time only; file bytes are pruned from the scan."""
    return _in_few_tasks(_listed(_scan(spark, path, pattern)))


def _listed(scan: DataFrame) -> DataFrame:
    return scan.select("path", F.col("length").alias("bytes"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))


def arrow_file(uri: str):
    """The Arrow file system of a URI or local path, and its name there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def hash_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of files too large for one row, read block by block inside the task."""
    for batch in batches:
        digests = []
        for uri in batch["path"]:
            system, name = arrow_file(uri)
            digest = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while block := stream.read(BLOCK_BYTES):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield batch.assign(exists=True, sha256=digests)[["path", "exists", "bytes", "mtime_ns", "sha256"]]


def file_facts(spark: SparkSession, path: str, pattern: str | None = None, whole_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Path, size, time and SHA-256 of every file; large files are hashed in blocks."""
    scan = _scan(spark, path, pattern)
    small = scan.filter(F.col("length") <= whole_bytes).select(
        "path", F.lit(True).alias("exists"), F.col("length").alias("bytes"),
        (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"), F.sha2("content", 256).alias("sha256"),
    )
    large = _in_few_tasks(_listed(scan).filter(F.col("bytes") > whole_bytes)).mapInPandas(hash_blocks, FACT_SCHEMA)
    return _in_few_tasks(small).unionByName(large)


def _text_files(root: str, key: str):
    """Writes the texts of each key to its file, which takes its name when it is whole; rows come in the order of folder and key."""
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        system, top = arrow_file(root)
        name = now = stream = None
        for batch in batches:
            for folder, own, text in zip(*(batch.column(c).to_pylist() for c in ("folder", "key", "value"))):
                if (folder, own) != now:
                    if stream:
                        stream.close()
                        system.move(part, name)
                    if not now or now[0] != folder:
                        system.create_dir(f"{top}/{folder}", recursive=True)
                    now, name = (folder, own), f"{top}/{folder}/{key}={quote(own, safe='')}.txt"
                    part = f"{name}.{uuid.uuid4().hex}"
                    stream = system.open_output_stream(part, buffer_size=1 << 16)
                stream.write((text or b"") + b"\n")
        if stream:
            stream.close()
            system.move(part, name)
        yield pa.RecordBatch.from_pydict({"done": pa.array([True])})

    return write


def write_text_files(rows: DataFrame, root: str, key: str, value: str) -> None:
    """A text file ``key=...`` for each value of ``key``, a line for each of its rows, some thousands to a folder.

    Tasks write the files themselves where Arrow knows the file system. A folder for each file, as
    ``partitionBy`` makes them, costs several processes a file on a local one; it is left for the others.
    """
    spark, width = rows.sparkSession, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    system, folder = folder_of(spark, root)
    target = str(system.makeQualified(folder).toString())
    try:
        arrow_file(target)
    except (OSError, ValueError):
        many_folders(rows.select(key, F.col(value).alias("value")).repartition(width, key).write).partitionBy(key).text(root)
        return
    system.mkdirs(folder)
    folders = max(1, math.ceil(rows.count() / FOLDER_FILES))
    dealt = rows.select(
        F.pmod(F.xxhash64(key), F.lit(folders)).alias("folder"),
        F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("key"), F.col(value).cast("binary").alias("value"),
    )
    dealt.repartition(max(width, folders), "folder", "key").sortWithinPartitions("folder", "key").mapInArrow(_text_files(target, key), "done boolean").agg(F.count("done")).first()


def stale_files(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files whose (path, size, time) is not among known facts: only these need hashing."""
    return listing.join(known.select("path", "bytes", "mtime_ns"), ["path", "bytes", "mtime_ns"], "left_anti")
