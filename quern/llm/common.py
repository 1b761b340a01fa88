"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import json
import uuid

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import REQUIRED_CONF, ensure_checkpoint_dir, scratch_path, ship_package

# Rows of one Arrow batch: whole texts travel in them, so a batch of long texts stays small.
ARROW_ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """Session settings, shared folder and package that the operators rely on."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` after it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_side(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` (``rows`` rows of fixed width) if they are few; else Spark shuffles."""
    return F.broadcast(df) if rows <= max_rows else df


def crc32_of_id(col: str) -> F.Column:
    """crc32 of an id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


# --- ranges that depend on the rows alone --------------------------------------------------
SHARD_BYTES = 32 << 20           # bytes of one range
MAX_SHARDS = 100_000             # ranges at most: beyond 3 TB they grow instead (1 GB each at 100 TB; tasks stream them)
SAMPLES = 16                     # sampled rows for each range, which the driver holds


class Ranges:
    """Ranges of (key, tie), both longs, in their order: rows of a range lie between two bounds, nulls have one of their own.

    Bounds are weighted quantiles of a sample by hash, so equal rows get equal ranges whatever the
    session's settings, the files they come from and the order in them.
    """

    def __init__(self, bounds: list[tuple[int, int]], nulls_first: bool):
        self.keys, self.ties = (np.array(c, np.int64) for c in (zip(*bounds) if bounds else ((), ())))
        self.nulls_first, self.count = nulls_first, len(bounds) + 2

    def place(self, keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Number of bounds below each (key, tie)."""
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        out = low.copy()
        for a in np.unique(low[high > low]).tolist():       # keys that are bounds themselves
            these = (low == a) & (high > low)
            b = int(high[these][0])
            out[these] += np.searchsorted(self.ties[a:b], ties[these], "left")
        return out

    def number(self, key: str, tie: str) -> Column:
        """The range of a row, from 0."""
        place = F.pandas_udf(lambda k, t: pd.Series(self.place(k.to_numpy(np.int64), t.to_numpy(np.int64)).astype(np.int32)), "int")
        null = F.lit(0 if self.nulls_first else self.count - 1)
        return F.when(F.col(key).isNull(), null).otherwise(
            place(F.coalesce(key, F.lit(0)), F.col(tie)) + F.lit(int(self.nulls_first))).cast("int")


def ranges(rows: DataFrame, nulls_first: bool, shard_bytes: int = SHARD_BYTES) -> Ranges:
    """Ranges of about ``shard_bytes`` (more beyond ``MAX_SHARDS``) of a written table ``(key long, tie long, bytes long)``."""
    n, total = rows.agg(F.count("*"), F.sum("bytes")).first()
    shards = min(MAX_SHARDS, max(1, -(-(total or 0) // shard_bytes)))
    if shards == 1:
        return Ranges([], nulls_first)
    share = min(1.0, SAMPLES * shards / n)
    mark = F.xxhash64(F.col("key"), F.col("tie"), F.lit("sample"))
    sample = rows.where(F.col("key").isNotNull() & (mark < int((2 * share - 1) * ((1 << 63) - 1)))).groupBy("key", "tie") \
        .agg(F.sum("bytes").alias("bytes")).toArrow().to_pandas().sort_values(["key", "tie"])
    ends = sample["bytes"].cumsum().to_numpy()
    at = np.unique(np.searchsorted(ends, ends[-1] * np.arange(1, shards) / shards)) if len(ends) else []
    return Ranges([(int(sample["key"].iloc[i]), int(sample["tie"].iloc[i])) for i in at], nulls_first)


# --- files written by tasks ---------------------------------------------------------------
def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:`` ...; no scheme: local)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri                  # ``qualified`` has put a scheme before shared folders
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark would write it to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


class TempFile:
    """One output file under a name no other attempt of the task uses."""

    def __init__(self, folder: str):
        self.fs, root = open_fs(folder)
        self.name = f"{uuid.uuid4().hex}.part"
        tmp = f"{root.rstrip('/')}/_temporary"
        self.fs.create_dir(tmp, recursive=True)
        self.out = self.fs.open_output_stream(f"{tmp}/{self.name}")
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()


def commit(folder: str, files: list[dict], suffix: str) -> list[dict]:
    """Rename the listed temporary files into place and write the manifest last.

    ``files`` are the rows that the successful task attempts returned, in output
    order. Names follow that order, so a rerun over equal rows gives equal names.
    Files of failed or repeated attempts are listed nowhere and go with the
    temporary folder. A reader that finds no manifest takes the folder as unfinished.
    """
    fs, root = open_fs(folder)
    root = root.rstrip("/")
    fs.create_dir(root, recursive=True)
    done = []
    for i, f in enumerate(files):
        name = f"part-{i:06d}{suffix}"
        fs.move(f"{root}/_temporary/{f['temp']}", f"{root}/{name}")
        done.append({k: v for k, v in f.items() if k != "temp"} | {"file": name})
    with contextlib.suppress(FileNotFoundError):
        fs.delete_dir(f"{root}/_temporary")
    with fs.open_output_stream(f"{root}/_manifest.tmp") as out:
        out.write(json.dumps({"files": done}).encode())
    fs.move(f"{root}/_manifest.tmp", f"{root}/MANIFEST.json")
    return done


def read_manifest(folder: str) -> list[dict]:
    fs, root = open_fs(folder)
    with fs.open_input_stream(f"{root.rstrip('/')}/MANIFEST.json") as f:
        return json.loads(f.read())["files"]


def file_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """One row and one task per file of a manifest."""
    df = spark.createDataFrame(pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]), schema) \
        if rows else spark.createDataFrame([], schema)
    return df.repartition(max(1, len(rows)))
