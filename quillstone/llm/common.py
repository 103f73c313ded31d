"""Shared plumbing of the training-data operators: tables in the folder that
the cluster shares, and zero-copy views of Arrow string columns."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A word is a run of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, below a
    temporary folder in local mode and below the warehouse otherwise."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        have = sc._jsc.sc().getCheckpointDir()
        root = have.get() if have.isDefined() else None
    if not root:
        if sc.master.startswith("local["):
            root = tempfile.mkdtemp(prefix="quillstone-")
        else:
            root = spark.conf.get("spark.sql.warehouse.dir")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/quillstone/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later joins the true
    size of the table."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Spark deletes shuffle files once the driver has collected the plan that
    wrote them, and nothing else may fill its heap for hours."""
    spark.sparkContext._jvm.System.gc()


def drop(*tables: DataFrame) -> None:
    """Deletes materialised tables that no later step reads."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if "/quillstone/" in folder:
                path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a bucketed table in the shared folder: joins on ``key`` move the
    other side only.  ``df`` comes from an aggregate by ``key``, whose shuffle
    has dealt the buckets already."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark)
    name = f"quillstone_{path.rpartition('/')[2]}"
    df.write.bucketBy(n, key).option("path", path).saveAsTable(name)
    del df
    collect_garbage(spark)
    return spark.table(name)


_releases: dict[str, Callable[[], None]] = {}


def alone(owner: str, release: Callable[[], None] | None = None) -> None:
    """What other operators keep in this Python worker goes, freed memory back to
    the system; ``release`` lets go of the caller's own tables.  Workers are used
    again by later stages, and idle ones count towards an executor's memory."""
    for name in [n for n in _releases if n != owner]:
        _releases.pop(name)()
    if release:
        _releases[owner] = release
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    col = col.cast(pa.large_binary())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def byte_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, of one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i]+lengths[i]-1 of all i, concatenated."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def sha256(data) -> str:
    return hashlib.sha256(data).hexdigest()


def others(df: DataFrame, *made: str) -> list[str]:
    """The columns that pass by: all but those that an operator reads or makes.
    A column of the name of a result is replaced by it."""
    return [c for c in df.columns if c not in made]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
