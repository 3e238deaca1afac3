"""Shared helpers: table access, staged tables in the shared folder, byte words."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Broadcasts are used below this many rows of a few bytes each; beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000

#: Space and the controls 9 to 13, which separate words everywhere in this subpackage.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_SEPARATOR = r"[\x20\x09-\x0D]+"

_staged: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local master may lack the setting; it then gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="sondera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/sondera/{tag}-{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(_drop_all)
    _staged.append(path)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop(df: DataFrame | None) -> None:
    """Delete a staged table that nothing reads any more."""
    path = getattr(df, "staged_at", None)
    if path:
        _delete(path)


def _delete(path: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _staged.remove(path)
    except Exception:  # the session may have ended; the folder is scratch space
        return


def _drop_all() -> None:
    for path in list(_staged):
        _delete(path)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a staged table for broadcast if it has at most ``most`` rows; else leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def byte_words(text: str | None) -> list[bytes]:
    """Words of the lower-cased (A-Z only) text. ``bytes.split`` cuts at exactly the characters of WORD_SEPARATOR."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hand_back() -> None:
    """Return free memory to the system, at the end of a task: idle Python workers live on beside their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
