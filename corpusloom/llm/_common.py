"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the contracts, `[\x20\x09-\x0D]`; bytes.split() and bytes.lower() use just these and A-Z.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, `spark.checkpoint.dir`. Where the session names none: in local
    mode, as in tests, a temporary one; on a cluster an error, as a folder of one machine would lose data."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage ends in files that outlive executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again._cut_path = path  # for `discard`
    return again


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that `cut` wrote and that no later plan reads."""
    for df in tables:
        jvm, path = df.sparkSession._jvm, getattr(df, "_cut_path", None)
        if path:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def clean_text(c: Column | str) -> Column:
    """A text as Python can read it: each invalid byte sequence becomes U+FFFD. Null stays null."""
    return F.make_valid_utf8((F.col(c) if isinstance(c, str) else c).cast("string"))


_owner: list[str] = [""]
_caches: dict[str, list[Callable[[], None]]] = {}


def remembers(owner: str, clear: Callable[[], None]) -> None:
    """A module that remembers things from task to task in a Python worker says how to forget them."""
    _caches.setdefault(owner, []).append(clear)


def give_back() -> None:
    """What this worker has freed goes back to the system: Arrow's pool and the C library's heap keep it otherwise, also while
    the worker is idle and its executor's JVM needs the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def claim(owner: str) -> None:
    """Called where a task starts: what other operators left in this worker's memory goes, back to the system too."""
    if _owner[0] != owner:
        for name, clears in _caches.items():
            if name != owner:
                for clear in clears:
                    clear()
        _owner[0] = owner
        give_back()


def bucket_of(key: Column, count: int) -> Column:
    """Buckets 0..count-1 in the order of the hash, so that order by (bucket, hash) is order by hash."""
    return F.least(F.floor((key.cast("double") / 2.0**64 + 0.5) * count).cast("int"), F.lit(count - 1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
