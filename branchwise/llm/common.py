"""What the operators share: tables, the shared folder, small column helpers."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The six ASCII white-space characters that end a word.
SPACES = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under spark.checkpoint.dir; a temporary one only in local mode (tests): executors could not share it."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="branchwise-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Shuffle files go when the write that made them is over, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """df, computed once, as a table in the shared folder: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession, purpose)}/table"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._bw_path = path
    if _SCOPES:
        _SCOPES[-1].append(out)
    return out


_SCOPES: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are deleted at the end, on failure too, but those that the given function was told to keep."""
    held, kept = [], []
    _SCOPES.append(held)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table._bw_path)
        return table

    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _SCOPES.remove(held)
        spent(*[t for t in held if t._bw_path not in kept])


def frugal(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """step for mapInPandas; at its end the Python worker, which Spark keeps for later tasks, gives free memory back to the system."""

    def run(frames: Iterator) -> Iterator:
        yield from step(frames)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def spent(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more, with their folders."""
    for t in tables:
        delete(t.sparkSession, t._bw_path.removesuffix("/table"))


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: others, whatever they are called, cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def text_key(text: Column) -> Column:
    """128 bits that stand for the exact text (null: as empty)."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def upto(n: Column) -> Column:
    """[1 .. n]; empty for n < 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
