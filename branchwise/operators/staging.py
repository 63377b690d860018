"""Ids and levels written to the shared folder, so that costly scores are asked for once."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from branchwise.control.files import Files


def shared_folder(spark: SparkSession) -> str:
    """Under spark.checkpoint.dir; a temporary folder only in local mode: executors could not share it."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="branchwise-")
    return f"{root.rstrip('/')}/stage-{uuid.uuid4().hex}"


#: Shuffle files go when the write that made them is over, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextlib.contextmanager
def keyed(rows: DataFrame, key: str) -> Iterator[DataFrame]:
    """rows as a table bucketed by key, in a new folder that goes at the end: a join on key moves only the other side."""
    spark, root, name = rows.sparkSession, shared_folder(rows.sparkSession), f"keyed_{uuid.uuid4().hex}"
    try:
        with _tidy(spark):
            rows.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", f"{root}/table").saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        Files(spark, root).delete(root)


def stager(spark: SparkSession, root: str | None = None) -> Callable[[DataFrame, int], DataFrame]:
    """Writes levels under root, else in a new folder; stage.root is that folder."""
    root = root or shared_folder(spark)

    def stage(level: DataFrame, depth: int) -> DataFrame:
        path = f"{root}/{depth}"
        with _tidy(spark):
            level.write.parquet(path)
        return spark.read.schema(level.schema).parquet(path)

    stage.root = root
    return stage


class Journal:
    """Levels of one model's walks under a folder that a later run finds: append-only, each level whole or not there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.stage = stager(spark, f"{root}/{uuid.uuid4().hex}")

    def rows(self) -> DataFrame | None:
        """All rows of the levels that earlier attempts have ended."""
        files = Files(self.spark, self.root)
        found = [f"{self.root}/{x.rpartition('/')[0]}" for x in files.walk(self.root) if x.endswith("/_SUCCESS")]
        return self.spark.read.parquet(*found) if found else None
