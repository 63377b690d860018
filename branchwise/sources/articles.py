"""Articles from a pinned snapshot, and deterministic samples of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from branchwise.control.config import Dataset
from branchwise.control.files import Files
from branchwise.functions import text

#: Raw columns of a snapshot; never inferred.
RAW = "source string, headline string, article string, date date, url string, journalists array<string>"
SAMPLE = "rank int, article_id string"


class SnapshotMismatch(ValueError):
    pass


def verify_snapshot(files: Files, path: str, sha256: str) -> None:
    """Fails unless the file, or the folder of files, has the pinned content; before anything else is read."""
    if (found := files.sha256(path)) != sha256:
        raise SnapshotMismatch(f"{path}: {found} is not the pinned {sha256}")


def snapshot(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """The raw articles of a pinned snapshot: provider, repository and revision name it, the hash proves it."""
    verify_snapshot(Files(spark, dataset.file), dataset.file, dataset.file_sha256)
    return spark.read.schema(RAW).parquet(dataset.file)


def sample(articles: DataFrame, seed: int, size: int) -> DataFrame:
    """(rank, article_id) of the `size` ids with the least hashes of seed and id; the same however ids are partitioned."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), "article_id"), 256)
    least = articles.select("article_id").distinct().withColumn("h", order).orderBy("h", "article_id").limit(size)
    return least.withColumn("rank", F.row_number().over(Window.orderBy("h", "article_id"))).select("rank", "article_id")  # of `size` rows


def sample_hash(sampled: DataFrame) -> tuple[str, int]:
    """Hash of (rank, article_id) in order, and the size."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "article_id"))), lambda x: F.concat_ws("\t", x["rank"].cast("string"), x["article_id"])), "\n")
    row = sampled.agg(F.sha2(lines, 256), F.count("*")).first()
    return row[0], row[1]


def restricted(articles: DataFrame, sampled: DataFrame) -> DataFrame:
    return articles.join(sampled, "article_id", "left_semi")


def canonical(raw: DataFrame, **normalization: bool) -> DataFrame:
    """Articles of raw headline, article, source, date, url, journalists."""
    head, body = (text.normalize(F.col(c), **normalization) for c in ("headline", "article"))
    return raw.select(
        text.article_id(head, F.col("date"), body).alias("article_id"), "source", "headline", "article", "date", "url", "journalists",
        text.source_hash(F.col("headline"), F.col("date"), F.col("article")).alias("source_hash"),
    )


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table documents as raw articles: the first line is the headline, the rest the article."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    cut = F.locate("\n", F.col("text"))
    return docs.select(
        "doc_id", "source", F.when(cut > 0, F.substring_index("text", "\n", 1)).otherwise(F.col("text")).alias("headline"),
        F.when(cut > 0, F.expr("substring(text, locate('\\n', text) + 1)")).otherwise(F.lit("")).alias("article"),
        F.lit(None).cast("date").alias("date"), F.lit(None).cast("string").alias("url"), F.array().cast("array<string>").alias("journalists"),
    )
