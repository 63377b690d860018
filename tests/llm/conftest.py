import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 997} and{i}" for i in range(40_000))
    plain = " ".join(f"alpha{i}" for i in range(60))
    rows = [
        (1, plain, "en", "a", 1), (1, plain, "en", "a", 1), (2, plain, "en", "b", 1), (3, None, None, None, None), (None, plain + " end", None, "c", 0),
        (None, None, None, None, None), (4, "", "en", "a", 0), (5, " \n\t", "en", "a", 3), (6, long_text, "fr", "a", 9), (7, "é" * 5000, "fr", "d", 5000),
    ]
    names = ["key", "bucket", "kept", "shard", "n_words", "rate", "_words", "h1", "refers_to", "_id"]
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit("x") for n in names})
