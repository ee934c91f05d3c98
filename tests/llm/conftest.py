import pytest

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def real(spark):
    """The documents of the smallest tables, as rows."""
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


@pytest.fixture(scope="session")
def benchmark_rows(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet").collect()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, other scripts."""
    long = "Ab cd\tÉf 9x the mit license under " * 3000
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", None, 3),
        (5, long, "fr", "b", len(long)), (6, long, "fr", "b", len(long)), (6, long, "fr", "b", len(long)),
        (7, "Ünïcode \U0001f600 ß 中文字 \x85 x", None, "c", 1), (8, "A b C d e F g h I j k l", "en", "c", 1), (9, "a b c d e f g h i j k l", "de", "a", 1),
        (10, "!!! ??? ...", "de", "a", 1), (None, "no id here at all", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """odd_rows with extra columns whose names clash with those that operators use."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_rows, DOCUMENTS)
    return frame.withColumns({c: F.lit("x") for c in ("size", "target", "frame", "n_words", "fp", "component", "item_id", "lang_pred", "text_hash", "copies")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
