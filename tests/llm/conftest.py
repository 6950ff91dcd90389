import pytest

LONG = "Lange Wörter und mehr davon . " * 4000
AWKWARD = [
    (1, None, "en", "s"), (2, "", "en", "s"), (3, " \t\n ", "de", None), (None, "no id here at all but words", "en", "s"),
    (4, "same text as the next one has it", "en", "s"), (4, "same text as the next one has it", "en", "s"),
    (5, "same text as the next one has it", "fr", "t"), (6, LONG, "de", "t"), (7, "x" * 60_000, None, "t"),
    (8, "12 %% ### !!", "en", "s"), (9, "日本語 😀 ▁ \u00a0 é\r\nzeile\x00zwei", "es", "s"), (-3, "negative id", "en", None),
]
CLASHES = ("id", "key", "row", "hash", "fp", "root", "part", "value", "place", "rank", "host", "kept", "score", "drawn", "u", "v", "tie")


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts, repeated rows, ties, and columns named like helpers."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHES}).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
