import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, found int, words int, label int"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns named like those of the operators."""
    long_text = " ".join(f"word{i % 977} token{i % 31}" for i in range(40_000))
    rows = [
        (1, "The cat sat on the mat. You idiot!", "en", "a", 34, "x", 1, 1, 1),
        (1, "The cat sat on the mat. You idiot!", "en", "a", 34, "x", 1, 1, 1),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, "x", 1, 1, 1),
        (None, "no id here: password = hunter22hunter22", "en", "b", 10, "x", 1, 1, 1),
        (5, "   \n\t ", "fr", None, 6, "x", 1, 1, 1),
        (6, "12345 67890 \U0001f600 <|endoftext|> x", "de", "b", 12, "x", 1, 1, 1),
        (7, long_text, "en", "a", len(long_text), "x", 1, 1, 1),
        (8, long_text + " tail", "en", "b", len(long_text) + 5, "x", 1, 1, 1),
        (9, "Straße ÄÖÜ ñandú été İstanbul", None, "a", 10, "x", 1, 1, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
