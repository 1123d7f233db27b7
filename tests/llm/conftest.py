import pytest

ODD_COLUMNS = "row fp key text_sha256 features rank length kind digest root u v n token part at".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like inner ones."""
    long = "The quick brown fox, " * 12_000
    texts = [
        (1, "Hello there, you all.\nSecond line. Third", "en"),
        (2, "hello THERE, you all.\nsecond line. third", "en"),
        (3, None, "en"),
        (4, "", None),
        (5, long, "en"),
        (6, "Guten Tag, wie geht es dir heute?", "de"),
        (6, "Guten Tag, wie geht es dir heute?", "de"),
        (6, "Guten Tag, wie geht es Ihnen?", "de"),
        (7, "123 456 ²² !!!", None),
        (8, "  spaced  out\t\n\n text <|endoftext|> end ", "en"),
        (9, "Éèê ça va, où est la gare?", "fr"),
        (None, "No id here at all", "en"),
        (None, None, None),
        (12, "\U0001f600 emoji é İ and ǅ", "en"),
    ]
    rows = [(i, t, lang, "s" if i and i % 2 else None, len(t or "")) for i, t, lang in texts]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in ODD_COLUMNS}).checkpoint()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
