import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, id string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank and very long texts, ties, repeated rows and columns of clashing names."""
    prose = "the cat sat on the mat and looked at the rain for a long while "
    texts = [
        (0, prose * 3), (1, prose * 3), (2, None), (3, ""), (4, " \n\t "), (5, "One"), (6, "one"), (7, "a b"),
        (8, " ".join(f"word{k}" for k in range(60_000))), (9, "naïve café 東京 \U0001f600 ß" * 20), (9, "naïve café 東京 \U0001f600 ß" * 20),
        (10, "x" * 1200), (11, "12345 !!! <|endoftext|>"), (12, prose * 2 + "fin"), (None, "no id here"),
    ]
    rows = [(k, t, "en" if t else None, "s", len(t or ""), 0.1, "f", "i") for k, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
