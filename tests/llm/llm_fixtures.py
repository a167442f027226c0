import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard int, row string, `__row` int"

LONG = "the quick onion of the thing and that " * 6000  # 222,000 characters


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    extra columns whose names clash with results and internals."""
    rows = [
        (1, "the cat sat on the mat and the dog lay by the door", "en", "b", 50, "x", 7, "r", 1),
        (1, "the cat sat on the mat and the dog lay by the door", "en", "b", 50, "x", 7, "r", 1),
        (2, "the cat sat on the mat and the dog lay by the door", "en", None, 50, None, None, None, None),
        (3, None, "en", "a", None, "x", 7, "r", 1),
        (4, "", "en", "a", 0, "x", 7, "r", 1),
        (5, " \t\n ", None, "a", 4, "x", 7, "r", 1),
        (6, LONG, "en", "a", len(LONG), "x", 7, "r", 1),
        (7, "123 456 !!!", "fr", "a", 11, "x", 7, "r", 1),
        (8, "le chat est sur la table et le chien dort", "fr", "b", 41, "x", 7, "r", 1),
        (None, "le chat est sur la chaise et le chien mange", "fr", None, 43, "x", 7, "r", 1),
        (9, "under the MIT license, ▁ naïve 日本語 \U0001f44d  two  spaces", None, "c", 50, "x", 7, "r", 1),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
