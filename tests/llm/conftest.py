import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and letterless texts, repeated rows, a long text, and columns named
    like the operators' own."""
    long = " ".join(f"the word{i % 97} of gate{i % 89} and so on" for i in range(4000))
    rows = [
        (1, "the cat and the dog of the house", "en", "a"), (1, "the cat and the dog of the house", "en", "a"),
        (2, None, "en", "a"), (3, "", None, "b"), (4, "12 34 -- !!", "de", None), (5, "der Hund und die Katze", "de", None),
        (None, "the cat and the dog", "en", "b"), (6, long, "en", "c"), (7, "▁ lit▁eral  \n\t x", None, "c"),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 2.0, "y") for r in rows],
                               "doc_id long, text string, lang string, source string, n_tokens int, row string, "
                               "score double, lang_pred string")
    return df


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)
