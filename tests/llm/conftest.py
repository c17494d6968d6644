import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, lang, source)."""
    def make(*rows):
        full = [(*row, *(None,) * (4 - len(row)), len(row[1] or "")) for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clashing():
    """The frame with columns named like those that the operators make."""
    from pyspark.sql import functions as F

    def add(df):
        names = ("hash", "size", "n", "sig", "place", "digest", "kept", "n_tokens", "score", "lang_pred", "mark", "_c0", "ids", "token", "root", "src", "at")
        return df.select("*", *[F.lit("x").alias(name) for name in names])

    return add
