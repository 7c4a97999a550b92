import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents of given texts; with columns of clashing names beside."""

    def make(texts, first=0, source="src1"):
        from pyspark.sql import functions as F

        rows = [(first + i, t, "en", source, len(t) if t else 0) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, DOCS)
        return frame.withColumns({c: F.lit(1) for c in ("kept", "salt", "digest", "length", "rank", "key", "start", "words", "n")})

    return make
