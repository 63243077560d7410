import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source); extra columns with the operators' own names."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        names = ("key", "body", "row", "size", "copies", "fp", "id", "bucket", "kept", "_text", "part", "rank")
        from pyspark.sql import functions as F

        return spark.createDataFrame(full, DOC).withColumns({n: F.lit("x") for n in names})

    return make
