import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents: ``documents((id, text, ...), ...)``; what is left out is NULL."""

    def make(*rows):
        return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCUMENTS)

    return make


@pytest.fixture
def cluttered():
    """Adds columns whose names operators use inside, to show that they do not clash."""
    from pyspark.sql import functions as F

    def add(df):
        names = ["key", "n", "node", "rank", "size", "tid", "shard", "kind", "row", "words", "x", "y", "count", "component_id", "kept", "doc", "a.b"]
        names += ["quality", "mix", "entities", "_words", "_lines", "_repeated", "_windows", "_ordered", "_starts", "_q", "_verdict", "_row"]
        names += ["_copy", "_source", "_size", "_class", "_spread", "_rank", "_cell", "_rows", "_inside", "_before", "_target", "_given0"]
        names += ["_found", "_matches", "_forms", "_pattern", "_attempts", "_page", "_w", "_p", "templates", "shingles", "spans", "f1", "f2"]
        return df.select("*", *[F.lit("extra").alias(n) for n in names if n not in df.columns])

    return add
