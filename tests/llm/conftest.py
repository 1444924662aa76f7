import pytest

SCHEMA = "doc_id BIGINT, text STRING"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) rows, in several partitions and with columns that clash."""

    def make(rows, schema=SCHEMA, extra=True):
        df = spark.createDataFrame(rows, schema).repartition(3)
        if not extra:
            return df
        names = ["row_key", "score", "tag", "spans", "value", "place", "words", "label", "shingles", "n_words"]
        return df.selectExpr("*", *[f"'x' AS {n}" for n in names if n not in df.columns])

    return make
