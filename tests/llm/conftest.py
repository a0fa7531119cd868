import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, or (doc_id, text, source)."""

    def made(rows, extra: str | None = None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumn(extra, F.lit("old"))
        return df

    return made
