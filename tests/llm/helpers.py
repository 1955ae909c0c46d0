"""Small tables shared by the tests of the corpus operators."""

from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=False):
    """Documents 0, 1, ... with the given texts; ``extra`` adds columns whose names clash with results."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if extra:
        df = df.selectExpr("*", "'x' AS score", "'x' AS ids", "'x' AS blob", "'x' AS shard", "'x' AS fingerprint",
                           "'x' AS key", "'x' AS k", "'x' AS component_id", "'x' AS size", "'x' AS t")
    return df


def save_docs(spark, df, path):
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)
