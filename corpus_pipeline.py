"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and rereads as the next stage's documents.
All but the last return the columns of ``documents``:

1. ``quality``: documents that the classifier scores below the threshold go;
2. ``language``: documents without a recognisable language go;
3. ``near_duplicates``: of each SimHash group the document with the smallest id stays;
4. ``secrets``: secrets are replaced by a mark, and ``n_chars`` follows the text;
5. ``packing``: a row per packed piece of a document.

NULL texts and texts without a letter go with stage 2 at the latest.  SQL cannot
express the stages (a fitted model, automata, an iterative grouping, a genetic
algorithm), so the tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import langid, packing, quality, secret_ledger, simhash
from tradewind.llm.common import documents, remainder, shared_path
from tradewind.llm.queries import QUALITY_THRESHOLD
from tradewind.session import intermediates, remove, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = remainder("doc_id", 5)
    model = quality.learn(docs.where(fold != 0), labels.where(fold != 0))
    return quality.keep(docs, model, QUALITY_THRESHOLD)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep(docs, langid.learn(docs.where(remainder("doc_id", 4) != 2)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=3, radius=3)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_ledger.redact(docs, shared_path(spark, "secret-ledger"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, capacity=2048)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: No SQL: see above.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote beside its result, and its input, go once its result is written.

    The last stage's own tables stay, since the returned rows are read from them."""
    docs, held = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        with intermediates(spark) as written:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            written.remove(path)
        if held:
            remove(spark, held)
        docs, held = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
