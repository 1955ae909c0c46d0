"""One thin query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import documents, remainder, shared_path

Query = Callable[[SparkSession, str], DataFrame]


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import bpe

    coded = bpe.decode(bpe.encode(documents(spark, sf_dir)))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import secret_ledger as sl

    found = sl.findings(documents(spark, sf_dir), shared_path(spark, "secret-ledger"))
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    base = [r.kind for r in sl.BASE_RULES]
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                        F.sha2(sl.joined(kinds=base), 256).alias("base_sha256"), sl.joined().alias("spans"))


def op8_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import sharding

    placed = sharding.shard_documents(documents(spark, sf_dir), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import packing

    return packing.pack_documents(documents(spark, sf_dir), capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import simhash

    found = simhash.near_duplicates(simhash.fingerprints(documents(spark, sf_dir), width=3), radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op5_cross_parsing_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import langid

    docs = documents(spark, sf_dir)
    rest = remainder("doc_id", 4)
    found = langid.predict(docs, langid.learn(docs.where(rest != 2)))
    return found.select("doc_id", F.coalesce(rest == 2, F.lit(True)).alias("held_out"), "lang_pred", "score")


#: Documents with a lower score are predicted to be of low quality.
QUALITY_THRESHOLD = 0.3


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import quality

    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = remainder("doc_id", 5)
    model = quality.learn(docs.where(fold != 0), labels.where(fold != 0))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import permutation_index

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return permutation_index.search(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import nn_descent

    return nn_descent.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.93)


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import kneser_ney

    docs, rest = documents(spark, sf_dir), remainder("doc_id", 7)
    model = kneser_ney.train(docs.where(rest != 2))
    return kneser_ney.score(docs, model).select(
        "doc_id", F.coalesce(rest == 2, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.words.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import spelling

    # A deleted code point only shortens a word, so runs of fewer than 6 can be left out at once.
    runs = spelling.occurrences(documents(spark, sf_dir), least=6)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    words = runs.select(F.when(h % 199 == 0, cut).otherwise(F.col("word")).alias("word"))
    return spelling.spelling_groups(spelling.vocabulary(words, least_length=6, least_count=5), factor=5)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents the words from one on repeat with a period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = F.col("doc_id").isNotNull() & (h % 10 == 0)
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(chosen, words).alias("w")) \
        .withColumn("n", F.nullif(F.size("w"), F.lit(0)))
    rows = rows.withColumn("a", F.col("g") % F.col("n")) \
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    word = lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.element_at("w", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int")))
    edited = F.array_join(F.transform("w", word), " ")
    return rows.select("doc_id", F.when(F.col("w").isNotNull() & (F.col("n") > 0), edited)
                       .otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradewind.llm import periodic_runs

    found = periodic_runs.periodic_runs(with_periodic_tails(documents(spark, sf_dir)))
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                               r["period"].alias("period"))))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("top", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        (-F.col("top.less")).alias("length"), F.col("top.period").alias("period"),
        F.expr("(-1000 * top.less) div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def tails_replaced(batches):
    """From compressed ``text`` and ``next_text``: ``n_chars`` and ``edited``, the text with its last third
    replaced by as much from the next text's beginning; other columns as they are."""
    import pyarrow as pa
    import zstandard

    read = zstandard.ZstdDecompressor().decompress
    for b in batches:
        kept = [c for c in b.schema.names if c not in ("text", "next_text")]
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            counts, texts = [], []
            for own, following in zip(part.column("text"), part.column("next_text")):
                text, after = read(own.as_py()).decode(), read(following.as_py()).decode()
                third = len(text) // 3
                counts.append(len(text))
                texts.append(text[:len(text) - third] + after[:third])
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(counts, pa.int64()),
                                              pa.array(texts, pa.string())], names=[*kept, "n_chars", "edited"])


def op13_piecewise_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    import pyarrow as pa

    from tradewind.llm import piecewise, succession

    rows, begins = succession.in_order(documents(spark, sf_dir))
    rows = succession.with_next(piecewise.fingerprints(rows, compress=True), begins, ["text", "fingerprint"])
    rows = rows.select("doc_id", "fingerprint", F.col("next.fingerprint").alias("next_fingerprint"), "times",
                       "text", F.col("next.text").alias("next_text"))

    def edit(batches):
        for b in piecewise.with_fingerprints(tails_replaced(batches), "edited", "edited_fingerprint"):
            at = b.schema.get_field_index("edited")
            digests = [hashlib.sha256(t.as_py().encode()).hexdigest() for t in b.column(at)]
            yield b.set_column(at, "edited_sha256", pa.array(digests, pa.string()))

    key_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(edit, f"doc_id {key_type}, fingerprint string, next_fingerprint string, times long, "
                                  "n_chars long, edited_sha256 string, edited_fingerprint string")
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        piecewise.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                        piecewise.likeness("fingerprint", "next_fingerprint").alias("near_next"),
                        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")).drop("copy")


QUERIES: dict[str, Query] = {
    "op4_kneser_ney": op4_kneser_ney,
    "op3_nn_descent": op3_nn_descent,
    "op2_permutation_index": op2_permutation_index,
    "op1_pu_quality": op1_pu_quality,
    "op5_cross_parsing_langid": op5_cross_parsing_langid,
    "op6_simhash": op6_simhash,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op8_lpt_sharding": op8_lpt_sharding,
    "op7_secret_ledger": op7_secret_ledger,
    "op9_byte_bpe": op9_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_piecewise_fingerprint": op13_piecewise_fingerprint,
}


def _secrets_sql() -> str:
    """Spans by unnested gaps and matches, positions by running sums of their lengths."""
    from tradewind.llm import secret_ledger as sl

    found = []
    for rank, rule in enumerate(sl.RULES):
        pattern = rule.pattern.replace("'", "''")
        part = [f"unnest(regexp_extract_all(t, '(?s)(.*?)({pattern}|\\z)', {i})) AS {c}"
                for i, c in ((1, "g"), (2, "m"), (2 + rule.group, "v"))]
        found.append(f"""SELECT row_id, {rank} AS rank, '{rule.kind}' AS kind, e - length(m) AS s, e FROM (
  SELECT *, SUM(length(g) + length(m)) OVER (PARTITION BY row_id ORDER BY i) AS e FROM (
    SELECT row_id, {", ".join(part)}, generate_subscripts(regexp_extract_all(t, '(?s)(.*?)({pattern}|\\z)', 1), 1) AS i
    FROM texts WHERE regexp_matches(t, '{pattern}'))) WHERE length(v) >= {max(rule.least, 1)}""")
    base = ", ".join(f"'{r.kind}'" for r in sl.BASE_RULES)
    one = "string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s, rank, e)"
    counts = ", ".join(f"COUNT(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in sl.BASE_RULES)
    union = " UNION ALL ".join(found)
    return f"""WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, COALESCE(text, '') AS t FROM documents),
spans AS ({union}),
rows AS (SELECT row_id, {counts}, {one} FILTER (WHERE kind IN ({base})) AS base, {one} AS spans FROM spans GROUP BY row_id)
SELECT doc_id, {", ".join(f"COALESCE(n_{r.kind}, 0) AS n_{r.kind}" for r in sl.BASE_RULES)},
  sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans FROM texts LEFT JOIN rows USING (row_id)"""


#: DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {"op7_secret_ledger": _secrets_sql()}
