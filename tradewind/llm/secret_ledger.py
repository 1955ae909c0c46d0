"""Secret scans over an incremental, content-addressed blob ledger.

Every version of every path is addressed by the SHA-256 of its content.  Only
pairs of (blob, rule version) that the ledger has not seen are scanned, once
per blob however many paths or versions hold it; findings are then joined back
to all paths.  Everything here is DataFrame functions: no Python on executors.

The ledger is a folder of Parquet files in shared storage, appended by one
committed write per scan: a row per scanned blob with the rule versions it was
scanned for and what they found.  A job that dies before the commit leaves no
row, so its blobs are scanned again by the next one; two scans of the same pair
find the same spans, which are merged.

Scale: the text moves once, to the task of its path's row, for unseen blobs
only.  A blob held by a third of all paths is one row of the ledger; joining it
back is a left join whose hot partition adaptive execution splits.

Defined results: NULL content counts as the empty text; an empty table gives an
empty result; repeated rows each get the findings.  Positions are code points,
ends exclusive.  Columns other than the key and the content are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    Give a new ``version`` to a changed pattern: blobs are then scanned again for this rule alone.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules.  The runs of `access` and `hex` state their least
# length in the pattern, which finds the same spans: such a run is matched to its
# end, and no part of a run that is too short is long enough.  `assign` filters
# afterwards, since a match that is dropped still uses up its characters.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)

# Further well-known credential forms.
EXTRA_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

RULES = BASE_RULES + EXTRA_RULES

_FINDINGS = "array<struct<start:int,rank:int,end:int,kind:string,rule:string>>"


def _spans(text: str, rule: Rule, rank: int) -> Column:
    """Findings of one rule in column ``text``.

    Each extraction takes the shortest gap before a match and the match itself;
    lengths added up give the positions.  The end of the text counts as an empty
    match, so that the last gap is walked once only.
    """
    walk = F.lit(f"(?s)(.*?)({rule.pattern}|\\z)")
    part = lambda i: F.regexp_extract_all(F.col(text), walk, F.lit(i))
    zipped = F.arrays_zip(part(1).alias("g"), part(2).alias("m"), part(2 + rule.group).alias("v"))
    begin = F.struct(F.lit(0).alias("pos"), F.lit(None).cast(_FINDINGS).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["g"])
        end = start + F.length(x["m"])
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                               F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"))).cast(_FINDINGS)
        found = F.when(F.length(x["v"]) >= max(rule.least, 1), F.concat(F.coalesce(acc["found"], _nothing()), one)) \
            .otherwise(acc["found"])
        return F.struct(end.alias("pos"), found.alias("found"))

    walked = F.aggregate(zipped, begin, step, lambda acc: F.coalesce(acc["found"], _nothing()))
    # Most texts hold nothing: one search without positions settles them.
    return F.when(F.col(text).rlike(rule.pattern), walked).otherwise(_nothing())


def _nothing() -> Column:
    return F.array().cast(_FINDINGS)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def blob_of(content: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(content), F.lit("")).cast("binary"), 256))


def scan_unseen(versions: DataFrame, ledger: str, key: str, content: str,
                rules: Sequence[Rule] = RULES) -> None:
    """Scan the pairs of blob and rule version that ``ledger`` lacks; append what is found."""
    spark = versions.sparkSession
    # The key as text and whether it is NULL: plain equalities, so that the grouping and the join of rows by key
    # and blob share one shuffle.
    source = versions.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(key).isNull().alias("none"),
                             F.coalesce(F.col(content), F.lit("")).alias("text")).withColumn("blob", blob_of("text"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    todo = source.groupBy("blob").agg(F.min(F.struct("none", "key")).alias("at")).select("blob", "at.key", "at.none")
    if _exists(spark, ledger):
        seen = spark.read.parquet(ledger).select("blob", F.explode("scanned").alias("rule")) \
            .groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = todo.join(seen, "blob", "left") \
            .withColumn("missing", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))) \
            .where(F.size("missing") > 0).drop("seen")
    else:
        todo = todo.withColumn("missing", wanted)
    # Text is fetched by the key of one holder of the blob: only small rows take part in the grouping.
    # Rows that repeat a key and a content are combined before they move.
    by = ["key", "none", "blob"]
    single = source.groupBy(*by).agg(F.first("text").alias("text"))
    held = single.join(todo.hint("shuffle_hash"), by)
    found = [F.when(F.array_contains("missing", r.key), _spans("text", r, i)).otherwise(_nothing())
             for i, r in enumerate(rules)]
    held.select("blob", F.col("missing").alias("scanned"), F.concat(*found).alias("findings")) \
        .write.mode("append").parquet(ledger)


def by_blob(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, found`` for the blobs of the ledger in which the given rules found something."""
    current = [r.key for r in rules]
    return spark.read.parquet(ledger).where(F.size("findings") > 0) \
        .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("findings")))).alias("found")) \
        .withColumn("found", F.filter("found", lambda x: x["rule"].isin(current))).where(F.size("found") > 0)


def findings(versions: DataFrame, ledger: str, key: str = "doc_id", content: str = "text",
             rules: Sequence[Rule] = RULES) -> DataFrame:
    """``key`` and ``findings`` for every row: the spans of its content, by start, then rule."""
    scan_unseen(versions, ledger, key, content, rules)
    paths = versions.select(F.col(key).alias(key), blob_of(content).alias("blob"))
    return paths.join(by_blob(versions.sparkSession, ledger, rules), "blob", "left") \
        .select(key, F.hex("blob").alias("blob"), F.coalesce("found", _nothing()).alias("findings"))


def joined(found: str = "findings", kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` of the findings, comma-joined."""
    kept = F.filter(found, lambda x: x["kind"].isin(list(kinds))) if kinds else F.col(found)
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                x["end"].cast("string"))), ",")


def redacted(text: str, found: str = "findings", mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch covered by findings replaced by ``mark``."""
    begin = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["pos"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(F.col(text), acc["pos"] + 1, x["start"] - acc["pos"]),
                                     F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["pos"] + 1, F.length(F.col(text))))
    return F.when(F.size(found) > 0, F.aggregate(found, begin, step, rest)).otherwise(F.col(text))


def redact(docs: DataFrame, ledger: str, key: str = "doc_id", content: str = "text", rules: Sequence[Rule] = RULES,
           mark: str = "[SECRET]") -> DataFrame:
    """``docs``, all columns, with the secrets in ``content`` replaced by ``mark``."""
    scan_unseen(docs, ledger, key, content, rules)
    own, spans = (_free(name, docs.columns) for name in ("_blob", "_found"))
    found = by_blob(docs.sparkSession, ledger, rules).select(F.col("blob").alias(own), F.col("found").alias(spans))
    held = docs.withColumn(own, blob_of(content)).join(found, own, "left")
    clean = F.when(F.col(spans).isNull(), F.col(content)).otherwise(redacted(content, spans, mark))
    return held.withColumn(content, clean).select(*docs.columns)


def _free(name: str, columns: Sequence[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name
