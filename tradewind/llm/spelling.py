"""Spelling variants: words one edit apart, joined through asymmetric q-chunks.

Of a pair of words the longer (of equal lengths: either) is cut into two disjoint
chunks that cover it; the other gives positional grams.  One inserted, deleted or
replaced code point leaves one of the two chunks whole: the first stays at its
place, the second shifts by the difference of the lengths, so by one at most.
The grams of the other word that lie at such places are what a chunk can meet;
those at other places join nothing and are not written.  The rest of the word,
beside the preserved chunk, is again one edit from the rest of the other, so the
same rule cuts it once more, and the join key holds a chunk of the rest as well.
A bucket then holds words that agree in about three quarters of their letters at
matching places, which keeps buckets small in a large vocabulary.  Pairs that meet
are verified by edit distance inside the join, so that no table of candidates is made.

Scale: words are counted with partial aggregates before their shuffle.  The join
reads plain rows on both sides, so adaptive execution splits a frequent chunk.
Forms are followed by doubling: since a form has at least ``factor`` times the
occurrences of its word, five rounds reach the end of any chain (``factor`` 5 and
counts below 2^63).  Only words with a form take part in that.

Defined results: NULL and empty texts have no words; repeated rows count again; an
empty table gives an empty result; ties are broken by code-point order; columns
other than those named are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize

# Letters of words, and the letters that are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, text: str = "text", least: int = 1, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``word``: a row per maximal run of letters with ``least`` code points or more, lower-cased."""
    # A run is matched from its first letter to its last, so a least length finds the same runs.
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    return docs.select(*[F.col(c) for c in keep], F.explode(runs).alias("word")) \
        .withColumn("word", F.translate("word", UPPER, LOWER))


def vocabulary(words: DataFrame, word: str = "word", least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``word, n``: distinct words that are long and frequent enough."""
    return words.select(F.col(word).alias("word")).where(F.length("word") >= least_length) \
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _piece(word: str, begin: Column, size: Column) -> Column:
    return F.substring(F.col(word), begin.cast("int") + 1, size.cast("int"))


def _half(size: Column) -> Column:
    return F.floor(size / 2).cast("int")


def _cuts(size: Column, other: Column) -> list[tuple[Column, Column, Column, Column]]:
    """Begin and size of (chunk, chunk of the rest) for the four cases, in a word of ``other``
    code points that pairs with a chunked word of ``size``.

    Places count from the left before the edit and from the right after it.
    """
    first = _half(size)
    second = size - first
    rest_a, rest_b = _half(second), _half(first)
    zero = F.lit(0)
    return [
        (zero, first, first, rest_a),                                    # edit in the last quarter
        (zero, first, other - (second - rest_a), second - rest_a),       # edit in the third
        (other - second, second, zero, rest_b),                          # edit in the second
        (other - second, second, other - second - (first - rest_b), first - rest_b),   # edit in the first
    ]


def _keys(words: DataFrame, size: Column) -> DataFrame:
    """``word, n, size, place, chunk, rest``: the four keys of each word for chunked words of ``size``."""
    keyed = words.withColumn("size", size.cast("int")).withColumn("own", F.length("word"))
    cases = [F.struct(F.lit(i).alias("place"), _piece("word", a, b).alias("chunk"), _piece("word", c, d).alias("rest"))
             for i, (a, b, c, d) in enumerate(_cuts(F.col("size"), F.col("own")))]
    return keyed.select("word", "n", "size", F.explode(F.array(*cases)).alias("k")).select("word", "n", "size", "k.*")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of distinct words that differ by exactly one edit, once."""
    words = vocab.select("word", "n")
    chunks = _keys(words, F.length("word")).select(F.col("word").alias("a"), F.col("n").alias("n_a"), "size", "place",
                                                    "chunk", "rest")
    # A word meets chunked words of its own length and of one code point more.
    grams = _keys(words, F.length("word")).unionByName(_keys(words, F.length("word") + 1)) \
        .select(F.col("word").alias("b"), F.col("n").alias("n_b"), "size", "place", "chunk", "rest")
    order = (F.length("a") > F.length("b")) | (F.col("a") < F.col("b"))
    same = [chunks[c] == grams[c] for c in ("size", "place", "chunk", "rest")]
    near = (chunks["a"] != grams["b"]) & order & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)
    met = chunks.join(grams, same[0] & same[1] & same[2] & same[3] & near)
    return met.select("a", "n_a", "b", "n_b").distinct()


def forms(vocab: DataFrame, factor: int = 5) -> DataFrame:
    """``word, n, n_near, form, form_n``: the near word of largest n (ties: smallest) if that is ``factor`` n or more."""
    pairs = near_pairs(vocab)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    held = F.col("best.less") <= -F.col("n") * F.lit(factor)
    return vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(held, F.col("best.near")).alias("form"), F.when(held, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame, factor: int = 5) -> DataFrame:
    """``word, root`` for the words with a form: the last word that forms lead to."""
    step = materialize(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), "form_n"),
                       "spelling-forms")
    # Along a chain n grows by the factor, from 1 at least.
    most = step.agg(F.max("form_n")).first()[0]
    step = step.select("word", "root")
    steps = math.floor(math.log(most, factor)) + 1 if most else 0
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                           "spelling-roots")
    return step


def spelling_groups(vocab: DataFrame, factor: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocab`` (``word, n``)."""
    formed = materialize(forms(materialize(vocab.select("word", "n"), "spelling-words"), factor), "spelling-near")
    return formed.join(roots(formed, factor), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
