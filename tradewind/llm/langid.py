"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of a sample of labelled text recognises every
substring of the sample.  A text is parsed greedily into phrases: each is the
longest prefix of the rest that occurs in the sample (a character that does not
occur is a phrase of its own).  The fewer phrases, the closer the language; the
entropy ``phrases * log2(sample length) / length`` takes ``SAMPLE_BYTES`` for shorter
samples, so that a phrase, and a character the sample lacks, is no cheaper where little
was learned.  The language with the least wins (ties: the smaller name).

Texts are lower-cased; runs of characters that are not letters become one blank.
The characters of samples and texts are the bytes of their UTF-8 form, so that all letters
of all scripts are told apart by automata over at most 256 signs.
Texts are parsed in segments of ``SEGMENT`` bytes, many segments of many
texts in step, one array operation per position for all languages.
A segment border adds a phrase at most, alike for every language.

Learning is bounded: ``sample_bytes`` bytes per language, taken from windows of
documents chosen by hash over the whole training table, and ``MODEL_BYTES`` for all languages
together, those with most text first.  A language's sample does not depend on how many
others there are.  The model is the sample text itself.  Workers build the automata
of at most ``TABLE_BYTES`` of samples at a time; texts pass through these groups one after the
other, so many languages cost time and no memory.

Defined results: NULL texts and texts without a letter are ``und`` with score 0;
without any learned language every text is ``und``; repeated rows each get a
result; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import batches_of, keep_rows, worker_state

#: Bytes of labelled text per language; characters of the window taken from one document.
SAMPLE_BYTES, WINDOW = 50_000, 4_096
#: Bytes of all samples together, in which a language counts for ``LEAST_BYTES`` at least; bytes of the samples whose automata a worker holds in one table; tables kept.
MODEL_BYTES, LEAST_BYTES, TABLE_BYTES, TABLES = 64_000_000, 1_000, 400_000, 2
#: Bytes of a segment; segments parsed in step.
SEGMENT, TOGETHER = 1_024, 4_096
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")

Model = tuple[tuple[str, bytes], ...]         # (language, sample), ordered by language


def normalise(text: str | None) -> str:
    """Lower-case words joined by single blanks; empty if there is no letter."""
    out = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return out if any(c.isalpha() for c in out) else ""


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample_bytes: int = SAMPLE_BYTES, model_bytes: int = MODEL_BYTES) -> Model:
    """Samples of each language's text in ``docs``, the labelled training rows; repeated rows count once."""
    place = F.xxhash64(F.lit("language sample"), "key", "text")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")) \
        .where("text IS NOT NULL AND lang IS NOT NULL").withColumn("place", place)
    # One row per language, the languages with most text first, as many as the model can hold.
    single = rows.groupBy("lang", "key", "place").agg(F.min(F.least(F.length("text"), F.lit(WINDOW))).alias("size"))
    totals = single.groupBy("lang").agg(F.sum("size").alias("total")).where("total > 0")
    bounded = totals.orderBy(F.desc("total"), "lang").limit(max(1, model_bytes // LEAST_BYTES)).collect()
    held, names = 0, []
    for r in bounded:
        held += max(LEAST_BYTES, min(r["total"], sample_bytes))
        if held > model_bytes and names:
            break
        names.append((r["lang"], r["total"]))
    if not names:
        return ()
    chosen = rows.sparkSession.createDataFrame(names, "lang string, total long")
    # Windows of three times the sample are fetched, so that short texts are enough too.
    share = F.pmod("place", F.lit(1 << 40)) / F.lit(float(1 << 40))
    windows = rows.join(F.broadcast(chosen), "lang") \
        .withColumn("share", share).where(F.col("share") * F.col("total") < 3 * sample_bytes) \
        .withColumn("at", F.pmod(F.xxhash64("share"), F.greatest(F.lit(1), F.length("text") - WINDOW + 1))) \
        .select("lang", "share", "key", F.expr(f"substring(text, cast(at AS int) + 1, {WINDOW})").alias("part")).distinct()
    parts: dict[str, list] = {}
    for r in windows.collect():
        parts.setdefault(r["lang"], []).append((r["share"], r["key"] is None, r["key"] or 0, r["part"]))
    model = []
    for name in sorted(parts):
        sample = " ".join(filter(None, (normalise(p[-1]) for p in sorted(parts[name])))).encode()[:sample_bytes]
        if sample:
            model.append((name, b" " + sample + b" "))
    return tuple(model)


def suffix_automaton(text: np.ndarray, letters: int) -> np.ndarray:
    """Transitions (states, letters) of the suffix automaton; 0, the initial state, is never a target."""
    size = 2 * len(text) + 1
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text.tolist():
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    assert len(moves) <= size
    table = np.zeros((len(moves), letters), dtype=np.int32)
    for s, m in enumerate(moves):
        for c, t in m.items():
            table[s, c] = t
    return table


class Parser:
    """The automata of some languages in one transition table."""

    def __init__(self, model: Model):
        self.names = [name for name, _ in model]
        held = sorted(set(b"".join(sample for _, sample in model)))
        self.codes = np.zeros(256, dtype=np.uint16)            # 0: no automaton knows it
        self.codes[held] = np.arange(1, len(held) + 1)
        self.letters = len(held) + 1
        # Room for as many states as there can be, filled in place: pages that stay untouched take no memory.
        most = sum(2 * len(sample) + 1 for _, sample in model) * self.letters
        table = np.zeros(most, dtype=np.int32 if most < 1 << 31 else np.int64)
        self.root, at = [], 0
        for _, sample in model:
            own = suffix_automaton(self.encode(sample), self.letters)
            # Targets are stored as positions of their rows, so that a step is one addition and one look-up.
            rows = table[at * self.letters:(at + len(own)) * self.letters].reshape(own.shape)
            np.add(own, at, out=rows, where=own > 0)
            rows *= self.letters
            self.root.append(at * self.letters)
            at += len(own)
        self.table = table[:at * self.letters]
        self.cost = np.log2([max(SAMPLE_BYTES, len(sample)) for _, sample in model])

    def encode(self, text: bytes) -> np.ndarray:
        return self.codes[np.frombuffer(text, dtype=np.uint8)]

    def phrases(self, segments: list[np.ndarray]) -> np.ndarray:
        """(segments, languages): phrases of each segment's greedy parse."""
        order = sorted(range(len(segments)), key=lambda i: -len(segments[i]))
        lengths = np.array([len(segments[i]) for i in order])
        width = int(lengths[0]) if len(lengths) else 0
        grid = np.zeros((width, len(order)), dtype=np.uint16)   # a row per position
        for col, i in enumerate(order):
            grid[:len(segments[i]), col] = segments[i]
        active = len(order) - np.searchsorted(lengths[::-1], np.arange(width), side="right")
        root = np.array(self.root, dtype=self.table.dtype)[:, None]
        state = np.repeat(root, len(order), axis=1)
        count = np.zeros(state.shape, dtype=np.int32)
        for j in range(width):
            n = active[j]
            c, s = grid[j, :n], state[:, :n]
            to = self.table[s + c]
            lost = to == 0
            count[:, :n] += lost | (s == root)
            again = self.table[root + c]                       # begin a phrase with this character
            s[:] = np.where(lost, np.where(again > 0, again, root), to)
        out = np.empty((len(order), len(self.names)), dtype=np.int64)
        out[order] = count.T
        return out


def groups(model: Model, most: int = TABLE_BYTES) -> tuple[Model, ...]:
    """The languages in order, cut so that the samples of a group have at most ``most`` bytes (or are one)."""
    out: list[list] = []
    size = 0
    for entry in model:
        if not out or size + len(entry[1]) > most:
            out.append([])
            size = 0
        out[-1].append(entry)
        size += len(entry[1])
    return tuple(map(tuple, out))


def parser(part: Model) -> Parser:
    return worker_state("langid", lambda: lru_cache(maxsize=TABLES)(Parser))(part)


def _scored(texts: list[str | None], parts: tuple[Model, ...]) -> Iterator[tuple[str, float]]:
    names = [name for part in parts for name, _ in part]
    segments, owner, empty = [], [], []
    for i, t in enumerate(texts):
        clean = normalise(t).encode("utf-8", "surrogatepass")
        empty.append(not clean)
        for at in range(0, len(clean), SEGMENT):
            segments.append(clean[at:at + SEGMENT])
            owner.append(i)
    costs = np.zeros((len(texts), len(names)))
    done = 0
    for part in parts:
        own = parser(part)
        total = np.zeros((len(texts), len(part)), dtype=np.int64)
        for i in range(0, len(segments), TOGETHER):
            held = [own.encode(x) for x in segments[i:i + TOGETHER]]
            np.add.at(total, np.array(owner[i:i + TOGETHER]), own.phrases(held))
        costs[:, done:done + len(part)] = total * own.cost
        done += len(part)
    for none, cost in zip(empty, costs):
        if none or not names:
            yield UNKNOWN, 0.0
            continue
        best = int(np.argmin(cost))
        others = np.delete(cost, best)
        yield names[best], 1.0 if not len(others) else float(1 - cost[best] / others.min())


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row: the score is the least entropy's distance from the
    second least, as a share of the latter (1 if a single language was learned)."""
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = groups(model)
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("lang_pred", pa.string()), ("score", pa.float64())])
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                found = _scored(part.column("t").to_pylist(), parts)
                yield from batches_of(((k, *f) for k, f in zip(part.column("k").to_pylist(), found)), schema)

    return source.mapInArrow(run, f"k {key_type}, lang_pred string, score double").withColumnRenamed("k", key)


def keep(docs: DataFrame, model: Model, languages: tuple[str, ...] | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose language is known (and among ``languages``, if given)."""
    def judge():
        parts = groups(model)
        return lambda texts: [name != UNKNOWN and (languages is None or name in languages)
                              for name, _ in _scored(texts, parts)]

    return keep_rows(docs, text, judge)
