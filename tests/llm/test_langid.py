import random
import tracemalloc

import numpy as np

from tests.llm.helpers import DOC_SCHEMA, docs_of
from tradewind.llm import langid
from tradewind.llm.queries import op5_cross_parsing_langid

WORDS = {"aa": ["bana", "nab", "ban", "ana"], "bb": ["xyzzy", "zyx", "yxy"], "cc": ["ñandú", "ßen", "été"]}


def brute_phrases(text, sample):
    """Greedy longest-match parse, by substring search."""
    n = at = 0
    while at < len(text):
        k = 0
        while at + k < len(text) and text[at:at + k + 1] in sample:
            k += 1
        at += max(k, 1)
        n += 1
    return n


def samples(seed=1, n=400):
    rng = random.Random(seed)
    return tuple((lang, (" " + " ".join(rng.choice(w) for _ in range(n)) + " ").encode()) for lang, w in sorted(WORDS.items()))


def test_parse_equals_brute_force():
    model, rng = samples(), random.Random(2)
    own = langid.Parser(model)
    texts = ["".join(rng.choice("abnxyz ñßéú☃") for _ in range(rng.randrange(1, 200))) for _ in range(60)] + ["☃", "a"]
    got = own.phrases([own.encode(t.encode()) for t in texts])
    assert got.tolist() == [[brute_phrases(t.encode(), s) for _, s in model] for t in texts]


def test_automaton_knows_exactly_the_substrings():
    text = np.array([1, 2, 1, 2, 2, 1, 3], dtype=np.uint8)
    table = langid.suffix_automaton(text, 4)
    subs = {tuple(text[i:j].tolist()) for i in range(7) for j in range(i + 1, 8)}
    reached, todo = set(), [((), 0)]
    while todo:
        word, state = todo.pop()
        for c in (1, 2, 3):
            if table[state, c]:
                reached.add(word + (c,))
                todo.append((word + (c,), table[state, c]))
    assert reached == subs


def test_long_texts_are_parsed_whole():
    own = langid.groups(samples())
    head, tail = " ".join(["xyzzy zyx"] * 100), " ".join(["bana nab ana"] * 3000)
    assert [p for p, _ in langid._scored([head, head + " " + tail], own)] == ["bb", "aa"]


def test_language_with_a_tiny_sample_wins_no_other_texts():
    letters, rng = {"aa": "abcdefghijklm ", "bb": "nopqrstuvwxyz "}, random.Random(4)
    text = lambda lang, n: " ".join("".join(rng.choice(letters[lang]) for _ in range(n)).split())
    model = tuple((lang, f" {text(lang, 20_000)} ".encode()) for lang in letters)
    texts = [(lang, text(lang, 200)) for lang in letters for _ in range(10)]
    for word in ("a", "ok", "hello"):
        own = langid.groups(model + (("zz", f" {word} ".encode()),))
        assert [p for p, _ in langid._scored([t for _, t in texts], own)] == [lang for lang, _ in texts]


def test_query_predicts_held_out_rows_and_odd_texts(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang, "s", 1)
            for i, lang in enumerate(sorted(WORDS) * 40)]
    odd = [(900, None, "aa", None, None), (901, "", None, None, None), (902, "12 3! ²", "aa", "s", 1),
           (903, "BANA nab", None, None, None), (None, "zyx", "aa", None, None)]
    df = spark.createDataFrame(rows + odd, DOC_SCHEMA).selectExpr("*", "'x' AS score", "'x' AS lang_pred", "'x' AS k")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = op5_cross_parsing_langid(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == lang and 0 <= by_id[i].score <= 1 for i, _, lang, _, _ in rows)
    assert [by_id[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert by_id[None].held_out and any(r.held_out for r in got) and any(not r.held_out for r in got)


def test_nothing_learned_and_empty_table(spark):
    model = langid.learn(spark.createDataFrame([(1, None, "aa", "s", 1), (2, "text", None, "s", 1)], DOC_SCHEMA))
    assert model == ()
    assert [r.lang_pred for r in langid.predict(docs_of(spark, ["text"]), model).collect()] == ["und"]
    assert langid.predict(spark.createDataFrame([], DOC_SCHEMA), samples()).count() == 0


def test_two_alphabets_of_300_letters(spark):
    rng = random.Random(6)
    letters = {"aa": [chr(0x4E00 + i) for i in range(300)], "bb": [chr(0xAC00 + i) for i in range(300)]}
    text = lambda lang, n: "".join(rng.choice(letters[lang]) for _ in range(n))
    rows = [(i, text("aa", 2000) if i < 20 else text("bb", 500), "aa" if i < 20 else "bb", "s", 1) for i in range(40)]
    model = langid.learn(spark.createDataFrame(rows, DOC_SCHEMA))
    texts = [(lang, text(lang, 60)) for lang in letters for _ in range(20)]
    got = list(langid._scored([t for _, t in texts], langid.groups(model)))
    assert [p for p, _ in got] == [lang for lang, _ in texts] and all(s > 0 for _, s in got)


def test_predictions_do_not_depend_on_the_number_of_labels(spark):
    rng = random.Random(7)
    real = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(200)), lang, "s", 1) for i, lang in enumerate(sorted(WORDS) * 5)]
    learn = lambda rows: langid.learn(spark.createDataFrame(rows, DOC_SCHEMA))
    alone = dict(learn(real))
    for junk in (20, 1500):
        rows = real + [(1000 + i, f"q{'jkvw'[i % 4]} zq", f"junk-{i}", "s", 1) for i in range(junk)]
        model = dict(learn(rows))
        assert len(model) == len(WORDS) + junk and all(model[lang] == alone[lang] for lang in WORDS)
    own = langid.groups(tuple(sorted(model.items())), 2_000)
    assert len(own) > 5                                    # several passes
    texts = [t for _, t, _, _, _ in real]
    assert [p for p, _ in langid._scored(texts, own)] == [lang for _, _, lang, _, _ in real]


def test_a_language_of_equal_rows_is_learned(spark):
    rows = [(7, "bana nab ana ban", "aa", "s", 1)] * 4000 + [(i, "xyzzy zyx yxy " * 50, "bb", "s", 1) for i in range(28)]
    model = langid.learn(spark.createDataFrame(rows, DOC_SCHEMA))
    assert [name for name, _ in model] == ["aa", "bb"] and model[0][1] == b" bana nab ana ban "


def test_automata_are_built_without_copies_of_the_table():
    rng = random.Random(5)
    model = tuple((f"l{i}", bytes(rng.choices(range(256), k=3_000))) for i in range(12))
    tracemalloc.start()
    own = langid.Parser(model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert own.table.dtype == np.int32 and peak < 2.5 * own.table.nbytes
