import zlib

import numpy as np
import pytest

from lakeloom.llm import langid, queries
from lakeloom.llm.common import read_table
from tests.conftest import SF


def test_automaton_knows_exactly_the_substrings():
    s = [1, 2, 1, 1, 2, 3, 1, 2]
    t = langid.suffix_automaton(s, 5)
    subs = {tuple(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)}

    def accepts(x):
        state = 0
        for c in x:
            state = t[state, c]
            if state < 0:
                return False
        return True

    import itertools

    for n in range(5):
        for x in itertools.product([1, 2, 3, 4], repeat=n):
            assert accepts(x) == (x in subs)


def test_phrases_match_a_plain_parse(monkeypatch):
    model = langid.LanguageModel({"aa": "the cat sat on the mat", "bb": "der hund und die katze"})
    rng = np.random.default_rng(2)
    mixed = " ".join(rng.choice("the cat sat on mat der hund und die katze xyz".split(), 900))
    monkeypatch.setattr(langid, "SEGMENT", 16)
    for text in ("the cat and the hund", "xyz", "", "katze" * 200, "日本 the", mixed, "the cat sat on the mat " * 60, "x" * 100):
        symbols = model.symbols(langid.code_points(text))
        got = model.phrases([symbols])[0]
        for k, lang in enumerate(model.langs):
            ref = model.symbols(langid.code_points({"aa": "the cat sat on the mat", "bb": "der hund und die katze"}[lang])).tolist()
            known = {tuple(ref[i:j]) for i in range(len(ref)) for j in range(i + 1, len(ref) + 1) if 0 not in ref[i:j]}
            want, phrase = len(symbols) > 0, ()
            for i, c in enumerate(symbols.tolist()):
                if phrase + (c,) in known:
                    phrase += (c,)
                else:
                    want += i > 0
                    phrase = (c,) if (c,) in known else ()
            assert got[k] == want
    texts = [model.symbols(langid.code_points(mixed[:n])) for n in (0, 1, 15, 16, 17, 500, 4000)]
    assert np.array_equal(model.phrases(texts), np.concatenate([model.phrases([t]) for t in texts]))


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in read_table(spark, SF, "documents").collect()}
    rows = queries.queries()["op2_language"](spark, SF).collect()
    assert len(rows) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.98


def test_edges(spark):
    learn = spark.createDataFrame([(1, "the cat sat on the mat and the dog", "en"), (2, "der hund und die katze sind hier", "de"), (3, "x", None), (None, "y", "fr"), (4, None, "es")], "doc_id long, text string, lang string")
    model = langid.fit(spark, learn)
    assert model.langs == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 .,!"), (4, "the cat"), (4, "the cat"), (5, "der hund " * 40_000), (None, "日本語")]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    assert [g[1] for g in got[:6]] == ["und", "und", "und", "en", "en", "de"] and got[3] == got[4] and all(0 <= g[2] <= 1 for g in got)
    docs = spark.createDataFrame([(1, None, "s", 0, "k"), (2, "the cat", "s", 7, "k")], "doc_id long, text string, source string, n_chars long, lang string")
    kept = langid.keep_known(docs, model).collect()
    assert [(r["doc_id"], r["lang"], r["n_chars"]) for r in kept] == [(2, "en", 7)]
    assert langid.keep_known(docs.drop("lang"), model).columns == ["doc_id", "text", "source", "n_chars"]
    empty = langid.fit(spark, learn.where("false"))
    assert langid.predict(docs, empty).collect()[1]["lang_pred"] == "und" and langid.predict(docs.where("false"), model).count() == 0


def test_ties_go_to_the_first_language():
    model = langid.LanguageModel({"b": "same text", "a": "same text"})
    assert model.classify(["same"])[0] == ["a"] and model.classify(["same"])[1][0] == pytest.approx(0.5)


def test_letters_beyond_the_dense_table_count():
    rng = np.random.default_rng(4)
    scripts = {"en": (97, 26), "ru": (0x430, 32), "el": (0x3B1, 17), "zh": (0x4E00, 900), "ko": (0xAC00, 700), "hi": (0x905, 50)}
    words = {k: ["".join(chr(first + i) for i in rng.integers(0, n, 4)) for _ in range(150)] for k, (first, n) in scripts.items()}
    # Two languages of one large script are told apart by their words.
    words["ja"] = ["".join(chr(0x4E00 + i) for i in rng.integers(0, 900, 4)) for _ in range(150)]
    text = lambda k, n: " ".join(rng.choice(words[k], n))
    model = langid.LanguageModel({k: text(k, 300 + 50 * i) for i, k in enumerate(sorted(words))})
    want = [k for k in sorted(words) for _ in range(5)]
    assert model.classify([text(k, 30) for k in want])[0] == want


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    learn = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    assert langid.fit(spark, learn.where("doc_id < 2")).langs == ["l0", "l1"]
    with pytest.raises(ValueError):
        langid.fit(spark, learn)
