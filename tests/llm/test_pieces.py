import hashlib
import random
import time

import numpy as np
import pytest

from lakeloom.llm import pieces, queries
from lakeloom.llm.common import read_table
from tests.conftest import SF


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(queries.piece_model_path())


def test_equals_the_library(model):
    rng = random.Random(3)
    texts = ["", " ", "   a", "a   b  ", "a" * 500, "\n\t<s></s><unk>", "é€😀漢字\u0000�", "▁▁a▁ b", "=" * 41, " " * 33 + "x", None]
    texts += ["".join(rng.choice("ab ▁\ne=t漢😀-0") for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    for text, ids in zip(texts, model.encode(texts)):
        want = model.lib.encode(text or "", add_bos=True, add_eos=True)
        assert ids.tolist() == want and model.decode(ids) == model.lib.decode(want)


def test_long_words_equal_the_library(model):
    rng = random.Random(4)
    for _ in range(150):
        letters = rng.choice(["ab", "thein", "etaoinshr", "abcdefghijklmnopqrstuvwxyz", "日本語a", "0123", "aA_-", "éàe"])
        word = "".join(rng.choice(letters) for _ in range(rng.randint(pieces.LONG - 3, 2500)))
        want = model.lib.encode(word, add_bos=True, add_eos=True)
        assert model.encode([word, "x", word + "z"])[0].tolist() == want
        model.forget()


def test_long_words_take_time_in_proportion(model):
    rng = random.Random(5)
    for word in ("".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(1_000_000)), "a" * 300_000, "the" * 100_000):
        began = time.time()
        ids = model.encode([word])[0]
        assert time.time() - began < 20 and ids.tolist() == model.lib.encode(word, add_bos=True, add_eos=True)


def test_the_queue_equals_the_rounds(model):
    rng = random.Random(6)
    for _ in range(50):
        points = [model.char_ids[ord(c)] for c in "".join(rng.choice("thein er") for _ in range(600)).replace(" ", "▁")]
        assert np.array_equal(model.merge_queue(np.array(points, np.int64)), model.merge_long(np.array(points, np.int64)))


def test_forgetting_words_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    for text in ("one two three four five", "four five six", "one two"):
        assert model.encode([text])[0].tolist() == model.lib.encode(text, add_bos=True, add_eos=True)


def test_query_equals_the_library(spark, model):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    rows = queries.queries()["op5_pieces"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = model.lib.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(model.lib.decode(ids).encode()).hexdigest()


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "x " * 50_000, 5), (3, "x " * 50_000, 5), (None, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.encode(docs, queries.piece_model_path()).collect()
    assert got[0]["ids"] == got[1]["ids"] == [1, 2] and got[2] == got[3] and got[4]["doc_id"] is None
    assert pieces.encode(docs.where("false"), queries.piece_model_path()).count() == 0
