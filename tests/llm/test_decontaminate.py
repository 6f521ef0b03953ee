import hashlib
import random

import pytest

from lakeloom.llm import decontaminate, queries
from lakeloom.llm.common import read_table
from tests.conftest import SF
from tests.llm.test_common import WORD, lower


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = WORD.findall(lower(text or ""))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    lengths = sorted({len(k) for k in wins})
    out = {}
    for doc, text in docs:
        w = WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    found |= wins[tuple(w[i : i + n])]
        ids = ",".join(sorted(found))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def answer(rows):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, sf, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in read_table(spark, sf, "benchmark").collect()]
    assert answer(queries.queries()["op10_decontamination"](spark, sf).collect()) == brute(docs, items)


def test_random_small_words(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice(["a", "B", "é", "日", "1"]) + rng.choice([" ", "  ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.randint(0, 14))) for i in range(25)] + [(7, text(12)), (90, None), (91, ""), (None, "x y")]
    docs = [(i, text(rng.randint(0, 200))) for i in range(150)] + [(900, None), (901, ""), (902, "--")]
    d = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, item_ids int")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.scan(d, b).collect()
    assert answer(rows) == brute(docs, items)
    texts = dict(docs)
    for r in rows:
        assert sum(len(WORD.findall(lower(texts[r["doc_id"]][s["start"] : s["end"]]))) for s in r["spans"]) == r["n_hit"]
    clean = decontaminate.drop_contaminated(d, b)
    assert clean.columns == d.columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in rows if not r["contaminated"]}


def test_shards_and_digits_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "d", "e", "f", "g"]) for _ in range(n))
    items, docs = [(i % 20 if i else None, text(rng.randint(0, 9))) for i in range(40)], [(i, text(rng.randint(0, 60))) for i in range(60)] + [(100, None)]
    d = spark.createDataFrame([(a, b, "k", 1) for a, b in docs], "doc_id long, text string, ids string, ranges int")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 4)
    for size, base in ((1 << 20, 16), (1 << 20, 2), (100, 16)):
        monkeypatch.setattr(decontaminate, "ONE_PASS", size)
        if base == 2:
            # Workers read the real base; the matcher of this process shows that more digits a word change nothing.
            monkeypatch.setattr(decontaminate, "BASE", base)
            matcher = decontaminate.Matcher(items, 4)
            for i, x in docs:
                n, ranges, found = matcher.hits(x)
                assert (n, sum(q - p for p, q in ranges), len(found), bool(ranges)) == (*want[i][:3], want[i][4])
            monkeypatch.undo()
            continue
        assert answer(decontaminate.scan(d, b, 4).collect()) == want
        clean = decontaminate.drop_contaminated(d, b, 4)
        assert clean.columns == d.columns and {r["doc_id"] for r in clean.collect()} == {i for i, w in want.items() if not w[4]}


def test_long_texts_and_empty_tables(spark):
    matcher = decontaminate.Matcher([(1, "a b c d e f"), (2, "c d e")], 3)
    assert matcher.hits("x a b c d e f y") == (8, [(1, 7)], {"1", "2"})
    d = spark.createDataFrame([(1, "q " * 300_000 + "one two three"), (1, "q")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "One, two THREE")], "item_id long, text string")
    assert sorted((r["n_words"], r["n_hit"]) for r in decontaminate.scan(d, b).collect()) == [(1, 0), (300_003, 3)]
    assert decontaminate.scan(d, b.where("false")).where("contaminated").count() == 0
    assert decontaminate.scan(d.where("false"), b).count() == 0
