import random

import numpy as np
import pytest

from lakeloom.llm import neardup
from lakeloom.llm.components import components
from tests.llm.test_common import WORD, lower


def brute(rows, threshold=0.8):
    sets = []
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append((d, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    label = {d: d for d, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                p, q = root(a), root(b)
                label[max(p, q)] = min(p, q)
    return {d: root(d) for d, _ in sets}


def classes(spark, rows):
    docs = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, class_id int, bands string")
    return [(r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect()]


def test_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 47, 300).astype(np.uint64)
    b = np.concatenate([a[:240], rng.integers(1, 1 << 47, 60).astype(np.uint64)])
    s = neardup.prob_minhash(np.repeat([0, 1], 300), np.concatenate([a, b]), np.ones(600), 2, 3000)
    assert (s[0] == s[1]).mean() == pytest.approx(240 / 360, abs=0.04)
    # Weighted sets, also of another scale: x = (1, 3), y = (6, 2) over two elements give 1/2.
    s = neardup.prob_minhash(np.array([0, 0, 1, 1]), np.array([5, 9, 5, 9], np.uint64), np.array([1.0, 3.0, 6.0, 2.0]), 2, 4000)
    assert (s[0] == s[1]).mean() == pytest.approx(0.5, abs=0.04)


def test_signature_does_not_depend_on_the_batch():
    a = np.arange(1, 40).astype(np.uint64)
    alone = neardup.prob_minhash(np.zeros(39, np.int64), a, np.ones(39), 1, 160)
    crowd = neardup.prob_minhash(np.concatenate([np.zeros(39, np.int64), np.ones(9000, np.int64)]), np.concatenate([a, np.arange(100, 9100).astype(np.uint64)]), np.ones(9039), 2, 160)
    assert np.array_equal(alone[0], crowd[0])


def test_classes_equal_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    rows, base = [], [rng.choice(vocab) for _ in range(120)]
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        rows.append((i, " ".join(t)))
    passage = [rng.choice(vocab) for _ in range(60)]
    rows += [(100 + i, " ".join([rng.choice(vocab) for _ in range(40)] + passage)) for i in range(60)]
    rows += [(200 + i, f"copy of this very text number {i % 3} with some more words") for i in range(30)]
    rows += [(300, None), (301, ""), (302, "..."), (303, "one two"), (304, "ONE two!"), (305, "one"), (306, "word " * 40_000), (307, "word " * 39_000)]
    assert dict(classes(spark, rows)) == brute(rows)


def test_large_buckets_are_complete(spark):
    # All texts share a passage (similarity 0.78) and meet in large buckets; only the two of a pair are alike (0.81).
    base = [f"base{i}" for i in range(104)]
    rows = [(2 * p + k, " ".join(base + [f"pair{p}a", f"pair{p}b"] + [f"own{p}x{k}x{i}" for i in range(12)])) for p in range(100) for k in range(2)]
    assert dict(classes(spark, rows)) == brute(rows)


def test_repeated_lines_do_not_hide_a_link(spark):
    # Sets of similarity 0.81 each, whose weighted signatures agree in half of their components.
    rows = []
    for p in range(30):
        common = [f"common{p}x{i}" for i in range(48)]
        rows += [(2 * p, " ".join(common)), (2 * p + 1, " ".join(common + [f"line{p}x{i}" for i in range(6)] * 300))]
    want = brute(rows)
    assert all(want[2 * p + 1] == 2 * p for p in range(30)) and dict(classes(spark, rows)) == want


def test_shared_counts_all_pairs():
    rng = random.Random(3)
    sets = [np.array(sorted(rng.sample(range(60), rng.randint(0, 30))), np.int64) for _ in range(20)]
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in sets[:7]] for x in sets]
    assert neardup.shared(sets, sets[:7], 8).tolist() == want and neardup.shared([], sets).shape == (0, 20)


def test_edges(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (None, None)]
    got = sorted(classes(spark, rows), key=str)
    assert got == [(1, 1), (1, 1), (2, 1), (None, None), (None, None)]
    docs = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, source string")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "None", "None"]
    assert neardup.classes(docs.where("false")).count() == 0


def test_template_corpus_is_complete(spark):
    # 300 texts share a template of 1,000 words; the two of a pair are alike (0.82), those of different pairs are not (0.78).
    base = [f"T{i}" for i in range(1000)]
    rows = [(2 * p + k, " ".join(base + [f"pair{p}x{i}" for i in range(25)] + [f"own{p}x{k}x{i}" for i in range(112)])) for p in range(150) for k in range(2)]
    got = dict(classes(spark, rows))
    assert all(got[2 * p] == got[2 * p + 1] == 2 * p for p in range(150))


def test_repeated_ids_lose_no_text(spark):
    a, b, c = "alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red green blue white black grey"
    rows = [(7, a), (7, b), (8, b), (9, c), (9, c), (9, None), (10, ""), (10, ""), (None, a)]
    docs = spark.createDataFrame([(d, t, f"s{i}", 1) for i, (d, t) in enumerate(rows)], "doc_id long, text string, source string, node int")
    kept = sorted(((r["doc_id"], r["text"]) for r in neardup.keep_one(docs).collect()), key=str)
    assert kept == sorted([(7, a), (7, b), (9, c), (9, None), (10, ""), (10, ""), (None, a)], key=str)
    assert sorted(classes(spark, rows), key=str) == sorted([(7, 7), (7, 7), (8, 7), (9, 9), (9, 9), (9, 9), (10, 10), (10, 10), (None, None)], key=str)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (1, 0)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = root(a), root(b)
            label[max(p, q)] = min(p, q)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(label)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
