import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import quality, queries, toxicity
from lakeloom.llm.common import flat_text, held_out_bucket, labelled_sample, read_table
from tests.conftest import SF


@pytest.fixture(scope="module")
def judged(spark):
    labels = {r["doc_id"]: r for r in read_table(spark, SF, "labels").collect()}
    out = {}
    for name in ("op1_quality", "op9_toxicity"):
        rows = queries.queries()[name](spark, SF).collect()
        assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
        out[name] = (rows, labels)
    return out


@pytest.mark.parametrize("name, label, cut, least", [("op1_quality", "quality", 0.5, 0.95), ("op9_toxicity", "toxic", 0.7, 0.9)])
def test_held_out_accuracy(judged, name, label, cut, least):
    rows, labels = judged[name]
    held = [(r["predicted"], labels[r["doc_id"]][label]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) >= least
    assert all(r["predicted"] == (r["score"] >= cut) for r in rows)


def test_held_out_fold(spark):
    from pyspark.sql import functions as F

    rows = spark.range(50).select("id", held_out_bucket(F.col("id"), 3).alias("b")).collect()
    assert all(r["b"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, module):
    good, bad = "the quiet river runs by the old town. " * 5, "you idiot clown!! $$$ trash &&& " * 5
    model = module.train([(good, 1), (bad, 0)] * 10 if module is quality else [(good, 0), (bad, 1)] * 10)
    long = good * 20_000
    rows = [(1, None, "x"), (2, "", "x"), (3, good, "x"), (3, good, "x"), (4, long, None), (None, bad, "x")]
    got = module.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    by = sorted((str(r["doc_id"]), r["score"]) for r in got)
    assert len(by) == 6 and all(0 <= s <= 1 for _, s in by)
    one, two, three, four = (dict(by)[k] for k in "1234")
    assert one == two and [s for k, s in by if k == "3"] == [three, three]
    none = dict(by)["None"]
    assert (three > none and four > none) if module is quality else (three < 0.5 < none and four < 0.5 and one == 0)
    assert module.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_one_class_only():
    assert 1 / (1 + np.exp(-quality.train([("a", 1)]).forward(*flat_text(pa.array(["b"]))))) > 0.99
    assert toxicity.train([("a", 0)]).score(*flat_text(pa.array(["b c."])))[0][0] < 0.01
    assert toxicity.train([]).score(*flat_text(pa.array(["b"])))[0][0] < 0.01


def test_network_matches_a_plain_version():
    model = quality.train([("aa bb cc", 1), ("!!! ### $$$", 0)], epochs=1, batch=2)
    for text in ("short", "x" * 1000, "mixed Words, 12 " * 60):
        raw, offsets = flat_text(pa.array([text]))
        blocks = max(1, -(-len(raw) // quality.BLOCK))
        padded = np.zeros(blocks * quality.BLOCK + quality.WIDTH, np.uint8)
        padded[: len(raw)] = raw
        p, tops = model.p, []
        for b in range(blocks):
            best = np.full(quality.FILTERS, -np.inf)
            for at in range(b * quality.BLOCK, min((b + 1) * quality.BLOCK, blocks * quality.BLOCK - quality.WIDTH + 1), quality.STRIDE):
                best = np.maximum(best, p["e"][padded[at : at + quality.WIDTH]].ravel() @ p["w1"] + p["b1"])
            tops.append(best)
        chunks, first = [], 0
        while True:
            chunks.append(np.max(tops[first : first + quality.CHUNK], axis=0))
            if first + quality.CHUNK >= blocks:
                break
            first += quality.STEP
        h = np.maximum(np.maximum(np.array(chunks), 0) @ p["w2"] + p["b2"], 0)
        want = np.concatenate([h.mean(0), h.max(0)]) @ p["w3"] + p["b3"]
        assert model.forward(raw, offsets)[0] == pytest.approx(want, abs=1e-3)
        # Neighbours in a batch change nothing.
        among = model.forward(*flat_text(pa.array(["before " * 9, text, "after"])))[1]
        assert among == pytest.approx(want, abs=1e-3)


def test_samples_are_whole_texts_within_bounds(spark, tmp_path):
    rows = [(i, "w" * (10 + 100 * (i % 2)), i % 3 == 0) for i in range(60)] + [(0, "another text of one id", True)] * 5
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[2])) for r in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    every = labelled_sample(spark, str(tmp_path), "toxic", 100, 1 << 20)
    texts = {t for _, t, _ in rows}
    assert {t for t, _ in every} <= texts and len(every) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))
    few = labelled_sample(spark, str(tmp_path), "toxic", 4, 400)
    assert {t for t, _ in few} <= texts and sum(y for _, y in few) <= 4 and sum(len(t) for t, _ in few) <= 400


def test_noisy_or_and_offending_sentences(spark):
    assert toxicity.noisy_or(np.array([0.0, 0.0]), np.array([0, 0]), 2).tolist() == pytest.approx([0.75, 0.0])
    clean = ["the river is calm today", "we walk along the road", "é ü plain words only"]
    rows = [(f"{c}. and {w} you. {c}", 1) for c in clean for w in ("idiot", "moron")] * 3 + [(c, 0) for c in clean] * 12
    model = toxicity.train(rows)
    text = "é ü plain. Fine line! You idiot there? Fine."
    r = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert r["score"] > 0.7 and [text[o["start"] : o["end"]] for o in r["offending"]] == ["You idiot there"]
