import re

import numpy as np
import pyarrow as pa

from lakeloom.llm import common

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_flat_text_with_nulls_and_slices():
    col = pa.array(["ab", None, "", "é"]).slice(1)
    raw, offsets = common.flat_text(col)
    assert raw.tobytes().decode() == "é" and offsets.tolist() == [0, 0, 0, 2]
    assert common.flat_text(pa.array([], pa.string()))[1].tolist() == [0]


def test_text_groups_cover_all_rows_once():
    col = pa.array(["x" * n for n in (3, 0, 10, 1, 1, 50, 0)])
    groups = list(common.text_groups(col, 8))
    assert [g[0] for g in groups] == [0, *[g[1] for g in groups[:-1]]] and groups[-1][1] == 7
    assert sum(len(g[2]) for g in groups) == 65


def test_words_agree_with_the_pattern():
    texts = ["Hello, wörld 12", "", "a", "--", "x_y Z", "日本 語", "tail", "tail "]
    value, row, start, end, _ = common.words_of(*common.flat_text(pa.array(texts)))
    raw = "".join(texts).encode()
    got = [(int(r), raw[a:b].decode()) for r, a, b in zip(row, start, end)]
    assert [(i, lower(w)) for i, w in got] == [(i, m) for i, t in enumerate(texts) for m in WORD.findall(lower(t))]
    by = {}
    for v, (_, w) in zip(value.tolist(), got):
        assert by.setdefault(lower(w), v) == v
    assert len(set(by.values())) == len(by)


def test_word_hashes_do_not_depend_on_place():
    a = common.words_of(*common.flat_text(pa.array(["same words here"])))[0]
    b = common.words_of(*common.flat_text(pa.array(["x" * 70_000 + " same words here"])))[0]
    assert np.array_equal(a, b[1:])


def test_materialize_and_discard(spark):
    df = common.materialize(spark.range(5))
    assert df.count() == 5
    common.discard(df)
    common.discard(spark.range(1))
    assert common.materialize(spark.range(0)).count() == 0
