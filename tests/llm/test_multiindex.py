import numpy as np
import pytest

from lakeloom.llm import multiindex, queries
from tests.conftest import SF


def brute(rows):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids = [i for i, _ in ok]
    x = np.array([v / np.linalg.norm(v) for _, v in ok])
    linked = x @ x.T >= 0.95
    label = {i: i for i in ids}
    for _ in ids:
        for a in range(len(ids)):
            low = min(label[ids[b]] for b in np.flatnonzero(linked[a]))
            label[ids[a]] = min(label[ids[a]], low)
    return {i: (int(linked[a].sum() - 1), label[i], label[i] == i) for a, i in enumerate(ids)}


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    return [(r["vec_id"], (r["n_links"], r["component_id"], r["kept"])) for r in multiindex.link_summary(df).collect()]


def test_multi_sequence_order():
    rng = np.random.default_rng(4)
    a, b = rng.random(7), rng.random(9)
    got = list(multiindex.multi_sequence(a, b))
    assert [t for *_, t in got] == pytest.approx(sorted((a[:, None] + b).ravel())) and len({g[:2] for g in got}) == 63


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 16))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 20] + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.5])]) for i in range(900)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(2000, [x * 2 for x in rows[5][1]])]
    assert dict(run(spark, rows)) == brute(rows)


def test_edges(spark):
    one = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, one), (2, one), (2, one), (3, [0.0] * 4), (4, None), (5, [float("nan"), 1.0, 0.0, 0.0]), (6, [None, 1.0, 0.0, 0.0]), (7, [1.0, 0.0]), (None, one), (8, [float("inf"), 0.0, 0.0, 1.0]), (9, [])]
    got = run(spark, rows)
    by = dict(got)
    assert len(got) == len(rows) and by[1] == (2, 1, True) and [v for k, v in got if k == 2] == [(2, 1, False)] * 2
    assert all(by[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9)) and by[None][0] == 0
    assert run(spark, [(1, None)]) == [(1, (0, 1, True))]
    assert multiindex.link_summary(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lengths_and_doubles(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i, dim in enumerate([2, 3, 16] * 60):
        v = np.ones(dim) + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.6])
        rows.append((i, [float(x) for x in v * 10.0 ** rng.integers(-200, 200)]))
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in multiindex.link_summary(df).collect()}
    want = {}
    for dim in (2, 3, 16):
        want |= brute([(i, list(np.array(v) / np.abs(v).max())) for i, v in rows if len(v) == dim])
    assert got == want


def test_distances_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    x, c = rng.normal(size=(300, 33)), rng.normal(size=(70, 33))
    whole = multiindex.exact_distances(x, c)
    for part in (slice(0, 1), slice(17, 40), slice(299, 300)):
        assert np.array_equal(whole[part], multiindex.exact_distances(x[part], c))
    raw = x.astype(np.float32).tobytes()
    assert np.array_equal(multiindex.unit(raw, 33)[5:6], multiindex.unit(x.astype(np.float32)[5:6].tobytes(), 33))


def test_query(spark):
    rows = queries.queries()["op7_embeddings"](spark, SF).collect()
    assert len(rows) == 500 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
