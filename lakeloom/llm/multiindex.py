"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut in halves and each half has its own codebook, fitted on a bounded sample; the product of the two
codebooks is a grid of cells, and every vector is filed in one. A search walks the grid by multi-sequence traversal,
nearest cells first, and goes on until the summed distance of its cells exceeds that of its nearest cell by a slack that
is calibrated on the sample: partners at exactly the threshold are found with probability ``TARGET`` from each side, so
a pair is missed only if both walks miss it. All vectors of the cells visited are verified in double precision.

Equal vectors are one class from the start and count as links without being paired. Cells are cut into blocks of about
``BLOCK`` classes; the work is block against block, and what leaves it is a count for each vector and a spanning forest
of the links, never the pairs.

Components are kept as stored (float or double) and every product is in double precision. Whether a walk visits a cell
is one computation, the same wherever it is asked for, so that no pair is counted twice or never.

Edge cases: vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different
lengths do not link, and each length has an index of its own; a null ``vec_id`` links with nothing; rows with equal
``vec_id`` but different vectors fall into one component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches, discard, materialize
from lakeloom.llm.components import components

THRESHOLD = 0.95
SAMPLE, TARGET, BLOCK = 8192, 0.98, 256
#: Classes of a cell aimed at, and the most centroids of a half.
PER_CELL, MOST = 128, 1024


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = distances(x, centroids).argmin(1)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
        if not full.all():
            centroids[~full] = x[rng.choice(len(x), (~full).sum())]
    return centroids


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1))


def exact_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, to the last bit the same for a vector whatever others are beside it: no matrix product, whose
    order of additions depends on the shapes."""
    out = np.empty((len(x), len(centroids)))
    step = max(1, (1 << 20) // max(1, centroids.size))
    for a in range(0, len(x), step):
        gap = x[a : a + step, None, :] - centroids[None]
        out[a : a + step] = np.add.reduce(np.ascontiguousarray(gap * gap), axis=2)
    return out


def multi_sequence(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Pairs of centroids by growing sum of their distances, from two lists of distances."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen = [(float(d1[o1[0]] + d2[o2[0]]), 0, 0)], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        yield int(o1[i]), int(o2[j]), total
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(o1) and b < len(o2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (float(d1[o1[a]] + d2[o2[b]]), a, b))


class MultiIndex:
    """Codebooks of both halves and the slack of a walk."""

    def __init__(self, sample: np.ndarray, expected: int, threshold: float = THRESHOLD, target: float = TARGET):
        self.dim = sample.shape[1]
        self.half = max(1, self.dim // 2)
        k = int(np.clip(np.ceil(np.sqrt(expected / PER_CELL)), 2, MOST))
        self.c1 = kmeans(sample[:, : self.half], k)
        self.c2 = kmeans(sample[:, self.half :], k) if self.dim > self.half else np.zeros((1, 0))
        rng = np.random.default_rng(5)
        x = sample[:2048]
        u = rng.normal(size=x.shape)
        u -= (u * x).sum(1, keepdims=True) * x
        u /= np.maximum(1e-12, np.linalg.norm(u, axis=1, keepdims=True))
        a, b = self.both(x), self.assign(threshold * x + np.sqrt(1 - threshold**2) * u)
        r = np.arange(len(x))
        extra = a[0][r, b // len(self.c2)] + a[1][r, b % len(self.c2)] - a[0].min(1) - a[1].min(1)
        self.slack = float(np.quantile(extra, target)) + 1e-9

    def both(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return exact_distances(x[:, : self.half], self.c1), exact_distances(x[:, self.half :], self.c2)

    def limits(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """How far each vector's walk goes."""
        return d1.min(1) + d2.min(1) + self.slack

    def assign(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.both(x)
        return d1.argmin(1) * len(self.c2) + d2.argmin(1)

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """Cells that each vector's walk visits."""
        d1, d2 = self.both(x)
        out = []
        for a, b, limit in zip(d1, d2, self.limits(d1, d2)):
            cells = []
            for i, j, total in multi_sequence(a, b):
                if total > limit:
                    break
                cells.append(i * len(self.c2) + j)
            out.append(cells)
        return out

    def would_visit(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Whether each vector's walk visits the cell beside it."""
        d1, d2 = self.both(x)
        r = np.arange(len(x))
        return d1[r, cell // len(self.c2)] + d2[r, cell % len(self.c2)] <= self.limits(d1, d2)


def unit(raw: bytes, dim: int, kind: type = np.float32) -> np.ndarray:
    x = np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64)
    # The largest component becomes 1 first: squares of very large or small ones would be infinite or zero.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.add.reduce(x * x, axis=1, keepdims=True))


def _valid(v: str) -> F.Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(v).isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked node of a block pair with the smallest node of its part of the link graph."""
    a, b = left.copy(), right.copy()
    top = np.iinfo(np.int64).max
    while True:
        a2 = np.minimum(a, np.where(linked, b[None, :], top).min(1))
        b2 = np.minimum(b, np.where(linked, a2[:, None], top).min(0))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    node, low = np.concatenate([left, right]), np.concatenate([a, b])
    return node[node != low], low[node != low]


def link_summary(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``."""
    double = vectors.select("embedding").schema[0].dataType.elementType.typeName() != "float"
    kind = "double" if double else "float"
    rows = bound_batches(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
    ok = F.coalesce(_valid("v"), F.lit(False)) & F.col("vec_id").isNotNull()
    # Minus zero equals zero.
    keyed = rows.withColumn("v", F.when(ok, F.transform("v", lambda x: x + F.lit(0.0).cast(kind))))
    out = keyed.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    lengths = keyed.where("v is not null").groupBy(F.size("v").alias("dim")).count().collect()
    for dim in sorted(r["dim"] for r in lengths):
        out = out.unionByName(_of_length(keyed.where(F.size("v") == dim), dim, np.float64 if double else np.float32, threshold, target))
    return out


def _of_length(keyed: DataFrame, dim: int, kind: type, threshold: float, target: float) -> DataFrame:
    """The summary of valid vectors of one length."""
    spark = keyed.sparkSession
    keyed = keyed.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64("v", F.lit(1)))
    nodes = materialize(keyed.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v")))
    n = nodes.count()
    picked = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("v").collect()
    index = MultiIndex(unit(np.array([r["v"] for r in picked], kind).tobytes(), dim, kind), n, threshold, target)
    shared = spark.sparkContext.broadcast(index)

    filed_schema = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("cell", pa.int64()), ("raw", pa.binary())])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind)
            cells = shared.value.assign(unit(raw.tobytes(), dim, kind))
            own = [x.tobytes() for x in raw.reshape(-1, dim)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells), pa.array(own, pa.binary())], schema=filed_schema)

    filed = nodes.select("node", "copies", "v").mapInArrow(file, "node long, copies long, cell long, raw binary")
    filed = materialize(filed)
    occupied = filed.groupBy("cell").agg(F.count("*").alias("held"))
    # A cell's classes are dealt to blocks by hash, so that no block grows with the cell. The grid has at most MOST**2
    # cells, which bounds the table that is broadcast.
    dealt = filed.join(F.broadcast(occupied), "cell").withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("held") / BLOCK)))
    lists = dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("node", "copies", "raw")).alias("l"))
    lists = lists.select("cell", F.col("l.node").alias("nodes"), F.col("l.copies").alias("copies"), F.col("l.raw").alias("raws"))

    block_schema = pa.schema([("cell", pa.int64()), ("nodes", pa.binary()), ("copies", pa.binary()), ("raw", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(
                    [{"cell": r["cell"], "nodes": np.array(r["nodes"], np.int64).tobytes(), "copies": np.array(r["copies"], np.int64).tobytes(), "raw": b"".join(r["raws"])}],
                    schema=block_schema,
                )

    blocks = materialize(lists.mapInArrow(pack, "cell long, nodes binary, copies binary, raw binary"))

    walk_schema = pa.schema([("target", pa.int64()), ("q_nodes", pa.binary()), ("q_copies", pa.binary()), ("q_cell", pa.int64()), ("q_raw", pa.binary())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                nodes_, copies, raw = (np.frombuffer(r[c], t) for c, t in (("nodes", np.int64), ("copies", np.int64), ("raw", kind)))
                raw = raw.reshape(-1, dim)
                who: dict[int, list[int]] = {}
                for i, cells in enumerate(shared.value.visits(unit(r["raw"], dim, kind))):
                    for c in cells:
                        who.setdefault(c, []).append(i)
                for c, i in sorted(who.items()):
                    yield pa.RecordBatch.from_pylist(
                        [{"target": c, "q_nodes": nodes_[i].tobytes(), "q_copies": copies[i].tobytes(), "q_cell": r["cell"], "q_raw": raw[i].tobytes()}], schema=walk_schema
                    )

    walks = blocks.mapInArrow(walk, "target long, q_nodes binary, q_copies binary, q_cell long, q_raw binary")
    met = walks.join(blocks, walks["target"] == blocks["cell"])
    found_schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q, y = np.frombuffer(r["q_nodes"], np.int64), np.frombuffer(r["nodes"], np.int64)
                qc, yc = np.frombuffer(r["q_copies"], np.int64), np.frombuffer(r["copies"], np.int64)
                x, z = unit(r["q_raw"], dim, kind), unit(r["raw"], dim, kind)
                linked = (x @ z.T >= threshold) & (q[:, None] != y[None, :])
                if not linked.any():
                    continue
                # A pair that both walks meet counts for each from its own walk; else this walk counts for both.
                once = linked & ~shared.value.would_visit(z, np.full(len(z), r["q_cell"]))[None, :]
                counts = np.concatenate([linked @ yc, once.T @ qc])
                node, low = _forest(linked, q, y)
                every = np.concatenate([q, y])
                live = counts > 0
                none = np.full(len(node), -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([every[live], node])),
                        pa.array(np.concatenate([counts[live], np.zeros(len(node), np.int64)])),
                        pa.array(np.concatenate([np.full(live.sum(), -1), low]), mask=np.concatenate([np.ones(live.sum(), bool), none > 0])),
                    ],
                    schema=found_schema,
                )

    found = materialize(met.select("q_nodes", "q_copies", "q_cell", "q_raw", "nodes", "copies", "raw").mapInArrow(verify, "node long, links long, low long"))
    counted = materialize(found.groupBy("node").agg(F.sum("links").alias("links")))
    labels = components(found.where("low is not null").select(F.col("node").alias("a"), F.col("low").alias("b")))
    named = nodes.select("h1", "h2", "node", "copies").join(counted, "node", "left").join(labels, "node", "left")
    named = named.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("label", "node").alias("c"))
    discard(filed, blocks, found)
    linked = keyed.select("vec_id", "h1", "h2").join(named, ["h1", "h2"])
    return linked.select("vec_id", F.col("n").cast("long").alias("n_links"), F.col("c").alias("component_id"), (F.col("vec_id") == F.col("c")).alias("kept"))
