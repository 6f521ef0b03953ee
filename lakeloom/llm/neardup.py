"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is its distinct shingles of five words, each weighted ``1 + ln(count)``. Every shingle is a Poisson process
whose rate is its weight; its arrivals fall on random components of the signature, and a component keeps the earliest.
A shingle stops as soon as its next arrival is later than all components (early termination), so a document costs about
its shingles plus the signature's length. Two signatures agree in a component with the probability Jaccard of the two
weighted sets. Bands of the signature propose pairs; the Jaccard similarity of the exact shingle sets decides. Repeated
shingles can make the probability Jaccard much smaller than that of the sets, so a document that has some also files the
bands of its signature with all weights 1, whose agreement is the Jaccard similarity of the sets. (Without repeated
shingles both signatures are the same.)

Documents with equal shingle counts are one class from the start, so copies are never paired. Buckets of at most
``SMALL`` classes are compared pair by pair. In a larger one all members are compared with one pivot, which joins most of
a group of near copies; where several components are left, every member outside the largest one is then compared with
every member, block against block, so that each pair of a bucket is either compared or joined already. A pair of blocks
emits a forest; no step emits all pairs of a large group.

Edge cases: a text of fewer than five words is one shingle of all its words; null, empty and wordless texts have no
shingle and are a class each; rows with equal ``doc_id`` and different texts are documents of their own, each with the
class of its text; a null ``doc_id`` links with nothing; other columns are ignored by :func:`classes` and kept by
:func:`keep_one` (but ``_near_text``, a name it uses).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches, discard, materialize, mix64, text_groups, words_of
from lakeloom.llm.components import components, merged

SHINGLE, THRESHOLD = 5, 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32, about 3 in a million, whatever its counts:
#: the bands of weight 1 are among those of every document.
BANDS, ROWS = 32, 5
#: Classes of a bucket up to which all pairs are listed; larger ones take a pivot and blocks.
SMALL = 16
#: Documents of a block at most, and shingles of a block (fewer documents where a bucket has long ones).
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
_LOW48 = np.uint64((1 << 48) - 1)


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: row, 48-bit hash and count, in that order's sort."""
    value, row, _, _, _ = words_of(raw, offsets)
    n = len(offsets) - 1
    words = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    first = np.cumsum(words) - words
    grams = np.where(words >= size, words - size + 1, (words > 0).astype(np.int64))
    owner = np.repeat(np.arange(n), grams)
    start = np.repeat(first, grams) + np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams)
    length = np.minimum(size, words)[owner]
    h = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            here = k < length
            word = value[np.minimum(start + k, max(0, len(value) - 1))] if len(value) else h
            h = np.where(here, mix64(h * np.uint64(0x9E3779B97F4A7C15) + word), h)
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (h & _LOW48))
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lead = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(lead, len(keys)))
    keys = keys[lead]
    return (keys >> np.uint64(48)).astype(np.int64), keys & _LOW48, counts


def prob_minhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """Signatures (n x k) of weighted sets: the element whose process reaches a component first."""
    earliest = np.full(n * k, np.inf)
    holder = np.zeros(n * k, np.uint64)
    live, at, drawn = np.arange(len(row)), np.zeros(len(row)), 0
    while len(live):
        # Few processes left: draw many of their arrivals in one go.
        points = 1 if len(live) > 4000 else 32
        steps = np.arange(drawn + 1, drawn + points + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            noise = mix64(mix64(element[live])[:, None] + steps * np.uint64(0xD1342543DE82EF95))
            slot = (mix64(noise + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(33)) % np.uint64(k)
        gaps = -np.log(((noise >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[live][:, None]
        x = at[:, None] + np.cumsum(gaps, axis=1)
        cell = (row[live][:, None] * k + slot.astype(np.int64)).ravel()
        flat = x.ravel()
        np.minimum.at(earliest, cell, flat)
        won = flat == earliest[cell]
        holder[cell[won]] = np.repeat(element[live], points)[won]
        limit = earliest.reshape(n, k).max(1)
        on = x[:, -1] <= limit[row[live]]
        live, at, drawn = live[on], x[on, -1], drawn + points
    return holder.reshape(n, k)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :bands])
    return h


_SIGN = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, raw, offsets in text_groups(batch.column(1)):
            n = end - first
            row, element, count = shingles(raw, offsets)
            signature = prob_minhash(row, element, 1 + np.log(count), n, BANDS * ROWS)
            size = np.bincount(row, minlength=n)
            digest = []
            with np.errstate(over="ignore"):
                for salt in (1, 2):
                    part = mix64(mix64(element + np.uint64(salt << 50)) + count.astype(np.uint64))
                    total = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
                    stop = np.cumsum(size)
                    digest.append(total[stop] - total[stop - size])
            keys = band_keys(signature)
            twice = np.unique(row[count > 1])
            some = np.isin(row, twice)
            plain = keys.copy()
            plain[twice] = band_keys(prob_minhash(np.searchsorted(twice, row[some]), element[some], np.ones(some.sum()), len(twice), BANDS * ROWS))
            filed = np.concatenate([np.ones_like(keys, bool), plain != keys], axis=1)
            cuts = np.concatenate([[0], np.cumsum(filed.sum(1))]).astype(np.int32)
            keys = np.concatenate([keys, plain], axis=1)[filed]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, n),
                    batch.column(2).slice(first, n),
                    *(pa.array(d.view(np.int64)) for d in digest),
                    pa.array(size),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.view(np.int64))),
                ],
                schema=_SIGN,
            )


_SET = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, raw, offsets in text_groups(batch.column(1)):
            row, element, _ = shingles(raw, offsets)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=end - first))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first), pa.ListArray.from_arrays(pa.array(cuts), pa.array(element.view(np.int64)))], schema=_SET
            )


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (u, v) whose exact shingle sets have a Jaccard similarity of at least ``threshold``."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v"
    )
    common = F.size(F.array_intersect("su", "sv"))
    return both.where(common >= F.lit(threshold) * (F.size("su") + F.size("sv") - common) - 1e-9).select(F.col("u").alias("a"), F.col("v").alias("b"))


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shared(a: list[np.ndarray], b: list[np.ndarray], step: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all sets of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    rows = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (a, b)]
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
    both = np.intersect1d(*flat)
    at = [np.searchsorted(both, x) for x in flat]
    held = [np.flatnonzero(both[np.minimum(k, len(both) - 1)] == x) if len(both) else np.zeros(0, np.int64) for k, x in zip(at, flat)]
    held = [h[np.argsort(k[h], kind="stable")] for h, k in zip(held, at)]
    columns = [k[h] for h, k in zip(held, at)]
    for first in range(0, len(both), step):
        tables = []
        for h, c, r, n in zip(held, columns, rows, out.shape):
            low, high = np.searchsorted(c, [first, first + step])
            table = np.zeros((n, min(step, len(both) - first)), np.float32)
            table[r[h[low:high]], c[low:high] - first] = 1
            tables.append(table)
        out += (tables[0] @ tables[1].T).astype(np.int64)
    return out


def _forest(cell: pa.Table) -> pa.Table:
    """Links of a cell's two blocks that join components: at most one less than the components."""
    node, label, side = (cell.column(k).to_numpy() for k in ("node", "label", "side"))
    column = cell.column("shingles").combine_chunks()
    cuts = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    sets = [flat[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    found = []
    if len(one) and len(two):
        common = shared([sets[k] for k in one], [sets[k] for k in two])
        size = np.diff(cuts)
        near = common >= THRESHOLD * (size[one][:, None] + size[two][None, :] - common) - 1e-9
        u, v = np.nonzero(near & (label[one][:, None] != label[two][None, :]))
        u, v = one[u], two[v]
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        first = np.unique(np.stack([label[u], label[v]], 1), axis=0, return_index=True)[1] if len(u) else []
        for k in first:
            p, q = root(int(label[u[k]])), root(int(label[v[k]]))
            if p != q:
                top[max(p, q)] = min(p, q)
                found.append((int(node[u[k]]), int(node[v[k]])))
    return pa.Table.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=_LINKS)


def block_links(named: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: links that join the components (``label``) left in the buckets of ``key, node, n, label``."""
    parts = named.groupBy("key", "label").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    open_ = parts.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("c"), F.max("n").alias("most"), F.count("*").alias("parts"))
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / F.col("most"))))
    open_ = open_.where("parts > 1").select("key", F.col("top.label").alias("top"), F.ceil((F.col("c") - F.col("top.c")) / width).alias("ni"), F.ceil(F.col("c") / width).alias("nj"))
    members = named.join(open_, "key")

    def dealt(rows: DataFrame, side: int, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("node", "key", F.lit(side)), F.col(f"n{own}")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), (F.col(f"n{other}") - 1).cast("int"))).alias(other)
        return rows.select("key", "node", "label", F.lit(side).alias("side"), mine, every).select("key", "node", "label", "side", "i", "j")

    cells = dealt(members.where("label <> top"), 0, "i", "j").unionByName(dealt(members, 1, "j", "i"))
    return cells.join(sets, "node").groupBy("key", "i", "j").applyInArrow(_forest, "a long, b long")


class _Found:
    """What the links say: every row with its digests, every text class with its representative row and component."""

    def __init__(self, signed: DataFrame, nodes: DataFrame, labels: DataFrame):
        self.signed, self.nodes, self.labels = signed, nodes, labels

    def parts(self) -> DataFrame:
        """``node, label`` with the first row (``doc``, ``t``) of the component."""
        named = self.nodes.select("node", "d1", "d2", "doc", "t").join(self.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        tops = named.groupBy("label").agg(F.min(F.struct("doc", "t")).alias("top"))
        return named.select("d1", "d2", "label").join(tops, "label").select("d1", "d2", F.col("top.doc").alias("class_id"), F.col("top.t").alias("class_t"))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return bound_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))


def _find(docs: DataFrame) -> _Found:
    """Links every pair of similarity 0.8. A node is a class of texts with equal shingle counts; its number is its own, so
    that ids which several texts carry cannot be confused, and its representative is its first row by id."""
    texts = _texts(docs)
    signed = materialize(texts.mapInArrow(_signatures, "doc_id long, t long, d1 long, d2 long, n long, bands array<long>"))
    grouped = signed.where("n > 0 and doc_id is not null").groupBy("d1", "d2")
    grouped = grouped.agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = materialize(grouped.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", F.col("rep.doc_id").alias("doc"), F.col("rep.t").alias("t"), "n", "bands"))
    filed = nodes.select("node", "n", F.explode("bands").alias("key"))
    sizes = filed.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).where("c > 1")
    members = materialize(filed.join(sizes, "key").select("key", "node", "n", "c", "pivot"))
    alike = F.least("n", "m") >= F.lit(THRESHOLD) * F.greatest("n", "m") - 1e-9

    small = members.where(F.col("c") <= SMALL)
    other = small.select("key", F.col("node").alias("v"), F.col("n").alias("m"))
    small_pairs = small.withColumnRenamed("node", "u").join(other, "key").where("u < v").where(alike).select("u", "v")
    large = members.where(F.col("c") > SMALL)
    first = sizes.where(F.col("c") > SMALL).select("pivot").distinct()
    pivots = nodes.join(first, nodes["node"] == first["pivot"]).select("pivot", F.col("n").alias("m"))
    large_pairs = large.select("node", "n", "pivot").distinct().join(pivots, "pivot").where("node <> pivot").where(alike)
    pairs = small_pairs.unionByName(large_pairs.select(F.col("pivot").alias("u"), F.col("node").alias("v"))).distinct()
    pairs = materialize(pairs)

    # Texts that can have a partner: both ends of the pairs, and all of large buckets, by their representative rows.
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).unionByName(large.select("node")).distinct()
    wanted = nodes.select("node", F.col("doc").alias("doc_id"), "t").join(wanted, "node", "left_semi")
    sets = materialize(texts.join(wanted, ["doc_id", "t"]).dropDuplicates(["node"]).select("node", "text").mapInArrow(_sets, "node long, shingles array<long>"))
    links = materialize(verified(pairs, sets))
    labels = materialize(components(links))

    done = [members, pairs, sets, links]
    if large.take(1):
        named = large.select("key", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        rest = materialize(block_links(named, sets))
        done.append(rest)
        if rest.take(1):
            done.append(labels)
            labels = materialize(merged(labels, rest))

    discard(*done)
    return _Found(signed, nodes, labels)


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` of every row: the smallest doc_id among all documents that links of similarity 0.8 join."""
    found = _find(docs)
    out = found.signed.select("doc_id", "d1", "d2", "n").join(found.parts().drop("class_t"), ["d1", "d2"], "left")
    return out.select("doc_id", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The first document (by id, then by its text's hash) of each class, all columns unchanged; rows that are a class
    each (without an id, or without a word) all stay. Of rows with equal id and text that represent a class one stays."""
    found = _find(docs)
    kept = found.parts().select(F.col("class_id").alias("doc_id"), F.col("class_t").alias("_near_text")).distinct()
    keyed = docs.withColumn("_near_text", F.xxhash64(F.col("text").cast("string")))
    alone = found.signed.where("n = 0 and doc_id is not null").select("doc_id", F.col("t").alias("_near_text")).distinct()
    same = [keyed["doc_id"].cast("long") == kept["doc_id"], keyed["_near_text"] == kept["_near_text"]]
    once = keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_near_text"]).select(docs.columns)
    same = [keyed["doc_id"].cast("long") == alone["doc_id"], keyed["_near_text"] == alone["_near_text"]]
    wordless = keyed.join(alone, same, "left_semi").select(docs.columns)
    return once.unionByName(wordless).unionByName(docs.where(F.col("doc_id").isNull()))
