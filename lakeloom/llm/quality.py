"""Quality by a byte-level convolutional network in numpy.

Every byte becomes a row of a learned table; learned filters of ``WIDTH`` bytes slide over the whole document, one place
after every ``STRIDE`` bytes; their outputs are max-pooled over overlapping chunks, a hidden layer reads each chunk, and
the mean and maximum over all chunks give one probability. Memory is bounded by a group of texts; no text is cut, in
training or in scoring.

Edge cases: null and empty texts are one padded chunk of nothing and get the network's score for it; repeated rows
score alike; with no labelled row of one class every score is the other class's; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches, flat_text, labelled_sample, text_groups

#: Bytes of a filter, between its places, of a pooling block, and blocks of a chunk and between chunks.
WIDTH, STRIDE, BLOCK, CHUNK, STEP = 8, 2, 64, 4, 3
#: Numbers that a byte is learned as, filters, and units that read a chunk.
EMBED, FILTERS, HIDDEN = 8, 48, 24
#: Bounds of the training sample: rows of each class, and bytes of all of them (whole texts).
PER_CLASS, MAX_BYTES = 700, 16 << 20


def layout(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts padded with zeros to whole blocks: padded bytes, first block of each text (one more than texts), and the
    number of its blocks."""
    lengths = np.diff(offsets)
    blocks = np.maximum(1, -(-lengths // BLOCK))
    first = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
    if len(raw):
        out[np.arange(len(raw)) + np.repeat(first[:-1] * BLOCK - offsets[:-1], lengths)] = raw
    return out, first, blocks


def chunk_index(first: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of every chunk (chunks x CHUNK, the last block again where a text ends) and first chunk of each text."""
    chunks = np.maximum(1, -(-(blocks - (CHUNK - STEP)) // STEP))
    start = np.concatenate([[0], np.cumsum(chunks)])
    within = np.arange(start[-1]) - np.repeat(start[:-1], chunks)
    base, last = np.repeat(first[:-1], chunks), np.repeat(first[1:] - 1, chunks)
    return np.minimum(base[:, None] + within[:, None] * STEP + np.arange(CHUNK), last[:, None]), start


class QualityModel:
    """Table of bytes e, filters w1 and b1, chunk layer w2 and b2, and the output layer w3 and b3."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = {k: np.asarray(v, np.float32) for k, v in params.items()}

    def forward(self, raw: np.ndarray, offsets: np.ndarray, trace: bool = False):
        p = self.p
        padded, first, blocks = layout(raw, offsets)
        n = len(padded) - WIDTH
        x = np.lib.stride_tricks.as_strided(p["e"][padded], (n // STRIDE, WIDTH * EMBED), (STRIDE * EMBED * 4, 4))
        conv = x @ p["w1"]
        per = BLOCK // STRIDE
        # A text's last places reach into the next text; those before have their bytes.
        for k in range(1, -(-WIDTH // STRIDE)):
            conv[first[1:] * per - k] = -np.inf
        pooled = conv.reshape(-1, per, FILTERS)
        block_max = pooled.max(1)
        index, start = chunk_index(first, blocks)
        gathered = block_max[index]
        m = np.maximum(gathered.max(1) + p["b1"], 0)
        h = np.maximum(m @ p["w2"] + p["b2"], 0)
        mean = np.add.reduceat(h, start[:-1]) / np.diff(start)[:, None]
        top = np.maximum.reduceat(h, start[:-1])
        z = np.concatenate([mean, top], 1)
        logit = z @ p["w3"] + p["b3"]
        if trace:
            return logit, (padded, x, pooled, index, gathered, m, h, z, start)
        return logit


def train(rows: list[tuple[str, int]], epochs: int = 8, batch: int = 32, rate: float = 6e-3, seed: int = 7) -> QualityModel:
    """Adam on the cross entropy, classes drawn alike; a fixed number of steps whatever the sample's size."""
    rng = np.random.default_rng(seed)
    model = QualityModel(
        {
            "e": rng.normal(0, 1.0, (256, EMBED)),
            "w1": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)),
            "b1": np.zeros(FILTERS),
            "w2": rng.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)),
            "b2": np.full(HIDDEN, 0.1),
            "w3": rng.normal(0, 0.2, 2 * HIDDEN),
            "b3": np.zeros(()),
        }
    )
    by = [[t for t, y in rows if y == label] for label in (0, 1)]
    if not by[0] or not by[1]:
        model.p["w3"][:] = 0
        model.p["b3"] = np.float32(30 if by[1] else -30)
        return model
    first, second, step = {k: 0.0 for k in model.p}, {k: 0.0 for k in model.p}, 0
    steps = epochs * 2 * PER_CLASS // batch
    for step in range(1, steps + 1):
        texts = [by[i % 2][rng.integers(len(by[i % 2]))] for i in range(batch)]
        y = np.arange(batch) % 2
        logit, (padded, x, pooled, index, gathered, m, h, z, start) = model.forward(*flat_text(pa.array(texts, pa.string())), trace=True)
        p, counts = model.p, np.diff(start)
        g = ((1 / (1 + np.exp(-logit)) - y) / batch).astype(np.float32)
        grads = {"w3": z.T @ g, "b3": g.sum()}
        gz = g[:, None] * p["w3"]
        chunk_row = np.repeat(np.arange(batch), counts)
        gh = (gz[:, :HIDDEN] / counts[:, None])[chunk_row]
        is_top = h == z[:, HIDDEN:][chunk_row]
        gh = (gh + gz[:, HIDDEN:][chunk_row] * is_top) * (h > 0)
        grads |= {"w2": m.T @ gh, "b2": gh.sum(0)}
        gm = (gh @ p["w2"].T) * (m > 0)
        # Each maximum came from one block of the chunk, and from one place of the block.
        block = index[np.arange(len(index))[:, None], gathered.argmax(1)]
        columns = np.broadcast_to(np.arange(FILTERS), block.shape)
        place = block * pooled.shape[1] + pooled[block, :, columns].argmax(-1)
        # Gains of the places that were a maximum, then what reaches the filters and the table of bytes.
        used, at = np.unique(place, return_inverse=True)
        gain = np.bincount(at.ravel() * FILTERS + columns.ravel(), gm.ravel(), len(used) * FILTERS).reshape(-1, FILTERS).astype(np.float32)
        seen = padded[used[:, None] * STRIDE + np.arange(WIDTH)].ravel()
        back = (gain @ p["w1"].T).reshape(-1, EMBED)
        grads |= {"w1": x[used].T @ gain, "b1": gm.sum(0), "e": np.stack([np.bincount(seen, back[:, k], 256) for k in range(EMBED)], 1)}
        for k, v in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            model.p[k] = (p[k] - rate * (1 - step / (steps + 1)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


def fit(spark: SparkSession, sf_dir: str) -> QualityModel:
    """Trains on a bounded sample of the labelled rows outside the held-out fold."""
    return train(labelled_sample(spark, sf_dir, "quality", PER_CLASS, MAX_BYTES))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in text_groups(batch.column(1), 1 << 18):
                logit = shared.value.forward(raw, offsets).astype(np.float64)
                # Sums depend on the shapes in their last digits; equal texts score alike without those.
                probability = np.round(1 / (1 + np.exp(-logit)), 6)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(probability)], schema=schema)

    return bound_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
