"""Shared pieces: flat text batches, word hashing, bounded labelled samples, materialised intermediates."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one round of numpy work holds; temporaries are some tens of times this.
GROUP_BYTES = 1 << 20

#: Bytes that belong to a word of the benchmark contract (digits, letters, all above ASCII), lower-cased.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_WORD_MAP = np.frombuffer(WORD_TABLE, np.uint8)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch: batches of a fixed number of rows would grow with the texts.
BATCH_BYTES = 4 << 20


def bound_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session whose Arrow batches are bounded in bytes (unless its own configuration says how)."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, str(BATCH_BYTES))
    return df


def flat_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and row offsets (one more than rows). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``limit`` bytes (a longer row alone): first row, end row, bytes, offsets."""
    raw, offsets = flat_text(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


_M = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    if len(_POWERS.get("p", ())) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_M), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _POWERS["p"] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, _M)]))
            _POWERS["q"] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]))
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(
    raw: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of flat text: hash, row, first byte and end byte of each; then for each length in ``prefixes`` the places
    of longer words and the hashes of their prefixes.

    Bytes that WORD_TABLE sends to a space separate words, and so does a row's end.
    """
    n = len(raw)
    if not n:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty, [(empty, np.zeros(0, np.uint64)) for _ in prefixes]
    low = _WORD_MAP[raw]
    inside = low != 0x20
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    p, q = _powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum((low.astype(np.uint64) + np.uint64(1)) * p[:n], dtype=np.uint64)])
        value = mix64((total[end] - total[start]) * q[start] + (end - start).astype(np.uint64))
        more = []
        for k in prefixes:
            at = np.flatnonzero(end - start > k)
            a = start[at]
            more.append((at, mix64((total[a + k] - total[a]) * q[a] + np.uint64(k << 32))))
    row = np.searchsorted(offsets, start, "right") - 1
    return value, row, start, end, more


def held_out_bucket(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def labelled_sample(spark: SparkSession, sf_dir: str, label: str, per_class: int, max_bytes: int) -> list[tuple[str, int]]:
    """A bounded sample of whole labelled training texts, the same on every run.

    At most ``per_class`` ids of each label are chosen from ``labels`` by hash and joined (a broadcast of at most
    ``2 * per_class`` ids) to their texts; an id with several texts gives the one that sorts first. In hash order, texts
    are taken as long as ``max_bytes`` bytes hold them (one that would not fit is passed over, never cut).
    """
    known = (
        read_table(spark, sf_dir, "labels")
        .where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (held_out_bucket(F.col("doc_id"), 3) != 1))
        .groupBy("doc_id")
        .agg(F.max(label).alias("y"))
    )
    order = F.xxhash64("doc_id", F.lit(17))
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").where(F.col("text").isNotNull())
    found = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    found = materialize(found.withColumn("size", F.octet_length("text")))
    room, chosen = {0: max_bytes // 2, 1: max_bytes // 2}, []
    for r in found.orderBy(order, "doc_id").select("doc_id", "y", "size").collect():
        if r["size"] <= room[r["y"]]:
            room[r["y"]] -= r["size"]
            chosen.append(r["doc_id"])
    rows = found.where(F.col("doc_id").isin(chosen)).select("doc_id", "text", "y").collect() if chosen else []
    discard(found)
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return [(r["text"], int(r["y"])) for r in rows]


#: Intermediates that are still there; what queries have not removed goes at the end of the process.
_LEFT: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, which all executors share; a local one only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|\Z)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/lakeloom-checkpoints"
    return f"{base.rstrip('/')}/lakeloom-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the frame once to the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    _LEFT[path] = spark
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lakeloom_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
    _LEFT.pop(path, None)


def discard(*frames: DataFrame | None) -> None:
    """Removes what :func:`materialize` wrote."""
    for df in frames:
        if path := getattr(df, "_lakeloom_path", None):
            remove(df.sparkSession, path)


@atexit.register
def _remove_left() -> None:
    for path, spark in list(_LEFT.items()):
        try:
            remove(spark, path)
        except Exception:  # The JVM may be gone already; then the folder's owner cleans it.
            return
