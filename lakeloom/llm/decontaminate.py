"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts scans each text once.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A pattern is ``window`` consecutive words of
an item; an item with fewer words, but not none, is one pattern. The words of the benchmark are numbered, and a number is
written in as many digits as the largest one needs, each place with digits of its own; all other words are zeros, which no
pattern holds. So the automaton takes a few steps a word, with few branches at each, a match can only be of whole words,
and its end gives the index of its last word, from which the range of code points in the original text follows.

A worker builds the automaton once. It holds the benchmark up to ``ONE_PASS`` bytes; a larger one is dealt by hash to
shards of that size, and the documents pass one shard after the other, with the same result.

Edge cases: null and empty texts have no words and no hits; repeated rows each get their own result; duplicate items
share patterns and are all reported; windows of an item without an id are hits, but it cannot be reported; an empty
benchmark leaves every document clean; other columns are ignored by :func:`scan` and kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import WORD_TABLE, bound_batches, discard, materialize

#: Bytes of benchmark text that one automaton holds (its memory is about a hundred times that).
ONE_PASS = 8 << 20
#: Digits of a place: a node of the automaton looks through its branches one by one.
BASE = 16

SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>, spans array<struct<start:long,end:long>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Matcher:
    """The patterns of benchmark items; its automaton is built where it is first used, once a worker."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = 10):
        self.items, self.window, self.automaton = items, window, None

    def __getstate__(self) -> dict:
        return {"items": self.items, "window": self.window, "automaton": None}

    def build(self) -> None:
        texts = [(None if i is None else str(i), words(t)) for i, t in self.items]
        number: dict[bytes, int] = {}
        for _, w in texts:
            for x in w:
                number.setdefault(x, len(number))
        self.wide, base = 1, BASE
        while base**self.wide < len(number):
            self.wide += 1
        self.symbols = {x: "".join([chr(1 + p * base + i // base**p % base) for p in range(self.wide)]) for x, i in number.items()}
        found: dict[str, tuple[int, dict[str, None]]] = {}
        for item, w in texts:
            n = min(self.window, len(w))
            line = [self.symbols[x] for x in w]
            for i in range(len(w) - n + 1 if n else 0):
                ids = found.setdefault("".join(line[i : i + n]), (n, {}))[1]
                if item is not None:
                    ids[item] = None
        automaton = ahocorasick.Automaton()
        for key, (n, ids) in found.items():
            automaton.add_word(key, (n, tuple(ids)))
        automaton.make_automaton()
        self.automaton = automaton

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged ranges of hit words (first, end), and ids of the items found."""
        if self.automaton is None:
            self.build()
        w = words(text)
        if not w or not len(self.automaton):
            return len(w), [], set()
        line = "".join(map(self.symbols.get, w, repeat("\0" * self.wide)))
        items: set[str] = set()
        found = [(end // self.wide + 1, n, ids) for end, (n, ids) in self.automaton.iter(line)]
        for ids in {ids for _, _, ids in found}:
            items.update(ids)
        return len(w), merge([(end - n, end) for end, n, _ in found]), items


def to_original(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code-point ranges in the original text of ranges of words."""
    if not ranges:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    norm, where, at = raw.translate(WORD_TABLE), [], 0
    for x in norm.split():
        at = norm.index(x, at)
        where.append((at, at + len(x)))
        at += len(x)
    out = []
    for a, b in ranges:
        begin = len(raw[: where[a][0]].decode("utf-8", "surrogatepass"))
        out.append({"start": begin, "end": begin + len(raw[where[a][0] : where[b - 1][1]].decode("utf-8", "surrogatepass"))})
    return out


def matchers(benchmark: DataFrame, window: int, text_cols: tuple[str, ...] = ("text",), id_col: str = "item_id") -> Iterator[Matcher]:
    """Matchers of the benchmark's texts (questions and answers, each column a text of its own): one, or one a shard.

    A benchmark is a fixed set of test items and does not grow with the corpus; a shard at a time is on the driver.
    """
    spark = benchmark.sparkSession
    size = benchmark.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text_cols), F.lit(0)))).first()[0] or 0
    shards = max(1, -(-size // ONE_PASS))
    for k in range(shards):
        part = benchmark.where(F.pmod(F.xxhash64(*text_cols), F.lit(shards)) == k) if shards > 1 else benchmark
        rows = part.select(id_col, *text_cols).collect()
        yield spark.sparkContext.broadcast(Matcher([(r[id_col], r[c]) for r in rows for c in text_cols], window))


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
        ("item_ids", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
_RANGES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_PASS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ranges", _RANGES), ("ids", pa.list_(pa.string()))])
_PASS_SQL = "doc_id long, text string, ranges array<struct<a:long,b:long>>, ids array<string>"


def _row(doc_id: int | None, text: str | None, n: int, ranges: list[tuple[int, int]], found: set[str]) -> dict:
    ids = sorted(found)
    return {
        "doc_id": doc_id,
        "n_words": n,
        "n_hit": sum(b - a for a, b in ranges),
        "n_items": len(ids),
        "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest(),
        "contaminated": bool(ranges),
        "item_ids": ids,
        "spans": to_original(text, ranges) if ranges else [],
    }


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_cols: tuple[str, ...] = ("text",)) -> DataFrame:
    """One row per document: words, hit words, items found, and the hit ranges in the original text (code points)."""
    rows = bound_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = list(matchers(benchmark, window, text_cols))

    def report(shared) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    text = batch.column(1)[i].as_py()
                    n, ranges, found = shared.value.hits(text)
                    if batch.num_columns > 2:
                        ranges = merge([*ranges, *((r["a"], r["b"]) for r in batch.column(2)[i].as_py())])
                        found = found.union(batch.column(3)[i].as_py())
                    out.append(_row(doc_id, text, n, ranges, found))
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

        return run

    def collect(shared) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ranges, ids = [], []
                for i in range(batch.num_rows):
                    _, new, found = shared.value.hits(batch.column(1)[i].as_py())
                    ranges.append([{"a": a, "b": b} for a, b in merge([*new, *((r["a"], r["b"]) for r in batch.column(2)[i].as_py())])])
                    ids.append(sorted(found.union(batch.column(3)[i].as_py())))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ranges, _RANGES), pa.array(ids, pa.list_(pa.string()))], schema=_PASS)

        return run

    if len(every) > 1:
        rows = rows.select("*", F.expr("cast(array() as array<struct<a:long,b:long>>)").alias("ranges"), F.expr("cast(array() as array<string>)").alias("ids"))
        for shared in every[:-1]:
            done = materialize(rows.mapInArrow(collect(shared), _PASS_SQL))
            discard(rows)
            rows = done
    return rows.mapInArrow(report(every[-1]), SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any hit, all columns unchanged; one scan (a shard of the benchmark), no shuffle."""
    at = docs.columns.index("text")

    def clean(shared) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not shared.value.hits(x.as_py())[1] for x in batch.column(at)], pa.bool_()))

        return run

    rows, every = bound_batches(docs), list(matchers(benchmark, window))
    for shared in every[:-1]:
        rows = materialize(rows.mapInArrow(clean(shared), docs.schema))
    return rows.mapInArrow(clean(every[-1]), docs.schema)
