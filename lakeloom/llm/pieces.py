"""SentencePiece BPE encoding in vectorised merge rounds, and decoding.

The model's pieces and scores are read from its file. No piece of such a model continues after a word mark that
follows another character (checked when it is loaded), so a text is a run of words that merge on their own. The distinct
words of a batch lie in one flat numpy array of symbols; in each round every word finds the best-scored pair of
neighbours (the leftmost among equals), merges its leftmost non-overlapping occurrences together, and the array is
compacted; words without a pair leave, until none remain. Characters that end up without a piece become byte pieces.

A word of more than ``LONG`` characters has rounds of its own, so that its cost stays in proportion to its length: every
pair that is the best one (the leftmost among equals) within twice the longest piece to each side merges in the same
round. Whatever happens farther away ends up in pieces that cannot reach it, so the order among such pairs is free. A
round that finds hardly any (long runs of equal pairs, where each waits for the one to its left) leaves the rest of the
word to a queue of pairs.

Edge cases: null and empty texts are only the begin and end ids; lone surrogates cannot occur in Spark strings;
repeated rows encode alike; very long texts and words are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words whose ids a worker remembers, besides those of the texts in hand.
CACHE_WORDS = 100_000
#: Characters from which on a word has rounds of its own, and the pairs of a word for each that a round must merge.
LONG, SLOW = 256, 1024
_NEVER = np.iinfo(np.int64).max
#: Texts whose ids differ where a model folds, composes or trims.
PROBES = ("ﬁ①Ａ Å Å é ｶﾞ", "  two  spaces \t\n end ", "UPPER lower", "\u00ad\u200b x\u3000y", "▁mark")


class PieceModel:
    """Vocabulary and merge table of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        self.begin, self.end, self.unknown = self.lib.bos_id(), self.lib.eos_id(), self.lib.unk_id()
        ordinary = [i for i in range(n) if not (self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_byte(i) or self.lib.is_unused(i))]
        text = {i: self.lib.id_to_piece(i) for i in ordinary}
        if any(MARK in p.lstrip(MARK) for p in text.values()):
            raise ValueError("a piece spans words; this encoder merges within words")
        self.id_of = {p: i for i, p in text.items()}
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(n):
            if self.lib.is_byte(i):
                self.byte_ids[int(self.lib.id_to_piece(i)[3:5], 16)] = i
        # Every way to split a piece into two pieces is a merge; its rank is that of the merged piece's score.
        scores = {i: self.lib.get_score(i) for i in ordinary}
        rank = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        keys, ranks, results = [], [], []
        for i, p in text.items():
            for cut in range(1, len(p)):
                a, b = self.id_of.get(p[:cut]), self.id_of.get(p[cut:])
                if a is not None and b is not None:
                    keys.append((a << 20) | b)
                    ranks.append(rank[scores[i]])
                    results.append(i)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.ranks, self.results = np.array(ranks, np.int64)[order], np.array(results, np.int64)[order]
        # A merge is steady if its piece begins no better-scored merge; only then do all its occurrences merge at once.
        own = {i: rank[s] for i, s in scores.items()}
        early = {x for k, r in zip(keys, ranks) for x in (k >> 20, k & 0xFFFFF) if r <= own[x]}
        self.steady = np.array([r not in early for r in self.results.tolist()], bool)
        self.size = n
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        self.reach = 2 * max(map(len, text.values()), default=1)
        self.forget()
        # A hash table with open slots replaces a binary search over all pairs.
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        pending = np.arange(len(self.keys))
        self.probes = 0
        while len(pending):
            at = self._slot(self.keys[pending], self.probes)
            free = self.slots[at] < 0
            at, who = at[free], pending[free]
            self.slots[at] = who
            self.slot_key[at] = self.keys[self.slots[at]]
            placed = np.zeros(len(self.keys), bool)
            placed[self.slots[at]] = True
            pending = pending[~placed[pending]]
            self.probes += 1
        # This encoder changes no character, keeps all spaces and puts one word mark first; a model may ask for else.
        for probe in PROBES:
            if self.encode([probe])[0].tolist() != self.lib.encode(probe, add_bos=True, add_eos=True):
                raise ValueError("the model normalises texts in a way that this encoder lacks")
        self.forget()

    def _slot(self, key: np.ndarray, probe: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)
        return (h.astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge of each pair of symbols, -1 if there is none. Negative symbols never merge."""
        key = (left << 20) | right
        found = np.full(len(key), -1, np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        for probe in range(self.probes):
            if not len(todo):
                break
            at = self._slot(key[todo], probe)
            there = self.slot_key[at]
            same = there == key[todo]
            found[todo[same]] = self.slots[at[same]]
            todo = todo[~same & (there >= 0)]
        return found

    def merge_long(self, symbol: np.ndarray) -> np.ndarray:
        """Symbols of one long word after all merges."""
        merge = self.find(symbol[:-1], symbol[1:])
        while True:
            pairs = int((merge >= 0).sum())
            if not pairs:
                return symbol
            n = len(symbol)
            # Rank, then place: the smallest key of a window is its best pair, the leftmost among equals.
            key = np.where(merge >= 0, self.ranks[merge] * n + np.arange(n - 1), _NEVER)
            at = np.flatnonzero((key == _window_min(key, self.reach)) & (merge >= 0))
            if len(at) * SLOW < pairs:
                return self.merge_queue(symbol)
            symbol[at] = self.results[merge[at]]
            keep = np.ones(n, bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            # A merge takes the pair to its right with it; its own place holds the pair with what follows.
            symbol, merge = symbol[keep], np.append(merge, -1)[keep][:-1]
            fresh = place[at]
            fresh = np.unique(np.concatenate([fresh, fresh - 1]))
            fresh = fresh[(fresh >= 0) & (fresh < len(symbol) - 1)]
            merge[fresh] = self.find(symbol[fresh], symbol[fresh + 1])

    def merge_queue(self, symbol: np.ndarray) -> np.ndarray:
        """Symbols of one word after all merges, one merge at a time from a queue of pairs."""
        if not self.table:
            self.table = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.results.tolist())))
        s, n, table = symbol.tolist(), len(symbol), self.table
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(found[0], i, s[i], s[i + 1], found[1]) for i in range(n - 1) if s[i] >= 0 <= s[i + 1] and (found := table.get(s[i] << 20 | s[i + 1]))]
        heapq.heapify(queue)
        gone = -(1 << 40)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if s[i] != a or j < 0 or s[j] != b:
                continue
            s[i], s[j] = made, gone
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 <= y and s[x] >= 0 <= s[y] and (found := table.get(s[x] << 20 | s[y])):
                    heapq.heappush(queue, (found[0], x, s[x], s[y], found[1]))
        left = np.array(s, np.int64)
        return left[left != gone]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (with their word marks) one after the other, and the number of each word's ids."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        # A character without a piece is a negative symbol of its own, which never merges.
        symbol = self.char_ids[points].astype(np.int64)
        symbol = np.where(symbol >= 0, symbol, -2 - points.astype(np.int64))
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbol, done_word = [], []
        first = np.cumsum(sizes) - sizes
        for i in np.flatnonzero(sizes > LONG):
            merged = self.merge_long(symbol[first[i] : first[i] + sizes[i]].copy())
            done_symbol.append(merged)
            done_word.append(np.full(len(merged), i))
        short = (sizes <= LONG)[word]
        symbol, word = symbol[short], word[short]
        while len(symbol):
            merge = self.find(symbol[:-1], symbol[1:])
            merge[word[1:] != word[:-1]] = -1
            rank = np.where(merge >= 0, self.ranks[merge], np.iinfo(np.int64).max)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            # The best rank of each word; its last symbol pairs with nothing.
            padded = np.append(rank, np.iinfo(np.int64).max)
            best = np.minimum.reduceat(padded, first)
            counts = np.diff(np.append(first, len(word)))
            going = np.repeat(best < np.iinfo(np.int64).max, counts)
            if not going.all():
                done_symbol.append(symbol[~going])
                done_word.append(word[~going])
            chosen = (padded == np.repeat(best, counts)) & going
            # The leftmost pair of that rank decides the piece; the same piece's other pairs merge with it.
            at = np.flatnonzero(chosen)
            if not len(at):
                symbol = symbol[:0]
                break
            owner = word[at]
            lead = np.concatenate([[True], owner[1:] != owner[:-1]])
            kind = merge[at[lead]][np.cumsum(lead) - 1]
            at = at[(merge[at] == kind) & (lead | self.steady[merge[at]])]
            # Of overlapping occurrences (a pair of equal symbols in a run) every second one merges.
            if len(at) > 1:
                joined = np.concatenate([[False], at[1:] == at[:-1] + 1])
                if joined.any():
                    run = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
                    at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbol = symbol.copy()
            symbol[at] = self.results[merge[at]]
            keep = going.copy()
            keep[at + 1] = False
            symbol, word = symbol[keep], word[keep]
        if len(symbol):
            done_symbol.append(symbol)
            done_word.append(word)
        symbol = np.concatenate([np.zeros(0, np.int64), *done_symbol])
        word = np.concatenate([np.zeros(0, np.int64), *done_word])
        order = np.argsort(word, kind="stable")
        symbol, word = symbol[order], word[order]
        odd = np.flatnonzero(symbol < 0)
        if len(odd):
            raw = [chr(-2 - c).encode("utf-8", "surrogatepass") for c in symbol[odd].tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(x) for x in raw]
            symbol, word = np.repeat(symbol, times), np.repeat(word, times)
            symbol[symbol < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return symbol.astype(np.uint32), np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, with begin and end ids."""
        split = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.index) > CACHE_WORDS or len(self.flat) > 16 * CACHE_WORDS:
            self.forget()
        index = self.index
        fresh = list(dict.fromkeys(w for words in split for w in words if w not in index))
        if fresh:
            ids, counts = self.merge_words(fresh)
            index.update(zip(fresh, range(len(index), len(index) + len(fresh))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.flat = np.concatenate([self.flat, ids])
        begin, end = np.array([self.begin], np.uint32), np.array([self.end], np.uint32)
        out = []
        for words in split:
            k = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            n = self.count[k]
            stop = np.cumsum(n)
            ids = self.flat[np.repeat(self.start[k] - stop + n, n) + np.arange(stop[-1] if len(stop) else 0)]
            out.append(np.concatenate([begin, ids, end]))
        return out

    def forget(self) -> None:
        """Empties the table of words that are encoded already."""
        self.index: dict[str, int] = {}
        self.table: dict[int, tuple[int, int]] = {}
        self.flat, self.start, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def decode(self, ids: np.ndarray) -> str:
        return self.lib.decode(ids.tolist())


def _window_min(key: np.ndarray, reach: int) -> np.ndarray:
    """The smallest key within ``reach`` places to each side, by doubling."""
    padded = np.concatenate([np.full(reach, _NEVER), key, np.full(reach, _NEVER)])
    size = 2 * reach + 1
    width = 1
    while 2 * width <= size:
        padded = np.minimum(padded[:-width], padded[width:])
        width *= 2
    if width < size:
        padded = np.minimum(padded[: len(padded) - (size - width)], padded[size - width :])
    return padded[: len(key)]


_MODELS: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    """One model a worker process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def groups(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str | None]]]:
    first, size, group = 0, 0, []
    for i, x in enumerate(column):
        text = x.as_py()
        if group and size + len(text or "") > limit:
            yield first, group
            first, size, group = i, 0, []
        group.append(text)
        size += len(text or "")
    if group:
        yield first, group


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """n_tokens, digest of the ids, digest of the decoded text, and (``with_ids``) the ids of every whole text.

    ``path`` must name the model's file on every executor, as installed packages do.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in batches:
            for first, texts in groups(batch.column(1), 1 << 20):
                ids = model.encode(texts)
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(model.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return bound_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    )
