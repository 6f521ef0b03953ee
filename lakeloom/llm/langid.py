"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built; a text is parsed greedily into the longest phrases that
occur in that text, and the language that needs the fewest phrases per character wins. All parses of a batch walk their
automata together: a lane is a stretch of a text in one language, and a step moves every lane by one symbol, so the work
is a few numpy gathers per symbol. Every letter of the references is a symbol of its own: the most frequent ones index a
dense table, transitions on all others are sorted keys that are searched.

Whole texts are parsed, and stretches leave no trace in the result: a lane first begins a phrase where its stretch
begins; then the phrase that is open at the end of the stretch before goes on into it, breaking where it must, until a
phrase begins where the lane began one too. From there both parses are the same. Where a stretch ends before that, the
next one is entered again, until nothing changes.

More than ``MAX_LANGS`` labels are an error. Edge cases: null texts and texts without a letter are ``und`` with score 0;
a symbol that a reference lacks is a phrase of its own there; repeated rows get the same result; ties go to the language
that sorts first; with no labelled row everything is ``und``; other columns are ignored by :func:`predict` and kept by
:func:`keep_known`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import bound_batches, discard, held_out_bucket, materialize, read_table

#: Bounds of the reference: languages, documents drawn for each (expected), and characters of a language (in whole texts).
MAX_LANGS, PER_LANG, REF_CHARS = 1024, 200, 30_000
#: Symbols of the dense table (the most frequent letters of the references; transitions on other letters are sparse) and
#: entries of the table, which has fewer symbols where there are many languages.
SYMBOLS, DENSE = 63, 16 << 20
#: Characters of a lane, and languages that walk together.
SEGMENT, TOGETHER = 256, 8
#: How sharply a difference of entropy (bits a character) turns into a score.
SHARPNESS = 6.0

_TOP = 0x110000
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter; surrogates are none."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(_TOP)), bool, _TOP))
    return _LETTERS[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def transitions(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton of a sequence."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        current = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = current
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[current] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return moves


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions of the suffix automaton of a sequence, dense: states x alphabet, -1 where no substring goes on."""
    return dense(transitions(symbols), alphabet)


def dense(moves: list[dict[int, int]], alphabet: int) -> np.ndarray:
    """Transitions on the symbols below ``alphabet`` as a table."""
    table = np.full((len(moves), alphabet), -1, np.int32)
    for state, row in enumerate(moves):
        for c, to in row.items():
            if c < alphabet:
                table[state, c] = to
    return table


class LanguageModel:
    """Symbol map and automata of all languages in one table; each language's root is its offset."""

    def __init__(self, texts: dict[str, str]):
        self.langs = sorted(k for k, v in texts.items() if v)
        folded = {k: texts[k].lower() for k in self.langs}
        symbol = np.zeros(_TOP, np.int32)
        points = [code_points(v) for v in folded.values()]
        every = np.concatenate(points) if points else np.zeros(0, np.uint32)
        chars, counts = np.unique(every[letters()[every]], return_counts=True)
        wide = int(np.clip(DENSE // max(1, 2 * sum(map(len, points))), 4, SYMBOLS)) - 1
        chosen = sorted(chars[np.lexsort((chars, -counts))][:wide].tolist())
        others = np.setdiff1d(chars, chosen)
        # 0: a letter that the references lack; 1: whatever is no letter.
        symbol[~letters()] = 1
        symbol[chosen] = np.arange(2, 2 + len(chosen))
        symbol[others] = np.arange(2 + len(chosen), 2 + len(chars))
        self.symbol, self.alphabet, self.every = symbol, 2 + len(chosen), 2 + len(chars)
        tables, self.roots, self.sizes, sparse = [], [], [], []
        base = 0
        for x in points:
            s = self.symbols(x)
            moves = transitions(s.tolist())
            sparse += [((state + base) * self.every + c, to + base) for state, row in enumerate(moves) for c, to in row.items() if c >= self.alphabet]
            t = dense(moves, self.alphabet)
            t[:, 0] = -1  # A letter that all references lack.
            tables.append(np.where(t >= 0, t + base, -1))
            self.roots.append(base)
            self.sizes.append(max(2, len(s)))
            base += len(t)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        # Transitions on letters outside the dense table; the last key is above all others.
        sparse = np.array(sorted(sparse) + [(np.iinfo(np.int64).max, -1)], np.int64)
        self.keys, self.targets = sparse[:, 0].copy(), sparse[:, 1].astype(np.int32)

    def moved(self, state: np.ndarray, c: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """States after the symbols ``c``, -1 where there is none; ``rare``: places of symbols outside the dense table."""
        if not len(rare):
            return self.table[state * self.alphabet + c]
        to = self.table[state * self.alphabet + np.where(c < self.alphabet, c, 0)]
        key = state[rare].astype(np.int64) * self.every + c[rare]
        at = np.searchsorted(self.keys, key)
        to[rare] = np.where(self.keys[at] == key, self.targets[at], -1)
        return to

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; a run of what is no letter is one symbol."""
        s = self.symbol[points]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 1) | (s[:-1] != 1)
        return s[keep]

    def step(self, state: np.ndarray, c: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after the symbols ``c``, and where a phrase had to begin."""
        to = self.moved(state, c, np.flatnonzero(c >= self.alphabet))
        broken = to < 0
        at = np.flatnonzero(broken)
        if len(at):
            again = self.moved(root[at], c[at], np.flatnonzero(c[at] >= self.alphabet))
            to[at] = np.where(again < 0, root[at], again)
        return to, broken

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (symbols) in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        parts = [-(-len(t) // SEGMENT) for t in texts]
        owner = np.repeat(np.arange(len(texts)), parts)
        if not len(owner):
            return out
        flat = np.concatenate(texts)
        begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        within = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = begin[owner] + within * SEGMENT
        size = np.minimum(SEGMENT, begin[owner + 1] - first)
        order = np.argsort(-size, kind="stable")
        # The lane of the stretch before each lane's, and of that after it; -1 at the ends of a text.
        lane = np.empty(len(order), np.int64)
        lane[order] = np.arange(len(order))
        before = np.where(within > 0, lane[np.maximum(np.arange(len(owner)) - 1, 0)], -1)[order]
        after = np.full(len(order), -1)
        after[before[before >= 0]] = np.flatnonzero(before >= 0)
        owner, first, size = owner[order], first[order], size[order]
        live = np.searchsorted(-size, -np.arange(1, SEGMENT + 1), "right")
        grid = flat[np.minimum(first[:, None] + np.arange(size[0]), len(flat) - 1)].T.astype(np.int32)
        for k in range(0, len(self.roots), TOGETHER):
            roots = np.array(self.roots[k : k + TOGETHER], np.int32)
            wide = len(roots)
            state = np.tile(roots, len(owner))
            every_root = state.copy()
            begins = np.zeros((size[0], len(owner) * wide), bool)
            begins[0] = True
            for i in range(size[0]):
                n = live[i] * wide
                state[:n], broken = self.step(state[:n], np.repeat(grid[i, : live[i]], wide), every_root[:n])
                if i:
                    begins[i, :n] = broken
            self._join(begins, state, grid, size, before, after, roots)
            counts = begins.sum(0).reshape(-1, wide)
            for j in range(wide):
                out[:, k + j] = np.bincount(owner, counts[:, j], len(texts))
        return out

    def _join(self, begins: np.ndarray, state: np.ndarray, grid: np.ndarray, size: np.ndarray, before: np.ndarray, after: np.ndarray, roots: np.ndarray) -> None:
        """Lets phrases run on into the next stretch; ``begins`` and the end states become those of the whole parse."""
        wide = len(roots)
        lanes = np.repeat(np.flatnonzero(before >= 0), wide)
        which = np.tile(np.arange(wide), len(lanes) // wide)
        while len(lanes):
            lane, root = lanes, roots[which]
            at, now = lane * wide + which, state[before[lane] * wide + which]
            changed = []
            for i in range(int(size[lane].max())):
                now, broken = self.step(now, grid[i, lane], root)
                met = broken & begins[i, at]
                begins[i, at] = broken
                ends = ~met & (size[lane] == i + 1)
                if ends.any():
                    state[at[ends]] = now[ends]
                    changed.append(at[ends])
                on = ~(met | ends)
                if not on.all():
                    lane, root, at, now = lane[on], root[on], at[on], now[on]
                    if not len(lane):
                        break
            again = np.concatenate(changed) if changed else np.zeros(0, np.int64)
            lanes, which = after[again // wide], again % wide
            lanes, which = lanes[lanes >= 0], which[lanes >= 0]

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        symbols = [self.symbols(code_points((t or "").lower())) for t in texts]
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return langs, scores
        has_letter = np.array([bool(((s == 0) | (s > 1)).any()) for s in symbols], bool)
        counts = self.phrases(symbols)
        n = np.maximum(1, [len(s) for s in symbols])
        bits = counts * np.log2(self.sizes) / n[:, None]
        best = bits.argmin(1)
        share = np.exp2(-SHARPNESS * (bits - bits.min(1, keepdims=True)))
        score = 1 / share.sum(1)
        for i in np.flatnonzero(has_letter):
            langs[i] = self.langs[best[i]]
            scores[i] = score[i]
        return langs, scores


def fit(spark: SparkSession, docs: DataFrame, learn_from: object | None = None) -> LanguageModel:
    """Learns from a bounded sample of whole texts: of each language about PER_LANG documents chosen by hash, in whose
    order texts are taken as long as REF_CHARS characters hold them (one that would not fit is passed over)."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.select("doc_id", "lang", "text")
    found = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages are labelled")
    counts = spark.createDataFrame(found, T.StructType([T.StructField("lang", T.StringType()), T.StructField("n", T.LongType())]))
    drawn = known.join(F.broadcast(counts), "lang").where(F.pmod(F.xxhash64("doc_id"), F.col("n")) < PER_LANG)
    # A text that no reference holds is left out before it moves; an id with several texts gives the first.
    drawn = drawn.where(F.length("text") < REF_CHARS).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    drawn = materialize(drawn)
    room, chosen = {r["lang"]: REF_CHARS for r in found}, []
    for r in drawn.select("lang", "doc_id", F.length("text").alias("size")).orderBy("lang", F.xxhash64("doc_id", F.lit(1)), "doc_id").collect():
        if r["size"] < room[r["lang"]]:
            room[r["lang"]] -= r["size"] + 1
            chosen.append((r["lang"], r["doc_id"]))
    texts: dict[str, str] = {}
    if chosen:
        wanted = spark.createDataFrame(chosen, drawn.select("lang", "doc_id").schema)
        for r in sorted(drawn.join(F.broadcast(wanted), ["lang", "doc_id"]).collect(), key=lambda r: (r["lang"], r["doc_id"])):
            texts[r["lang"]] = texts.get(r["lang"], "") + "\n" + r["text"]
    discard(drawn)
    return LanguageModel(texts)


def _groups(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, list[str | None]]]:
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


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                langs, scores = shared.value.classify(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(langs, pa.string()), pa.array(scores)], schema=schema)

    return bound_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, model: LanguageModel, min_score: float = 0.0) -> DataFrame:
    """The documents whose language is known with at least ``min_score``; ``lang``, where there is one, becomes the
    prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at, lang_at = names.index("text"), names.index("lang") if "lang" in names else -1
    schema = T.StructType([T.StructField("lang", T.StringType()) if f.name == "lang" else f for f in docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _groups(batch.column(at)):
                langs, scores = shared.value.classify(texts)
                part = batch.slice(first, len(texts))
                columns = [pa.array(langs, pa.string()) if i == lang_at else c for i, c in enumerate(part.columns)]
                keep = pa.array([x != "und" and s >= min_score for x, s in zip(langs, scores)], pa.bool_())
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    return bound_batches(docs).mapInArrow(run, schema)


def fit_on(spark: SparkSession, sf_dir: str) -> LanguageModel:
    return fit(spark, read_table(spark, sf_dir, "documents"), held_out_bucket(F.col("doc_id"), 5) != 0)
