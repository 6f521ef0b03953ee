"""Personal data by candidate spans and gradient-boosted trees, in DataFrame operations only.

Generators propose spans, many of them wrong and overlapping: e-mail addresses, dotted quads, runs of digits, numbers
with a plus, numbers with brackets and dots, and long tokens of mixed characters. Each span has small whole-number
features of its format and of the characters beside it. Boosted trees are fitted to the counts of all feature
combinations in the corpus (a table bounded by the features' ranges, whatever the corpus' size). Their labels come from
evidence that no feature shows: check digits and ranges of numbers, a naming word before the span (``password:``,
``tel.``), the published beginning of a kind of key. So the trees learn what such spans look like and find those that lack
the evidence: a key without its name, a number without its check.

A quarter of the documents is held out of the fit. On their counts the margin of each added kind is calibrated, and its
threshold is the lowest probability from which on the held-out candidates have the share ``PRECISION`` of evidence; a
kind that never reaches it adds nothing. The trees are one SQL expression.

Base spans (validated formats) always stay; added spans have kind ``secret`` or ``number`` and touch no base span.
Offsets are code points, ends exclusive.

A text costs time in proportion to its length: patterns are free of nested repetition, spans are collected and compared
in chunks of sorted lists, and context is read from the gaps between matches.

Edge cases: null and empty texts have no span; repeated rows each give their row; ties in position go to the kind
listed first; a corpus without candidates gets a model that adds nothing; extra columns are kept by :func:`redact`
unless they begin with ``_pii``; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds as listed by the contract, then those that the trees add.
BASE, ADDED = ("email", "ip", "card", "phone"), ("secret", "number")
TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "secret": "[SECRET]", "number": "[NUMBER]"}

_LOCAL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\\z"
_DOMAIN = r"\\A[A-Za-z0-9-][A-Za-z0-9.-]*+"
_IP = r"(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
_PHONE = r"\\+[0-9][\\x20().0-9-]+[0-9]"
#: What stands between runs of digits that single spaces or dashes join.
_BETWEEN = r"[^0-9]{2,}+|[^0-9\\x20-]|\\A[\\x20-]|[\\x20-]\\z"
_TOKEN = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}+"
_NUMBER = r"(?<![0-9.])[0-9(][0-9()\\x20.-]{5,}[0-9]"
_NAMED = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|auth|bearer|credential)s?[\\x22\\x27 ]*[=:]?[\\x22\\x27 ]*\\z"
_CALLED = r"(?i)(?:tel|phone|mobile|call|fax|cell)[a-z]*[.:)\\x20]*\\z"
#: Beginnings that providers publish for their keys.
_ISSUED = r"\\A(?:AKIA|ASIA|AIza|ghp_|gho_|ghs_|github_pat_|glpat-|sk-|sk_live_|pk_live_|rk_live_|xox[abprs]-|eyJ|SG\\.|npm_|hf_|dop_v1_|shpat_)"
#: A span while it is collected; candidates of a chunk, of which lists are built one by one.
_SPAN, CHUNK = "struct<start:bigint,end:bigint,m:string,pre:string,post:string>", 64
_EMPTY = f"cast(array() as array<{_SPAN}>)"


def _let(value: str, body: str) -> str:
    """SQL of ``body`` with ``it`` bound to a value that is computed once."""
    return f"element_at(transform(array({value}), it -> {body}), 1)"


def _fold(items: str, at: str, step: str, element: str) -> str:
    """SQL that walks through ``items`` with a running number ``s.at`` (and ``s.used``) and collects ``s.out``.

    A list that grows by one is copied each time, so lists of CHUNK items are built and joined at the end.
    """
    return _let(
        items,
        f"aggregate(sequence(0, (size(it) - 1) div {CHUNK}), struct({at} as at, 0 as used, cast(array() as array<array<{element}>>) as out), "
        f"(c, k) -> aggregate(slice(it, k * {CHUNK} + 1, {CHUNK}), struct(c.at as at, c.used as used, cast(array() as array<{element}>) as out), "
        f"(s, x) -> {step}, r -> struct(r.at as at, r.used as used, concat(c.out, array(r.out)) as out)), c -> flatten(c.out))",
    )


def _spans(gaps: str, matches: str, after: str, least: int = 1) -> str:
    """SQL that turns gaps, the matches that follow them and the gaps that follow those into spans."""
    items = f"zip_with(zip_with({gaps}, {matches}, (g, m) -> struct(coalesce(g, '') as g, coalesce(m, '') as m)), {after}, (a, n) -> struct(a.g as g, a.m as m, left(coalesce(n, ''), 1) as n))"
    start = "s.at + length(x.g)"
    found = f"struct({start} as start, {start} + length(x.m) as end, x.m as m, right(x.g, 24) as pre, x.n as post)"
    return _fold(items, "0L", f"struct({start} + length(x.m) as at, 0 as used, if(length(x.m) >= {least}, concat(s.out, array({found})), s.out) as out)", _SPAN)


def _found(pattern: str) -> str:
    gaps = f"split(_pii, '{pattern}', -1)"
    return _spans(gaps, f"regexp_extract_all(_pii, '{pattern}', 0)", f"slice({gaps}, 2, size({gaps}))")


def _emails() -> str:
    """Addresses around each ``@``: the run before it that is still free, and the longest list of labels after it."""
    pieces = "split(_pii, '@', -1)"
    pairs = f"zip_with(slice({pieces}, 1, size({pieces}) - 1), slice({pieces}, 2, size({pieces})), (a, b) -> struct(a, b))"
    free = f"regexp_extract(substr(x.a, s.used + 1), '{_LOCAL}', 0)"
    name = f"regexp_replace(substring_index(regexp_extract(x.b, '{_DOMAIN}', 0), '..', 1), '\\\\.\\\\z', '')"
    ok = f"({free} <> '' and instr({name}, '.') > 0)"
    end = "s.at + length(x.a)"
    found = (
        f"struct({end} - length({free}) as start, {end} + 1 + length({name}) as end, concat({free}, '@', {name}) as m, "
        f"right(left(x.a, length(x.a) - length({free})), 24) as pre, substr(x.b, length({name}) + 1, 1) as post)"
    )
    return _fold(pairs, "0L", f"struct({end} + 1 as at, if({ok}, length({name}), 0) as used, if({ok}, concat(s.out, array({found})), s.out) as out)", _SPAN)


def _cards() -> str:
    """Runs of 13 or more characters that are digits joined by single spaces or dashes."""
    between = f"regexp_extract_all(_pii, '{_BETWEEN}', 0)"
    return _spans(f"concat(array(''), {between})", f"split(_pii, '{_BETWEEN}', -1)", between, 13)


def _luhn(digits: str) -> str:
    twice = "cast(substr(reverse({d}), i, 1) as int) * (2 - i % 2)".format(d=digits)
    return f"aggregate(sequence(1, length({digits})), 0, (t, i) -> t + {twice} - if({twice} > 9, 9, 0)) % 10 = 0"


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)",
    "card": f"length({_DIGITS}) between 13 and 19 and {_luhn(_DIGITS)}",
    "phone": f"length({_DIGITS}) between 9 and 15",
}

#: Features of a candidate and the number of their values.
FEATURES = {"kind": 6, "digits": 11, "size": 13, "letters": 3, "hex": 2, "marks": 6, "plus": 2, "quoted": 2, "glued": 2}
#: Evidence by kind, which no feature shows.
_EVIDENCE = {
    "email": "regexp_like(x.m, '[.][A-Za-z]{2,}\\\\z')",
    "ip": _VALID["ip"],
    "card": _VALID["card"],
    "phone": f"{_VALID['phone']} or regexp_like(x.pre, '{_CALLED}')",
    "secret": f"regexp_like(x.pre, '{_NAMED}') or regexp_like(x.m, '{_ISSUED}')",
    "number": f"({_VALID['card']}) or regexp_like(x.pre, '{_CALLED}') or (endswith(x.pre, '+') and {_VALID['phone']})",
}


def _features(kind: int, evidence: str) -> str:
    low, up = "regexp_like(x.m, '[a-z]')", "regexp_like(x.m, '[A-Z]')"
    parts = {
        "kind": str(kind),
        "digits": f"cast(least(length({_DIGITS}) div 2, 10) as int)",
        "size": "cast(least(length(x.m) div 4, 12) as int)",
        "letters": f"if({low}, 1, 0) + if({up}, 1, 0)",
        "hex": "if(regexp_like(x.m, '\\\\A[0-9a-f]+\\\\z'), 1, 0)",
        "marks": "least(length(regexp_replace(x.m, '[A-Za-z0-9]', '')), 5)",
        "plus": "if(startswith(x.m, '+'), 1, 0)",
        "quoted": "if(right(x.pre, 1) in ('\"', '\\\''), 1, 0)",
        "glued": "if(regexp_like(right(x.pre, 1), '[A-Za-z0-9]') or regexp_like(x.post, '[A-Za-z0-9]'), 1, 0)",
    }
    fields = ", ".join(f"{v} as {k}" for k, v in parts.items())
    return f"struct({fields}, if({evidence}, 1, 0) as y)"


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``_pii`` (the text, null as empty), ``_pii_base`` (validated spans) and ``_pii_more`` (candidates with their
    features); both are arrays and empty where the text has no digit and no ``@``, which a cheap test decides."""
    out = docs.withColumn("_pii", F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = out.withColumn("_pii_n", F.expr("regexp_like(_pii, '[0-9]')")).withColumn("_pii_a", F.expr("instr(_pii, '@') > 0"))
    found = {
        "email": ("_pii_a", _emails()),
        "ip": ("_pii_n", _found(_IP)),
        "card": ("_pii_n", _cards()),
        "phone": ("_pii_n and instr(_pii, '+') > 0", _found(_PHONE)),
        "secret": ("_pii_n", _found(_TOKEN)),
        "number": ("_pii_n", _found(_NUMBER)),
    }
    out = out.withColumns({f"_pii_{k}": F.expr(f"if({guard}, {sql}, {_EMPTY})") for k, (guard, sql) in found.items()})
    base = ", ".join(
        f"transform(filter(_pii_{k}, x -> {_VALID[k]}), x -> struct({i} as rank, '{k}' as kind, x.start as start, x.end as end))" for i, k in enumerate(BASE)
    )
    more = [f"transform(_pii_{k}, x -> struct({i} as rank, '{k}' as kind, x.start as start, x.end as end, {_features(i, _EVIDENCE[k])} as f))" for i, k in enumerate(BASE + ADDED)]
    return out.withColumns({"_pii_base": F.expr(f"concat({base})"), "_pii_more": F.expr(f"if(_pii_n or _pii_a, concat({', '.join(more)}), null)")})


class Trees:
    """Boosted regression trees of depth two over small whole-number features; ``sql`` is their probability. Each added
    kind has its own calibration (scale and shift of the margin) and threshold."""

    def __init__(self, trees: list, intercept: float, calibration: dict[int, tuple[float, float, float]]):
        self.trees, self.intercept, self.calibration = trees, intercept, calibration

    def margin(self, f: dict) -> float:
        total = self.intercept
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[2] if f[tree[0]] <= tree[1] else tree[3]
            total += tree
        return total

    def probability(self, f: dict) -> float:
        scale, shift, _ = self.calibration.get(f["kind"], (1.0, 0.0, 2.0))
        return _sigmoid(scale * self.margin(f) + shift)

    def sql(self, f: str, kind: int) -> str:
        def one(tree) -> str:
            return f"if({f}.{tree[0]} <= {tree[1]}, {one(tree[2])}, {one(tree[3])})" if isinstance(tree, tuple) else f"{tree:.9f}D"

        scale, shift, _ = self.calibration.get(kind, (1.0, 0.0, 2.0))
        return f"1 / (1 + exp(-greatest(-30D, least(30D, {scale:.9f}D * ({' + '.join([f'{self.intercept:.9f}D', *map(one, self.trees)])}) + {shift:.9f}D))))"

    def threshold(self, kind: int) -> float:
        return self.calibration.get(kind, (1.0, 0.0, 2.0))[2]


#: A model that adds nothing.
NOTHING = Trees([], -30.0, {})
#: Share of held-out candidates with evidence that an added kind must reach, and the least number of those.
PRECISION, LEAST = 0.9, 5


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _calibrated(cells: list[dict], margins: list[float]) -> tuple[float, float, float]:
    """Scale, shift and threshold of one kind from its held-out counts (Platt's, with his smoothed targets)."""
    w = [float(c["n"]) for c in cells]
    positive, total = sum(a for a, c in zip(w, cells) if c["y"]), sum(w)
    if positive < LEAST:
        return 1.0, 0.0, 2.0
    y = [(positive + 1) / (positive + 2) if c["y"] else 1 / (total - positive + 2) for c in cells]
    scale, shift = 1.0, 0.0
    for _ in range(25):
        p = [_sigmoid(scale * m + shift) for m in margins]
        ga, gb = sum(a * (q - t) * m for a, q, t, m in zip(w, p, y, margins)) + scale - 1, sum(a * (q - t) for a, q, t in zip(w, p, y)) + shift
        v = [a * q * (1 - q) for a, q in zip(w, p)]
        aa, ab, bb = sum(a * m * m for a, m in zip(v, margins)) + 1.0, sum(a * m for a, m in zip(v, margins)), sum(v) + 1.0
        det = aa * bb - ab * ab
        scale, shift = max(0.1, min(10.0, scale - (bb * ga - ab * gb) / det)), max(-20.0, min(20.0, shift - (aa * gb - ab * ga) / det))
    # From the most probable down, as long as enough of those so far have evidence.
    by: dict[float, list[float]] = {}
    for c, a, m in zip(cells, w, margins):
        entry = by.setdefault(round(_sigmoid(scale * m + shift), 6), [0.0, 0.0])
        entry[0] += a
        entry[1] += a * c["y"]
    threshold, seen, good = 2.0, 0.0, 0.0
    for p in sorted(by, reverse=True):
        seen, good = seen + by[p][0], good + by[p][1]
        if good >= PRECISION * seen and good >= LEAST:
            threshold = p - 1e-5
    return scale, shift, threshold


def boost(cells: list[dict], rounds: int = 30, rate: float = 0.4) -> Trees:
    """Newton boosting on weighted cells (``n`` is a cell's count, ``y`` its evidence), then calibration on those that are
    ``held`` out."""
    names = list(FEATURES)
    held, cells = [c for c in cells if c["held"]], [c for c in cells if not c["held"]]
    y, w = [int(c["y"]) for c in cells], [float(c["n"]) for c in cells]
    total, positive = sum(w), sum(a * b for a, b in zip(w, y))
    if not total or not 0 < positive < total:
        return NOTHING
    start = math.log(positive / (total - positive))
    margin, trees = [start] * len(cells), []

    def leaf(rows: list[int], g: list[float], h: list[float]) -> float:
        return rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + 1.0)

    def grow(rows: list[int], g: list[float], h: list[float], depth: int):
        best, sum_g, sum_h = None, sum(g[i] for i in rows), sum(h[i] for i in rows)
        if depth:
            for name in names:
                gs, hs = [0.0] * FEATURES[name], [0.0] * FEATURES[name]
                for i in rows:
                    gs[cells[i][name]] += g[i]
                    hs[cells[i][name]] += h[i]
                left_g = left_h = 0.0
                for cut in range(FEATURES[name] - 1):
                    left_g, left_h = left_g + gs[cut], left_h + hs[cut]
                    gain = left_g**2 / (left_h + 1) + (sum_g - left_g) ** 2 / (sum_h - left_h + 1) - sum_g**2 / (sum_h + 1)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, name, cut)
        if best is None:
            return leaf(rows, g, h)
        _, name, cut = best
        low, high = [i for i in rows if cells[i][name] <= cut], [i for i in rows if cells[i][name] > cut]
        if not low or not high:
            return leaf(rows, g, h)
        return (name, cut, grow(low, g, h, depth - 1), grow(high, g, h, depth - 1))

    def value(tree, cell: dict) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if cell[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        p = [_sigmoid(m) for m in margin]
        g, h = [a * (b - c) for a, b, c in zip(w, y, p)], [a * c * (1 - c) for a, c in zip(w, p)]
        tree = grow(list(range(len(cells))), g, h, 2)
        trees.append(tree)
        margin = [m + value(tree, c) for m, c in zip(margin, cells)]
    model = Trees(trees, start, {})
    for kind in range(len(BASE), len(BASE + ADDED)):
        own = [c for c in held if c["kind"] == kind]
        model.calibration[kind] = _calibrated(own, [model.margin(c) for c in own])
    return model


def fit(docs: DataFrame) -> Trees:
    """Trees fitted to the feature counts of all candidates; the counts are one bounded table, summed before it moves."""
    found = candidates(docs).select((F.pmod(F.crc32("_pii"), F.lit(4)) == 0).alias("held"), F.explode("_pii_more.f").alias("f")).select("held", "f.*")
    cells = found.groupBy(*FEATURES, "y", "held").agg(F.count("*").alias("n")).collect()
    rows = sorted((r.asDict() for r in cells), key=lambda r: tuple(r.values()))
    return boost(rows)


_KIND = "struct<rank:int,kind:string,start:bigint,end:bigint>"


def _unblocked(blockers: str, items: str) -> str:
    """SQL of the items that overlap no blocker: one sorted list of both is walked up with the farthest end of a blocker so
    far, and down with the nearest start."""
    both = (
        f"array_sort(concat(transform({blockers}, b -> struct(b.start as start, 0 as side, b.end as end, b.rank as rank, b.kind as kind, false as hit)), "
        f"transform({items}, b -> struct(b.start as start, 1 as side, b.end as end, b.rank as rank, b.kind as kind, false as hit))))"
    )
    element = "struct<start:bigint,side:int,end:bigint,rank:int,kind:string,hit:boolean>"

    def walk(items: str, at: str, to: str, hit: str) -> str:
        one = f"struct(x.start as start, x.side as side, x.end as end, x.rank as rank, x.kind as kind, (x.hit or {hit}) as hit)"
        return _fold(items, at, f"struct(if(x.side = 0, {to}, s.at) as at, 0 as used, concat(s.out, array({one})) as out)", element)

    up = walk(both, "-1L", "greatest(s.at, x.end)", "s.at > x.start")
    down = walk(f"reverse({up})", "9223372036854775807L", "least(s.at, x.start)", "s.at < x.end")
    return f"transform(filter({down}, x -> x.side = 1 and not x.hit), x -> struct(x.rank, x.kind, x.start, x.end))"


def spans(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` with ``_pii_spans``: base spans by kind and start, then added spans of kinds secret and number."""
    out = candidates(docs)

    def chosen(kind: int) -> str:
        if model.threshold(kind) > 1:
            return f"cast(array() as array<{_KIND}>)"
        picked = f"filter(_pii_more, x -> x.rank = {kind} and {model.sql('x.f', kind)} >= {model.threshold(kind):.9f}D)"
        return f"transform({picked}, x -> struct(x.rank, x.kind, x.start, x.end))"

    def added(kind: int, blockers: str) -> str:
        """Most texts have no candidate left to add, and need no comparison."""
        return _let(chosen(kind), f"if(size(it) = 0, cast(array() as array<{_KIND}>), {_unblocked(blockers, 'it')})")

    none = f"cast(array() as array<{_KIND}>)"
    out = out.withColumn("_pii_secret_spans", F.expr(f"if(_pii_more is null, {none}, {added(4, '_pii_base')})"))
    # A number inside a selected secret is part of it.
    out = out.withColumn("_pii_number_spans", F.expr(f"if(_pii_more is null, {none}, {added(5, 'concat(_pii_base, _pii_secret_spans)')})"))
    return out.withColumn("_pii_spans", F.expr("array_sort(concat(_pii_base, _pii_secret_spans, _pii_number_spans))"))


def report(docs: DataFrame, model: Trees) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, and their number."""
    joined = "array_join(transform({a}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    return spans(docs, model).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.expr(f"cast(size(filter(_pii_base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE),
        F.expr(f"sha2({joined.format(a='array_sort(_pii_base)')}, 256)").alias("base_sha256"),
        F.expr(joined.format(a="_pii_spans")).alias("spans"),
        F.expr("cast(size(_pii_spans) as bigint)").alias("n_spans"),
    )


def redact(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` with every span replaced by its kind's tag and ``n_chars`` (where there is one) counted anew.

    Spans are applied from left to right; of two that overlap the one that begins first (then the kind listed first)
    is tagged, and the rest of the other goes with it.
    """
    tags = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in TAGS.items()) + ")"
    order = "array_sort(transform(_pii_spans, x -> struct(x.start as start, x.rank as rank, x.end as end, x.kind as kind)))"
    # What a span adds: the text since the last one's end, and its tag; a span that is covered already adds nothing. The
    # text of a chunk of spans is cut out first, so that no place is looked for from the text's beginning each time.
    gap = "substr(c.part, cast(s.at - c.at + 1 as int), cast(greatest(x.start - s.at, 0) as int))"
    one = f"struct(x.end as at, concat(s.done, array({gap}, if(x.start < s.at, '', element_at({tags}, x.kind)))) as done)"
    inner = f"aggregate(slice(it, k * {CHUNK} + 1, {CHUNK}), struct(c.at as at, cast(array() as array<string>) as done), (s, x) -> if(x.end <= s.at, s, {one}), r -> struct(r.at as at, concat(b.done, array(array_join(r.done, ''))) as done))"
    part = f"substr(_pii, cast(b.at + 1 as int), cast(greatest(array_max(transform(slice(it, k * {CHUNK} + 1, {CHUNK}), x -> x.start)) - b.at, 0) as int))"
    chunk = f"element_at(transform(array(struct(b.at as at, {part} as part)), c -> {inner}), 1)"
    text = _let(
        order,
        f"aggregate(sequence(0, (size(it) - 1) div {CHUNK}), struct(0L as at, cast(array() as array<string>) as done), (b, k) -> {chunk}, "
        "b -> concat(array_join(b.done, ''), substr(_pii, cast(b.at + 1 as int))))",
    )
    out = spans(docs, model).withColumn("text", F.expr(f"if(size(_pii_spans) = 0, cast(text as string), {text})"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.expr("size(_pii_spans) = 0"), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(docs.columns)
