"""Main text of web pages by suffix arrays over the pages of a host.

A page is parsed into blocks (:func:`parse`): end tags that HTML implies are implied, raw elements run to their end tag,
and the scan is linear whatever the markup. Blocks of its ``article`` or ``main`` element are content, and so is not what
its markup names as menu, header, footer, sidebar, notice, advert, form, script or comment. What is left, unmarked text
outside an article, is one token stream a page, and here repetition decides: the streams of a host are concatenated (a
separator of its own after each page) and their suffix array, built by prefix doubling, counts on how many distinct
pages each run of ``RUN`` tokens stands. Runs on ``PAGES`` or more are boilerplate: blocks that they cover are removed,
and so are stretches of ``LONG`` or more tokens within a block; the unique runs that remain are kept. Text of a declared
article is never removed by repetition, as copies and shared passages of articles are text as well; and where a page
declares none, a stretch that is more than half of it is its body, which copies share.

A host is dealt by hash to shards of about ``SHARD`` bytes, each with a suffix array of its own; the counts of all shards
of a host are added up before anything is decided, so the result does not depend on the shards. Pages of a host with
equal text are one page, and their text is made once.

A class name marks a part only as a whole word of it (``related-posts``, ``site-footer``, not ``header-image``), and a
part that holds most of its article (of its page, where no article stands outside it) and not mainly links is kept
whatever its class, unless that names reader comments or adverts, or says ``sidebar`` and the like inside an article.

Edge cases: null and empty html give empty text; unclosed and stray tags, comments, scripts and styles never end up in
the text; character references are decoded; white space of a block becomes one space; repeated rows each give their
row; pages without a host form one group; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches, discard, materialize

#: Tokens of a run, tokens of a stretch that goes from inside a block, pages of a run, and characters of a shard.
RUN, LONG, PAGES, SHARD = 6, 10, 3, 1 << 20
#: Hosts above a shard that the plan may name (their shard counts are broadcast); a shard grows once they are more.
MOST_HOSTS = 1_000_000

# Elements and words of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol optgroup option p pre section summary table caption tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("nav footer aside menu button dialog template svg math object canvas select audio video".split())
#: Elements whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("body br html option optgroup caption tbody td tfoot th thead tr".split())
#: What a start tag ends, and the elements that shield what is outside them.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tbody": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption"), ("table",)),
}
SHIELDS = frozenset("table td th caption object template".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header "
    "masthead cookie cookies consent notice notices gdpr popup modal overlay subscribe newsletter signup login search share sharing social comment "
    "comments respond replies disqus related recommended widget toolbar pagination pager".split()
)
COMMENTS = frozenset("comment comments respond replies disqus".split())
ADVERTS = frozenset("ad ads advert adverts advertisement sponsor sponsored".split())
#: Names that leave no doubt where they stand alone inside an article.
SURE = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr popup newsletter pagination pager".split())
#: Words that say nothing about what a part is.
NEUTRAL = frozenset(
    "area bar block body bottom box button buttons card cards col column container content count div end feed form grid group header icon icons inner items "
    "label left links list main media message notice outer panel posts primary right row secondary section site slot small text thread title top unit wrap "
    "wrapper".split()
)
ABOUT = frozenset("has no not with without".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_OPEN = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])")
_NAME = re.compile(r"[^\s/>]+")
_ATTR = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_END = re.compile(r"[\s/]*>")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


def named(value: str) -> str:
    """What a class or id names: ``never`` for reader comments and adverts, ``sure``, ``part`` or ``header`` for other
    boilerplate, else nothing."""
    found = ""
    for token in value.split():
        words = [w.lower() for w in _WORD.findall(token)]
        if not words or ABOUT.intersection(words):
            continue
        if words[-1] in NAMES or words[0] in NAMES and NEUTRAL.issuperset(words[1:]):
            if words[-1] in COMMENTS or words[0] in COMMENTS or len(words) == 1 and words[0] in ADVERTS:
                return "never"
            if len(words) == 1 and words[0] in SURE:
                found = "sure"
            elif found in ("", "header"):
                found = "header" if words[-1] == "header" else "part"
    return found


def marked(name: str, attributes: dict[str, str], inside: bool) -> str:
    """``drop`` for an element that is boilerplate by its kind, otherwise what its names say; a ``header`` of the article
    itself is nothing."""
    if name in ("html", "body", "article", "main"):
        return ""
    if name in DROPPED or name == "header" and not inside:
        return "drop"
    if not attributes:
        return "part" if name == "form" else ""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in re.sub(r"\s", "", attributes.get("style", "").lower()):
        return "drop"
    if attributes.get("role", "").strip().lower() in ROLES:
        return "drop"
    found = named(f"{attributes.get('class', '')} {attributes.get('id', '')}")
    if found == "header":
        return "" if inside else "part"
    return found or ("part" if name == "form" else "")


class _Part:
    """An open element that its names mark: characters of its text, of its links, and the article around it."""

    __slots__ = ("kind", "article", "chars", "links")

    def __init__(self, kind: str, article: int):
        self.kind, self.article, self.chars, self.links = kind, article, 0, 0


def parse(page: str | None) -> list[tuple[int, str]]:
    """Blocks of a page in order: 2 content of the article, 1 unmarked text outside, 0 a part that its names mark. What
    elements say by their kind to be no text is left out and, where they stand in a line, does not break it."""
    if not page:
        return []
    #: Text, number of its article (-1: none), and the marked parts around it.
    blocks: list[tuple[str, int, tuple[_Part, ...]]] = []
    pieces: list[str] = []
    linked = 0
    #: Open elements: name and the state around them (dropped, article, parts, inside a link).
    stack: list[tuple[str, tuple]] = []
    where: dict[str, list[int]] = {}
    special: list[int] = []
    shields: list[int] = []
    state: tuple[bool, int, tuple[_Part, ...], bool] = (False, -1, (), False)
    articles = 0
    outer: list[tuple[_Part, ...]] = []
    at, n = 0, len(page)

    def close_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                blocks.append((text, *state[1:3]))
                for part in state[2]:
                    part.chars += len(text)
                    part.links += min(linked, len(text))
        linked = 0

    def enter(to: tuple) -> None:
        nonlocal state
        if to[1:3] != state[1:3]:
            close_block()
        state = to

    def pop_to(i: int) -> None:
        """Closes the open elements from the i-th on."""
        while len(stack) > i:
            name, before = stack.pop()
            where[name].pop()
            for list_ in (special, shields):
                if list_ and list_[-1] == len(stack):
                    list_.pop()
        enter(before)

    def last(name: str) -> int:
        return where[name][-1] if where.get(name) else -1

    while at < n:
        m = _OPEN.search(page, at)
        end = m.start() if m else n
        if end > at and not state[0]:
            pieces.append(page[at:end])
            if state[3]:
                linked += end - at
        if not m:
            break
        lead = m[0]
        if lead == "<!--":
            stop = page.find("-->", m.end() - 2)
            at = n if stop < 0 else stop + 3
            continue
        if lead in ("<!", "<?"):
            stop = page.find(">", m.end())
            at = n if stop < 0 else stop + 1
            continue
        closing = lead[1] == "/"
        name_at = _NAME.match(page, m.end() - 1)
        name, at = name_at[0].lower(), name_at.end()
        if closing:
            stop = page.find(">", at)
            at = n if stop < 0 else stop + 1
            if name in BLOCKS:
                close_block()
            i = last(name)
            if i < 0 or name in BLOCKS and name not in SHIELDS and shields and shields[-1] > i:
                continue
            # An inline end tag does not close the blocks that began inside it, unless it ends a marked part.
            if name in BLOCKS or not special or special[-1] < i or stack[i][1][:3] != (stack[i + 1][1] if i + 1 < len(stack) else state)[:3]:
                pop_to(i)
            continue
        attributes: dict[str, str] = {}
        while not (stop := _END.match(page, at)):
            a = _ATTR.match(page, at)
            if not a:
                break
            attributes.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
            at = a.end()
        empty = bool(stop) and page[stop.end() - 2] == "/"
        at = stop.end() if stop else n
        if name in BLOCKS:
            close_block()
        if name in RAW:
            stop = _RAW_END[name].search(page, at)
            at = stop.end() if stop else n
            continue
        if name in VOID or name == "head":
            continue
        if name in ENDS_P:
            i = last("p")
            if i > (shields[-1] if shields else -1):
                pop_to(i)
        if name in ENDS:
            closes, guards = ENDS[name]
            guard = max(last(g) for g in guards)
            i = min((k for k in map(last, closes) if k > guard), default=-1)
            if i >= 0:
                pop_to(i)
        if empty:
            continue
        dropped, article, parts, link = before = state
        mark = marked(name, attributes, article >= 0)
        if article < 0 and not (dropped or mark == "drop") and (name in ("article", "main") or attributes.get("role", "").strip().lower() in ("main", "article")):
            article = articles
            articles += 1
            outer.append(parts)
        if mark == "drop":
            dropped = True
        elif mark:
            parts = (*parts, _Part(mark, before[1]))
        if len(parts) > 64:
            # Deeper nesting of marked parts says nothing new.
            parts = parts[:64]
        enter((dropped, article, parts, link or name == "a"))
        where.setdefault(name, []).append(len(stack))
        if name in BLOCKS:
            special.append(len(stack))
        if name in SHIELDS:
            shields.append(len(stack))
        stack.append((name, before))
    close_block()
    return _decided(blocks, outer)


def _decided(blocks: list[tuple[str, int, tuple[_Part, ...]]], outer: list[tuple[_Part, ...]]) -> list[tuple[int, str]]:
    """Kinds of the blocks: a marked part goes, unless it holds most of its article or page and not mainly links."""
    sizes = [0] * len(outer)
    total = 0
    for text, article, _ in blocks:
        total += len(text)
        if article >= 0:
            sizes[article] += len(text)
    free = any(size and not parts for size, parts in zip(sizes, outer))

    def kept(part: _Part) -> bool:
        if part.kind == "never" or part.article < 0 and free or part.article >= 0 and part.kind == "sure":
            return False
        around = total if part.article < 0 else sizes[part.article]
        return 2 * part.chars > around and 2 * part.links < part.chars

    known: dict[int, bool] = {}
    out = []
    for text, article, parts in blocks:
        for part in parts:
            if id(part) not in known:
                known[id(part)] = kept(part)
        dropped = not all(known[id(part)] for part in parts)
        out.append((0 if dropped else 2 if article >= 0 else 1, text))
    return out


def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``length`` tokens or more (prefix doubling): equal beginnings, equal rank.

    ``np.argsort(ranks)`` is the suffix array to that depth.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < length:
        step = min(depth, length - depth)
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-step] = rank[step:] if step < len(rank) else ahead[:-step]
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        depth += step
    return rank


def _token_hash(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def run_hashes(streams: list[list[str]], run: int = RUN) -> list[np.ndarray]:
    """The hash of the run that begins at each token (none for the last ``run - 1``) of each stream."""
    known: dict[str, int] = {}
    out = []
    for s in streams:
        if len(s) < run:
            out.append(np.zeros(0, np.int64))
            continue
        values = np.array([known[t] if t in known else known.setdefault(t, _token_hash(t)) for t in s], np.uint64)
        h = np.zeros(len(s) - run + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(run):
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + values[k : len(s) - run + 1 + k]
        out.append(h.view(np.int64))
    return out


def run_counts(streams: list[list[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each distinct run of these pages' streams, and the number of pages that it stands on."""
    ids: dict[str, int] = {}
    tokens: list[int] = []
    page: list[int] = []
    for i, s in enumerate(streams):
        tokens += [ids.setdefault(t, len(ids)) for t in s] + [-1 - i]
        page += [i] * (len(s) + 1)
    hashes = run_hashes(streams, run)
    if not sum(map(len, hashes)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t, p = np.array(tokens, np.int64), np.array(page, np.int64)
    rank = suffix_ranks(t, run)
    order = np.lexsort((p, rank))
    # Runs that reach past a page's end hold its separator, which no other page has: they are left out.
    sizes = np.array([len(s) + 1 for s in streams])
    begin = np.cumsum(sizes) - sizes
    whole = np.arange(len(t)) - begin[p] + run < sizes[p]
    order = order[whole[order]]
    r, q = rank[order], p[order]
    new_rank = np.concatenate([[True], r[1:] != r[:-1]])
    new_page = new_rank | np.concatenate([[True], q[1:] != q[:-1]])
    pages = np.bincount(np.cumsum(new_rank) - 1, new_page).astype(np.int64)
    lead = order[new_rank]
    flat = np.concatenate(hashes)
    first = np.cumsum([len(h) for h in hashes]) - np.array([len(h) for h in hashes])
    return flat[first[p[lead]] + lead - begin[p[lead]]], pages


def covered(stream: list[str], often: np.ndarray, run: int = RUN) -> np.ndarray:
    """For each token of a page, whether a run whose hash is among ``often`` covers it."""
    hit = np.flatnonzero(np.isin(run_hashes([stream], run)[0], often))
    edge = np.zeros(len(stream) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + run, -1)
    return np.cumsum(edge)[:-1] > 0


def outside(blocks: list[tuple[int, str]]) -> list[str]:
    """The token stream of a page: its unmarked text outside an article."""
    return [t for kind, text in blocks if kind == 1 for t in text.split()]


def extract(blocks: list[tuple[int, str]], flags: np.ndarray) -> str:
    """Main text of a page, given which tokens of its stream frequent runs cover."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    length = np.zeros(len(flags), np.int64)
    for a, b in zip(edges[::2], edges[1::2]):
        length[a:b] = b - a
    texts, at = [], 0
    for kind, text in blocks:
        if kind == 2:
            texts.append(text)
        elif kind == 1:
            tokens = text.split()
            own, size = flags[at : at + len(tokens)], length[at : at + len(tokens)]
            at += len(tokens)
            gone = own if own.all() else own & (size >= LONG)
            if kept := [t for t, g in zip(tokens, gone) if not g]:
                texts.append(" ".join(kept))
    return " ".join(texts)


_PARSED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("host", pa.string()),
        ("text", pa.string()),
        ("size", pa.int64()),
        ("kinds", pa.list_(pa.int8())),
        ("texts", pa.list_(pa.string())),
    ]
)
_PARSED_SQL = "page_id long, url string, host string, text string, size long, kinds array<byte>, texts array<string>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of pages that markup decides; blocks (without marked ones) and the size of the stream of the others."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts, sizes, kinds, blocks = [], [], [], []
            for x in part.column(3):
                found = [b for b in parse(x.as_py()) if b[0]]
                size = sum(len(t) for kind, t in found if kind == 1)
                texts.append(None if size else " ".join(t for _, t in found))
                sizes.append(size)
                kinds.append([k for k, _ in found] if size else None)
                blocks.append([t for _, t in found] if size else None)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(kinds, pa.list_(pa.int8())), pa.array(blocks, pa.list_(pa.string()))],
                schema=_PARSED,
            )


def _blocks(table: pa.Table) -> list[list[tuple[int, str]]]:
    return [list(zip(k, t)) for k, t in zip(table.column("kinds").to_pylist(), table.column("texts").to_pylist())]


_COUNTS = pa.schema([("host", pa.string()), ("shard", pa.int64()), ("run", pa.int64()), ("pages", pa.int64())])


def testifies(blocks: list[tuple[int, str]], often: np.ndarray) -> bool:
    """Whether a page declares an article, or else repeated runs cover at most half of it."""
    flags = covered(outside(blocks), often)
    return any(kind == 2 for kind, _ in blocks) or 2 * int(flags.sum()) <= len(flags)


def _counted(group: pa.Table, often: pa.Table | None = None) -> pa.Table:
    """Runs of a shard with their pages: all, or only those among ``often`` on pages that testify."""
    blocks = _blocks(group)
    if often is not None:
        hashes = often.column("run").to_numpy()
        blocks = [b for b in blocks if testifies(b, hashes)]
    run, pages = run_counts([outside(b) for b in blocks])
    if often is not None:
        known = np.isin(run, hashes)
        run, pages = run[known], pages[known]
    host, shard = group.column("host")[0], group.column("shard")[0]
    return pa.Table.from_arrays([pa.array([host.as_py()] * len(run), pa.string()), pa.array(np.full(len(run), shard.as_py(), np.int64)), pa.array(run), pa.array(pages)], schema=_COUNTS)


_TEXTS = pa.schema([("host", pa.string()), ("h1", pa.int64()), ("h2", pa.int64()), ("text", pa.string())])


def _texts(group: pa.Table, often: pa.Table) -> pa.Table:
    hashes = often.column("run").to_numpy()
    texts = [extract(b, covered(outside(b), hashes)) for b in _blocks(group)]
    return pa.Table.from_arrays([*(group.column(k).combine_chunks() for k in ("host", "h1", "h2")), pa.array(texts, pa.string())], schema=_TEXTS)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page. Pages are parsed once; only those with unmarked text outside an
    article are shuffled, by host and shard, and each text of a host once."""
    rows = bound_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))
    parsed = materialize(rows.select("page_id", "url", host.alias("host"), "html").mapInArrow(_parsed, _PARSED_SQL))
    plain = parsed.where("size = 0").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    some = parsed.where("size > 0").withColumn("h1", F.xxhash64("kinds", "texts")).withColumn("h2", F.xxhash64("texts", "kinds", F.lit(1)))

    bytes_of = some.groupBy("host").agg(F.sum("size").alias("bytes"))
    total = bytes_of.agg(F.sum("bytes")).first()[0]
    if not total:
        return plain
    limit = max(SHARD, total // MOST_HOSTS)
    # At most MOST_HOSTS hosts can hold more than this limit each, so their table has a proven bound.
    large = bytes_of.where(F.col("bytes") > limit).select("host", F.ceil(F.col("bytes") / limit).alias("shards"))
    own = some.select("host", "h1", "h2", "kinds", "texts").dropDuplicates(["host", "h1", "h2"])
    own = own.join(F.broadcast(large), "host", "left").withColumn("shard", F.pmod(F.col("h1"), F.coalesce("shards", F.lit(1))).cast("long")).drop("shards")
    own = materialize(own)
    sql = "host string, shard long, run long, pages long"

    def often(counts: DataFrame) -> DataFrame:
        """The runs of each shard that enough pages of the whole host hold."""
        found = counts.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= PAGES).select("host", "run")
        return counts.select("host", "shard", "run").join(found, ["host", "run"]).groupBy("host", "shard")

    by_shard = own.groupBy("host", "shard")
    counts = materialize(by_shard.applyInArrow(lambda group: _counted(group), sql))
    # Pages without a repeated run have nothing to testify to, and shards without one are left out as well.
    heard = materialize(by_shard.cogroup(often(counts)).applyInArrow(lambda group, runs: _counted(group, runs) if len(group) and len(runs) else _COUNTS.empty_table(), sql))
    texts = materialize(by_shard.cogroup(often(heard)).applyInArrow(_texts, "host string, h1 long, h2 long, text string"))
    discard(own, counts, heard)
    decided = some.select("page_id", "url", "host", "h1", "h2").join(texts, ["host", "h1", "h2"])
    return plain.unionByName(decided.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
