"""Chat formatting in budgeted windows.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens decide how far a window reaches: the
leading system turn is repeated in every window, then a limited history of turns that earlier windows held, then new
turns as long as the sum stays within the budget (a turn longer than the budget is a window of its own, uncut). Only
assistant turns that are new in a window are under its loss mask, so every target counts once.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles ``<|`` cannot occur: a backslash goes between
``<`` and ``|`` (one more where backslashes stand there already), which is undone exactly when reading back; line ends
and backslashes of a role are written as ``\\n`` and ``\\\\``.

Conversations stream through sorted partitions: what is held is one window's turns, never a conversation.

Edge cases: null texts and roles are empty; turns are ordered by turn (null first), then role and text, and repeated
rows are turns of their own; a null ``conv_id`` is one conversation; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches

#: Tokens of a window, the most repeated turns, and their share of a window.
BUDGET, HISTORY, HISTORY_SHARE = 1024, 2, 0.25
_TOKEN = re.compile(r"\w+|[^\w\s]")
_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ROLE = {"\\\\": "\\", "\\n": "\n"}


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\\\|\\n", lambda m: _ROLE[m[0]], role))


def count_tokens(text: str) -> int:
    return len(_TOKEN.findall(text)) + 3


class Windows:
    """Takes the turns of one conversation in order and gives its windows."""

    def __init__(self, budget: int = BUDGET, history: int = HISTORY, share: float = HISTORY_SHARE):
        self.budget, self.history, self.room = budget, history, int(budget * share)
        self.system: tuple[str, str, int] | None = None
        #: Turns in hand and the prefix sums of their tokens (one more); the first ``repeated`` are history.
        self.turns: list[tuple[str, str]] = []
        self.sums, self.repeated, self.count, self.started = [0], 0, 0, False

    def push(self, role: str, text: str) -> Iterator[dict]:
        tokens = count_tokens(text)
        first, self.started = not self.started, True
        if first and role == "system":
            self.system = (role, text, tokens)
            return
        if len(self.turns) > self.repeated and self._size() + tokens > self.budget:
            yield self._close(tokens)
        self.turns.append((role, text))
        self.sums.append(self.sums[-1] + tokens)

    def _size(self) -> int:
        return self.sums[-1] - self.sums[0] + (self.system[2] if self.system else 0)

    def _close(self, coming: int = 0) -> dict:
        parts, spans, at = [], [], 0
        head = [self.system[:2]] if self.system else []
        old = self.repeated + (1 if head and self.count else 0)
        for i, (role, text) in enumerate(head + self.turns):
            start = f"<|im_start|>{escape_role(role)}\n"
            body = escape(text)
            if role == "assistant" and i >= len(head) + self.repeated:
                spans.append({"start": at + len(start), "end": at + len(start) + len(body)})
            piece = f"{start}{body}<|im_end|>\n"
            parts.append(piece)
            at += len(piece)
        out = {"window": self.count, "repeated": old, "text": "".join(parts), "loss": spans, "n_tokens": self._size()}
        self.count += 1
        # The longest run of last turns, at most ``history``, that fits its share beside what is coming.
        room = min(self.room, self.budget - coming - (self.system[2] if self.system else 0))
        first = len(self.turns)
        while first and len(self.turns) - first < self.history and self.sums[-1] - self.sums[first - 1] <= room:
            first -= 1
        self.turns, self.sums = self.turns[first:], self.sums[first:]
        self.repeated = len(self.turns)
        return out

    def flush(self) -> Iterator[dict]:
        if len(self.turns) > self.repeated or (self.system and not self.count):
            yield self._close()


_WINDOW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("repeated", pa.int64()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("n_tokens", pa.int64()),
    ]
)
WINDOW_SQL = "conv_id long, window long, repeated long, text string, loss array<struct<start:long,end:long>>, n_tokens long"


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: its text, the code-point spans under the loss mask, and how many leading turns repeat
    earlier ones. Windows of a conversation come in order within one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, ready, size = object(), None, [], 0
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                made = []
                if state is None or conv != key:
                    if state is not None:
                        made += [(key, w) for w in state.flush()]
                    key, state = conv, Windows(budget, history)
                made += [(key, w) for w in state.push(role or "", text or "")]
                for k, w in made:
                    ready.append({"conv_id": k, **w})
                    size += len(w["text"])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(ready, schema=_WINDOW)
                    ready, size = [], 0
        if state is not None:
            ready += [{"conv_id": key, **w} for w in state.flush()]
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=_WINDOW)

    rows = bound_batches(conversations).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", F.col("role").cast("string"), F.col("text").cast("string")).mapInArrow(run, WINDOW_SQL)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_windows", pa.int64()),
    ]
)


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.formatted, self.windows = conv_id, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, repeated: int, loss: list[dict]) -> None:
        for i, m in enumerate(_TURN.finditer(text)):
            if i >= repeated:
                self.turns += 1
                self.all.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
        for span in loss:
            target = unescape(text[span["start"] : span["end"]])
            self.chars += len(target)
            self.loss.update(target.encode())
        self.formatted += len(text)
        self.windows += 1

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.formatted,
            "n_windows": self.windows,
        }


def read_back(windows: DataFrame, in_order: bool = False) -> DataFrame:
    """What the windows hold, read from their texts alone: turns (each once) and targets of every conversation.

    ``in_order``: the rows come straight from :func:`format_windows`; else they are brought into order first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, ready = None, []
        for batch in batches:
            for conv, repeated, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != state.conv_id:
                    if state is not None:
                        ready.append(state.row())
                    state = _Digest(conv)
                state.add(text, repeated, loss)
            if len(ready) > 5000:
                yield pa.RecordBatch.from_pylist(ready, schema=_DIGEST)
                ready = []
        if state is not None:
            ready.append(state.row())
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=_DIGEST)

    if not in_order:
        windows = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return bound_batches(windows).select("conv_id", "repeated", "text", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    )
