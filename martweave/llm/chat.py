"""Chat formatting with budgeted windows.

The turns of a conversation are cut into windows of a token budget, at turns
only. Prefix sums of the turns' tokens say where: a window opens with the
system turn, then repeats as many of the latest turns as fit into the history
budget, then takes new turns as long as their prefix sum fits. Repeated turns are out
of the loss mask, so each assistant text is a target exactly once.

Format of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
roles and texts are escaped by one backslash after the ``<`` (``<|`` becomes
``<\\|``, ``<\\|`` becomes ``<\\\\|``, and so on), so ``<|`` occurs only where the
template puts it, and unescaping takes one backslash back.

Rows are dealt by conversation and sorted by turn, and each task streams over
its conversations: it holds one window and the system turn, not a conversation.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.llm.common import partitions

BUDGET, HISTORY = 1024, 256
# The control strings of the template.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_WINDOW = "conv_id bigint, window bigint, formatted string, n_repeated int, n_turns int, tokens bigint, loss_spans array<array<bigint>>"


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def turn_tokens(role: str, text: str) -> int:
    """Tokens a turn is taken for: a quarter of its UTF-8 bytes, and the frame of the template."""
    return (len(role.encode()) + len(text.encode()) + 3) // 4 + 5


class _Windows:
    """Windows of one conversation, from turns given one by one."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple[str, str] | None = None
        self.turns: list[tuple[str, str]] = []  # repeated history, then new turns; the system turn is apart
        self.sums = [0]  # prefix sums of the tokens of `turns`
        self.repeated, self.number, self.seen = 0, 0, 0

    def _full(self, tokens: int) -> bool:
        head = turn_tokens(*self.system) if self.system and self.number else 0
        return len(self.turns) > self.repeated and head + self.sums[-1] + tokens > self.budget

    def add(self, role: str, text: str) -> dict | None:
        """Takes a turn; gives the window that it closes, if any."""
        tokens, out = turn_tokens(role, text), None
        if self._full(tokens):
            out = self.close()
            self._carry(tokens)
        if self.seen == 0 and role == "system":
            self.system = (role, text)
        self.seen += 1
        self.turns.append((role, text))
        self.sums.append(self.sums[-1] + tokens)
        return out

    def _carry(self, tokens: int) -> None:
        """Keeps the latest turns that fit the history budget and leave room for the next turn."""
        body = 1 if self.number == 1 and self.system else 0  # the system turn is retained by itself
        head = turn_tokens(*self.system) if self.system else 0
        room = min(self.history, self.budget - head - tokens)
        low = max(body, bisect_left(self.sums, self.sums[-1] - room)) if room > 0 else len(self.turns)
        self.turns = self.turns[low:]
        self.sums = [s - self.sums[low] for s in self.sums[low:]]
        self.repeated = len(self.turns)

    def close(self) -> dict:
        head = [self.system] if self.system and self.number else []
        repeated = len(head) + self.repeated
        parts, spans, at = [], [], 0
        for i, (role, text) in enumerate([*head, *self.turns]):
            before = f"{START}{escaped(role).replace(chr(10), NEWLINE)}\n"
            body = escaped(text)
            if i >= repeated and role == "assistant":
                spans.append([at + len(before), at + len(before) + len(body)])
            parts += [before, body, END, "\n"]
            at += len(before) + len(body) + len(END) + 1
        self.number += 1
        tokens = self.sums[-1] + (turn_tokens(*head[0]) if head else 0)
        return {
            "conv_id": self.conv_id,
            "window": self.number - 1,
            "formatted": "".join(parts),
            "n_repeated": repeated,
            "n_turns": len(head) + len(self.turns),
            "tokens": tokens,
            "loss_spans": spans,
        }


def format_chats(
    turns: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """Windows of all conversations of ``turns(conv_id, turn, role, text)``.

    One row per window: the formatted text, how many of its turns are repeated
    (they stand first), its tokens and the loss spans as [start, end) in code
    points. A window exceeds ``budget`` only when one turn does, as turns are
    never cut. The first turn is retained if its role is ``system``. A null text
    or role is empty, a null turn comes first, a null ``conv_id`` is one
    conversation; equal turn numbers are in order of role and text, and repeated
    rows are repeated turns. Other columns are ignored.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("window", pa.int64()),
            ("formatted", pa.string()),
            ("n_repeated", pa.int32()),
            ("n_turns", pa.int32()),
            ("tokens", pa.int64()),
            ("loss_spans", pa.list_(pa.list_(pa.int64()))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out, size = None, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for conv_id, role, text in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        out.append(current.close())
                    current = _Windows(conv_id, budget, history)
                window = current.add(role, text)
                if window:
                    out.append(window)
                    size += len(window["formatted"])
                if size > 1 << 22 or len(out) > 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        if current is not None:
            out.append(current.close())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    dealt = rows.repartition(partitions(turns.sparkSession), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _WINDOW)


def parse_window(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and where the escaped text stands, of each turn of a window."""
    return [
        (unescaped(m[1].replace(NEWLINE, "\n")), unescaped(m[2]), m.start(2), m.end(2))
        for m in _TURN.finditer(formatted)
    ]


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted text and loss spans alone: digests of turns and targets."""
    schema = pa.schema(
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

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []

        def finish() -> None:
            conv_id, turns, turn_hash, chars, loss_hash, formatted, n = state
            row = (conv_id, turns, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), formatted, n)
            out.append(dict(zip(schema.names, row, strict=True)))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "n_repeated", "loss_spans")]
            for conv_id, formatted, repeated, spans in zip(*columns, strict=True):
                if state is None or state[0] != conv_id:
                    if state is not None:
                        finish()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                fresh = parse_window(formatted)[repeated:]
                state[1] += len(fresh)
                for role, text, _, _ in fresh:
                    state[2].update(f"{role}\n{text}\n".encode())
                for start, end in spans:
                    target = unescaped(formatted[start:end])
                    state[3] += len(target)
                    state[4].update(target.encode())
                state[5] += len(formatted)
                state[6] += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if state is not None:
            finish()
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    dealt = windows.select("conv_id", "window", "formatted", "n_repeated", "loss_spans")
    dealt = dealt.repartition(partitions(windows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "window")
    return dealt.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint, n_windows bigint",
    )
