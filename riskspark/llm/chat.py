"""Chat formatting in budgeted windows.

The turns of a conversation are laid out as ``<|turn|>role``, a line end, the text and ``<|end|>``.
Control strings inside roles and texts get a backslash more after their first character, so reading
back takes one away. A window holds the system turn, then some last turns of the window before
(``history`` tokens at most), then as many new turns as the budget allows, at least one; prefix sums
of the turns' tokens choose both by search. Loss falls on the texts of assistant turns that are new
in their window, so each falls under the mask once.

Conversations stream through sorted partitions; a task holds the turns of one window and its
history, never a whole conversation.

Defined cases: null roles and texts are empty; turns are taken by ``turn`` (nulls first), ties by
role and text, repeated rows as repeated turns; rows without a conv_id are one conversation; a turn
beyond the budget is a window of its own; only a first turn of role ``system`` is retained, whatever
its length (a window over the budget shows in ``n_tokens``); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
_TAIL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"
_PLAIN = re.compile(r"([<\[]\\*)" + _TAIL)
_ESCAPED = re.compile(r"([<\[]\\*)\\" + _TAIL)


@dataclass(frozen=True)
class ChatRules:
    """Tokens of a window and of the history repeated in it."""

    budget: int = 1024
    history: int = 256


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1" + "\\\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def tokens_of(text: str) -> int:
    """Words of a text and the marks around it."""
    return len(text.split()) + 4


def format_window(turns: list[tuple[str, str]], n_context: int) -> tuple[str, list[dict]]:
    """The text of a window and its loss spans, in code points."""
    out, at, loss = [], 0, []
    for i, (role, text) in enumerate(turns):
        head, body = f"{TURN}{_role_line(role)}\n", escape(text)
        at += len(head)
        if i >= n_context and role == "assistant" and body:
            loss.append({"start": at, "stop": at + len(body)})
        out += [head, body, END]
        at += len(body) + len(END)
    return "".join(out), loss


def read_window(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted window."""
    turns = []
    for part in text.split(TURN)[1:]:
        line, body = part.split("\n", 1)
        turns.append((_role_of(line), unescape(body.removesuffix(END))))
    return turns


def windows_of(turns: list[tuple[str, str]], rules: ChatRules, state: dict) -> Iterator[dict]:
    """Windows of the next turns of a conversation, in order, as soon as they are full.

    ``state`` goes from call to call: the retained system turn, the history, the turns
    that wait for their window, and the number of windows so far.
    """
    state["waiting"] += turns
    while True:
        window = _next_window(state, rules, last=False)
        if window is None:
            return
        yield window


def _next_window(state: dict, rules: ChatRules, last: bool) -> dict | None:
    waiting = state["waiting"]
    if not waiting:
        return None
    fixed = state["system"]
    used = sum(tokens_of(t) for _, t in fixed)
    past = state["past"]
    # Suffix sums of the past: as many last turns as the history's tokens allow.
    suffix = list(accumulate(tokens_of(t) for _, t in reversed(past)))
    room = min(rules.history, rules.budget - used - tokens_of(waiting[0][1]))
    n_history = int(np.searchsorted(suffix, room, side="right")) if suffix else 0
    used += suffix[n_history - 1] if n_history else 0
    prefix = list(accumulate(tokens_of(t) for _, t in waiting))
    n_new = max(1, int(np.searchsorted(prefix, rules.budget - used, side="right")))
    if n_new == len(waiting) and not last:
        return None  # the next turn may still fit
    new = waiting[:n_new]
    context = fixed + (past[-n_history:] if n_history else [])
    text, loss = format_window(context + new, len(context))
    window = {
        "window": state["n"], "n_context": len(context), "n_new": n_new,
        "n_tokens": used + prefix[n_new - 1], "text": text, "loss": loss,
    }
    if state["n"] == 0 and new[0][0] == "system":
        state["system"], new = new[:1], new[1:]
    kept, size = [], 0
    for turn in reversed(past + new):
        size += tokens_of(turn[1])
        if size > rules.history:
            break
        kept.append(turn)
    state["past"] = kept[::-1]
    state["n"] += 1
    state["waiting"] = waiting[n_new:]
    return window


def _fresh() -> dict:
    return {"system": [], "past": [], "waiting": [], "n": 0}


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_WINDOWS = pa.schema(
    [
        ("conv_id", pa.int64()), ("window", pa.int64()), ("n_context", pa.int64()),
        ("n_new", pa.int64()), ("n_tokens", pa.int64()), ("text", pa.string()), ("loss", _LOSS),
    ]
)


def _sorted(rows: DataFrame, *order: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", *order)


def chat_windows(conversations: DataFrame, rules: ChatRules = ChatRules()) -> DataFrame:
    """``conv_id, window, n_context, n_new, n_tokens, text, loss``: the training rows.

    The first ``n_context`` turns of a window are repeated from earlier windows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches):
        conv, state, ready = None, None, []

        def finish():
            while (window := _next_window(state, rules, last=True)) is not None:
                ready.append({"conv_id": conv, **window})

        for batch in batches:
            for c, role, text in zip(
                *(batch.column(x).to_pylist() for x in ("conv_id", "role", "text")), strict=True
            ):
                if state is None or c != conv:
                    if state is not None:
                        finish()
                    conv, state = c, _fresh()
                ready += [{"conv_id": c, **w} for w in windows_of([(role, text)], rules, state)]
                if len(ready) >= 500:
                    yield pa.RecordBatch.from_pylist(ready, schema=_WINDOWS)
                    ready.clear()
        if state is not None:
            finish()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=_WINDOWS)

    return _sorted(rows, "turn", "role", "text").mapInArrow(
        run,
        "conv_id long, window long, n_context long, n_new long, n_tokens long, text string, "
        "loss array<struct<start:long,stop:long>>",
    )


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()), ("n_windows", pa.int64()),
    ]
)


def read_back(windows: DataFrame) -> DataFrame:
    """One row for each conversation, from the formatted windows alone."""

    def run(batches):
        conv, now, ready = None, None, []

        def finish():
            ready.append(
                {
                    "conv_id": conv, "n_turns": now["turns"],
                    "turns_sha256": now["all"].hexdigest(), "loss_chars": now["loss"],
                    "loss_sha256": now["under"].hexdigest(),
                    "formatted_chars": now["chars"], "n_windows": now["windows"],
                }
            )

        for batch in batches:
            for c, n_context, text, loss in zip(
                *(batch.column(x).to_pylist() for x in ("conv_id", "n_context", "text", "loss")),
                strict=True,
            ):
                if now is None or c != conv:
                    if now is not None:
                        finish()
                    conv = c
                    now = {"turns": 0, "loss": 0, "chars": 0, "windows": 0}
                    now |= {"all": hashlib.sha256(), "under": hashlib.sha256()}
                for role, body in read_window(text)[n_context:]:
                    now["turns"] += 1
                    now["all"].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    plain = unescape(text[span["start"] : span["stop"]])
                    now["loss"] += len(plain)
                    now["under"].update(plain.encode())
                now["chars"] += len(text)
                now["windows"] += 1
                if len(ready) >= 2000:
                    yield pa.RecordBatch.from_pylist(ready, schema=_DIGEST)
                    ready.clear()
        if now is not None:
            finish()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=_DIGEST)

    return _sorted(windows, "window").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_windows long",
    )
