"""Chat formatting: turn-aligned windows under a token budget, with a loss mask over new assistant text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_INSIDE = re.compile(r"([<\[])(\\*)(?=s>|/s>|INST\]|/INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=s>|/s>|INST\]|/INST\])")
_TURN = re.compile(r"<s>(?:\[INST\]|\[/INST\])([^\n]*)\n(.*?)\n</s>\n", re.S)

WINDOWS = "conv_id {kind}, window long, formatted string, n_context int, n_new int, n_tokens long, loss array<struct<start:int,end:int>>"
DIGESTS = "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    """No control string is left: a backslash goes behind its first character; such strings get one more."""
    return _INSIDE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def turn_markup(role: str, text: str, target: bool) -> tuple[str, int]:
    """A formatted turn, and the place of its text in it."""
    head = f"<s>{'[/INST]' if target else '[INST]'}{escape(role).replace(chr(37), '%25').replace(chr(10), '%0A')}\n"
    return f"{head}{escape(text)}\n</s>\n", len(head)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape(role.replace("%0A", "\n").replace("%25", "%")), unescape(text)) for role, text in _TURN.findall(formatted)]


def count_tokens(text: str) -> int:
    """Runs of code points other than space and \\t to \\r."""
    return len(text.encode("utf-8", "surrogatepass").split())


class _Conversation:
    """Turns of one conversation as they come; gives out a window when the next turn would pass the budget."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: list[tuple[str, str, int]] = []
        self.context: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str, int]] = []
        self.tokens, self.window = 0, 0

    def add(self, role: str, text: str) -> dict | None:
        turn = role, text, count_tokens(text)
        out = None
        if self.new and self.tokens + turn[2] > self.budget:
            out = self.close()
            # history: the latest turns, as long as they take `history` tokens at most and leave room for this one
            room, kept = min(self.history, self.budget - turn[2] - sum(t[2] for t in self.system)), []
            for old in reversed([t for t in self.context + self.new if not any(t is s for s in self.system)]):
                room -= old[2]
                if room < 0:
                    break
                kept.append(old)
            self.context, self.new = self.system + kept[::-1], []
            self.tokens = sum(t[2] for t in self.context)
        if role == "system" and not self.system and not self.new and not self.window:
            self.system = [turn]
        self.new.append(turn)
        self.tokens += turn[2]
        return out

    def close(self) -> dict:
        parts, loss, at = [], [], 0
        for k, (role, text, _) in enumerate(self.context + self.new):
            markup, head = turn_markup(role, text, role == "assistant")
            if role == "assistant" and k >= len(self.context):
                loss.append({"start": at + head, "end": at + len(markup) - len("\n</s>\n")})
            parts.append(markup)
            at += len(markup)
        self.window += 1
        return {"conv_id": self.conv_id, "window": self.window - 1, "formatted": "".join(parts), "n_context": len(self.context), "n_new": len(self.new), "n_tokens": self.tokens, "loss": loss}


def _flush(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    frame["conv_id"] = frame["conv_id"].astype("object")
    return frame


def format_windows(turns: DataFrame, budget: int = 2048, history: int = 512) -> DataFrame:
    """Windows of formatted turns: conv_id, window, formatted, n_context, n_new, n_tokens, loss.

    turns (conv_id, turn, role, text) are dealt by conv_id and sorted, then read as a stream: a task holds
    the turns of one window, so a conversation may be of any length. A window takes whole turns while they fit the
    budget (a longer turn has a window of its own). Later windows begin with the system turn and the
    latest turns of up to `history` tokens; `n_context` counts these. loss has the code-point span of each new assistant text,
    so each is trained on once. Null texts and roles are empty; equal turn numbers are ordered by role and
    text; null conv_ids form one conversation. Repeated rows are repeated turns. Other columns are not read; an empty table
    gives an empty one.
    """
    kind = dict(turns.dtypes)["conv_id"]
    names = [x.split()[0] for x in WINDOWS.split(", ")]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out, held = None, [], 0
        for frame in frames:
            for conv_id, none, role, text in zip(frame["conv_id"], frame["none"], frame["role"], frame["text"]):
                conv_id = None if none else conv_id
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.close())
                    now = _Conversation(conv_id, budget, history)
                if done := now.add(role, text):
                    out.append(done)
                    held += len(done["formatted"])
                if len(out) >= 2000 or held > 4 << 20:
                    yield _flush(out, names)
                    out, held = [], 0
        if now is not None:
            out.append(now.close())
        if out:
            yield _flush(out, names)

    dealt = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select(F.coalesce("conv_id", F.lit("0").cast(kind)).alias("conv_id"), F.col("conv_id").isNull().alias("none"), "role", "text").mapInPandas(rows, WINDOWS.format(kind=kind))


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation from its formatted windows, in the order in which format_windows gives them.

    Windows from a stored table have lost that order: sort them within partitions by conv_id and window first. Null conv_ids
    are one conversation; texts that were null come back empty; repeated turns come back as often as they stood. Texts of any length
    are digested window by window; other columns are not read; an empty table gives an empty one.
    """
    kind = dict(windows.dtypes)["conv_id"]
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out = None, []

        def close():
            conv_id, n, turns, n_loss, loss, chars = now
            return {"conv_id": conv_id, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": n_loss, "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        for frame in frames:
            for conv_id, none, window, formatted, n_context, spans in zip(frame["conv_id"], frame["none"], frame["window"], frame["formatted"], frame["n_context"], frame["loss"]):
                if window == 0:
                    if now is not None:
                        out.append(close())
                    now = [None if none else conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted)[n_context:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"] : span["end"]])
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(formatted)
            yield _flush(out, names)
            out = []
        if now is not None:
            yield _flush([close()], names)

    return windows.select(F.coalesce("conv_id", F.lit("0").cast(kind)).alias("conv_id"), F.col("conv_id").isNull().alias("none"), "window", "formatted", "n_context", "loss").mapInPandas(rows, DIGESTS.format(kind=kind))
