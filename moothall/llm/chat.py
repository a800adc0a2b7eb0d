"""Chat formatting by incremental black-box rendering.

A template is a function from a list of (role, text) to a string; nothing else is known of it. For every turn the
conversation is rendered up to the turn before it, with it, and with a placeholder for its text. Comparing consecutive
outputs gives the turn's span; the placeholder's place gives the text's span inside it, which is the loss mask of
assistant turns. Where an output doesn't begin with the one before it, the template has rewritten history: the turn is
marked, with the number of characters that still agree.

Prefixes are whole by default: a conversation is held by its task, and rendering it costs the square of its length. With
``lookback``, a prefix is the turns of the last ``lookback`` before the turn, if that is shown to give the same for the
conversation: the pieces, none of them rewritten, are held against whole prefixes of doubling lengths and the whole
conversation. Where they differ, or the template raises, the conversation is rendered by whole prefixes. Give it for
templates that look at a few turns at a time. Digests of a conversation need its turns one after another in one task, as a
digest can't be put together from parts.

Defined results: turns are ordered by (turn, role, text), so ties and repeated rows have a fixed order and all count;
null text or role is empty; rows with a null conversation id are one conversation with that id; extra columns are dropped;
roles don't hold the placeholder character U+E000, while texts may; a very long text is rendered whole, twice a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]
#: Turns that are enough for ``instruct``, which looks at one at a time.
LOOKBACK = 16
#: Turns that leave a task at once.
PART = 2000

# The control strings of the template below.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_RAW = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\]|/?ROLE\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\]|/?ROLE\])")
#: A placeholder text; a private-use character that template and roles don't have.
HOLE = "\ue000"


def escape(text: str) -> str:
    """No control string is left: one backslash more after the bracket of all that looks like one."""
    return _RAW.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def instruct(turns: list[tuple[str, str]]) -> str:
    """User turns are ``<s>[INST] text [/INST]``, assistant turns `` text</s>``, others name their role."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"<s>[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f" {escape(text)}</s>")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE] {escape(text)}</s>")
    return "".join(out)


_TURN = re.compile(
    r"<s>\[INST\] (?P<user>(?s:.*?)) \[/INST\]|\[ROLE\](?P<role>(?s:.*?))\[/ROLE\] (?P<other>(?s:.*?))</s>| (?P<assistant>(?s:.*?))</s>"
)


def read_instruct(formatted: str) -> list[tuple[str, str]]:
    """The turns that a string of ``instruct`` says, unescaped."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        if m["user"] is not None:
            out.append(("user", unescape(m["user"])))
        elif m["assistant"] is not None:
            out.append(("assistant", unescape(m["assistant"])))
        else:
            out.append((unescape(m["role"]), unescape(m["other"])))
        at = m.end()
    return out


def _common(a: str, b: str) -> int:
    """Characters that two strings agree in from the start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


class Renderer:
    """Turn after turn: the span that each adds to the output."""

    def __init__(self, template: Template, lookback: int | None):
        self.template, self.turns, self.before, self.at = template, deque(maxlen=lookback), "", 0

    def add(self, role: str, text: str) -> tuple[str, int, int, int, int, bool, int]:
        """The new output's rendered text, its start and end, the text's start and end in the whole output, whether
        history was rewritten, and how many characters of the output before still hold. A null lookback is whole prefixes."""
        if len(self.turns) == self.turns.maxlen:  # the prefix moves on by the turn that falls out
            self.before = self.template(list(self.turns)[1:])
        prefix = list(self.turns)[1 if len(self.turns) == self.turns.maxlen else 0 :]
        after = self.template([*prefix, (role, text)])
        rewritten = not after.startswith(self.before)
        agree = _common(self.before, after) if rewritten else len(self.before)
        start = self.at - (len(self.before) - agree)
        new = after[agree:]
        probe = self.template([*prefix, (role, HOLE)])
        hole = probe.find(HOLE, min(agree, len(probe)))
        head, tail = (hole - agree, len(probe) - hole - len(HOLE)) if hole >= 0 else (len(new), 0)
        end = start + len(new)
        mask = (start + head, max(start + head, end - tail))
        self.turns.append((role, text))
        self.before, self.at = after, end
        return new, start, end, *mask, rewritten, start


def _holds(template: Template, turns: list[tuple[str, str]], made: list[tuple]) -> bool:
    """Whether what was made of parts of a conversation is what whole prefixes of doubling lengths give."""
    if any(m[5] for m in made):
        return False
    said = "".join(m[0] for m in made)
    lengths = {len(turns)} | {1 << k for k in range(len(turns).bit_length())}
    for n in lengths:
        whole = Renderer(template, None)
        whole.turns.extend(turns[: n - 1])
        whole.before = template(turns[: n - 1]) if n > 1 else ""
        whole.at = len(whole.before)
        if whole.add(*turns[n - 1]) != made[n - 1] or whole.before != said[: made[n - 1][2]]:
            return False
    return True


def rendered(template: Template, turns: list[tuple[str, str]], lookback: int | None) -> list[tuple]:
    """What ``Renderer.add`` gives for each turn of a conversation by whole prefixes; by parts where that is the same."""
    if lookback is not None and len(turns) >= lookback:
        try:
            parts = Renderer(template, lookback)
            made = [parts.add(*t) for t in turns]
            if _holds(template, turns, made):
                return made
        except Exception:  # a template may refuse a part of a conversation that it takes whole
            pass
    whole = Renderer(template, None)
    return [whole.add(*t) for t in turns]


_SPANS = "pos long, role string, rendered string, start long, end long, text_start long, text_end long, rewritten boolean, agree long"


def format_turns(conversations: DataFrame, template: Template = instruct, lookback: int | None = None) -> DataFrame:
    """One row for each turn: conv_id, its place, role, rendered text, its span and its text's span in the whole output,
    and whether it rewrote history. Rows of a conversation are consecutive and in order within a partition."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv_id", "pos", "role", "rendered", "start", "end", "text_start", "text_end", "rewritten", "agree"]
        own, turns, out = None, [], []

        def frames(last: bool) -> Iterator[pd.DataFrame]:
            out.extend((own, i, turns[i][0], *m) for i, m in enumerate(rendered(template, turns, lookback)))
            if len(out) >= PART or last:
                for i in range(0, len(out), PART):
                    yield pd.DataFrame(out[i : i + PART], columns=columns).astype({"conv_id": object})
                out.clear()

        for batch in batches:
            for conv, role, text in zip(batch["conv_id"].astype(object), batch["role"], batch["text"]):
                conv = None if pd.isna(conv) else conv
                if turns and conv != own:
                    yield from frames(False)
                    turns = []
                own = conv
                turns.append((role, text))
        if turns:
            yield from frames(True)

    return rows.mapInPandas(spans, f"conv_id {kind}, {_SPANS}")


def conversation_digests(
    turns: DataFrame, read: Callable[[str], list[tuple[str, str]]] = read_instruct, plain: Callable[[str], str] = unescape
) -> DataFrame:
    """Per conversation, read back from the rendered output of a template that doesn't rewrite history: digests of its
    turns and of the text under the loss mask. ``turns`` comes straight from ``format_turns``."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten boolean"

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, state = None, None

        def row() -> tuple:
            n, said, loss, chars, length, rewritten = state
            return own, n, said.hexdigest(), chars, loss.hexdigest(), length, rewritten

        for batch in batches:
            out = []
            columns = (batch[c] for c in ("role", "rendered", "start", "end", "text_start", "text_end", "rewritten"))
            for conv, role, new, start, end, a, b, rewritten in zip(batch["conv_id"].astype(object), *columns):
                conv = None if pd.isna(conv) else conv
                if state is None or conv != own:
                    if state is not None:
                        out.append(row())
                    own, state = conv, [0, hashlib.sha256(), hashlib.sha256(), 0, 0, False]
                for said_role, text in read(new):
                    state[0] += 1
                    state[1].update(f"{said_role}\n{text}\n".encode())
                if role == "assistant":
                    text = plain(new[a - start : b - start])
                    state[2].update(text.encode())
                    state[3] += len(text)
                state[4] = end
                state[5] = state[5] or bool(rewritten)
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")]).astype({"conv_id": object})
        if state is not None:
            yield pd.DataFrame([row()], columns=[f.split()[0] for f in schema.split(", ")]).astype({"conv_id": object})

    return turns.mapInPandas(digests, schema)
