"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. The field adds to them: its nodes are a document's tokens that have a digit or an @ (all other
words are known to be no personal data, so they end a chain). Neighbouring tokens share transition potentials. Tokens that
are the same once signs are left out, and tokens that begin alike, share potentials over any distance: each such group has a
node of its own that all its members are linked to, so a group of m takes m links. Messages pass over all links until they
settle, and each token takes the label of its largest belief. So a number that stands apart somewhere is known where it runs
into another one, and what is cut short is known by its whole.

The weights are learned from a bounded sample of texts (``SAMPLE``), labelled by the patterns, by pseudo-likelihood: each
token's label given its neighbours' and its group's. A prior draws the weights to what the shapes of tokens mean anyway,
which is all there is if the sample is empty. What patterns refuse because it runs on for too long is left out of the sample.

Defined results: null text is empty and has no spans; places are code points from 0, ends exclusive; spans are ordered by
start, then by kind as listed; an added span overlaps no base span; each row gives one row; equal texts get equal spans,
whatever else is in the table but the sample; a very long text is one field in one task, with memory in proportion to its tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.llm.common import settled

KINDS = ("email", "ip", "card", "phone")
#: Different texts that the weights are learned from, and tokens of each.
SAMPLE, TOKENS = 2000, 200
#: Rounds of messages at most, and the change of a belief that ends them.
ROUNDS, SETTLED = 60, 1e-6
#: Digits that an added card or phone has at least.
LEAST_DIGITS = 7

LABELS = ("O", "B-email", "B-ip", "B-card", "I-card", "B-phone", "I-phone")
#: For each label its kind: 0 for none, else the place in KINDS from 1.
KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])
_BEGIN, _INSIDE = {1: 1, 2: 2, 3: 3, 4: 5}, {1: 1, 2: 2, 3: 4, 4: 6}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match can't begin inside a run of digits: what fails at its start fails there too
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9@._%+-])[A-Za-z._%+-]*+[0-9@][A-Za-z0-9@._%+-]*")
_SIGNS = re.compile(r"[^0-9]")
_GAP = re.compile(r"[ ().-]{0,3}")
_WORDS = re.compile(r"[A-Za-z]+")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap, found from each @ to the left, so that long runs aren't tried at every place."""
    free, at = 0, text.find("@")
    while at >= 0:
        head = text[free:at]
        local = len(head) - len(head.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if local else None
        if m:
            yield at - local, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind from 1, end) of what the patterns find, in order, and the places of numbers that run on for too long."""
    found = [(a, 1, b) for a, b in _emails(text)] if "@" in text else []
    long = []
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), 2, m.end()))
    for m in _CARD.finditer(text):
        digits = _SIGNS.sub("", m[0])
        if len(digits) > 19:
            long.append(m.span())
        elif len(digits) >= 12 and luhn(digits):
            found.append((m.start(), 3, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        n = len(_SIGNS.sub("", m[0]))
        if n > 15:
            long.append(m.span())
        elif n >= 9:
            found.append((m.start(), 4, m.end()))
    return sorted(found), long


# tokens and their features

_SHAPES = ("mail", "at", "ip", "dotted", "luhn", "hex", "letters", "plus", "opened", "after", "before", "alone")
_SIZES = (1, 2, 3, 4, 5, 7, 8, 9, 12, 20)
FEATURES = ("bias", *_SHAPES, *[f"digits{n}" for n in _SIZES], *[f"first{n}" for n in _SIZES], *[f"further{n}" for n in _SIZES])
_AT = {f: i for i, f in enumerate(FEATURES)}


def _size(n: int) -> int:
    return max((k for k in _SIZES if k <= n), default=1)


class Field:
    """A document's tokens: places, features (tokens x FEATURES, 0 or 1), whether each goes on from the one before it, and
    the groups that link them."""

    def __init__(self, text: str):
        self.spans, forms = [], []
        for m in _TOKEN.finditer(text):
            raw = m[0].lstrip("._%-")
            start = m.end() - len(raw)
            raw = raw.rstrip("._%-")
            if raw and not raw.strip("+") == "":
                self.spans.append((start, start + len(raw)))
                forms.append(raw)
        n = len(forms)
        self.joined = np.zeros(n, bool)
        for i in range(1, n):
            a, b = self.spans[i - 1][1], self.spans[i][0]
            self.joined[i] = b - a <= 3 and _GAP.fullmatch(text, a, b) is not None
        self.digits = [_SIGNS.sub("", f) for f in forms]
        self.x = np.zeros((n, len(FEATURES)), np.float32)
        for i, form in enumerate(forms):
            self.x[i, [_AT[f] for f in self._features(text, i, form)]] = 1
        self.same, self.alike = self._groups(forms)

    def _features(self, text: str, i: int, form: str) -> list[str]:
        digits, (start, end) = self.digits[i], self.spans[i]
        letters = _WORDS.search(form) is not None
        before = bool(self.joined[i])
        after = i + 1 < len(self.joined) and bool(self.joined[i + 1])
        out = ["bias"]
        if "@" in form:
            out.append("mail" if _MAIL.fullmatch(form) else "at")
        elif letters:
            out.append("hex" if len(form) >= 16 and set(form) <= set("0123456789abcdef") else "letters")
        else:
            parts = form.lstrip("+").split(".")
            if len(parts) == 4 and all(p.isdigit() and _small(p) for p in parts):
                out.append("ip")
            elif len(parts) > 2:
                out.append("dotted")
            else:
                size = _size(len(digits))
                out.append(f"digits{size}")
                out.append(f"further{size}" if before else f"first{size}")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append("luhn")
        if form[0] == "+":
            out.append("plus")
        if start and text[start - 1] == "(":
            out.append("opened")
        return [*out, *(["before"] if before else []), *(["after"] if after else []), *([] if before or after else ["alone"])]

    def _groups(self, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each token the number of the group of the same, and of those that begin alike; -1 for groups of one."""
        keys: list[tuple[str | None, str | None]] = []
        for form, digits in zip(forms, self.digits):
            key = form.lower() if "@" in form or _WORDS.search(form) else form if form.count(".") > 2 else digits
            key = key if len(key) >= LEAST_DIGITS else None
            keys.append((key, key[:8] if key and len(key) >= 8 else None))
        out = []
        for side in range(2):
            number: dict[str, int] = {}
            own = np.array([-1 if k[side] is None else number.setdefault(k[side], len(number)) for k in keys], np.int64)
            size = np.bincount(own[own >= 0], minlength=len(number) or 1)
            keep = (own >= 0) & (size[own] > 1)
            out.append(np.where(keep, own, -1))
        if len(out[0]):
            # a group of those that begin alike says nothing new where all its members are the same
            at = np.flatnonzero(out[1] >= 0)
            low, high = np.full(len(keys), len(keys)), np.full(len(keys), -1)
            np.minimum.at(low, out[1][at], out[0][at])
            np.maximum.at(high, out[1][at], out[0][at])
            alone = (low[out[1][at]] >= 0) & (low[out[1][at]] == high[out[1][at]])
            out[1][at[alone]] = -1
        return out[0], out[1]


# the model: weights of features, transitions and links


class Model:
    """``unary`` (features x labels), ``step`` (label x next label), ``start`` (labels), ``same`` and ``alike`` (one number
    each: what it is worth that a token and its group are of one kind)."""

    def __init__(self, flat: np.ndarray):
        f, k = len(FEATURES), len(LABELS)
        self.flat = flat
        self.unary = flat[: f * k].reshape(f, k)
        self.step = flat[f * k : f * k + k * k].reshape(k, k)
        self.start = flat[f * k + k * k : f * k + k * k + k]
        self.same, self.alike = flat[-2], flat[-1]


def prior() -> np.ndarray:
    """What shapes mean without any data, which is what the learned weights are drawn to."""
    f, k = len(FEATURES), len(LABELS)
    unary = np.zeros((f, k))
    unary[_AT["bias"], 0] = 3.0
    said = {"mail": ("B-email", 6.0), "at": ("B-email", 1.0), "ip": ("B-ip", 6.0), "luhn": ("B-card", 4.0), "first12": ("B-card", 2.0), "plus": ("B-phone", 3.5), "hex": ("O", 4.0), "letters": ("O", 4.0)}
    for name, (label, w) in said.items():
        unary[_AT[name], LABELS.index(label)] += w
    for name in ("digits9", "digits12"):
        unary[_AT[name], LABELS.index("B-phone")] += 0.5
    unary[_AT["further12"], LABELS.index("B-card")] += 2.0
    unary[_AT["further4"], LABELS.index("I-card")] += 1.0
    unary[_AT["further3"], LABELS.index("I-phone")] += 1.5
    unary[_AT["further4"], LABELS.index("I-phone")] += 1.5
    unary[_AT["further7"], LABELS.index("I-phone")] += 2.0
    step = np.zeros((k, k))
    start = np.zeros(k)
    for b, i in (("B-card", "I-card"), ("B-phone", "I-phone")):
        b, i = LABELS.index(b), LABELS.index(i)
        step[:, i] = -8.0
        step[b, i] = step[i, i] = 1.0
        start[i] = -8.0
    return np.concatenate([unary.ravel(), step.ravel(), start, [3.0, 2.0]])


def _silver(field: Field, text: str) -> np.ndarray:
    """Labels by the patterns; -1 where a number runs on for too long."""
    found, long = base_spans(text)
    out = np.zeros(len(field.spans), np.int64)
    for i, (a, b) in enumerate(field.spans):
        over = next(((s, kind) for s, kind, e in found if s < b and a < e), None)
        if over:
            first = not (i and field.spans[i - 1][1] > over[0])
            out[i] = (_BEGIN if first else _INSIDE)[over[1]]
        elif any(s < b and a < e for s, e in long):
            out[i] = -1
    return out


def _agreement(groups: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """For each token and kind the share of the other members of its group that are of that kind."""
    out, at = np.zeros((len(groups), len(KINDS) + 1)), np.flatnonzero((groups >= 0) & (kinds >= 0))
    total = np.zeros((groups.max(initial=-1) + 1, len(KINDS) + 1))
    np.add.at(total, (groups[at], kinds[at]), 1)
    others = total[groups[at]]
    others[np.arange(len(at)), kinds[at]] -= 1
    out[at] = others / np.maximum(others.sum(1, keepdims=True), 1)
    return out


def training_rows(text: str) -> list[tuple]:
    """(feature numbers, label, label before or -1, label after or -1, agreement, likeness) for a text's first TOKENS tokens
    that have a label."""
    field = Field(text)
    labels = _silver(field, text)
    kinds = np.where(labels >= 0, KIND_OF[np.maximum(labels, 0)], -1)
    same, alike = _agreement(field.same, kinds), _agreement(field.alike, kinds)
    out = []
    for i in np.flatnonzero(labels >= 0)[:TOKENS]:
        before = labels[i - 1] if field.joined[i] else -1
        after = labels[i + 1] if i + 1 < len(labels) and field.joined[i + 1] else -1
        out.append((np.flatnonzero(field.x[i]).tolist(), int(labels[i]), int(before), int(after), same[i].tolist(), alike[i].tolist()))
    return out


def fit(rows: list[tuple], steps: int = 200, rate: float = 0.1, spread: float = 2.0) -> Model:
    """The weights of largest pseudo-likelihood under a Gaussian prior around ``prior``, by steps of fixed number (Adam)."""
    mean = prior()
    if not rows:
        return Model(mean)
    n, f, k = len(rows), len(FEATURES), len(LABELS)
    x = np.zeros((n, f))
    for i, r in enumerate(rows):
        x[i, r[0]] = 1
    y, before, after = (np.array([r[j] for r in rows]) for j in (1, 2, 3))
    same, alike = (np.array([r[j] for r in rows])[:, KIND_OF] for j in (4, 5))
    truth, has, next_ = np.eye(k)[y], before >= 0, after >= 0
    flat = mean.copy()
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for t in range(1, steps + 1):
        w = Model(flat)
        z = x @ w.unary + w.same * same + w.alike * alike
        z[has] += w.step[before[has]]
        z[~has] += w.start
        z[next_] += w.step[:, after[next_]].T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = truth - p
        step = np.zeros((k, k))
        np.add.at(step, before[has], d[has])
        np.add.at(step.T, after[next_], d[next_])
        g = np.concatenate([(x.T @ d).ravel(), step.ravel(), d[~has].sum(0), [(d * same).sum(), (d * alike).sum()]])
        g -= (flat - mean) / spread**2
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        flat = flat + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return Model(flat)


# messages


def beliefs(field: Field, model: Model) -> np.ndarray:
    """Belief in each label of each token, by loopy messages over chains and groups."""
    n, k = field.x.shape[0], len(LABELS)
    unary = field.x @ model.unary
    first = ~field.joined
    unary[first] += model.start
    own = _normal(np.exp(unary - unary.max(1, keepdims=True))) if n else unary
    psi = np.exp(model.step - model.step.max())
    right = np.flatnonzero(field.joined)  # tokens with one before them in the chain
    links = []
    for groups, weight in ((field.same, model.same), (field.alike, model.alike)):
        at = np.flatnonzero(groups >= 0)
        if len(at):
            _, number = np.unique(groups[at], return_inverse=True)
            links.append((at, number, int(number.max()) + 1, np.exp(weight * (KIND_OF[:, None] == np.arange(len(KINDS) + 1)) - max(weight, 0))))
    forward, backward = np.full((len(right), k), 1 / k), np.full((len(right), k), 1 / k)
    down = [np.full((len(at), k), 1 / k) for at, *_ in links]
    belief = own
    for turn in range(ROUNDS):
        logs = np.log(own)
        np.add.at(logs, right, np.log(forward))
        np.add.at(logs, right - 1, np.log(backward))
        for (at, *_), d in zip(links, down):
            np.add.at(logs, at, np.log(d))
        new = _normal(np.exp(logs - logs.max(1, keepdims=True))) if n else logs
        change = np.abs(new - belief).max() if n else 0.0
        belief = new
        if not (len(right) or links):
            break
        forward_new = _normal(_without(belief[right - 1], backward) @ psi)
        backward_new = _normal(_without(belief[right], forward) @ psi.T)
        # each token tells its group what kind it is by all but the group; the group tells each member what the others say
        for j, (at, number, size, agree) in enumerate(links):
            up = np.log(_normal(_without(belief[at], down[j]) @ agree))
            total = np.zeros((size, up.shape[1]))
            np.add.at(total, number, up)
            others = total[number] - up
            down[j] = _normal(np.exp(others - others.max(1, keepdims=True)) @ agree.T)
        forward, backward = forward_new, backward_new
        if change < SETTLED and turn > 1:
            break
    return belief


def _normal(p: np.ndarray) -> np.ndarray:
    p = np.maximum(p, 1e-30)
    return p / p.sum(1, keepdims=True)


def _without(belief: np.ndarray, message: np.ndarray) -> np.ndarray:
    return _normal(belief / message)


def added_spans(text: str, found: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the field finds beside the patterns' spans."""
    field = Field(text)
    labels = beliefs(field, model).argmax(1) if field.spans else np.zeros(0, np.int64)
    groups: list[list[int]] = []
    for i in np.flatnonzero(labels > 0):
        goes_on = LABELS[labels[i]].startswith("I-") and groups and groups[-1][-1] == i - 1 and field.joined[i] and KIND_OF[labels[i - 1]] == KIND_OF[labels[i]]
        if goes_on:
            groups[-1].append(i)
        else:
            groups.append([i])
    out, k = [], 0
    taken = sorted((s, e) for s, _, e in found)
    furthest = list(np.maximum.accumulate([e for _, e in taken])) if taken else []
    starts = [s for s, _ in taken]
    for g in groups:
        kind = int(KIND_OF[labels[g[0]]])
        if kind > 2 and sum(len(field.digits[i]) for i in g) < LEAST_DIGITS:
            continue
        a, b = field.spans[g[0]][0], field.spans[g[-1]][1]
        k = int(np.searchsorted(starts, b))
        if not (k and furthest[k - 1] > a):
            out.append((a, kind, b))
    return out


# Spark

FOUND = "array<struct<start:int,kind:int,end:int,base:boolean>>"


def learned(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """A model from the ``sample`` different texts with digits or @ whose hashes are smallest."""
    own = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    least = own.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if least is None:
        return fit([])

    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[dict(zip(("x", "y", "before", "after", "same", "alike"), r)) for r in training_rows(t)] for t in texts], dtype=object)

    kind = "array<struct<x:array<int>,y:int,before:int,after:int,same:array<double>,alike:array<double>>>"
    chosen = own.where(F.col("h") <= least).groupBy("h").agg(F.max("text").alias("text"))
    got = chosen.select("h", F.pandas_udf(rows, kind)("text").alias("rows")).collect()
    return fit([tuple(x) for r in sorted(got, key=lambda r: r["h"]) for x in r["rows"]])


def spans_of(text: Column, model: Model) -> Column:
    """All spans of texts in order, those of the patterns marked ``base``; null for texts without a digit or @."""
    flat = model.flat

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(flat)
        for texts in batches:
            out = []
            for t in texts:
                if t is None:
                    out.append(None)
                    continue
                base, _ = base_spans(t)
                both = [(*s, True) for s in base] + [(*s, False) for s in added_spans(t, base, own)]
                out.append([dict(zip(("start", "kind", "end", "base"), s)) for s in sorted(both)])
            yield pd.Series(out, dtype=object)

    # nothing to find without a digit or an @: such texts don't leave the JVM
    return F.pandas_udf(found, FOUND)(F.when(text.rlike("[0-9@]"), text))


def personal_data(docs: DataFrame, text: str = "text", name: str = "personal", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with a column ``name``: an array of (start, kind, end, base), kind from 1 as in KINDS."""
    docs = settled(docs)
    return docs.withColumn(name, spans_of(F.col(text), learned(docs, text, sample)))


def _listed(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    said = F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.coalesce(F.array_join(said, ","), F.lit(""))


def personal_report(docs: DataFrame) -> DataFrame:
    """One row for each document: counts of the base kinds, a digest of their spans, and all spans."""
    found = personal_data(docs.select("doc_id", "text")).select("doc_id", "personal")
    base = F.filter("personal", lambda s: s["base"])
    n = lambda k: F.coalesce(F.size(F.filter(base, lambda s: s["kind"] == k)), F.lit(0)).cast("long")
    counts = [F.when(F.col("personal").isNull(), F.lit(0)).otherwise(n(i + 1)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("personal")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; spans that overlap become one, of the first's kind."""
    own = docs.columns
    docs = settled(docs)
    model = learned(docs, text, sample)
    whole = F.struct(*[F.col(c) for c in own]).alias("doc")
    flat = model.flat

    def hidden(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = Model(flat)
        for texts in batches:
            yield pd.Series([t if t is None else _hidden(t, fitted) for t in texts], dtype=object)

    made = F.coalesce(F.pandas_udf(hidden, "string")(F.when(F.col(text).rlike("[0-9@]"), F.col(text))), F.col(text))
    return docs.select(whole, made.alias("made")).select(*[F.col("made").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in own])


def _hidden(text: str, model: Model) -> str:
    base, _ = base_spans(text)
    out, at = [], 0
    for start, kind, end in sorted([*base, *added_spans(text, base, model)]):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind - 1].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
