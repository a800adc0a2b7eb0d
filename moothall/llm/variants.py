"""Spelling variants, grouped by pivotal grams.

Two words are near if one inserted, deleted or replaced code point makes one of the other. Bigrams with their places are
ordered by how many words have them, rare ones first. A word's prefix is its first three bigrams in that order (and any
that tie with the third): any three hold two that share no character, and one edit can't touch both of these. So of two near
words, the one whose prefix ends no later has one of its two *pivots* in the other's prefix, unharmed.

Which two a word takes for pivots is chosen by dynamic programming over its prefix from left to right, so that they stand
apart and cost least: how many words have the bigram, less by a half for each character of the side that has to agree.
Where the edit is not in or left of the left pivot, all that is left of it agrees, and it stands at the same place;
otherwise all that is right of the right pivot agrees, and it stands at the same place from the end. So a word looks up
its left pivot with the text before it and its right pivot with the text after it (which fixes both positions), against
the prefixes of all others. Where four characters or more are on the other side, the first two of them or the word's last
two agree as well, so it looks up both of these instead. ``levenshtein`` verifies what meets. Nothing is lost and no bucket
is cut.

Words come from texts with planted errors: the contract of the query deletes one code point of a word where a hash of the
document's id and the word says so, which depends on nothing else.

Defined results: null text has no words; a null id counts as an empty one; a word without a near word has no form and is its
own root; of several forms with the same count the smallest in code-point order is taken; a table without words gives no
rows; the longest word is taken whole; repeated rows count as often as they come.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moothall.llm.common import cut

#: Code points and occurrences that a word has at least, and how many times as frequent its form is.
LENGTH, TIMES, RATIO = 6, 5, 5
#: One word of so many of a document is damaged.
DAMAGED = 199
#: What remains of a pivot's cost with each character beside it that has to agree, and how many of the other side's are
#: looked up as well.
FALLS, FURTHER = 0.5, 2
#: Different words that a task counts before it hands them on.
HELD = 200_000

_RUN = re.compile(rf"[A-Za-zÀ-ÿ]{{{LENGTH},}}")


def damaged(word: str, seed: int) -> str:
    """``word`` without the code point that its hash names, if the hash says so; ``seed`` is the crc32 of what comes first."""
    h = zlib.crc32(word.encode(), seed)
    if h % DAMAGED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def words_in(key: str, text: str) -> Counter:
    """The words of a text of LENGTH or more and how often each comes. The same run of a text has the same fate."""
    seed = zlib.crc32(f"{key}:".encode())
    out: Counter = Counter()
    # bytes.lower changes A-Z and nothing else
    for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
        word = damaged(run, seed)
        if len(word) >= LENGTH:
            out[word] += n
    return out


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = TIMES) -> DataFrame:
    """(word, n) of words that come ``least`` times or more; each task adds up its own texts before anything moves."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for k, t in zip(batch["k"], batch["t"], strict=True):
                held.update(words_in(k, t))
                if len(held) > HELD:
                    yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})

    own = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    return own.mapInPandas(partial, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def gram_order(words: DataFrame) -> dict[str, int]:
    """The place of each bigram in the order: rare ones first, ties by the bigram. Words have 90 different letters (a-z and
    U+00C0 to U+00FF), so this is 8,100 entries at most, however many words there are."""
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    each = words.select(F.explode(F.array_distinct(F.transform(at, lambda p: F.substring(F.col("word"), p, 2)))).alias("gram"))
    return {r["gram"]: i for i, r in enumerate(sorted(each.groupBy("gram").agg(F.count("*").alias("n")).collect(), key=lambda r: (r["n"], r["gram"])))}


def prefix_of(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(place in the order, place in the word) of the three first bigrams and of all that tie with the third, in order."""
    every = sorted((order[word[p : p + 2]], p) for p in range(len(word) - 1))
    last = every[2][0]
    return [g for g in every if g[0] <= last]


def pivots_of(prefix: list[tuple[int, int]], length: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """The cheapest two bigrams of a prefix that share no character, the left one first."""
    left = before = best = None
    for rank, p in sorted(prefix, key=lambda g: g[1]):
        # places differ, so all but the bigram right before this one have ended
        ended = min(filter(None, (left, before)), default=None) if before is None or before[1] + 2 <= p else left
        if ended is not None:
            pair = (ended[0] + (rank + 1) * FALLS ** min(length - 2 - p, 30), (ended[2], ended[1]), (rank, p))
            best = pair if best is None or pair < best else best
        left = min(filter(None, (left, before)), default=None)
        before = ((rank + 1) * FALLS ** min(p, 30), p, rank)
    return best[1], best[2]


def keys_of(word: str, order: dict[str, int]) -> tuple[list[int], list[int], int]:
    """What a word looks up, what it is found by, and where its prefix ends. A key is a side, a bigram, how many characters
    stand on that side of it, which others are to agree, and a checksum of them all; letters are one byte each in latin-1."""
    data, n = word.encode("latin-1"), len(word)
    sides = (data, data[::-1])

    def sums(side: int, upto: int) -> list[int]:
        out = [0]
        for i in range(upto):
            out.append(zlib.crc32(sides[side][i : i + 1], out[-1]))
        return out

    def keys(side: int, rank: int, stands: int, kinds: tuple[int, ...]) -> list[int]:
        # 0: the side and the bigram; 1: the next characters too; 2: the last ones too
        whole, upto, own = sides[side], stands + 2, side << 62 | rank << 48 | (stands & 0x3FFF) << 32
        sums = made[side]
        crc = (sums[upto], sums[min(upto + FURTHER, n)], zlib.crc32(whole[-FURTHER:], sums[upto]))
        return [own | k << 46 | crc[k] for k in kinds]

    prefix = prefix_of(word, order)
    made = (sums(0, n), sums(1, n))
    look, found = [], []
    for side, (rank, p) in enumerate(pivots_of(prefix, n)):
        stands = p if side == 0 else n - 2 - p
        look += keys(side, rank, stands, (1, 2) if n - 2 - stands >= 2 * FURTHER else (0,))
    for rank, p in prefix:
        for side, stands in ((0, p), (1, n - 2 - p)):
            found += keys(side, rank, stands, (0, 1, 2) if n - 2 - stands >= 2 * FURTHER - 1 else (0,))
    return look, found, prefix[-1][0]


def keyed(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """(word, n, key, looks, last): a row for each key; ``looks`` if the word looks it up rather than being found by it."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"], batch["n"], strict=True):
                look, found, last = keys_of(word, order)
                rows += [(word, n, k, True, last) for k in look] + [(word, n, k, False, last) for k in found]
            yield pd.DataFrame(rows, columns=["word", "n", "key", "looks", "last"])

    return words.mapInPandas(made, "word string, n long, key long, looks boolean, last int")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for each pair of near words, both ways, once."""
    keys = cut(keyed(words, gram_order(words)))
    a = keys.where("looks").select("key", F.col("word").alias("a"), F.col("n").alias("an"), F.col("last").alias("al"))
    b = keys.where("NOT looks").select("key", F.col("word").alias("b"), F.col("n").alias("bn"), F.col("last").alias("bl"))
    meet = (a["key"] == b["key"]) & (F.col("al") <= F.col("bl")) & (F.abs(F.char_length("a") - F.char_length("b")) <= 1)
    one, other = F.struct(F.col("a").alias("word"), F.col("an").alias("n")), F.struct(F.col("b").alias("word"), F.col("bn").alias("n"))
    pairs = a.join(b, meet & (F.levenshtein("a", "b", 1) == 1)).select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y")).distinct()
    way = lambda x, y: F.struct(F.col(f"{x}.word").alias("word"), F.col(f"{y}.word").alias("near"), F.col(f"{y}.n").alias("near_n"))
    return pairs.select(F.inline(F.array(way("x", "y"), way("y", "x"))))


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows: the last word that a word's forms lead to. Each form is RATIO times as frequent as
    the word before, so forms make no ring; steps double in each round until none goes further."""
    steps = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.join(steps.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        steps = cut(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not steps.where("moved").take(1):
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) rows."""
    words = cut(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    every = words.join(near, "word", "left")
    frequent = -F.col("best.less") >= ratio * F.col("n")
    every = cut(every.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")))
    roots = rooted(every.where("form IS NOT NULL"))
    return every.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_report(docs: DataFrame) -> DataFrame:
    """Each word of ``docs`` (doc_id, text), its more frequent near form, and the word that these lead to."""
    return grouped(counted(docs.select("doc_id", "text")))
