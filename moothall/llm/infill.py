"""Fill-in-middle rewriting of texts.

A text is cut in two places, counted in units (code points, or words with the gap behind them), into prefix, middle and
suffix, which are put in another order behind marks. To find a cut, the text's UTF-8 bytes are seen as blocks of ``BLOCK``
bytes. A Fenwick tree over the blocks has, for each block, how many units and how many code points begin in it; a descent by
powers of two finds the block that holds the cut and what is before it, and only that block is searched for the place.

Where a text is cut and what form it gets depends on the hash of its id alone, so a job that is run again gives the same.

Defined results: null text is empty; a null id counts as an empty one; empty texts, texts that hold a mark and a tenth of
the others stay plain; both cuts may fall on one place or on an end, which leaves a part empty; each row gives one row and
keeps its columns, of which one named like the result is replaced; a very long text needs about two bytes of memory for
each of its own besides its text and output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a block.
BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are rewritten, and of 100 of these so many begin with the suffix.
REWRITTEN, SUFFIX_FIRST = 90, 20
MADE = "output string, n_units long, prefix_chars long, middle_chars long"


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The Fenwick tree (one row for each block, from 1) of rows of counts."""
    tree = np.zeros((len(counts) + 1, *counts.shape[1:]), np.int64)
    tree[1:] = counts
    step = 1
    while step < len(tree):
        # nodes whose lowest bit is 2 * step take in the node that ends in their middle
        at = np.arange(2 * step, len(tree), 2 * step)
        tree[at] += tree[at - step]
        step *= 2
    return tree


def descend(tree: np.ndarray, unit: int) -> tuple[int, np.ndarray]:
    """The number of the block in which unit ``unit`` (from 0) begins, and the counts before that block; the number of
    blocks if there is no such unit."""
    at, before, step = 0, np.zeros(tree.shape[1], np.int64), 1 << (len(tree) - 1).bit_length()
    while step:
        if at + step < len(tree) and before[0] + tree[at + step, 0] <= unit:
            at += step
            before = before + tree[at]
        step >>= 1
    return at, before


class Cuts:
    """A text's bytes and the tree over its blocks."""

    def __init__(self, data: bytes, units: str = "char", block: int = BLOCK):
        self.data, self.block = np.frombuffer(data, np.uint8), block
        self.chars = (self.data & 0xC0) != 0x80
        self.starts = self.chars if units == "char" else self._words()
        at = np.arange(0, len(self.data), block)
        both = [np.add.reduceat(x, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64) for x in (self.starts, self.chars)]
        self.tree = fenwick(np.stack(both, axis=1))
        self.n_units, self.n_chars = int(both[0].sum()), int(both[1].sum())

    def _words(self) -> np.ndarray:
        """Where words begin: bytes after white space that aren't white space; the first unit begins with the text."""
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        starts = ~blank
        starts[1:] &= blank[:-1]
        if len(starts) and blank[0]:
            first = np.flatnonzero(starts)[:1]
            starts[first] = False
        starts[:1] = True
        return starts

    def place(self, unit: int) -> tuple[int, int]:
        """The byte and the code point at which a unit begins; the text's end after the last one."""
        k, before = descend(self.tree, unit)
        low = k * self.block
        if low >= len(self.data):
            return len(self.data), self.n_chars
        own = low + int(np.flatnonzero(self.starts[low : low + self.block])[unit - before[0]])
        return own, int(before[1]) + int(np.count_nonzero(self.chars[low:own]))


def rewrite(text: str, first: int, second: int, form: str, units: str = "char") -> tuple[str, int, int | None, int | None]:
    """The rewritten text, its number of units, and the code points of prefix and middle (null if plain)."""
    data = text.encode()
    cuts = Cuts(data, units)
    if form == "plain":
        return text, cuts.n_units, None, None
    (a, chars_a), (b, chars_b) = cuts.place(first), cuts.place(second)
    prefix, middle, suffix = data[:a].decode(), data[a:b].decode(), data[b:].decode()
    parts = (SUFFIX, suffix, PREFIX, prefix) if form == "spm" else (PREFIX, prefix, SUFFIX, suffix)
    return "".join((*parts, MIDDLE, middle)), cuts.n_units, chars_a, chars_b - chars_a


def rewritten(text: Column, first: Column, second: Column, form: Column, units: str = "char") -> Column:
    """struct (output, n_units, prefix_chars, middle_chars) of texts cut before units ``first`` and ``second``."""

    def made(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [rewrite(t, int(a), int(b), f, units) for t, a, b, f in zip(*batch, strict=True)]
            out = pd.DataFrame(rows, columns=["output", "n_units", "prefix_chars", "middle_chars"])
            yield out.astype({"n_units": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return F.pandas_udf(made, MADE)(F.coalesce(text, F.lit("")), first, second, form)


def unit_count(text: Column, units: str = "char") -> Column:
    """How many units a text has."""
    whole = F.coalesce(text, F.lit(""))
    if units == "char":
        return F.char_length(whole).cast("long")
    n = F.size(F.split(F.regexp_replace(whole, r"^[\x20\t-\r]+|[\x20\t-\r]+$", ""), r"[\x20\t-\r]+"))
    return F.when(whole == "", F.lit(0)).otherwise(n).cast("long")


def drawn(key: Column, k: int, seed: int = 1) -> Column:
    """The k-th (from 1) of eight 32-bit numbers that a key's hash gives."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def form_of(text: Column, key: Column, seed: int = 1) -> Column:
    """plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle)."""
    whole = F.coalesce(text, F.lit(""))
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (drawn(key, 3, seed) % 100 >= REWRITTEN)
    return F.when(plain, "plain").when(drawn(key, 4, seed) % 100 < SUFFIX_FIRST, "spm").otherwise("psm")


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", units: str = "char", seed: int = 1, name: str = "fim") -> DataFrame:
    """``docs`` with a column ``name``: struct (form, output, n_units, prefix_chars, middle_chars)."""
    own = F.col(text)
    n = unit_count(own, units) + 1
    cuts = [drawn(F.col(key), k, seed) % n for k in (1, 2)]
    form = form_of(own, F.col(key), seed)
    made = rewritten(own, F.least(*cuts), F.greatest(*cuts), form, units)
    doc = F.struct(*[F.col(c) for c in docs.columns if c != name])
    parts = [F.col("form"), *[F.col(f"made.{c}") for c in ("output", "n_units", "prefix_chars", "middle_chars")]]
    return docs.select(doc.alias("doc"), form.alias("form"), made.alias("made")).select("doc.*", F.struct(*parts).alias(name))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made from. A rewritten text holds no mark, and none can come about
    where parts meet, so the marks cut an output into exactly four pieces, the first of them empty."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda k: F.get(parts, F.lit(k))
    return F.when(form == "plain", output).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(F.concat(part(1), part(3), part(2)))


ORACLE = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
num AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM doc),
form AS (
  SELECT *, least(a, b) AS i, greatest(a, b) AS j, CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {REWRITTEN}
    THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM num),
part AS (SELECT *, substring(t, 1, i) AS p, substring(t, i + 1, j - i) AS m, substring(t, j + 1) AS s FROM form)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part
"""


def fim_report(docs: DataFrame) -> DataFrame:
    """One row for each document: its form, the lengths of its parts, and digests of the output and of what is restored
    from it."""
    made = fill_in_middle(docs.select("doc_id", "text")).select("doc_id", "fim.*")
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
