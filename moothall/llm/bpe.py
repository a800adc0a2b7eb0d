"""Byte-level BPE in DuckDB, one database for each Python worker.

Each match of the split pattern is a word. A batch's words that the worker hasn't met yet become token-position rows,
which a recursive query joins to the merge table until no pair is left: every round contracts each word's leftmost
pair of minimum rank. Decoding joins token ids to the vocabulary and aggregates the pieces in order of position.

Words of up to ``SHORT`` bytes take one contraction a round. Longer ones (long runs of letters or spaces) contract all
occurrences of the minimum pair in a round, from the left, up to the first one that makes a pair of a smaller rank;
that gives what one contraction after another gives, in far fewer rounds.

Defined results: null text encodes as the empty text, the empty text has no ids, null ids decode to no bytes, and
what isn't a list of known ids decodes to null. Texts
are worked through in pieces of ``CHARS`` characters or ``WORDS`` words, so that memory doesn't grow with a text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of text, or words of a longer text, that are held as Python strings at once.
CHARS, WORDS = 2_000_000, 300_000
#: Bytes up to which a word counts as short; words that one recursive query takes; words in each half of the cache.
SHORT, CHUNK, CACHE = 48, 30_000, 150_000
#: Tokens that one decoding query takes.
TOKENS = 200_000

_ENCODE_SHORT = """
WITH RECURSIVE t(w, step, pos, tok, nxt, rank) AS (
    SELECT w, 0, pos, tok, nxt, rank FROM init LEFT JOIN merges ON key = tok::BIGINT * 65536 + nxt
  UNION ALL (
    WITH best AS (SELECT w, min(rank::BIGINT * 65536 + pos) AS k FROM t WHERE rank IS NOT NULL GROUP BY w),
    pair AS (
      SELECT best.w, (k // 65536)::INT AS r, (k % 65536)::INT AS p, t.nxt AS after
      FROM best JOIN t ON t.w = best.w AND t.pos = (k % 65536) + 1),
    merged AS (
      SELECT t.w, step + 1 AS step, CASE WHEN pos > p THEN pos - 1 ELSE pos END AS pos,
             CASE WHEN pos = p THEN r ELSE tok END AS tok,
             CASE WHEN pos = p THEN after WHEN pos = p - 1 THEN r ELSE nxt END AS nxt
      FROM t JOIN pair ON t.w = pair.w WHERE pos <> p + 1)
    SELECT w, step, pos::INT, tok, nxt, m.rank
    FROM merged LEFT JOIN merges m ON m.key = merged.tok::BIGINT * 65536 + merged.nxt))
SELECT w, pos, tok FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) ORDER BY w, pos
"""

_ENCODE_LONG = """
WITH RECURSIVE t(w, pos, tok, done) AS (
    SELECT w, pos, tok, false FROM init
  UNION ALL (
    WITH near AS (
      SELECT w, pos, tok, lag(tok) OVER o AS prev, lead(tok) OVER o AS nxt, lead(tok, 2) OVER o AS after
      FROM t WHERE NOT done WINDOW o AS (PARTITION BY w ORDER BY pos)),
    ranked AS (SELECT near.*, m.rank FROM near LEFT JOIN merges m ON m.key = tok::BIGINT * 65536 + nxt),
    best AS (SELECT *, min(rank) OVER (PARTITION BY w) AS low FROM ranked),
    hits AS (SELECT *, coalesce(rank = low, false) AS hit FROM best),
    checked AS (
      SELECT h.*, coalesce(least(a.rank, b.rank, c.rank) < low, false) AS unsafe
      FROM hits h
      LEFT JOIN merges a ON a.key = CASE WHEN hit THEN prev::BIGINT * 65536 + low END
      LEFT JOIN merges b ON b.key = CASE WHEN hit THEN low::BIGINT * 65536 + after END
      LEFT JOIN merges c ON c.key = CASE WHEN hit THEN low::BIGINT * 65536 + low END),
    counted AS (
      SELECT *, row_number() OVER o AS n, sum(hit::INT) OVER o AS nth, sum(unsafe::INT) OVER o - unsafe::INT AS stop
      FROM checked WINDOW o AS (PARTITION BY w ORDER BY pos)),
    taken AS (
      SELECT *, hit AND stop = 0 AND row_number() OVER (PARTITION BY w, hit, n - nth ORDER BY pos) % 2 = 1 AS take
      FROM counted)
    SELECT w, pos, CASE WHEN take THEN low ELSE tok END, low IS NULL
    FROM (SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY pos), false) AS gone FROM taken)
    WHERE NOT gone))
SELECT w, pos, tok FROM t WHERE done ORDER BY w, pos
"""

_DECODE = """
SELECT string_agg(piece, '' ORDER BY pos) FROM rows JOIN vocab USING (tok)
"""


class Codec:
    """A worker's database with the merge table and the vocabulary, and the ids of words met lately."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import duckdb
        import pyarrow as pa
        import regex

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks_file.splitlines() if x)}
        self.ranks = ranks
        # white space as Unicode defines it; the regex module agrees with that for \s
        self.pattern = regex.compile(pattern)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [
            (ranks[t[:i]] * 65536 + ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        key, rank = map(np.array, zip(*pairs))
        self.register("m", pa.table({"key": pa.array(key, pa.int64()), "rank": pa.array(rank, pa.int32())}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM m")
        # each byte stands as the character of its number, so that pieces of a character can be strings
        vocab = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "piece": [t.decode("latin-1") for t in ranks]})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = [len(t) for t in ranks]
        self.register("v", vocab)
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM v")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def register(self, name: str, rows) -> None:
        self.con.register(name, rows)

    def contract(self, words: list[str], query: str) -> list[bytes]:
        """The ids of each word, by one recursive query over their bytes."""
        import pyarrow as pa

        coded = [x.encode() for x in words]
        n = np.array([len(b) for b in coded])
        tok = self.byte[np.frombuffer(b"".join(coded), np.uint8)]
        w = np.repeat(np.arange(len(coded), dtype=np.int32), n)
        pos = (np.arange(len(tok)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        last = np.append(w[1:] != w[:-1], True)
        nxt = pa.array(np.append(tok[1:], 0).astype(np.int32), mask=last)
        self.register("init", pa.table({"w": w, "pos": pos, "tok": tok, "nxt": nxt}))
        got = self.con.sql(query).to_arrow_table()
        w, tok = got.column("w").to_numpy(), got.column("tok").to_numpy().astype("<u4")
        ends = np.searchsorted(w, np.arange(len(coded) + 1))
        return [tok[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]

    def learn(self, words: set[str]) -> None:
        """Put the ids of these words into the cache."""
        if len(self.new) > CACHE:
            self.old, self.new = self.new, {}
        short, long = [], []
        for x in words:
            if x in self.new:
                continue
            if (ids := self.old.get(x)) is not None:
                self.new[x] = ids
            elif (rank := self.ranks.get(coded := x.encode())) is not None:
                self.new[x] = rank.to_bytes(4, "little")
            else:
                (short if len(coded) <= SHORT else long).append(x)
        for i in range(0, len(short), CHUNK):
            part = short[i : i + CHUNK]
            self.new.update(zip(part, self.contract(part, _ENCODE_SHORT)))
        for x in long:
            self.new[x] = self.contract([x], _ENCODE_LONG)[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as unsigned 32-bit little-endian integers."""
        out: list[bytes] = []
        batch: list[list[str]] = []
        chars = 0

        def flush() -> None:
            nonlocal batch, chars
            self.learn(set().union(*batch))
            ids = self.new.__getitem__
            out.extend(b"".join(map(ids, words)) for words in batch)
            batch, chars = [], 0

        for text in texts:
            if len(text) > CHARS:
                flush()
                parts, matches = [], self.pattern.finditer(text)
                while words := [m[0] for m in islice(matches, WORDS)]:
                    self.learn(set(words))
                    parts.append(b"".join(map(self.new.__getitem__, words)))
                out.append(b"".join(parts))
                continue
            batch.append(self.pattern.findall(text))
            chars += len(text)
            if chars > CHARS:
                flush()
        flush()
        return out

    def known(self, ids: bytes) -> bool:
        """Whether these are ids of the vocabulary."""
        if len(ids) % 4:
            return False
        tok = np.frombuffer(ids, "<u4")
        return not len(tok) or bool(tok.max() < len(self.length) and self.length[tok].all())

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids, all of them known."""
        import pyarrow as pa

        tok = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        text = []
        for i in range(0, len(tok), TOKENS):
            t = tok[i : i + TOKENS]
            self.register("rows", pa.table({"pos": np.arange(len(t), dtype=np.int32), "tok": t}))
            text.append(self.con.sql(_DECODE).fetchall()[0][0].encode("latin-1"))
        whole = b"".join(text)
        ends = np.cumsum(np.append(0, self.length[tok]))[np.cumsum([0] + [len(x) // 4 for x in ids])]
        return [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(ranks_file: bytes, pattern: str) -> Codec:
    """The worker's codec; it outlives a task, as the worker does."""
    if (key := (hash(ranks_file), pattern)) not in _codecs:
        _codecs[key] = Codec(ranks_file, pattern)
    return _codecs[key]


def _pieces(values: list, size: int) -> Iterator[list]:
    """Consecutive parts of a list, of about ``size`` bytes or characters each."""
    part, n = [], 0
    for x in values:
        part.append(x)
        n += len(x)
        if n > size:
            yield part
            part, n = [], 0
    if part:
        yield part


def encode(text: Column, vocabulary: str, pattern: str) -> Column:
    """The ids of a text by the rank file ``vocabulary``, as binary: little-endian unsigned 32-bit integers."""
    with open(vocabulary, "rb") as f:
        ranks_file = f.read()

    @F.pandas_udf("binary")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(ranks_file, pattern)
        for texts in batches:
            yield pd.Series(codec.encode(texts.fillna("").tolist()), dtype=object)

    return coded(text)


def round_trip(text: Column, vocabulary: str, pattern: str) -> Column:
    """struct<ids, decoded>: what ``encode`` gives, and what ``decode`` makes of that, by one codec in each worker."""
    with open(vocabulary, "rb") as f:
        ranks_file = f.read()

    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(ranks_file, pattern)
        for texts in batches:
            ids = codec.encode(texts.fillna("").tolist())
            decoded = [b for part in _pieces(ids, 4 * TOKENS) for b in codec.decode(part)]
            yield pd.DataFrame({"ids": ids, "decoded": decoded})

    return F.pandas_udf(both, "ids binary, decoded binary")(text)


def decode(ids: Column, vocabulary: str, pattern: str) -> Column:
    """The bytes that a binary column of ids stands for."""
    with open(vocabulary, "rb") as f:
        ranks_file = f.read()

    @F.pandas_udf("binary")
    def plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(ranks_file, pattern)
        for ids in batches:
            values = [b"" if x is None else bytes(x) for x in ids]
            good = [codec.known(x) for x in values]
            plain = (b for part in _pieces([x for x, ok in zip(values, good) if ok], 4 * TOKENS) for b in codec.decode(part))
            yield pd.Series([next(plain) if ok else None for ok in good], dtype=object)

    return plain(ids)
