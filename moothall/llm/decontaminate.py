"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every window of the documents.

All of it is DataFrame functions. A document becomes one head row (its number of words) and one row for each window of
words; windows meet the benchmark's in a hash join on a 64-bit hash, and the join compares the words themselves, so a
hit is never a mere collision. Only head rows and hits are shuffled. The benchmark's windows are broadcast while there
are at most ``max_broadcast`` of them, which is counted first; beyond that the join shuffles.

A window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window. Words are runs of
digits, a-z and characters beyond ASCII after A-Z are lower-cased.

Defined results: null and empty texts have no words and no hits; repeated documents are rows of their own; an item that
occurs in several rows counts once by its id; items without an id hit words but aren't listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.llm.common import once, settled, words_of

#: Words of a window, and windows up to which the benchmark's are broadcast.
N, MAX_BROADCAST = 10, 1_000_000
#: A word before lower-casing.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _grams(words: Column, length: int) -> Column:
    """(place from 0, words) of each run of ``length`` words."""
    n = F.size(words)
    places = F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct((i - 1).alias("at"), F.slice(words, i, length).alias("gram")))


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row for each different window: length, gram, key and the ids of its items."""
    items = once(benchmark.select(F.col("item_id"), F.col("text")), words=words_of(F.col("text")))
    items = items.withColumn("length", F.least(F.lit(n), F.size("words"))).where("length > 0")
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    grams = F.transform(starts, lambda i: F.slice("words", i, F.col("length")))
    each = items.select("item_id", "length", F.explode(grams).alias("gram"))
    found = each.groupBy("length", "gram").agg(F.collect_set("item_id").alias("items"))
    return found.withColumn("key", F.xxhash64("gram"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N, max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """For each row of ``docs`` (its number in ``row``): n_words, hits (place and length of each window found, places
    from 0) and items."""
    windows = benchmark_windows(benchmark, n)
    sizes = {r["length"]: r["count"] for r in windows.groupBy("length").count().collect()}
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    rows = once(rows, words=words_of(F.col("text")))
    # null for the head row's gram; the place of a head row is -1 - the number of words
    head = F.struct((-1 - F.size("words")).alias("at"), F.lit(None).cast("array<string>").alias("gram"))
    grams = [_grams(F.col("words"), length) for length in sorted(sizes)]
    rows = rows.select("row", F.inline(F.concat(F.array(head), *grams)))
    rows = rows.withColumn("key", F.xxhash64("gram"))
    windows = windows.select("key", F.col("gram").alias("window"), "length", "items")
    if sum(sizes.values()) <= max_broadcast:
        windows = F.broadcast(windows)
    met = rows.join(windows, (rows.key == windows.key) & (rows.gram == windows.window), "left")
    met = met.where("at < 0 OR length IS NOT NULL")
    hit = F.when(F.col("at") >= 0, F.struct("at", "length"))
    return met.groupBy("row").agg(
        F.max(F.when(F.col("at") < 0, -1 - F.col("at"))).alias("n_words"),
        F.collect_set(hit).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("at") >= 0, F.col("items"))))).alias("items"),
    )


def hit_words(hits: Column) -> Column:
    """The places of all words inside a hit."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["length"] - 1))))


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: how many of its words lie in benchmark windows, and whose."""
    docs = settled(docs)
    found = find_leaks(docs, benchmark)
    names = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id")
    found = found.join(names, "row")
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    found = found.withColumn("n_hit", F.size(hit_words(F.col("hits"))).cast("long"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with their hit words cut out of the texts.

    Columns stay as they are; other columns that describe a text, such as its length, are the caller's to update."""
    own, docs = docs.columns, settled(docs)
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    found = find_leaks(docs, benchmark).where(F.size("hits") > 0)
    if remove == "documents":
        return numbered.join(found.select(F.col("row").alias("__row")), "__row", "left_anti").select(*own)
    found = found.select(F.col("row").alias("__row"), hit_words(F.col("hits")).alias("__hit"))
    joined = numbered.join(found, "__row", "left")
    lead = F.regexp_extract("text", rf"^(?:(?!{ANY_CASE})[\s\S])*", 0)
    pieces = F.regexp_extract_all("text", F.lit(rf"{ANY_CASE}(?:(?!{ANY_CASE})[\s\S])*"), F.lit(0))
    joined = once(joined, __pieces=pieces, __mark=F.map_from_arrays("__hit", F.transform("__hit", lambda x: F.lit(True))))
    kept = F.filter("__pieces", lambda _, i: F.col("__mark")[i].isNull())
    text = F.when(F.col("__hit").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(kept, "")))
    return joined.withColumn("text", text).select(*own)


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH item AS (SELECT item_id, w, least({N}, len(w)) AS length FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark)),
spot AS (SELECT item_id, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM item WHERE length > 0),
win AS (SELECT DISTINCT item_id, length, list_slice(w, i, i + length - 1) AS gram FROM spot),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
place AS (
  SELECT r, w, length, unnest(range(1, len(w) - length + 2)) AS i
  FROM doc, (SELECT DISTINCT length FROM win) WHERE len(w) >= length),
hit AS (
  SELECT r, i, win.length, item_id
  FROM (SELECT r, i, length, list_slice(w, i, i + length - 1) AS gram FROM place) p JOIN win
    ON p.length = win.length AND p.gram = win.gram),
word AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + length)) AS k FROM hit) GROUP BY r),
found AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(word.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(found.ids, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN found USING (r)
"""
