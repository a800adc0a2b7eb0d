"""Secret scans over an incremental ledger of blobs.

Every version of every document is addressed by the SHA-256 of its text. Only pairs of blob and rule version that the
ledger doesn't hold are scanned, each once however many paths carry it; findings are then joined back to all paths. One
representative row of each unseen blob is chosen by its row number before any text moves, so a text that a third of all
rows share is neither gathered nor scanned twice.

All of it is DataFrame functions. Spark has no function for the places of matches: a text's gaps between matches and the
matches themselves give lengths in code points, and a running sum over a blob's lengths gives the places.

Defined results: null text is the empty blob, without findings; every row of the input comes back once, with its own
columns whatever their names; places are code points from 0, ends exclusive; a very long text is scanned whole in one row,
and its matches become rows of their own. Rows of kinds that a rule set lists later sort after earlier kinds at the same start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moothall.llm.common import once, settled


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The version goes up with every change of a rule: blobs are then scanned anew.
VERSION = 1
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", "[0-9a-f]{16,}", 0, 16, True),  # a shorter run fails whole, so runs of 16 or more are all that stay
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def versions(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, blob, text, doc) of ``docs``: a row number, the text and its address, and all other columns of the row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    doc = F.struct(*[F.col(c) for c in docs.columns if c != text] or [F.lit(0).alias("none")]).alias("doc")
    return docs.select(F.monotonically_increasing_id().alias("row"), F.sha2(whole, 256).alias("blob"), F.col(text).alias("text"), doc)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """(blob, kind, number of the rule, start, end) of each finding in rows of blob and text."""

    def lengths(rule: Rule) -> Column:
        pattern, t = F.lit(rule.pattern), F.col(text)
        gaps = F.transform(F.split(t, rule.pattern, -1), lambda x: F.char_length(x).alias("gap"))
        found = F.transform(F.regexp_extract_all(t, pattern, F.lit(0)), lambda x: F.char_length(x))
        counts = F.regexp_extract_all(t, pattern, F.lit(rule.group)) if rule.group else None
        kept = F.transform(counts, lambda x: F.char_length(x)) if rule.group else found
        return F.when(t.rlike(rule.pattern), F.arrays_zip(gaps.alias("gap"), found.alias("found"), kept.alias("kept")))

    kinds = [
        F.struct(F.lit(i).alias("rule"), lengths(r).alias("parts")) for i, r in enumerate(rules)
    ]
    any_rule = F.lit(False)
    for r in rules:
        any_rule = any_rule | F.col(text).rlike(r.pattern)
    each = blobs.where(any_rule).select("blob", F.inline(F.array(*kinds))).where("parts IS NOT NULL")
    each = each.select("blob", "rule", F.posexplode("parts").alias("k", "part"))
    each = each.select("blob", "rule", "k", "part.gap", "part.found", "part.kept")
    before = Window.partitionBy("blob", "rule").orderBy("k")
    end = F.sum(F.col("gap") + F.coalesce("found", F.lit(0))).over(before)
    each = each.withColumn("end", end)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rule") + 1)
    each = each.where(F.col("kept") >= least)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule") + 1)
    return each.select("blob", kind.alias("kind"), "rule", (F.col("end") - F.col("found")).alias("start"), "end")


def scan_unseen(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, version: int = VERSION
) -> DataFrame:
    """Rows for the ledger: (blob, rule_version, findings) for each blob that ``ledger`` lacks at this version and that
    has findings; ``findings`` is an array of (start, rule, end, kind) in order."""
    all_versions = versions(settled(docs))
    first = all_versions.groupBy("blob").agg(F.min("row").alias("row"))
    if ledger is not None:
        first = first.join(ledger.where(F.col("rule_version") == version), "blob", "left_anti")
    unseen = all_versions.select("row", "blob", "text").join(first.select("row"), "row", "left_semi")
    found = scan(unseen, rules).groupBy("blob")
    findings = F.array_sort(F.collect_list(F.struct("start", "rule", "end", "kind")))
    return found.agg(findings.alias("findings")).withColumn("rule_version", F.lit(version))


def extend(docs: DataFrame, ledger: DataFrame | None = None, version: int = VERSION, **rules) -> DataFrame:
    """The ledger with all blobs of ``docs`` in it, those without findings with an empty list."""
    new = versions(docs).select("blob").distinct()
    if ledger is not None:
        new = new.join(ledger.where(F.col("rule_version") == version), "blob", "left_anti")
    found = scan_unseen(docs, ledger, version=version, **rules).select("blob", "findings")
    kind = found.schema["findings"].dataType
    new = new.join(found, "blob", "left").select(
        "blob", F.lit(version).alias("rule_version"), F.coalesce("findings", F.array().cast(kind)).alias("findings")
    )
    return new if ledger is None else ledger.unionByName(new)


def findings_by_path(
    docs: DataFrame, ledger: DataFrame | None = None, version: int = VERSION, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(row, blob, text, doc, findings): what the ledger or a scan of unseen blobs has for each row's text; null if
    nothing. ``doc`` has the other columns of ``docs``, whatever their names."""
    found = scan_unseen(docs, ledger, rules, version).select("blob", "findings")
    if ledger is not None:
        found = found.unionByName(ledger.where(F.col("rule_version") == version).select("blob", "findings"))
    return versions(docs).join(found, "blob", "left")


def _listed(findings: Column) -> Column:
    text = F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.coalesce(F.array_join(text, ","), F.lit(""))


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each document: counts of the base kinds, a digest of their spans, and all spans."""
    found = findings_by_path(docs.select("doc_id", "text"), rules=rules)
    n_base = sum(r.base for r in rules)
    base = F.filter("findings", lambda x: x["rule"] < n_base)

    def count(kind: str) -> Column:
        of_kind = F.filter("findings", lambda x: x["kind"] == kind)
        return F.when(F.col("findings").isNull(), 0).otherwise(F.size(of_kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc.doc_id",
        *[count(r.kind) for r in rules if r.base],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("findings")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; findings that overlap become one mark."""
    own = docs.columns
    found = findings_by_path(docs)
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.transform("findings", lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end")))

    def joined(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (x["start"] < last["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(x))
        )

    found = once(found, __merged=F.aggregate(spans, nothing, joined))
    begin = F.concat(F.array(F.lit(0)), F.col("__merged.end"))
    end = F.concat(F.col("__merged.start"), F.array(F.char_length("text")))
    pieces = F.zip_with(begin, end, lambda a, b: F.substring(F.col("text"), a + 1, b - a))
    text = F.when(F.col("findings").isNull(), F.col("text")).otherwise(F.array_join(pieces, mark)).alias("text")
    return found.select(*[text if c == "text" else F.col("doc").getField(c).alias(c) for c in own])


def _oracle() -> str:
    quoted = lambda x: x.replace("'", "''")
    parts = " UNION ALL ".join(
        f"SELECT r, {i} AS rule, '{x.kind}' AS kind, {x.least} AS least, regexp_split_to_array(t, '{quoted(x.pattern)}') AS gaps, "
        f"regexp_extract_all(t, '{quoted(x.pattern)}') AS found, regexp_extract_all(t, '{quoted(x.pattern)}', {x.group}) AS kept FROM doc"
        for i, x in enumerate(RULES)
    )
    n_base = sum(r.base for r in RULES)
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({parts}),
each AS (
  SELECT r, rule, kind, least, k, length(gaps[k]) AS gap, length(found[k]) AS n, length(kept[k]) AS kept
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM parts)),
placed AS (SELECT *, sum(gap + n) OVER (PARTITION BY r, rule ORDER BY k)::BIGINT AS stop FROM each),
span AS (SELECT *, stop - n AS start, kind || ':' || (stop - n) || ':' || stop AS said FROM placed WHERE kept >= least),
total AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b,
         count(*) FILTER (kind = 'hex') AS c,
         string_agg(said, ',' ORDER BY start, rule) FILTER (rule < {n_base}) AS base,
         string_agg(said, ',' ORDER BY start, rule) AS every
  FROM span GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM doc LEFT JOIN total USING (r)
"""


ORACLE = _oracle()
