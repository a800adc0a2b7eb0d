"""Extractors as data: each site has rules of its own, and one plan runs all sites' rules over all their pages.

A rule is a chain of steps for a field; each step is a row (site, field, step, op, css, arg, other), its selector compiled into
combinators and tests. A site's rows go along with its pages, and one evaluator parses a page once, finds what all its site's
selectors name in one pass over the nodes, and runs the chains from each row of the list. A new site is new rows; the plan
stays the same.

Fields with a meaning: ``container`` (one is expected; with arg ``first`` the first of several counts), ``row`` (all that its
first step names inside the container; further steps lead from each to the row), ``link`` and ``next`` (addresses, made
absolute), ``skip:<reason>`` (the row is marked with the first reason whose chain gives anything). All others are values.

Steps on nodes: select, last, find (arg: a pattern for the element's only text), having and lacking (arg: an attribute, other: a
pattern that it matches or doesn't), find_text, next, previous, parent,
next_sibling, previous_sibling (with a selector), next_node, next_text (the next text
that isn't blank), contents (arg: which). From nodes to texts: text (arg: separator,
other: raw keeps white space), string, attr, outer, pretty. On texts: replace, strip, split (other: which part), match (the
pattern's first group), lower, before (puts arg before it), absolute, default.

A chain that finds nothing gives null. A page whose rules raise is a failure with the error as its status, alone; the rest
of the job goes on.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moothall.operators import matching, selectors, tree

RULE = "site string, field string, step int, op string, css array<array<struct<sign:string,tests:array<struct<on:string,name:string,op:string,value:string>>>>>, arg string, other string"
#: More nodes than a page has: positions of a page's rows go on from those of the page before.
PAGE_NODES = 1 << 32
_CSS = frozenset("select last find having lacking next previous parent next_sibling previous_sibling".split())
_NODE = _CSS | {"find_text", "next_node", "next_text", "contents"}
_TO_TEXT = frozenset("text string attr outer pretty".split())
_TEXT = frozenset("replace strip split match lower before absolute default".split())

#: A step as it is written: its op, then what the op takes: a selector first, if it is one of those that do.
Written = tuple[str, ...]


def rule_rows(site: str, rules: Mapping[str, Sequence[Written]]) -> list[tuple]:
    """A site's rules as rows. ValueError for steps or selectors that there aren't."""
    out = []
    for field, chain in rules.items():
        for k, (op, *rest) in enumerate(chain):
            if op not in _NODE | _TO_TEXT | _TEXT:
                raise ValueError(f"no such step: {op!r}")
            css = selectors.steps(rest.pop(0) if rest else "*") if op in _CSS else None
            arg, other = (*rest, None, None)[:2]
            out.append((site, field, k, op, css, arg, other))
    return out


def rule_table(spark: SparkSession, sites: Mapping[str, Mapping[str, Sequence[Written]]]) -> DataFrame:
    """The rules of many sites as a table."""
    return spark.createDataFrame([r for site, rules in sites.items() for r in rule_rows(site, rules)], RULE)


def programs(rules: DataFrame) -> DataFrame:
    """(site, program): a site's rules as one text; a site has as many as someone wrote."""
    step = F.struct("field", "step", "op", "css", "arg", "other")
    return rules.groupBy("site").agg(F.to_json(F.array_sort(F.collect_list(step), lambda a, b: F.coalesce(_order(a, b, "field"), _order(a, b, "step"), F.lit(0)))).alias("program"))


def programs_of(sites: Mapping[str, Mapping[str, Sequence[Written]]]) -> dict[str, str]:
    """The same without Spark, for trying rules on a page."""
    named = ("site", "field", "step", "op", "css", "arg", "other")

    def as_row(row: tuple) -> dict:
        css = row[4] and [[{"sign": sign, "tests": [dict(zip(("on", "name", "op", "value"), t)) for t in tests]} for sign, tests in path] for path in row[4]]
        return dict(zip(named, row)) | {"css": css}

    return {site: json.dumps([as_row(r) for r in rule_rows(site, rules)]) for site, rules in sites.items()}


def _order(a, b, name: str):
    return F.when(a[name] < b[name], -1).when(a[name] > b[name], 1)


class Site:
    """A site's program, ready to run."""

    def __init__(self, program: str):
        self.chains: dict[str, list[dict]] = {}
        css = {}
        for step in json.loads(program):
            self.chains.setdefault(step["field"], []).append(step)
            if step.get("css") is not None:
                step["key"] = f"{step['field']}\0{step['step']}"
                css[step["key"]] = [[(s["sign"], [(t["on"], t["name"], t["op"], t["value"]) for t in s["tests"]]) for s in path] for path in step["css"]]
            pattern = step.get("other" if step["op"] in ("having", "lacking") else "arg")
            if step["op"] in ("find", "find_text", "match", "having", "lacking") and pattern is not None:
                step["pattern"] = re.compile(pattern)
        self.matching = matching.Program(css)
        self.skips = [f for f in self.chains if f.startswith("skip:")]
        self.values = [f for f in self.chains if f not in ("container", "row", "next") and f not in self.skips]


class Run:
    """A site's program on one page."""

    def __init__(self, site: Site, source: str, url: str | None, closed: bool = False):
        self.site, self.page, self.url = site, tree.Page(source, closed), url or ""
        self.hits = site.matching.run(self.page)

    def chain(self, field: str, at: int, skip: int = 0):
        value = at
        for step in self.site.chains[field][skip:]:
            if value is None and step["op"] != "default":
                continue
            value = self.step(step, value)
        return value

    def step(self, step: dict, value):
        op, arg, other = step["op"], step.get("arg"), step.get("other")
        if op in _NODE:
            return None if isinstance(value, str) else self.node(step, op, arg, value)
        if op in _TO_TEXT:
            return self.text(op, arg, other, value) if isinstance(value, int) else value
        if isinstance(value, int):
            value = self.page.joined_text(value)
        if op == "default":
            return value or arg
        if op == "replace":
            return value.replace(arg, other or "")
        if op == "split":
            parts = value.split(arg)
            k = int(other or 0)
            return parts[k] if -len(parts) <= k < len(parts) else None
        if op == "match":
            m = step["pattern"].search(value)
            return m and m[1 if m.re.groups else 0]
        if op == "absolute":
            return urljoin(self.url, value)
        return value.strip() if op == "strip" else value.lower() if op == "lower" else arg + value

    def text(self, op: str, arg: str | None, other: str | None, i: int) -> str | None:
        if op == "text":
            return self.page.joined_text(i, arg or "", other != "raw")
        if op == "string":
            return self.page.string(i)
        if op == "attr":
            return self.page.attrs[i].get(arg)
        return self.page.outer(i) if op == "outer" else self.page.pretty(i)

    def node(self, step: dict, op: str, arg: str | None, i: int) -> int | None:
        page, found = self.page, self.hits.get(step.get("key"), [])
        if op == "select":
            return matching.first(page, found, i) if arg is None else _nth(matching.below(page, found, i), int(arg))
        if op == "last":
            return _nth(matching.below(page, found, i), -1)
        if op == "find":
            return next((k for k in matching.below(page, found, i) if step["pattern"].search(page.string(k) or "")), None)
        if op in ("having", "lacking"):
            said = lambda k: arg in page.attrs[k] and step["pattern"].search(page.attrs[k][arg]) is not None
            return next((k for k in matching.below(page, found, i) if said(k) == (op == "having")), None)
        if op == "find_text":
            return next((k for k in matching.below(page, page.texts, i) if step["pattern"].search(page.text[k])), None)
        if op == "next":
            return _nth(found, matching.bisect_right(found, i) + int(arg or 0))
        if op == "previous":
            at = matching.bisect_right(found, i - 1) - 1 - int(arg or 0)
            return found[at] if at >= 0 else None
        if op == "next_node":
            return i + 1 if i + 1 < len(page.tag) else None
        if op == "next_text":
            at = matching.bisect_right(page.texts, i)
            return next((page.texts[k] for k in range(at, len(page.texts)) if page.text[page.texts[k]].strip()), None)
        if op == "contents":
            return _nth(page.kids(i), int(arg or 0))
        if op == "parent":
            up = page.up[i]
            while up >= 0 and not _has(found, up):
                up = page.up[up]
            return up if up >= 0 else None
        if op == "next_sibling":
            k, end = page.last[i] + 1, page.last[page.up[i]] if page.up[i] >= 0 else len(page.tag) - 1
            while k <= end and not _has(found, k):
                k = page.last[k] + 1
            return k if k <= end else None
        before = [k for k in (page.kids(page.up[i]) if page.up[i] >= 0 else ()) if k < i and _has(found, k)]
        return before[-1] if before else None

    def listed(self) -> tuple[str, list[dict]]:
        """A status (ok, none or several containers) and the rows."""
        steps = self.site.chains.get("container", [])
        box = -1
        if steps:
            boxes = matching.below(self.page, self.hits[steps[0]["key"]], -1) if "key" in steps[0] and steps[0]["op"] == "select" and len(steps) == 1 else None
            if boxes is None:
                box = self.chain("container", -1)
                if box is None:
                    return "none", []
            elif not boxes:
                return "none", []
            elif len(boxes) > 1 and steps[0].get("arg") != "first":
                return "several", []
            else:
                box = boxes[0]
        first = self.site.chains["row"][0]
        nodes = matching.below(self.page, self.hits[first["key"]], box)
        if len(self.site.chains["row"]) > 1:
            nodes = list(dict.fromkeys(k for n in nodes if (k := self.chain("row", n, 1)) is not None))
        places = {i: k for k, i in enumerate(self.page.elements)}
        return "ok", [{"pos": places.get(i, i), "fields": self.values(i), "skip": self.skip(i)} for i in nodes]

    def values(self, i: int) -> dict[str, str | None]:
        out = {}
        for name in self.site.values:
            value = self.chain(name, i)
            value = self.page.joined_text(value) if isinstance(value, int) else value
            out[name] = urljoin(self.url, value) if name == "link" and value is not None else value
        return out

    def skip(self, i: int) -> str | None:
        return next((f[5:] for f in self.site.skips if self.chain(f, i) not in (None, "")), None)

    def next(self) -> str | None:
        value = self.chain("next", -1) if "next" in self.site.chains else None
        value = self.page.attrs[value].get("href") if isinstance(value, int) else value
        return urljoin(self.url, value) if value else None


def _nth(found: Sequence[int], k: int) -> int | None:
    return found[k] if -len(found) <= k < len(found) else None


def _has(found: list[int], i: int) -> bool:
    at = matching.bisect_right(found, i)
    return bool(at) and found[at - 1] == i


def _runs(batches: Iterator[tuple[pd.Series, ...]], use, columns: list[str], closed: bool = False) -> Iterator[pd.DataFrame]:
    """``use`` of each page's run; a page whose rules raise is a row of its own with the error as its status."""
    known: dict[str, Site] = {}
    for contents, urls, texts in tree.bounded(batches):
        out = []
        for content, url, text in zip(contents, urls, texts, strict=True):
            try:
                if text is None:
                    out.append(("no rules", *[None] * (len(columns) - 1)))
                    continue
                if text not in known:
                    known[text] = Site(text)
                out.append(use(Run(known[text], content or "", url, closed)))
            except Exception as e:  # one page's failure is its own
                out.append((f"error: {type(e).__name__}: {e}", *[None] * (len(columns) - 1)))
        yield pd.DataFrame(out, columns=columns)


LISTED = "status string, next_url string, rows array<struct<pos:int,fields:map<string,string>,skip:string>>"


def _list(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]], closed: bool = False) -> Iterator[pd.DataFrame]:
    def use(run: Run) -> tuple:
        status, rows = run.listed()
        return status, run.next(), rows

    return _runs(batches, use, ["status", "next_url", "rows"], closed)


def _detail(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    return _runs(batches, lambda run: ("ok", run.values(-1)), ["status", "fields"])


def _with_program(pages: DataFrame, rules: DataFrame) -> DataFrame:
    return pages.join(programs(rules), "site", "left")


def listings(pages: DataFrame, rules: DataFrame, closed: bool = False) -> DataFrame:
    """``pages`` (site, url, content and others) with ``status``, ``next_url`` and ``rows``; each page is parsed once."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        return _list(batches, closed)

    made = F.pandas_udf(run, LISTED).asNondeterministic()("content", "url", "program")
    own = _with_program(pages, rules).withColumn("made", made).drop("program")
    return own.select(*[c for c in pages.columns], "made.status", "made.next_url", "made.rows")


def list_rows(pages: DataFrame, rules: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, failures) of list pages (site, url, content, and n, the page's number from 0, if lists have several): rows with
    site, pos, url (the link), ``names`` and skip, failures with site, url and status."""
    n = F.col("n").cast("long") if "n" in pages.columns else F.lit(0)
    found = listings(pages, rules)
    failures = found.where("status <> 'ok'").select("site", "url", "status")
    rows = found.where("status = 'ok'").select("site", n.alias("n"), F.inline("rows"))
    pos = F.col("pos") + F.col("n") * PAGE_NODES
    return rows.select("site", pos.alias("pos"), F.col("fields")["link"].alias("url"), *[F.col("fields")[x].alias(x) for x in names], "skip"), failures


def with_details(rows: DataFrame, details: DataFrame, rules: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` (site, url and others) with ``names`` from their detail pages (url, content), by each site's own rules; a page that
    several rows of a site have is parsed once for the site."""
    needed = rows.select("site", "url").distinct().join(details.select("url", "content"), "url")
    made = F.pandas_udf(_detail, "status string, fields map<string,string>").asNondeterministic()("content", "url", "program")
    found = _with_program(needed, rules).withColumn("made", made)
    found = found.select(F.col("site").alias("__site"), F.col("url").alias("__url"), *[F.col("made.fields")[x].alias(x) for x in names])
    own = rows.drop(*names)
    return own.join(found, (F.col("site") == F.col("__site")) & (F.col("url") == F.col("__url")), "left").drop("__site", "__url")
