"""CSS selectors, as data and over node tables.

The subset that rosters use: tags, classes, ids, attributes (``=``, ``^=``, ``*=``, ``$=``), ``:first-child``,
``:last-child``, ``:nth-child(n)``, descendants, children, next siblings (``+``) and comma lists; anything else is a
ValueError. ``steps`` gives a selector as data, which ``matching`` runs over a page in one pass while it is parsed
(``nodes.found``, ``nodes.listed``). Over node tables, which are for what goes on to other tables, a simple selector is a
predicate on one node, and a combinator a semi join of the nodes with their ancestors, parents or siblings on the same page.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART = re.compile(r"""\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([\^*$]?=)\s*("[^"]*"|'[^']*'|[^\]"'\s]+)\s*)?\]|:(first|last)-child|:nth-child\(\s*(\d+)\s*\)|([\w-]+|\*)""")
_SIMPLE = re.compile(f"(?:{_PART.pattern})+")


def parts(css: str) -> list[list[tuple[str, str]]]:
    """For each part of a comma list its (combinator, simple selector) steps; ValueError for what isn't supported."""
    paths, steps, at, sign = [], [], 0, ""
    css = css.strip()
    while at < len(css):
        m = _SIMPLE.match(css, at)
        if not m:
            raise ValueError(f"not a supported selector: {css!r}, at {at}")
        steps.append((sign, m[0]))
        gap = re.compile(r"\s*([>+,]?)\s*").match(css, m.end())
        if gap.end() == m.end() and gap.end() < len(css):
            raise ValueError(f"not a supported selector: {css!r}, at {gap.end()}")
        at, sign = gap.end(), gap[1]
        if sign == ",":
            paths, steps, sign = [*paths, steps], [], ""
    if not steps or sign:
        raise ValueError(f"a selector that ends too soon: {css!r}")
    return [*paths, steps]


def predicate(simple: str, get: Callable[[str], Column] = F.col) -> Column:
    """Whether a node is what a simple selector says; ``get`` gives a node's fields, a node table's columns by default."""
    tests = [F.lit(True)]
    for m in _PART.finditer(simple):
        cls, ident, attr, op, value, edge, nth, tag = m.groups()
        value = (value or "").strip("\"'")
        if tag and tag != "*":
            tests.append(get("tag") == tag.lower())
        elif cls:
            tests.append(F.array_contains(get("classes"), cls))
        elif ident:
            tests.append(get("id") == ident)
        elif edge:
            tests.append(get("sib_index") == (F.lit(1) if edge == "first" else get("sib_count")))
        elif nth:
            tests.append(get("sib_index") == int(nth))
        elif attr:
            own = get("attrs")[attr]
            tests.append({None: own.isNotNull(), "=": own == value, "^=": own.startswith(value), "*=": own.contains(value), "$=": own.endswith(value)}[op])
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


def steps(css: str) -> list[list[tuple[str, list[tuple[str, str, str, str]]]]]:
    """A selector as data: for each part of a comma list its steps, each a combinator and tests (on, name, op, value)."""
    return [[(sign, tests_of(simple)) for sign, simple in path] for path in parts(css)]


def tests_of(simple: str) -> list[tuple[str, str, str, str]]:
    """What a simple selector asks of a node."""
    out = []
    for m in _PART.finditer(simple):
        cls, ident, attr, op, value, edge, nth, tag = m.groups()
        if tag:
            out += [("tag", "", "", tag.lower())] if tag != "*" else []
        elif cls or ident:
            out.append(("class" if cls else "id", "", "", cls or ident))
        elif attr:
            out.append(("attr", attr, op or "", (value or "").strip("\"'")))
        else:
            out.append((edge or "nth", "", "", nth or ""))
    return out


def below(n: Column, o: Column) -> Column:
    """Whether node ``n`` is below ``o``."""
    return (n["pre"] > o["pre"]) & (n["pre"] <= o["end"])


#: How a node stands to one of the step before, by combinator.
_STANDS = {
    "": below,
    ">": lambda n, o: n["parent"] == o["pre"],
    "+": lambda n, o: n["parent"].eqNullSafe(o["parent"]) & (n["sib_index"] == o["sib_index"] + 1),
}


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, not again for each element that ``use`` goes through."""
    return F.transform(F.array(value), use)[0]


def matched(tree: Column, css: str) -> Column:
    """The nodes of a page's array (``nodes.parsed``) that a selector names, in document order, each once. For an array that is
    at hand: it compares pairs of nodes, where ``nodes.found`` looks at each node of a page once."""

    def named(all_nodes: Column, simple: str) -> Column:
        return F.filter(all_nodes, lambda n: predicate(simple, n.getField))

    def further(all_nodes: Column, level: Column, sign: str, simple: str) -> Column:
        return bound(level, lambda lv: F.filter(named(all_nodes, simple), lambda n: F.exists(lv, lambda o: _STANDS[sign](n, o))))

    def path(all_nodes: Column, steps: list[tuple[str, str]]) -> Column:
        return reduce(lambda level, step: further(all_nodes, level, *step), steps[1:], named(all_nodes, steps[0][1]))

    paths = parts(css)
    if len(paths) == 1:
        return bound(tree, lambda t: path(t, paths[0]))
    places = lambda t: F.concat(*[F.transform(path(t, steps), lambda n: n["pre"]) for steps in paths])
    return bound(tree, lambda t: bound(places(t), lambda at: F.filter(t, lambda n: F.array_contains(at, n["pre"]))))


def valued(rows: DataFrame, node: str, value: Column, name: str) -> DataFrame:
    """``rows`` with ``name`` in place of ``node``, a column that has a node: ``value``, a Column of node fields; null
    where there is no node."""
    own = rows.select(F.struct(*[F.col(c) for c in rows.columns if c != node]).alias("__row"), f"{node}.*")
    return own.select("__row.*", F.when(F.col("pre").isNotNull(), value).alias(name))


def inside(nodes: DataFrame, outer: DataFrame, key: str, child: bool = False) -> DataFrame:
    """The nodes below (with ``child``: directly below) any of ``outer``; both have ``key``, pre and end."""
    o = outer.select(F.col(key).alias("__k"), F.col("pre").alias("__pre"), F.col("end").alias("__end"))
    on = F.col(key).eqNullSafe(F.col("__k"))
    if child:
        return nodes.join(o, on & (F.col("parent") == F.col("__pre")), "left_semi")
    return nodes.join(o, on & (F.col("pre") > F.col("__pre")) & (F.col("pre") <= F.col("__end")), "left_semi")


def following(nodes: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """The nodes right after any of ``before``, below the same parent."""
    b = before.select(F.col(key).alias("__k"), F.col("parent").alias("__parent"), F.col("sib_index").alias("__at"))
    same = F.col(key).eqNullSafe(F.col("__k")) & F.col("parent").eqNullSafe(F.col("__parent"))
    return nodes.join(b, same & (F.col("sib_index") == F.col("__at") + 1), "left_semi")


def select(nodes: DataFrame, css: str, key: str) -> DataFrame:
    """The nodes that a selector names; a node that several parts of a comma list name comes once."""
    found = []
    for steps in parts(css):
        level = nodes.where(predicate(steps[0][1]))
        for sign, simple in steps[1:]:
            named = nodes.where(predicate(simple))
            level = following(named, level, key) if sign == "+" else inside(named, level, key, sign == ">")
        found.append(level)
    if len(found) == 1:
        return found[0]
    both = reduce(DataFrame.unionByName, [f.select(key, "pre") for f in found]).distinct()
    both = both.select(F.col(key).alias("__k"), F.col("pre").alias("__pre"))
    return nodes.join(both, F.col(key).eqNullSafe(F.col("__k")) & (F.col("pre") == F.col("__pre")), "left_semi")


def select_one(nodes: DataFrame, css: str, key: str) -> DataFrame:
    """The first node of each page that a selector names."""
    found = select(nodes, css, key)
    first = F.min_by(F.struct(*[c for c in found.columns if c != key]), "pre").alias("n")
    return found.groupBy(key).agg(first).select(key, "n.*")


def field(rows: DataFrame, nodes: DataFrame, css: str, value: Column, name: str, key: str) -> DataFrame:
    """``rows`` (nodes with key, pre and end) with ``name``: ``value`` of the first node below each that ``css`` names."""
    found = select(nodes, css, key).select(F.col(key).alias("__k"), F.col("pre").alias("__pre"), value.alias("__value"))
    own = rows.select(F.col(key).alias("__rk"), F.col("pre").alias("__rpre"), F.col("end").alias("__rend"))
    hit = own.join(found, F.col("__rk").eqNullSafe(F.col("__k")) & (F.col("__pre") > F.col("__rpre")) & (F.col("__pre") <= F.col("__rend")))
    hit = hit.groupBy("__rk", "__rpre").agg(F.min_by("__value", "__pre").alias(name))
    return rows.join(hit, F.col(key).eqNullSafe(F.col("__rk")) & (F.col("pre") == F.col("__rpre")), "left").drop("__rk", "__rpre")


def one_container(nodes: DataFrame, css: str, key: str) -> DataFrame:
    """Each page's container, with ``status``: ok, none or several. Pages without one have a row too; their failure is
    theirs alone."""
    found = select(nodes, css, key).groupBy(key).agg(F.count("*").alias("n"), F.min_by(F.struct("pre", "end"), "pre").alias("c"))
    pages = nodes.select(F.col(key).alias("__k")).distinct()
    both = pages.join(found, F.col("__k").eqNullSafe(F.col(key)), "left")
    status = F.when(F.col("n").isNull(), "none").when(F.col("n") > 1, "several").otherwise("ok")
    return both.select(F.col("__k").alias(key), status.alias("status"), "c.pre", "c.end")


#: By axis: which nodes stand there as seen from a node, and whether the nearest is the first or the last of them.
AXES = {
    "next": ("pre > __rpre", True),
    "previous": ("pre < __rpre", False),
    "parent": ("pre < __rpre AND __rpre <= end", False),
    "next_sibling": ("parent <=> __rparent AND pre > __rpre", True),
    "previous_sibling": ("parent <=> __rparent AND pre < __rpre", False),
}


_SEEN = {
    "next": lambda n, o: n["pre"] > o["pre"],
    "previous": lambda n, o: n["pre"] < o["pre"],
    "parent": lambda n, o: below(o, n),
    "next_sibling": lambda n, o: n["parent"].eqNullSafe(o["parent"]) & (n["pre"] > o["pre"]),
    "previous_sibling": lambda n, o: n["parent"].eqNullSafe(o["parent"]) & (n["pre"] < o["pre"]),
}


def closest(tree: Column, node: Column, axis: str, test: Callable[[Column], Column]) -> Column:
    """The nearest node of a page's array on an axis of ``node`` that passes ``test``; null without one."""
    found = F.filter(tree, lambda n: _SEEN[axis](n, node) & F.coalesce(test(n), F.lit(False)))
    return F.try_element_at(found, F.lit(1 if AXES[axis][1] else -1))


def nearest(rows: DataFrame, nodes: DataFrame, axis: str, test: Column, value: Column, name: str, key: str) -> DataFrame:
    """``rows`` (nodes with key, pre and parent) with ``name``: ``value`` of the nearest node on an axis that passes
    ``test``, a condition on nodes, such as one on their tag or text; null where none does."""
    where, first = AXES[axis]
    found = nodes.where(test).select(F.col(key).alias("__k"), "pre", "end", "parent", value.alias("__value"))
    own = rows.select(F.col(key).alias("__rk"), F.col("pre").alias("__rpre"), F.col("parent").alias("__rparent"))
    hit = own.join(found, F.col("__rk").eqNullSafe(F.col("__k")) & F.expr(where))
    hit = hit.groupBy("__rk", "__rpre").agg((F.min_by if first else F.max_by)("__value", "pre").alias(name))
    return rows.join(hit, F.col(key).eqNullSafe(F.col("__rk")) & (F.col("pre") == F.col("__rpre")), "left").drop("__rk", "__rpre")
