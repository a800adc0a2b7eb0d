"""Pages as node tables.

A page becomes one row for each element, with pre-order interval encoding: an element's descendants are the rows of the
same page whose ``pre`` lies in (pre, end]. Every axis of a tree is then an equality on the page and a comparison of
numbers. ``tree`` builds pages as browsers do, so each has html, head and body. ``all_nodes`` gives texts and comments too,
with their places in the source.

``found`` and ``listed`` match selectors while a page is parsed and hand on what they name, so that the rest of the tree never
leaves the task. All of a page's rows come from one task, which holds one page's tree, and the rows of a piece
of a batch (``tree.bounded``), at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.operators import matching, tree
from moothall.operators.selectors import steps

_STRUCT = (
    "struct<pre:int,end:int,parent:int,depth:int,sib_index:int,sib_count:int,tag:string,id:string,"
    "classes:array<string>,attrs:map<string,string>,own_text:string,text_strip:string,text_after:string>"
)
NODE = f"array<{_STRUCT}>"
#: Nodes of every kind: ``at`` is a place in document order, ``tag`` is #text or #comment for what is no element, ``start``
#: and ``stop`` are places in the source in code points.
ANY_NODE = "array<struct<at:int,last:int,parent:int,depth:int,tag:string,attrs:map<string,string>,text:string,start:int,stop:int>>"


class Elements:
    """A page's elements as rows that are made when they are asked for."""

    def __init__(self, page: tree.Page):
        self.page = page
        self.pre = {i: k for k, i in enumerate(page.elements)}
        self.index, self.count = matching._places(page)

    def row(self, i: int) -> dict:
        p, up = self.page, self.page.up[i]
        k = self.pre[i]
        below = matching.bisect_right(p.elements, p.last[i]) - 1
        after = p.texts[at] if (at := matching.bisect_right(p.texts, i)) < len(p.texts) else None
        attrs = p.attrs[i]
        return {
            "pre": k, "end": below, "parent": self.pre.get(up), "depth": p.depth[i], "sib_index": self.index[i], "sib_count": self.count[up],
            "tag": p.tag[i], "id": attrs.get("id"), "classes": tree.classes(attrs), "attrs": attrs, "own_text": "".join(p.text[x] for x in p.kids(i) if p.tag[x] == "#text"),
            "text_strip": p.joined_text(i), "text_after": "" if after is None else p.text[after],
        }


def parse(html: str, closed: bool = False) -> list[dict]:
    """The rows of a page's elements in document order."""
    rows = Elements(tree.Page(html, closed))
    return [rows.row(i) for i in rows.page.elements]


def _parsed(batches: Iterator[pd.Series], closed: bool = False) -> Iterator[pd.Series]:
    for pages in tree.bounded(batches):
        yield pd.Series([parse(page, closed) for page in pages.fillna("")], dtype=object)


def parsed(html: Column, closed: bool = False) -> Column:
    """The elements of a page as an array, in document order; fields as in ``node_table``. Null or empty pages have none.
    Not deterministic to the optimizer, which would otherwise parse a page again for each filter on what was found."""

    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _parsed(pages, closed)

    return F.pandas_udf(run, NODE).asNondeterministic()(html)


def node_table(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key`` and the columns of every element of every page. Columns: pre, end, parent, depth, sib_index (from 1),
    sib_count, tag, id, classes, attrs, own_text, text_strip (all texts below, stripped and joined), text_after (the
    first text after the start tag). Null or empty pages have no elements."""
    return pages.select(F.col(key), F.inline(parsed(F.col(html))))


def _every(batches: Iterator[pd.Series], closed: bool = False) -> Iterator[pd.Series]:
    names = ("at", "last", "parent", "depth", "tag", "attrs", "text", "start", "stop")
    for pages in tree.bounded(batches):
        out = []
        for html in pages.fillna(""):
            p = tree.Page(html, closed)
            text = [t if tag[0] == "#" else None for t, tag in zip(p.text, p.tag)]
            out.append([dict(zip(names, r)) for r in zip(range(len(p.tag)), p.last, p.up, p.depth, p.tag, p.attrs, text, p.start, p.stop)])
        yield pd.Series(out, dtype=object)


def all_nodes(html: Column, closed: bool = False) -> Column:
    """Every node of a page as an array in document order, fields as in ANY_NODE; the parent of a node at the top is -1."""

    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _every(pages, closed)

    return F.pandas_udf(run, ANY_NODE).asNondeterministic()(html)


def source_of(html: Column, node: Column) -> Column:
    """A node's own source, from its start tag to its end tag."""
    return F.substring(html, node["start"] + 1, node["stop"] - node["start"])


def byte_range(html: Column, node: Column) -> Column:
    """struct (start, stop) of a node in the page's UTF-8 bytes."""
    at = lambda c: F.octet_length(F.substring(html, F.lit(1), c))
    return F.struct(at(node["start"]).alias("start"), at(node["stop"]).alias("stop"))


def text_of(nodes: Column, node: Column, separator: str = "", strip: bool = True, blanks: str = r"\s") -> Column:
    """All texts below a node of ``all_nodes`` in order, each stripped of ``blanks``, empty ones left out, with ``separator`` between;
    those of scripts and styles only where the node is one."""
    inside = F.slice(nodes, node["at"] + 1, node["last"] - node["at"] + 1)
    shown = lambda n: (n["parent"] == node["at"]) | ~F.get(nodes, n["parent"])["tag"].isin(*sorted(tree.HIDDEN))
    texts = F.transform(F.filter(inside, lambda n: (n["tag"] == "#text") & shown(n)), lambda n: F.regexp_replace(n["text"], rf"^{blanks}+|{blanks}+\z", "") if strip else n["text"])
    return F.array_join(F.filter(texts, lambda t: t != "") if strip else texts, separator)


def contents(nodes: Column, node: Column) -> Column:
    """The nodes right below a node of ``all_nodes``."""
    inside = F.slice(nodes, node["at"] + 2, node["last"] - node["at"])
    return F.filter(inside, lambda n: n["parent"] == node["at"])


def _found(batches: Iterator[pd.Series], css: Mapping[str, str], closed: bool = False) -> Iterator[pd.DataFrame]:
    program = matching.Program({k: steps(v) for k, v in css.items()})
    for pages in tree.bounded(batches):
        out = []
        for html in pages.fillna(""):
            rows = Elements(tree.Page(html, closed))
            out.append({k: [rows.row(i) for i in v] for k, v in program.run(rows.page).items()})
        yield pd.DataFrame(out, columns=list(css), dtype=object)


def found(html: Column, closed: bool = False, /, **css: str) -> Column:
    """struct: for each name the nodes that its selector names, in document order. A page is parsed once for all of them.
    ``closed``, here and elsewhere, is ``tree.Page``'s."""
    for c in css.values():
        steps(c)
    kind = "struct<" + ",".join(f"{k}:{NODE}" for k in css) + ">"

    def run(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _found(pages, css, closed)

    return F.pandas_udf(run, kind).asNondeterministic()(html)


def _listed(batches: Iterator[pd.Series], container: str, row: str, css: Mapping[str, str], closed: bool = False) -> Iterator[pd.DataFrame]:
    program = matching.Program({"container": steps(container), "row": steps(row)} | {f"f_{k}": steps(v) for k, v in css.items()})
    for pages in tree.bounded(batches):
        out = []
        for html in pages.fillna(""):
            rows = Elements(tree.Page(html, closed))
            hits = program.run(rows.page)
            box = hits["container"][0] if hits["container"] else None
            listed = []
            for r in matching.below(rows.page, hits["row"], box) if box is not None else ():
                fields = {k: matching.first(rows.page, hits[f"f_{k}"], r) for k in css}
                listed.append({"row": rows.row(r)} | {f"f_{k}": None if i is None else rows.row(i) for k, i in fields.items()})
            out.append((len(rows.page.elements), len(hits["container"]), listed))
        yield pd.DataFrame(out, columns=["n_nodes", "n_boxes", "rows"])


def listed(html: Column, container: str, row: str, css: Mapping[str, str], closed: bool = False) -> Column:
    """struct: ``n_nodes`` of a page, ``n_boxes`` (how many containers it has), and ``rows`` in the first of them, each a struct
    of ``row`` and, for each field, ``f_<name>``: the first node below the row that the field's selector names."""
    for c in (container, row, *css.values()):
        steps(c)
    fields = ",".join([f"row:{_STRUCT}", *[f"f_{k}:{_STRUCT}" for k in css]])
    kind = f"struct<n_nodes:int,n_boxes:int,rows:array<struct<{fields}>>>"

    def run(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _listed(pages, container, row, css, closed)

    return F.pandas_udf(run, kind).asNondeterministic()(html)


def pretty(html: Column, css: str) -> Column:
    """Of each node that a selector names its markup, each tag and each text in a line of its own; an array."""
    program = {"found": steps(css)}

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = matching.Program(program)
        for pages in tree.bounded(batches):
            out = []
            for page in map(tree.Page, pages.fillna("")):
                out.append([page.pretty(i) for i in ready.run(page)["found"]])
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(run, "array<string>").asNondeterministic()(html)
