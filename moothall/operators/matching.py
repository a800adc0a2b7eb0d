"""Selectors over a page in one pass.

All steps of all selectors of a program get a bit each. In document order, a node's bits are those steps whose tests it passes
and whose step before stands where the combinator says: among the bits of its ancestors (handed down), its parent, or the
element before it. So each node is looked at once, whatever the number of selectors, and time is in proportion to nodes;
tests are looked up by tag first. What is below what is then a search in sorted lists of places.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Mapping

from moothall.operators.tree import Page, classes

#: A test of one node: (on, name, op, value). ``on`` is tag, class, id, attr, first, last or nth.
Test = tuple[str, str, str, str]
#: A selector: for each part of a comma list its steps, each a combinator and tests.
Selector = list[list[tuple[str, list[Test]]]]

_OPS = {"": lambda own, value: True, "=": str.__eq__, "^=": str.startswith, "*=": str.__contains__, "$=": str.endswith}


class Program:
    """Selectors by name, compiled into steps."""

    def __init__(self, selectors: Mapping[str, Selector]):
        self.by_tag: dict[str, list] = defaultdict(list)
        self.any: list = []
        self.ends: list[tuple[int, list[str]]] = []
        ends: dict[int, list[str]] = {}
        bit = 1
        for name, paths in selectors.items():
            for path in paths:
                before = 0
                for sign, tests in path:
                    tag = next((t[3] for t in tests if t[0] == "tag"), "")
                    rest = [t for t in tests if t[0] != "tag"]
                    (self.by_tag[tag] if tag else self.any).append((bit, before, sign, rest))
                    before, bit = bit, bit << 1
                ends.setdefault(before, []).append(name)
        self.ends = list(ends.items())
        self.names = list(selectors)

    def run(self, page: Page) -> dict[str, list[int]]:
        """For each name the numbers of the nodes that its selector names, in document order, each once."""
        n = len(page.tag)
        own, above, previous = [0] * n, [0] * n, {}
        found: dict[str, list[int]] = {name: [] for name in self.names}
        index, count = _places(page)
        for i in page.elements:
            up = page.up[i]
            inherited = own[up] | above[up] if up >= 0 else 0
            above[i] = inherited
            parent, before = (own[up] if up >= 0 else 0), previous.get(up, 0)
            bits = 0
            for steps in (self.by_tag.get(page.tag[i], ()), self.any):
                for bit, needs, sign, tests in steps:
                    if needs and not needs & (inherited if sign == "" else parent if sign == ">" else before):
                        continue
                    if all(_holds(page, i, t, index[i], count.get(up, 0)) for t in tests):
                        bits |= bit
            own[i] = previous[up] = bits
            if bits:
                names = {name for end, names in self.ends if end & bits for name in names}
                for name in names:
                    found[name].append(i)
        return found


def _places(page: Page) -> tuple[list[int], dict[int, int]]:
    """Each element's place among its parent's elements from 1, and how many each parent has."""
    count: dict[int, int] = {}
    index = [0] * len(page.tag)
    for i in page.elements:
        index[i] = count[page.up[i]] = count.get(page.up[i], 0) + 1
    return index, count


def _holds(page: Page, i: int, test: Test, index: int, count: int) -> bool:
    on, name, op, value = test
    attrs = page.attrs[i]
    if on == "class":
        return value in classes(attrs)
    if on == "id":
        return attrs.get("id") == value
    if on == "attr":
        return name in attrs and _OPS[op](attrs[name], value)
    if on == "first":
        return index == 1
    if on == "last":
        return index == count
    return index == int(value)


def below(page: Page, found: list[int], i: int) -> list[int]:
    """Those of some nodes, in document order, that are below node ``i`` (all of them for -1)."""
    return found if i < 0 else found[bisect_right(found, i) : bisect_right(found, page.last[i])]


def first(page: Page, found: list[int], i: int) -> int | None:
    at = 0 if i < 0 else bisect_right(found, i)
    return found[at] if at < len(found) and (i < 0 or found[at] <= page.last[i]) else None


def outermost(page: Page, found: Iterable[int]) -> list[int]:
    """Those of some nodes in document order that aren't below another of them."""
    out: list[int] = []
    for i in found:
        if not out or i > page.last[out[-1]]:
            out.append(i)
    return out
