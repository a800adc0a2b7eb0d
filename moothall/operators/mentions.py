"""Names of a list found in the texts of pages, and the heading that each place stands under.

A page's texts are cut into runs of words, lower-cased and without marks, of the lengths that names have and where one of them
may begin. Texts meet the names of their key in blocks, and runs and names meet by equality within such a row, so no name is
compared with a text that doesn't hold it. Each text knows the nearest heading before it, as the texts are read in document
order. A name of more than ``LONGEST`` words is looked for by its first ones, and verified in the text.

Defined results: a name without words is found nowhere; a name that a text holds twice is one row for each place; a null page
has no texts; names of pages that aren't there have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.functions import text
from moothall.operators import matching, tree
from moothall.operators.selectors import steps

#: Words of the longest run that is looked up, and names of a key that a text meets at once.
LONGEST, TOGETHER = 4, 500

_TEXTS = "array<struct<at:int,text:string,heading:string,tag:string>>"


def texts_under(html: Column, heading: str = "h1, h2, h3, h4, h5, h6", closed: bool = False) -> Column:
    """A page's texts that aren't blank, in document order: place, text, the text of the nearest heading that began before it,
    and the tag of the element that it stands in."""
    css = steps(heading)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        program = matching.Program({"heading": css})
        for pages in tree.bounded(batches):
            out = []
            for page in (tree.Page(html, closed) for html in pages.fillna("")):
                found = program.run(page)["heading"]
                said, rows, k = None, [], 0
                for i in page.texts:
                    while k < len(found) and found[k] < i:
                        said, k = page.joined_text(found[k]), k + 1
                    inside = page.tag[page.up[i]] if page.up[i] >= 0 else ""
                    if page.text[i].strip() and inside not in tree.HIDDEN:
                        rows.append({"at": i, "text": page.text[i], "heading": said, "tag": inside})
                out.append(rows)
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(run, _TEXTS).asNondeterministic()(html)


def words(x: Column) -> Column:
    """A text's words, lower-cased, without marks."""
    return F.filter(F.split(text.slugify(x), "-"), lambda w: w != "")


def _runs(said: Column, starts: Column) -> Column:
    """The runs of a text's words from these places that are looked up."""
    of = lambda k: F.transform(F.filter(starts, lambda i: i + k <= F.size(said)), lambda i: F.array_join(F.slice(said, i + 1, k), " "))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), of))


def _blocks(own: DataFrame, key: str) -> DataFrame:
    """(key, names, looked, heads): the names of a key in blocks of ``TOGETHER``, about, the runs that they are looked for by, and
    their first words."""
    parts = own.groupBy(key).agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    dealt = own.join(parts, key).withColumn("part", F.pmod(F.xxhash64("run"), F.col("parts")))
    names = F.collect_list(F.struct("name", "words", "run")).alias("names")
    return dealt.groupBy(key, "part").agg(names).select(key, "names", F.array_distinct("names.run").alias("looked"), F.array_distinct(F.transform("names", lambda x: x["words"][0])).alias("heads"))


def mentions(names: DataFrame, pages: DataFrame, key: str = "council_id", name: str = "name", html: str = "content", closed: bool = False) -> DataFrame:
    """(key, name, at, heading, tag, text) of each place of each name in the pages of its key: ``at`` is the text's place, ``heading``
    the nearest one before it."""
    own = names.select(key, F.col(name).alias("name")).distinct().withColumn("words", words(F.col("name"))).where(F.size("words") > 0)
    own = own.withColumn("run", F.array_join(F.slice("words", 1, LONGEST), " "))
    # texts move once for each block of their key's names, and runs not at all
    texts = pages.select(key, F.inline(texts_under(F.col(html), closed=closed)))
    met = texts.join(_blocks(own, key), key)
    # generators, as projections would be copied into each place that uses them
    once = lambda x, alias: met.select("*", F.explode(F.array(x)).alias(alias))
    met = once(words(F.col("text")), "all")
    met = once(F.array_intersect("heads", "all"), "begun").where(F.size("begun") > 0)
    met = once(F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.array_contains("begun", F.get("all", i))), "starts")
    met = once(F.array_intersect("looked", _runs(F.col("all"), F.col("starts"))), "held").where(F.size("held") > 0)
    met = met.select("*", F.explode(F.filter("names", lambda x: F.array_contains("held", x["run"]))).alias("named"))
    places = F.filter("starts", lambda i: F.slice("all", i + 1, F.size("named.words")) == F.col("named.words"))
    found = met.select("*", F.explode(places))
    return found.select(key, F.col("named.name").alias(name), "at", "heading", "tag", "text")
