"""Extractors for the kinds of sites there are. Each takes captured payloads and gives rows with ``pos``, their order
within a council, and ``skip``, why a row isn't to be kept (null if it is). ``operators.people.gate`` judges them.

A site with rules of its own passes Columns: what a field is, what to skip.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moothall import schemas
from moothall.functions import links, text, values
from moothall.operators import nodes, people, selectors
from moothall.plans import sites
from moothall.plans.sites import PAGE_NODES
from moothall.sources import fetch
from moothall.sources.shared import put_aside


def ward_listing(payloads: DataFrame, skip: dict[str, Column] | None = None) -> DataFrame:
    """Office-holders from XML answers that list wards and the people of each. Columns of ``payloads``: council_id,
    base_url, content. The end of the last term is when someone stands down, unless it is ``unspecified``."""
    parsed = payloads.withColumn("xml", F.from_xml("content", schemas.WARDS_XML.simpleString(), {"mode": "PERMISSIVE"}))
    wards = parsed.select("council_id", "base_url", F.posexplode("xml.wards.ward").alias("w", "ward"))
    rows = wards.select("council_id", "base_url", "w", "ward.wardtitle", F.posexplode("ward.councillors.councillor").alias("c", "p"))
    ends = F.filter(F.col("p.termsofoffice.termofoffice.enddate"), lambda x: x.isNotNull())
    last = F.nullif(F.trim(F.try_element_at(ends, F.lit(-1))), F.lit("unspecified"))
    rows = rows.select(
        "council_id",
        (F.col("w") * 100_000 + F.col("c")).alias("pos"),
        F.concat(links.endpoint(F.col("base_url"), "/mgUserInfo.aspx?UID="), F.trim("p.councillorid")).alias("url"),
        F.trim("p.councillorid").alias("identifier"),
        text.strip(F.col("p.fullusername")).alias("name"),
        text.strip(F.col("p.politicalpartytitle")).alias("party"),
        text.strip(F.col("wardtitle")).alias("division"),
        F.nullif(text.strip(F.col("p.email")), F.lit("")).alias("email"),
        F.nullif(F.col("p.photobigurl"), F.lit("")).alias("photo_url"),
        values.iso_time(values.date_of(last).cast("timestamp")).alias("standing_down"),
    )
    return rows.withColumn("skip", people.skip_reason(skip or {}))


def _dealt(pages: DataFrame, key: str) -> DataFrame:
    """Pages dealt by a key over as many tasks as a shuffle has. Parsing costs far more than reading, so pages that are small
    in their file, and would be read by a task or two, are spread before it; the number is given, as Spark joins small
    partitions otherwise."""
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def person_blocks(
    pages: DataFrame, details: DataFrame | None = None, division_label: str = "Ward:", block: str = "PE_People_PersonBlock", party: list[sites.Written] | tuple[str, Column] | None = None
) -> DataFrame:
    """Office-holders from list pages of person blocks: link, name, the text after the ward's label, and the title of the
    last picture as party. Columns of ``pages``: council_id, content; a council may have several, in the order of ``n`` or
    else ``url``, if there are such columns. ``details`` (url, content) adds e-mails. A site that names parties otherwise
    gives ``party``, a chain of steps from the block, or a selector and a Column of the node."""
    label = ("find_text", rf"^\s*{re.escape(division_label)}")
    rules = {
        "row": [("select", f"div.{block}")],
        "link": [("select", "a"), ("attr", "href")],
        "name": [("select", "div.NameLink"), ("text",)],
        "inline": [label, ("text",), ("replace", division_label), ("strip",)],
        "beside": [label, ("next_text",), ("text",)],
        "party": party if isinstance(party, list) else [("last", "img"), ("attr", "title")],
    }
    order = next((c for c in ("n", "url") if c in pages.columns), None)
    own = _dealt(pages, "council_id").select("council_id", F.lit("blocks").alias("site"), F.lit("").alias("url"), "content", (F.col(order) if order else F.xxhash64("content")).alias("__page"))
    found = sites.listings(own, sites.rule_table(pages.sparkSession, {"blocks": rules}))
    if isinstance(party, tuple):
        said = nodes.listed(F.col("content"), "html", f"div.{block}", {"party": party[0]})["rows"]
        found = found.select("council_id", "__page", F.inline(F.arrays_zip("rows", F.transform(said, lambda r: r["f_party"]).alias("__party"))))
        found = selectors.valued(found.select("council_id", "__page", "rows.*", "__party"), "__party", party[1], "__said")
    else:
        found = found.select("council_id", "__page", F.inline("rows"))
    # rows of a council are as many as its people
    page = F.dense_rank().over(Window.partitionBy("council_id").orderBy("__page")) - 1
    value = lambda name: F.col("fields")[name]
    rows = found.select(
        "council_id",
        (F.col("pos") + page * PAGE_NODES).alias("pos"),
        value("link").alias("url"),
        links.segment_after(value("link"), "id").alias("identifier"),
        value("name").alias("name"),
        text.strip(F.replace(F.col("__said") if isinstance(party, tuple) else value("party"), F.lit("(logo)"), F.lit(""))).alias("party"),
        text.first_of(value("inline"), value("beside")).alias("division"),
    )
    if details is not None:
        mails = _dealt(details, "url").select(F.col("url").alias("u"), F.get(nodes.found(F.col("content"), mail=".Email")["mail"], F.lit(0))["text_strip"].alias("email"))
        rows = rows.join(mails, F.col("url") == F.col("u"), "left").drop("u")
    else:
        rows = rows.withColumn("email", F.lit(None).cast("string"))
    return rows.withColumn("skip", people.skip_reason({"vacant": F.contains("name", F.lit("Vacancy"))}))


def list_pages(
    pages: DataFrame, container: str, row: str, fields: dict[str, tuple[str, Column]], link: str = "a", skip: dict[str, Column] | None = None, paged: bool = False, closed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, failures) of list pages (council_id, url, content): a container, rows in it, and fields as (selector, value
    Column of the node). ``link`` is resolved against the page. Pages with no container or with several fail, alone.

    With ``paged`` a council has several pages, numbered by a column ``n`` from 0 (``linked_pages`` gives them); rows go
    on from page to page, and of several containers of a page the first one counts."""
    ok = ("ok", "several") if paged else ("ok",)
    own = pages.select("council_id", "url", (F.col("n").cast("long") if paged else F.lit(0)).alias("n"), nodes.listed(F.col("content"), container, row, {"_link": link} | {n: c for n, (c, _) in fields.items()}, closed).alias("page"))
    own = own.select("council_id", "url", "n", "page.*").where("n_nodes > 0")
    found = own.withColumn("status", F.when(F.col("n_boxes") == 0, "none").when(F.col("n_boxes") > 1, "several").otherwise("ok"))
    failures = found.where(~F.col("status").isin(*ok)).select("council_id", "status").distinct()
    rows = found.where(F.col("status").isin(*ok)).select("council_id", F.col("url").alias("__page"), F.col("n").alias("__n"), F.inline("rows"))
    rows = rows.select("*", F.col("row.pre").alias("__pre"), F.col("row.text_strip").alias("text_strip")).drop("row")
    rows = selectors.valued(rows, "f__link", F.col("attrs")["href"], "href")
    for name, (_, value) in fields.items():
        rows = selectors.valued(rows, f"f_{name}", value, name)
    rows = rows.withColumns({"url": links.absolute(F.col("__page"), F.col("href")), "pos": F.col("__pre") + F.col("__n") * PAGE_NODES})
    return rows.drop("__pre", "__page", "__n").withColumn("skip", people.skip_reason(skip or {})), failures


def with_next(pages: DataFrame, css: str, base: Column | None = None) -> DataFrame:
    """``pages`` (council_id, url, content) with ``next_url``: the first link in the first element that ``css`` names,
    resolved against ``base``, or the page's own address. Null where a page has none."""
    own = pages.withColumn("__next", nodes.listed(F.col("content"), css, "a", {}))
    own = own.withColumn("__href", F.get("__next.rows", F.lit(0))["row"]["attrs"]["href"]).drop("__next")
    return own.withColumn("next_url", links.absolute(F.col("url") if base is None else base, F.col("__href"))).drop("__href")


def with_details(rows: DataFrame, details: DataFrame, fields: dict[str, tuple[str, Column]], closed: bool = False) -> DataFrame:
    """``rows`` with fields from their detail pages (url, content), each page parsed once."""
    needed = details.join(rows.select("url").distinct(), "url", "left_semi")
    css = {f"f{i}": c for i, (c, _) in enumerate(fields.values())}
    found = needed.select(F.col("url").alias("__u"), nodes.found(F.col("content"), closed, **css).alias("__found"))
    for i, (name, (_, value)) in enumerate(fields.items()):
        found = selectors.valued(found.withColumn("__node", F.get(F.col(f"__found.f{i}"), F.lit(0))), "__node", value, name)
    return rows.join(found.drop("__found"), F.col("url") == F.col("__u"), "left").drop("__u")


def linked_pages(pages: DataFrame, first: DataFrame) -> DataFrame:
    """(council_id, n, url, content) of captured list pages, from a council's first page along ``next_url``. A page that
    was met before ends the chain, and so does one that wasn't captured.

    Steps double: once the pages less than m steps away and each page's m-th next page are known, a join gives those less
    than 2m steps away. So a chain of n pages takes log2(n) rounds, which end when one adds nothing."""
    urls = pages.select("url").distinct()
    step = put_aside(pages.select("url", F.col("next_url").alias("to")).distinct().join(urls.select(F.col("url").alias("to")), "to", "left_semi"))
    met = first.select("council_id", "url").distinct().join(urls, "url", "left_semi").select("council_id", "url", F.lit(0).alias("n"))
    met, m, known = put_aside(met), 1, 0
    while known < (count := met.count()):
        further = met.join(step, "url").select("council_id", F.col("to").alias("url"), (F.col("n") + m).alias("n"))
        met, m, known = put_aside(met.unionByName(further).groupBy("council_id", "url").agg(F.min("n").alias("n"))), m * 2, count
        step = put_aside(step.join(step.select(F.col("url").alias("to"), F.col("to").alias("further")), "to").select("url", F.col("further").alias("to")).distinct())
    return met.join(pages.select("url", "content"), "url").select("council_id", "n", "url", "content")


def from_json(payloads: DataFrame, array: str, item: str, fields: dict[str, str], defaults: dict[str, str] | None = None) -> DataFrame:
    """Office-holders from JSON answers (council_id, content): ``array`` is the path of the list, ``item`` the schema of an
    entry, fields are SQL expressions over ``item``; empty values take their default."""
    parsed = payloads.select("council_id", F.from_json(F.get_json_object("content", array), f"array<{item}>").alias("items"))
    rows = parsed.select("council_id", F.posexplode("items").alias("pos", "item"))
    out = rows.select("council_id", "pos", *[F.expr(e).cast("string").alias(n) for n, e in fields.items()])
    for n, d in (defaults or {}).items():
        out = out.withColumn(n, text.first_of(F.col(n), F.lit(d)))
    return out.withColumn("skip", F.lit(None).cast("string"))


def json_details(rows: DataFrame, details: DataFrame, item: str, fields: dict[str, str]) -> DataFrame:
    """``rows`` (with url) with fields from a JSON answer for each (``details``: url, content). ``item`` is the answer's schema,
    fields are SQL expressions over ``item``."""
    own = details.select(F.col("url").alias("__url"), F.from_json("content", item).alias("item"))
    own = own.select("__url", *[F.expr(e).cast("string").alias(n) for n, e in fields.items()])
    return rows.drop(*fields).join(own, F.col("url") == F.col("__url"), "left").drop("__url")


def from_json_with_details(councils: DataFrame, list_path: str, array: str, entry: str, detail: Column, item: str, fields: dict[str, str], **options) -> DataFrame:
    """Office-holders of JSON sites (council_id, base_url) whose list names people and whose details are asked for one by one:
    ``detail`` is the address of a person's answer, a Column over ``base_url`` and ``entry``. Both fetches are Spark jobs."""
    lists = fetch.with_fetched(councils.withColumn("url", F.concat("base_url", F.lit(list_path))), **options)
    entries = lists.withColumn("entry", F.from_json(F.get_json_object("content", array), f"array<{entry}>"))
    rows = entries.select("council_id", "base_url", F.posexplode("entry").alias("pos", "entry")).withColumn("url", detail)
    answers = fetch.fetched(rows, **options)
    return json_details(rows, answers.where("status = 200"), item, fields).drop("entry", "base_url").withColumn("skip", F.lit(None).cast("string"))


def faces(documents: DataFrame) -> DataFrame:
    """What a face detector said of a picture's first face, flat; ``documents`` have FaceDetails."""
    f = F.col("FaceDetails")[0]
    happy = F.exists(f["Emotions"], lambda e: (e["Type"] == "HAPPY") & (e["Confidence"] > 70))
    return documents.select(
        *[c for c in documents.columns if c != "FaceDetails"],
        f["Gender"]["Value"].alias("gender"),
        f["AgeRange"]["Low"].alias("age_low"),
        f["AgeRange"]["High"].alias("age_high"),
        f["Smile"]["Value"].alias("smile"),
        f["Eyeglasses"]["Value"].alias("glasses"),
        f["Beard"]["Value"].alias("beard"),
        happy.alias("happy"),
    )


def photo_size(url: Column, small: str = "120x150", large: str = "240x300") -> Column:
    """A thumbnail's address as that of the larger picture."""
    return F.replace(url, F.lit(small), F.lit(large))


def photo_links(rows: DataFrame, denied: tuple[str, ...] = ("logo", "icon", "badge", "avatar"), suffixes: tuple[str, ...] = (".gif", ".svg"), insecure: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a picture that may be a portrait: a web address without a denied word or suffix. Addresses of hosts that are
    ``insecure`` are asked for without encryption."""
    url = F.col("photo_url")
    bad = people.any_of([F.lower(url).contains(w) for w in denied] + [F.lower(url).endswith(s) for s in suffixes])
    kept = rows.where(url.startswith("http") & ~bad)
    if not insecure:
        return kept
    own = people.any_of([url.startswith(f"https://{h}/") for h in insecure])
    return kept.withColumn("photo_url", F.when(own, F.regexp_replace(url, "^https:", "http:")).otherwise(url))
