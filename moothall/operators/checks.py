"""Checks of extractors against their metadata: errors, warnings and suggestions as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The system that a parent class is for, and parents that need no methods of their own.
EXPECTED = {"ModGovCouncillorScraper": "ModernGov", "CMISCouncillorScraper": "CMIS", "HTMLCouncillorScraper": "Custom HTML"}
COMPLETE = ("ModGovCouncillorScraper", "CMISCouncillorScraper")
# What reports say.
NO_SOURCE = "No councillors.py file found"
UNREADABLE = "Could not load scraper class information"
NO_BASE = "No base_url found in metadata. Please set services.councillors.base_url in metadata.json"
MISMATCH = "CMS type mismatch: scraper uses '%s' (suggests '%s') but metadata has '%s'"
SKIPPED = "Scraper is disabled - base_url validation skipped"
SUGGESTED = "Consider setting %s"


def said(**messages: tuple[Column, Column | str]) -> Column:
    """The messages whose condition holds, in order."""
    each = [F.when(F.coalesce(c, F.lit(False)), F.lit(m) if isinstance(m, str) else m) for c, m in messages.values()]
    return F.array_compact(F.array(*each))


def validated(councils: DataFrame, facts: DataFrame) -> DataFrame:
    """(council_id, valid, warnings, errors, suggestions) of each council; ``facts`` are those of its source text."""
    f = facts.withColumn("has_source", F.lit(True)).withColumnRenamed("council_id", "__id")
    both = councils.join(f, F.col("council_id") == F.col("__id"), "left")
    source, parent = F.col("has_source").isNotNull(), F.col("parent_class")
    read = source & parent.isNotNull()
    cms, base = F.nullif("service.cms_type", F.lit("")), F.nullif("service.base_url", F.lit(""))
    off = F.coalesce("disabled", F.lit(False))
    expected = F.create_map(*[F.lit(x) for kv in EXPECTED.items() for x in kv])[parent]
    public = F.filter("methods", lambda m: ~m.startswith("_"))
    upper = F.upper("content")
    errors = said(
        none=(~source, NO_SOURCE),
        unread=(source & ~read, UNREADABLE),
        base=(read & ~off & base.isNull(), NO_BASE),
    )
    warnings = said(
        todo=(read & upper.contains("TODO"), "Contains TODO comments"),
        fixme=(read & upper.contains("FIXME"), "Contains FIXME comments"),
        off=(read & off, "Scraper is disabled"),
        methods=(read & (F.size(public) == 0) & ~parent.isin(*COMPLETE), "No public methods found"),
        system=(
            read & cms.isNotNull() & expected.isNotNull() & (expected != cms),
            F.format_string(MISMATCH, parent, expected, cms),
        ),
    )
    suggestions = said(
        cms=(read & cms.isNull(), SUGGESTED % "cms_type"),
        base=(read & base.isNull(), SUGGESTED % "base_url"),
        off=(read & off, SKIPPED),
    )
    return both.select("council_id", read.alias("valid"), warnings.alias("warnings"), errors.alias("errors"), suggestions.alias("suggestions"))


# What an extractor's class may be derived from.
BASES = ("BaseCouncillorScraper", "HTMLCouncillorScraper", "PagedHTMLCouncillorScraper", "ModGovCouncillorScraper", "CMISCouncillorScraper", "JSONCouncillorScraper")


def loaded(codes: DataFrame, facts: DataFrame, bases: tuple[str, ...] = BASES) -> DataFrame:
    """(council_id, status) of each code's extractor: ``ok``, ``missing`` without a source, ``wrong base`` where its class isn't
    derived from one of ``bases`` or there is none."""
    own = facts.select(F.col("council_id").alias("__id"), "parent_class", F.lit(True).alias("there"))
    both = codes.join(own, F.col("council_id") == F.col("__id"), "left")
    right = F.coalesce(F.col("parent_class").isin(*bases), F.lit(False))
    return both.select("council_id", F.when(F.col("there").isNull(), "missing").when(right, "ok").otherwise("wrong base").alias("status"))


#: What every extractor's class must state.
CONTRACT = ("service_name", "scraper_object_type")


def failed(classes: DataFrame, tests: dict[str, Column] | None = None) -> DataFrame:
    """(council_id, failed): the names of the tests that each class doesn't pass, in order. ``tests`` are Columns over
    ``classes``; a null counts as not passed. Without them, the contract: service name and object type are stated."""
    if tests is None:
        tests = {n: F.coalesce(n, F.lit("")) != "" for n in CONTRACT}
    return classes.select("council_id", said(**{n: (~F.coalesce(t, F.lit(False)), n) for n, t in tests.items()}).alias("failed"))


def totals(reports: DataFrame) -> DataFrame:
    return reports.agg(
        F.count("*").alias("total"),
        F.count_if("valid").alias("valid"),
        F.count_if(F.size("warnings") > 0).alias("with_warnings"),
        F.count_if(F.size("errors") > 0).alias("with_errors"),
    )


def common_issues(reports: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent warnings; ties go by their text."""
    issues = reports.select(F.explode("warnings").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    return issues.orderBy(F.desc("n"), "issue").limit(most)


def with_issues(reports: DataFrame, most: int = 20) -> DataFrame:
    return reports.where((F.size("warnings") > 0) | (F.size("errors") > 0)).orderBy("council_id").limit(most)
