"""The registry of councils: which are current, runnable, tagged, missing or fresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moothall.functions import values


def current(councils: DataFrame, as_of: Column) -> DataFrame:
    """Councils in being on a day; unknown or unreadable dates don't end one."""
    return councils.where(values.current(values.date_of(F.col("start_date")), values.date_of(F.col("end_date")), as_of))


def listed(rows: DataFrame, ids: str, key: str = "council_id") -> DataFrame:
    """Rows whose id is in a comma-separated list; an id may carry a slug after a hyphen, and lower case."""
    wanted = [x.strip().split("-")[0].upper() for x in ids.split(",") if x.strip()]
    return rows.where(F.col(key).isin(wanted))


def local_authorities(councils: DataFrame, ident: str | None = None) -> DataFrame:
    """Councils that are local authorities; with ``ident``, the one of that official identifier."""
    own = F.col("organisation")
    kept = councils.where(own["organisation_type"] == "local-authority")
    return kept if ident is None else kept.where(own["official_identifier"] == ident)


def missing(councils: DataFrame, registry: DataFrame) -> DataFrame:
    """Councils without an extractor."""
    return councils.join(registry.select("council_id"), "council_id", "left_anti")


def known(councils: DataFrame, registry: DataFrame) -> DataFrame:
    return councils.join(registry.select("council_id"), "council_id", "left_semi")


def disabled(registry: DataFrame) -> DataFrame:
    return registry.where(F.coalesce("disabled", F.lit(False)))


def all_tags() -> Column:
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce("tags", none), F.coalesce("class_tags", none))


def tagged_all(registry: DataFrame, tags: list[str]) -> DataFrame:
    """Extractors that have every tag, of their own or of their class."""
    return registry.where(F.size(F.array_except(F.array(*map(F.lit, tags)), all_tags())) == 0)


def tagged_any(registry: DataFrame, tags: list[str]) -> DataFrame:
    """Extractors that have any of the tags as their own."""
    return registry.where(F.coalesce(F.arrays_overlap("tags", F.array(*map(F.lit, tags))), F.lit(False)))


def stale(runs: DataFrame, as_of: Column, key: str = "council_id", at: str = "end", hours: int = 24) -> DataFrame:
    """Keys and their last run, where that isn't within so many hours."""
    last = runs.groupBy(key).agg(F.max(at).alias("last_run"))
    return last.where(~F.coalesce(F.col("last_run") > as_of - F.make_dt_interval(hours=F.lit(hours)), F.lit(False)))


def resolved(codes: DataFrame, folders: DataFrame) -> DataFrame:
    """Each code with its folder: one named code-slug, else just the code, else one that has it as a token. A code that
    fits several folders equally well has none, and ``status`` says so."""
    code, folder = F.upper("code"), F.col("folder")
    tokens = F.split(F.lower(folder), "-")
    # a folder can be met by its id or by any of its tokens: the join is on single words
    words = folders.select("folder", F.explode(F.array_distinct(F.concat(tokens, F.array(F.lower(F.split_part(folder, F.lit("-"), F.lit(1))))))).alias("word"))
    met = codes.join(words, F.lower("code") == F.col("word"))
    rank = F.when(folder.startswith(F.concat(code, F.lit("-"))), 1).when(folder == code, 2).otherwise(3)
    best = met.withColumn("rank", rank).groupBy("code").agg(F.min_by(F.col("folder"), F.struct("rank", "folder")).alias("folder"), F.min("rank").alias("rank"), F.collect_list("rank").alias("ranks"))
    ties = F.size(F.filter("ranks", lambda r: r == F.col("rank"))) > 1
    found = codes.join(best.select(F.col("code").alias("c"), "folder", "rank", ties.alias("ties")), F.col("code") == F.col("c"), "left")
    status = F.when(F.col("folder").isNull(), "unknown").when(F.col("ties"), "ambiguous").otherwise("ok")
    return found.select("code", status.alias("status"), F.when(status == "ok", F.col("folder")).alias("folder"))


def tasks(councils: DataFrame) -> DataFrame:
    """What a worker is told."""
    return councils.select(F.lit("councillors").alias("scraper_type"), F.col("council_id").alias("council"))


def systems(councils: DataFrame) -> DataFrame:
    """Councils with any service data: id, name and system, with fallbacks that pass over empty strings."""
    from moothall.functions.text import first_of

    s, o = F.col("service"), F.col("organisation")
    present = s.isNotNull() & F.coalesce(s["cms_type"], s["cms_version"], s["base_url"], s["notes"]).isNotNull()
    return councils.where(present).select(
        first_of(o["official_identifier"], F.col("council_id")).alias("council_id"),
        F.coalesce(first_of(o["common_name"], o["official_name"]), F.lit("Unknown")).alias("name"),
        s["cms_type"].alias("cms_type"),
        s["cms_version"].alias("cms_version"),
        s["base_url"].alias("base_url"),
    )


def newest(rows: DataFrame, order: list[Column], keep: int) -> DataFrame:
    """``rows`` with ``keep``: whether they are among the newest so many. For listings of bounded size, such as reports."""
    first = rows.orderBy(*order).limit(keep).withColumn("keep", F.lit(True))
    return first.unionByName(rows.join(first.drop("keep"), rows.columns, "left_anti").withColumn("keep", F.lit(False)))


def keep_newest(rows: DataFrame, by: list[str], order: list[Column], keep: int) -> DataFrame:
    """The same for each group."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("keep", n <= keep)
