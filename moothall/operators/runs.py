"""Roll-ups of run results, and what is told about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.functions import values

RATE_LIMITED = 429


def bucket(status: Column, code: Column) -> Column:
    """completed, rate_limited, failed, disabled or other, in that precedence; unset is unknown and 200."""
    status, code = F.coalesce(status, F.lit("unknown")), F.coalesce(code, F.lit(200))
    out = F.when(status == "completed", "completed").when(code == RATE_LIMITED, "rate_limited")
    return out.when(status == "failed", "failed").when(status == "disabled", "disabled").otherwise("other")


def counts(own: Column) -> list[Column]:
    """Totals of a bucket column, and the rate of success."""
    done = F.count_if(own == "completed")
    return [
        F.count("*").alias("total_ran"),
        done.alias("total_succeeded"),
        *[F.count_if(own == b).alias(f"total_{b}") for b in ("failed", "rate_limited", "disabled")],
        values.percent(done, F.count("*"), 2).alias("success_rate"),
    ]


def summary(results: DataFrame) -> DataFrame:
    """One row, also for no results."""
    return results.select(bucket(F.col("status"), F.col("statusCode")).alias("b")).agg(*counts(F.col("b")))


def post_processing(results: DataFrame) -> DataFrame:
    """The later totals, in which a rate limit is a failure."""
    return results.agg(
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "disabled").alias("disabled"),
        F.coalesce(F.sum("files_committed"), F.lit(0)).alias("files_committed"),
    )


def report(results: DataFrame) -> DataFrame:
    """Rows of the report, with an error and a log only where there is one."""
    own = bucket(F.col("status"), F.col("statusCode"))
    error = F.coalesce(F.nullif("error", F.lit("")), F.when(own == "rate_limited", "GHRateLimited").when(own == "failed", "Unknown error"))
    return results.select(
        F.coalesce("council", F.lit("unknown")).alias("council"),
        F.coalesce("scraper_type", F.lit("unknown")).alias("scraper_type"),
        own.alias("bucket"),
        F.when(own.isin("rate_limited", "failed"), error).alias("error"),
        F.nullif("runlog_s3_key", F.lit("")).alias("log"),
    )


def message(rows: DataFrame, most: int = 20) -> DataFrame:
    """A section of text for each bucket: its first councils in order and how many more there are. Groups are cut to
    ``most`` before they are collected."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("bucket").orderBy("council"))
    totals = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    first = rows.withColumn("k", n).where(F.col("k") <= most)
    line = F.concat(F.lit("- "), F.col("council"), F.coalesce(F.concat(F.lit(": "), F.col("error")), F.lit("")))
    lines = first.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("lines"))
    both = totals.join(lines, "bucket")
    said = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    more = F.when(F.col("n") > most, F.concat(F.lit("\n... and "), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return both.select("bucket", "n", F.concat(said, more).alias("text"))


def finished(runs: DataFrame) -> DataFrame:
    """Run logs with their duration."""
    return runs.withColumn("duration", F.col("end") - F.col("start")).withColumn(
        "duration_seconds", F.unix_micros("end") / 1e6 - F.unix_micros("start") / 1e6
    )


def histogram(rows: DataFrame, by: Column, name: str, unknown: str | None = "Unknown") -> DataFrame:
    """Counts of a column's values and their shares; with ``unknown``, null and empty are that value, else null is a group
    of its own. The shares come from one more row-sized join, not from a window over all rows."""
    value = F.coalesce(F.nullif(by, F.lit("")), F.lit(unknown)) if unknown is not None else by
    groups = rows.groupBy(value.alias(name)).agg(F.count("*").alias("n"))
    total = groups.agg(F.sum("n").alias("total"))
    share = values.percent(F.col("n"), F.col("total"))
    return groups.join(F.broadcast(total)).select(name, "n", share.alias("share"))  # one row by definition


def file_changes(diff: DataFrame) -> DataFrame:
    """Files added, deleted and modified, from lines added and deleted; binary files have neither and don't count."""
    a, d = F.col("added"), F.col("deleted")
    return diff.agg(
        F.count_if((a > 0) & (d == 0)).alias("files_added"),
        F.count_if((a == 0) & (d > 0)).alias("files_deleted"),
        F.count_if(a.isNotNull() & d.isNotNull() & ~((a > 0) & (d == 0)) & ~((a == 0) & (d > 0))).alias("files_modified"),
    )


def sync_totals(stats: DataFrame) -> DataFrame:
    """Totals of mirrored repositories; skipped and dry runs don't count."""
    real = stats.where(~F.coalesce("skipped", F.lit(False)) & ~F.coalesce("dry_run", F.lit(False)))
    return real.agg(
        F.coalesce(F.sum("files_downloaded"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("total_bytes"), F.lit(0)).alias("bytes"),
        F.count_if(F.coalesce("errors", F.lit(0)) == 0).alias("ok"),
        F.count("*").alias("repositories"),
    )


def expired(reports: DataFrame, logs: DataFrame, keep: int = 10) -> DataFrame:
    """Keys to delete: all reports but the newest ``keep``, and the logs of their executions."""
    order = [F.desc("last_modified"), F.asc("key")]
    kept = reports.orderBy(*order).limit(keep)
    old = reports.join(kept.select("key"), "key", "left_anti")
    return old.select("key").unionByName(logs.join(old.select("execution_id"), "execution_id", "left_semi").select("key"))
