"""Rows of office-holders: checks, skips, duplicates and the gate on their number.

A council that fails writes nothing, and never fails the job: its rows go to the reject table with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall import schemas

#: Fewer people than this, and a council's rows aren't trusted.
LEAST = 10
REQUIRED = ("division", "name", "party", "identifier")


def missing_fields(required: tuple[str, ...] = REQUIRED) -> Column:
    """The names of required fields that are null or empty."""
    tests = F.array(*[F.when(F.coalesce(F.col(n), F.lit("")) == "", F.lit(n)) for n in required])
    return F.array_compact(tests)


def skip_reason(rules: dict[str, Column]) -> Column:
    """The first rule that says a row is to be skipped; null for rows to keep."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()], F.lit(None).cast("string"))


def vacancy() -> Column:
    return F.lower("name").rlike("vacan(cy|t)")


def first_wins(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the first in order. Rows are reduced before they are shuffled."""
    return _one(rows, by, F.min, order)


def last_wins(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return _one(rows, by, F.max, order)


def _one(rows: DataFrame, by: list[str], pick, order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in by and c not in order]
    best = rows.groupBy(*by).agg(pick(F.struct(*order, *rest)).alias("__best"))
    return best.select(*by, "__best.*").select(*rows.columns)


def gate(rows: DataFrame, by: str = "council_id", least: int = LEAST, required: tuple[str, ...] = REQUIRED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, rejected, councils) of rows with an optional ``skip`` reason and their order in ``pos``.

    ``councils`` has n_seen (different identifiers, skipped ones too), n_kept and status: ok, few or incomplete. A council
    with a row that lacks a required field is incomplete as a whole; skipped rows lack nothing. Only councils that are ok
    are accepted, first rows winning over later ones of the same identifier. ``rejected`` has all other rows and why."""
    if "skip" not in rows.columns:
        rows = rows.withColumn("skip", F.lit(None).cast("string"))
    rows = rows.withColumn("lacks", missing_fields(required))
    kept = F.col("skip").isNull()
    councils = rows.groupBy(by).agg(
        F.count_distinct("identifier").alias("n_seen"),
        F.count_distinct(F.when(kept, F.col("identifier"))).alias("n_kept"),
        F.coalesce(F.bool_or(kept & (F.size("lacks") > 0)), F.lit(False)).alias("incomplete"),
    )
    status = F.when(F.col("incomplete"), "incomplete").when(F.col("n_seen") < least, "few").otherwise("ok")
    councils = councils.select(by, "n_seen", "n_kept", status.alias("status"))
    judged = rows.join(councils.select(F.col(by).alias("__by"), "status"), F.col(by).eqNullSafe(F.col("__by"))).drop("__by")
    good = judged.where((F.col("status") == "ok") & kept).drop("skip", "lacks", "status")
    accepted = first_wins(good, [by, "identifier"], ["pos"])
    why = F.coalesce("skip", F.when(F.size("lacks") > 0, F.concat(F.lit("lacks "), F.array_join("lacks", ", "))), F.concat(F.lit("council "), F.col("status")))
    rejected = judged.where((F.col("status") != "ok") | ~kept).withColumn("reason", why).drop("skip", "lacks", "status")
    return accepted, rejected, councils


def by_file_name(rows: DataFrame, name: Column, order: list[str]) -> DataFrame:
    """The last row staged under a file name."""
    return last_wins(rows.withColumn("file_name", name), ["council_id", "file_name"], order)


def checked_schema(rows: DataFrame) -> DataFrame:
    """All columns of a person, optional ones null where ``rows`` lacks them."""
    names = [f.name for f in schemas.PERSON.fields]
    have = set(rows.columns)
    return rows.select(*[c for c in rows.columns if c not in names], *[F.col(n) if n in have else F.lit(None).cast("string").alias(n) for n in names])


def standing_down(rows: DataFrame, councils: list[str], month: str = "2019-05") -> DataFrame:
    """People with an e-mail in the listed councils, or whose term ends in the month."""
    listed = F.col("council_id").isin(councils) | F.coalesce(F.contains("standing_down", F.lit(month)), F.lit(False))
    return rows.where((F.coalesce("email", F.lit("")) != "") & listed)


def same_domain(domain: str) -> Column:
    return F.coalesce(F.col("email").endswith(domain), F.lit(False))



def any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out
