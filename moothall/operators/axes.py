"""Neighbours in an order: the nearest row before or after that meets a condition, and siblings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_before(value: Column, condition: Column, by: list[str], order: list[str]) -> Column:
    """``value`` of the closest earlier row of the group for which ``condition`` holds."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(F.when(condition, value), ignorenulls=True).over(w)


def nearest_after(value: Column, condition: Column, by: list[str], order: list[str]) -> Column:
    """The same of the closest later row. Rows are gone through from the end, so each is looked at once."""
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(F.when(condition, value), ignorenulls=True).over(w)


def nearest_in_stretches(rows: DataFrame, value: Column, condition: Column, by: list[str], order: list[str], stretch: Column, before: str, after: str) -> DataFrame:
    """``rows`` with the values of the closest earlier and later row of the group for which ``condition`` holds, where a group
    may have any share of all rows. ``stretch`` cuts a group into pieces that are in the same order as its rows, such as the
    hour of a time; a task has a piece, and what lies beyond it comes from the pieces' own first and last values, of which a
    group has one for each stretch."""
    own = rows.withColumns({"__value": F.when(condition, value), "__stretch": stretch})
    piece = [*by, "__stretch"]
    own = own.withColumns({before: nearest_before(F.col("__value"), F.col("__value").isNotNull(), piece, order), after: nearest_after(F.col("__value"), F.col("__value").isNotNull(), piece, order)})
    place = F.when(F.col("__value").isNotNull(), F.struct(*order))
    ends = own.groupBy(*piece).agg(F.min_by("__value", place).alias("__first"), F.max_by("__value", place).alias("__last"))
    ends = ends.withColumns({"__earlier": nearest_before(F.col("__last"), F.col("__last").isNotNull(), by, ["__stretch"]), "__later": nearest_after(F.col("__first"), F.col("__first").isNotNull(), by, ["__stretch"])})
    ends = ends.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__stretch").alias("__at"), "__earlier", "__later")
    same = F.col("__stretch").eqNullSafe(F.col("__at"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    both = own.join(ends, same)
    return both.select(*rows.columns, F.coalesce(before, "__earlier").alias(before), F.coalesce(after, "__later").alias(after))


def following(value: Column, by: list[str], order: list[str], n: int = 1) -> Column:
    return F.lead(value, n).over(Window.partitionBy(*by).orderBy(*order))


def nth(by: list[str], order: list[Column | str]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))
