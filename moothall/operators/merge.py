"""Changes between two states of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differing(old: DataFrame, new: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """``key``, the change (added, removed, changed) and which fields differ; null equals null. Same rows aren't returned."""
    a = old.select(*key, F.struct(*fields).alias("old"))
    b = new.select(*key, F.struct(*fields).alias("new"))
    both = a.join(b, key, "full")
    names = F.array_compact(F.array(*[F.when(~F.col(f"old.{f}").eqNullSafe(F.col(f"new.{f}")), F.lit(f)) for f in fields]))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.size(names) > 0, "changed")
    return both.select(*key, change.alias("change"), F.when(change == "changed", names).alias("fields")).where(change.isNotNull())


def upserted(old: DataFrame, feed: DataFrame, key: list[str], fields: list[str], now: Column, stamp: str = "last_updated") -> DataFrame:
    """``old`` with the feed's values of ``fields`` where the feed has one that differs; other columns are kept, new keys
    come in, and ``stamp`` is ``now`` for rows that changed."""
    rest = [c for c in old.columns if c not in (*key, *fields, stamp)]
    b = feed.select(*key, F.struct(*fields).alias("__new"))
    a = old.withColumn("__had", F.lit(True))
    both = a.join(b, key, "full")
    values = {f: F.coalesce(F.col(f"__new.{f}"), F.col(f)) for f in fields}
    changed = F.col("__had").isNull()
    for f in fields:
        changed = changed | (F.col(f"__new.{f}").isNotNull() & ~F.col(f"__new.{f}").eqNullSafe(F.col(f)))
    return both.select(*key, *[v.alias(f) for f, v in values.items()], *rest, F.when(changed, now).otherwise(F.col(stamp)).alias(stamp))
