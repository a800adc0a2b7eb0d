"""Dates, amounts and structured values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Day-first forms that records use, after ISO.
DATES = ("yyyy-MM-dd", "dd/MM/yyyy", "d/M/yyyy", "dd MMMM yyyy", "d MMMM yyyy")


def date_of(x: Column) -> Column:
    """A date in ISO or a day-first form, with any time after it ignored; null if it is neither."""
    day = F.regexp_replace(x, r"[T ]\d{1,2}:\d{2}.*$", "")
    return F.coalesce(*[F.try_to_timestamp(day, F.lit(f)) for f in DATES]).cast("date")


def iso_time(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss")


def size_label(n: Column) -> Column:
    """Bytes as B, KB, MB, GB or TB with one decimal, by steps of 1024."""
    label = lambda k, unit: F.concat(F.format_string("%.1f", F.bround(n / float(1024**k), 1)), F.lit(f" {unit}"))
    out = label(4, "TB")
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(n < 1024 ** (k + 1), label(k, unit)).otherwise(out)
    return out


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """A share as text; ties go to the even digit, and nothing out of nothing is zero."""
    share = F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)
    return F.concat(F.format_string(f"%.{digits}f", F.bround(share, digits)), F.lit("%"))


def current(start: Column, end: Column, as_of: Column) -> Column:
    """Valid on a day: open ends are valid and both bounds belong to the interval."""
    return F.coalesce(end >= as_of, F.lit(True)) & F.coalesce(start <= as_of, F.lit(True))


def compact(*fields: Column | str) -> Column:
    """The JSON text of a record, without its null fields."""
    return F.to_json(F.struct(*fields))


def overlaid(base: Column, top: Column) -> Column:
    """One map over another: the upper one's values win; a null map has no entries."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    base, top = F.coalesce(base, none), F.coalesce(top, none)
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(top), k)), top)


def same_system(a: Column, b: Column) -> Column:
    """Equal but for case; an unset system agrees with all."""
    return F.coalesce(F.lower(a) == F.lower(b), F.lit(True))
