"""Links and addresses."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute(base: Column, href: Column) -> Column:
    """A link against the page it stands on; null if either is null. Python's rules, in Arrow batches: Spark has no
    function for dot segments and partial links."""

    def joined(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for bases, hrefs in batches:
            yield pd.Series([None if b is None or h is None else _joined(b, h) for b, h in zip(bases, hrefs)], dtype=object)

    return F.pandas_udf(joined, "string")(base, href)


def _joined(base: str, href: str) -> str | None:
    try:
        return urljoin(base, href)
    except ValueError:
        return None


def query_value(url: Column, name: str) -> Column:
    """A query parameter's value, or the url itself."""
    return F.coalesce(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)), url)


def last_segment(url: Column) -> Column:
    return F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)


def segment_after(url: Column, name: str) -> Column:
    """The path segment after one of that name; null without one."""
    return F.nullif(F.regexp_extract(url, f"/{name}/([^/?#]+)", 1), F.lit(""))


def with_scheme(url: Column) -> Column:
    """``//host`` as ``https://host``; inline data is no link."""
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(~url.startswith("data:"), url)


def style_url(style: Column) -> Column:
    """The address in a style attribute, without its query."""
    return F.nullif(F.regexp_extract(style, r"'([^'?]+)[^']*'", 1), F.lit(""))


def endpoint(base: Column, path: str) -> Column:
    return F.concat(F.rtrim(base, F.lit("/")), F.lit(path))
