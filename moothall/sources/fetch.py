"""Fetching as an operator over a table of links.

Every different address is asked for once, however many rows have it. Addresses are dealt to tasks by host and lane: a
host's addresses are spread over ``lanes`` by their hash, and each lane is in one task, which waits ``pace`` times ``lanes``
seconds between two of its requests. So a host is asked no more often than once in ``pace`` seconds whatever the number of
tasks, and a host that has a third of all links can be given more lanes without being asked more often.

What came back is put into the shared checkpoint folder before anything uses it, so a plan that needs it twice, or a task that
is lost later on, doesn't ask again; a task that is lost while it fetches asks for its own addresses again.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moothall.sources.shared import put_aside
from moothall.sources.web import Client

PAGE = "url string, status int, content string, error string"
#: Characters of answers that a task holds before it hands them on.
HELD = 8 << 20


def _fetched(batches: Iterator[pd.DataFrame], options: dict[str, str], gap: float) -> Iterator[pd.DataFrame]:
    client, free, rows, size = Client(options), {}, [], 0
    for batch in batches:
        for url, lane in zip(batch["url"], batch["lane"], strict=True):
            key = (urlsplit(url).netloc, lane)
            time.sleep(max(0.0, free.get(key, 0.0) - time.monotonic()))
            free[key] = time.monotonic() + gap
            status, content, error = client.fetch(client.asked(url))
            rows.append((url, status, content, error))
            size += len(content or "")
            if size > HELD:
                yield pd.DataFrame(rows, columns=["url", "status", "content", "error"])
                rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["url", "status", "content", "error"])


def fetched(links: DataFrame, url: str = "url", pace: float = 0.0, lanes: int = 1, tasks: int | None = None, **options: str) -> DataFrame:
    """(url, status, content, error) of each different address in a column; null addresses have no row. ``options`` are those of
    ``web.Client``, ``tasks`` how many tasks ask at once (the session's shuffle partitions if not given)."""
    n = tasks or int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = links.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    host, lane = F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1), F.pmod(F.xxhash64("url"), F.lit(lanes))
    dealt = own.withColumn("lane", lane).repartition(n, host, "lane").sortWithinPartitions("url")
    asked = {k: str(v) for k, v in options.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _fetched(batches, asked, pace * lanes)

    return put_aside(dealt.mapInPandas(run, PAGE))


def with_fetched(rows: DataFrame, url: str = "url", **options) -> DataFrame:
    """``rows`` with status, content and error of the address that each has; several rows may have the same."""
    pages = fetched(rows, url, **options).withColumnRenamed("url", "__url")
    return rows.drop("status", "content", "error").join(pages, F.col(url) == F.col("__url"), "left").drop("__url")
