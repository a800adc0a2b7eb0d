"""Live sources of pages, as Spark data sources and as an operator over a table of links.

``pages``: ``spark.dataSource.register(PageSource)``, then ``spark.read.format("pages").option("urls", json_list)``; rows are
(url, start, page, status, content, error). Pages are dealt to partitions of ``per_partition`` links. With ``next_pattern`` a
partition follows the link that the pattern's first group has; ``url`` is then each page's own address and ``start`` that of the
first one; where ``max_pages`` is given and ends a chain, its last row's error says so. For links that are rows of a table
there is ``fetch.fetched``.

``rest``: a paginated JSON interface as a table whose columns are named by the given schema. Equality filters on columns that
the option ``filters`` lists (a JSON array) become parameters of the request, and Spark doesn't see them again; all others
are left to Spark. Fields that the schema doesn't name aren't read from the answers; those that aren't texts come as JSON.
Filters are handed on where ``spark.sql.python.filterPushdown.enabled`` is set.

A page that can't be had is a row with a status and an error (an exception in ``rest``, whose rows have no place for it).
Answers 429 and 5xx and failed connections are asked for again, ``retries`` times in all, after a pause that doubles.
``verify`` false takes any certificate, ``proxy`` is a proxy's address, and ``query`` (a JSON object) is put into every address.
"""

from __future__ import annotations

import json
import re
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.types import StringType, StructType


class Client:
    """One way of asking: options as in the module's docstring."""

    def __init__(self, options: Mapping[str, str]):
        self.timeout, self.pause = float(options.get("timeout", 30)), float(options.get("pause", 0))
        self.retries = int(options.get("retries", 3))
        self.verify, self.proxy = options.get("verify", "true").lower() != "false", options.get("proxy")
        self.query, self.headers = json.loads(options.get("query", "{}")), json.loads(options.get("headers", "{}"))

    def opener(self) -> urllib.request.OpenerDirector:
        context = ssl.create_default_context() if self.verify else ssl._create_unverified_context()
        handlers: list = [urllib.request.HTTPSHandler(context=context)]
        if self.proxy:
            handlers.append(urllib.request.ProxyHandler({"http": self.proxy, "https": self.proxy}))
        return urllib.request.build_opener(*handlers)

    def asked(self, url: str) -> str:
        """An address with the query's values."""
        if not self.query:
            return url
        own = urllib.parse.urlsplit(url)
        values = dict(urllib.parse.parse_qsl(own.query, keep_blank_values=True)) | self.query
        return urllib.parse.urlunsplit(own._replace(query=urllib.parse.urlencode(values)))

    def fetch(self, url: str) -> tuple[int, str | None, str | None]:
        """Status, content and error of an address."""
        status, error, opener = 0, None, self.opener()
        for turn in range(self.retries):
            if turn:
                time.sleep(self.pause * 2 ** (turn - 1))
            try:
                request = urllib.request.Request(url.replace(" ", "%20"), headers=self.headers)
                with opener.open(request, timeout=self.timeout) as r:
                    return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), None
            except urllib.error.HTTPError as e:
                status, error = e.code, str(e)
                if status != 429 and status < 500:
                    break
            except (OSError, ValueError) as e:
                status, error = 0, str(e)
        return status, None, error


class Links(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(urls)


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "url string, start string, page int, status int, content string, error string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


class PageReader(DataSourceReader):
    def __init__(self, options):
        self.client = Client(options)
        self.urls, self.per_partition = json.loads(options["urls"]), int(options.get("per_partition", 10))
        self.max_pages, self.next = int(options.get("max_pages", 0)), options.get("next_pattern")

    def partitions(self) -> list[Links]:
        return [Links(self.urls[i : i + self.per_partition]) for i in range(0, len(self.urls), self.per_partition)]

    def read(self, partition: Links) -> Iterator[tuple]:
        for start in partition.value:
            url, page, seen = start, 0, set()
            while url and url not in seen:
                seen.add(url)
                status, content, error = self.client.fetch(self.client.asked(url))
                found = re.search(self.next, content or "") if self.next else None
                if found and page + 1 == self.max_pages:
                    found, error = None, f"more pages than {self.max_pages}"
                yield url, start, page, status, content, error
                url, page = urllib.parse.urljoin(url, found[1]) if found else None, page + 1
                time.sleep(self.client.pause)


class RestSource(DataSource):
    """Options: ``url``, ``items`` (the answer's list; the answer itself if empty), ``next`` (the key of the next page's address)."""

    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self) -> StructType:
        raise ValueError("name the columns: read.format('rest').schema(...)")

    def reader(self, schema: StructType) -> DataSourceReader:
        return RestReader(self.options, schema)


class RestReader(DataSourceReader):
    def __init__(self, options, fields: StructType):
        self.client, self.fields = Client(options), fields
        self.url, self.items, self.next = options["url"], options.get("items", "results"), options.get("next", "next")
        self.served = json.loads(options.get("filters", "[]"))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in self.served and f.attribute[0] not in self.client.query:
                self.client.query = self.client.query | {f.attribute[0]: str(f.value)}
            else:
                yield f

    def partitions(self) -> list[Links]:
        return [Links([self.url])]

    def read(self, partition: Links) -> Iterator[tuple]:
        url, seen = self.client.asked(partition.value[0]), set()
        while url and url not in seen:
            seen.add(url)
            status, content, error = self.client.fetch(url)
            if content is None:
                raise RuntimeError(f"{url}: {status} {error}")
            answer = json.loads(content)
            for item in answer[self.items] if self.items else answer:
                yield tuple(self.value(item.get(f.name), f.dataType) for f in self.fields.fields)
            url = answer.get(self.next) if isinstance(answer, dict) and self.next else None
            url = urllib.parse.urljoin(partition.value[0], url) if url else None
            time.sleep(self.client.pause)

    def value(self, x, kind):
        if isinstance(kind, StringType):
            return x if x is None or isinstance(x, str) else json.dumps(x)
        return x
