"""Pages to be fetched, as a stream.

``spark.dataSource.register(PageStream)``; ``spark.readStream.format("page_stream").option("queue", folder)``. A run puts a file of
links into the queue, a line for each: a council, a tab, an address. Files are taken in order of their names, which don't change
once they are there. The stream's offset is the name of the last file taken, so the checkpoint of a query says where a restarted
run takes up, and what was fetched in a batch that ended isn't fetched again; a batch that was broken off is. The driver sees
names of files, never links: each file's lines are dealt to ``tasks`` by number.

Options besides: ``tasks`` for a file (8), ``pace`` between two requests of a task, and those of ``web.Client``.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from moothall.sources.web import Client

PAGES = "council_id string, url string, status int, content string, error string, fetched_at timestamp"


class PageStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_stream"

    def schema(self) -> str:
        return PAGES

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStreamReader(self.options)


class Part(InputPartition):
    def __init__(self, file: str, number: int):
        super().__init__((file, number))


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.queue, self.tasks, self.pace = options["queue"], int(options.get("tasks", 8)), float(options.get("pace", 0))
        self.options = dict(options)

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.queue) if "://" in self.queue else (fs.LocalFileSystem(), self.queue)

    def _files(self) -> list[str]:
        at, path = self._place()
        found = at.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(i.base_name for i in found if i.is_file and not i.base_name.startswith((".", "_")))

    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        return {"last": max(self._files(), default="")}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return [Part(f, k) for f in self._files() if start["last"] < f <= end["last"] for k in range(self.tasks)]

    def read(self, partition: Part) -> Iterator[tuple]:
        at, path = self._place()
        file, number = partition.value
        client = Client(self.options)
        with at.open_input_stream(f"{path}/{file}") as f:
            lines = f.read().decode().splitlines()
        for line in lines[number :: self.tasks]:
            council, _, url = line.partition("\t")
            if url.strip():
                status, content, error = client.fetch(client.asked(url.strip()))
                yield council, url.strip(), status, content, error, datetime.now(UTC)
                time.sleep(self.pace)


def last_runs(pages: DataFrame) -> DataFrame:
    """(council_id, last_run, pages, failed) of each council so far: state that grows with councils, not with pages."""
    return pages.groupBy("council_id").agg(F.max("fetched_at").alias("last_run"), F.count("*").alias("pages"), F.count_if(F.col("status") != 200).alias("failed"))


def run(pages: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write a stream's pages to a table, by council; without ``every``, what is in the queue, once."""
    out = pages.writeStream.format("parquet").partitionBy("council_id").option("path", path).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start()
