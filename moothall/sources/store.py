"""A store of councils' files with transactions, as a Spark data source.

``spark.dataSource.register(Store)``. A session replaces all files of the councils it has: those whose rows all went lose
their files. Tasks write their files into folders of their own, which nobody sees: what is in force is said by a manifest, a
small file that names for each council the folders with its files. A session's end writes the next manifest in one move, so
all its councils change at once, or none if a task or the driver fails; files of attempts that failed or were repeated are
in no manifest. ``vacuum`` removes what no manifest in force names, such as what a task of a broken-off session wrote after
its end.

Layout: ``<root>/manifests/<number>-<session>.json`` and ``<root>/files/<session>/<attempt>/<council>/<file>``. The manifest has
an entry for each council, not for each file. ``root`` is a folder that driver and executors share: a path, or an address that
pyarrow's file systems know.

Defined results: a session without rows changes nothing; a row without a file name says that its council belongs to the
session; a session that was committed is closed, and writing to it again is an error; so is a session during which another one
was committed, and an empty message. A council or file name may hold any characters.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FILES = "council_id string, file_name string, content string"


class Root:
    """The manifests and files below a folder."""

    def __init__(self, root: str):
        self.fs, self.path = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)

    def names(self, below: str) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/{below}", allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.startswith("."))

    def manifests(self) -> list[str]:
        return [n for n in self.names("manifests") if n.endswith(".json")]

    def read(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.path}/{name}") as f:
            return json.loads(f.read())

    def current(self) -> dict:
        """The manifest in force."""
        names = self.manifests()
        return self.read(f"manifests/{names[-1]}") if names else {"number": 0, "councils": {}}

    def write(self, name: str, data: bytes) -> None:
        folder = f"{self.path}/{name}".rpartition("/")[0]
        self.fs.create_dir(folder, recursive=True)
        with self.fs.open_output_stream(f"{self.path}/{name}") as f:
            f.write(data)

    def drop(self, below: str) -> None:
        if self.fs.get_file_info(f"{self.path}/{below}").type != fs.FileType.NotFound:
            self.fs.delete_dir(f"{self.path}/{below}")


@dataclass
class Written(WriterCommitMessage):
    """A task's folder and, for each council, how many files it wrote there."""

    folder: str
    councils: dict[str, int]


class Store(DataSource):
    """Options: ``root``; for reading also ``council_id``, for writing ``session`` and ``message``."""

    @classmethod
    def name(cls) -> str:
        return "council_store"

    def schema(self) -> str:
        return FILES

    def reader(self, schema) -> DataSourceReader:
        return StoreReader(self.options["root"], self.options.get("council_id"))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return StoreWriter(self.options, schema.fieldNames())


class StoreWriter(DataSourceWriter):
    def __init__(self, options, names: list[str]):
        self.root, self.session, self.message = options["root"], options["session"], options.get("message", "").strip()
        if not self.message:
            raise ValueError("a session needs a message")
        if not {"council_id", "file_name", "content"} <= set(names):
            raise ValueError(f"rows need {FILES}")
        root = Root(self.root)
        if any(n.endswith(f"-{quote(self.session, safe='')}.json") for n in root.manifests()):
            raise RuntimeError(f"session {self.session} is closed")
        self.base = root.current()["number"]

    def write(self, rows: Iterator) -> Written:
        root, councils = Root(self.root), {}
        folder = f"files/{quote(self.session, safe='')}/{uuid.uuid4().hex}"
        for r in rows:
            councils.setdefault(r["council_id"], 0)
            if r["file_name"] is not None:
                root.write(f"{folder}/{quote(r['council_id'], safe='')}/{quote(r['file_name'], safe='')}", (r["content"] or "").encode())
                councils[r["council_id"]] += 1
        return Written(folder, councils)

    def commit(self, messages: list[Written | None]) -> None:
        root, changed = Root(self.root), {}
        for m in filter(None, messages):
            for council, n in m.councils.items():
                entry = changed.setdefault(council, {"folders": [], "files": 0})
                if n:
                    entry["folders"].append(m.folder)
                    entry["files"] += n
        if not changed:
            return
        now = root.current()
        if now["number"] != self.base:
            raise RuntimeError(f"another session was committed after {self.session} began")
        councils = {**now["councils"], **changed}
        # a council without files is in no manifest
        councils = {k: v for k, v in sorted(councils.items()) if v["files"]}
        number = self.base + 1
        manifest = {"number": number, "session": self.session, "message": self.message, "applied": sum(c["files"] for c in changed.values()), "changed": sorted(changed), "councils": councils}
        name = f"{number:09d}-{quote(self.session, safe='')}.json"
        root.write(f"manifests/.{name}", json.dumps(manifest).encode())
        root.fs.move(f"{root.path}/manifests/.{name}", f"{root.path}/manifests/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        Root(self.root).drop(f"files/{quote(self.session, safe='')}")


class Council(InputPartition):
    def __init__(self, council: str, folders: list[str]):
        super().__init__((council, folders))


class StoreReader(DataSourceReader):
    """The files in force; with ``only`` those of one council, so that others' aren't touched."""

    def __init__(self, root: str, only: str | None):
        self.root, self.only = root, only

    def partitions(self) -> list[Council]:
        found = Root(self.root).current()["councils"]
        return [Council(c, v["folders"]) for c, v in found.items() if self.only in (None, c)]

    def read(self, partition: Council | None) -> Iterator[tuple]:
        if partition is None:  # there are no partitions
            return
        root = Root(self.root)
        council, folders = partition.value
        for folder in folders:
            below = f"{folder}/{quote(council, safe='')}"
            for name in root.names(below):
                with root.fs.open_input_stream(f"{root.path}/{below}/{name}") as f:
                    yield council, unquote(name), f.read().decode()


def commit(files: DataFrame, councils: DataFrame, root: str, message: str, session: str | None = None) -> dict:
    """Replace the files of ``councils`` (council_id) by ``files`` (council_id, file_name, content), all at once, and tell what
    is in force. Files of other councils are left out; of several files of one name the one with the greatest content stays."""
    spark = files.sparkSession
    spark.dataSource.register(Store)
    own = councils.select("council_id").distinct()
    kept = files.join(own, "council_id", "left_semi").groupBy("council_id", "file_name").agg(F.max("content").alias("content"))
    none = own.join(kept, "council_id", "left_anti").select("council_id", F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("string").alias("content"))
    before = Root(root).current()["number"]
    # a council's files are few tasks' work; a very large one is split
    staged = kept.unionByName(none).hint("rebalance", "council_id")
    staged.write.format("council_store").mode("append").options(root=root, message=message, session=session or uuid.uuid4().hex).save()
    now = Root(root).current()
    if now["number"] == before:
        return {"skipped": True, "reason": "no changes"}
    return {k: now[k] for k in ("number", "session", "message", "applied", "changed")}


def stored(spark: SparkSession, root: str, council: str | None = None) -> DataFrame:
    """(council_id, file_name, content) of the files in force, of all councils or of one."""
    spark.dataSource.register(Store)
    rows = spark.read.format("council_store").option("root", root)
    return (rows if council is None else rows.option("council_id", council)).load()


def vacuum(root: str, keep: int = 2) -> list[str]:
    """Remove the sessions' folders that none of the last ``keep`` manifests names; tells which. Not to be run during a session."""
    at = Root(root)
    used = {f.split("/")[1] for n in at.manifests()[-keep:] for c in at.read(f"manifests/{n}")["councils"].values() for f in c["folders"]}
    gone = [s for s in at.names("files") if s not in used]
    for s in gone:
        at.drop(f"files/{s}")
    return gone
