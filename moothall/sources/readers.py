"""Readers. Every one returns a lazy DataFrame; schemas are given, never inferred, so unused fields aren't parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moothall import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _folder(levels: int) -> Column:
    """The name of the folder that many levels above a file."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 - levels)


def council_of(folder: Column) -> Column:
    """A folder's council: the text before its first hyphen."""
    return F.split_part(folder, F.lit("-"), F.lit(1))


def registry_folders(spark: SparkSession, root: str) -> DataFrame:
    """(council_id, folder) of the registry's folders, those that begin with two underscores left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    found = files.select(_folder(1).alias("folder")).where(~F.col("folder").startswith("__")).distinct()
    return found.select(council_of(F.col("folder")).alias("council_id"), "folder")


def metadata_documents(spark: SparkSession, root: str) -> DataFrame:
    """council_id, organisation, service and last update of each metadata document; what is missing is null."""
    rows = spark.read.schema(schemas.METADATA).option("multiLine", True).json(f"{root}/*/metadata.json")
    rows = rows.withColumn("council_id", council_of(_folder(1)))
    own = F.col("everyelectiion_data")
    return rows.select(
        "council_id",
        own.alias("organisation"),
        F.col("services.councillors").alias("service"),
        F.col("everyelectiion_data_last_updated").alias("last_updated"),
        F.coalesce(own["start_date"], F.col("start_date")).alias("start_date"),
        F.coalesce(own["end_date"], F.col("end_date")).alias("end_date"),
    )


def extractor_sources(spark: SparkSession, root: str, name: str = "councillors.py") -> DataFrame:
    """(council_id, content) of each extractor's source text."""
    rows = spark.read.text(f"{root}/*/{name}", wholetext=True)
    return rows.select(council_of(_folder(1)).alias("council_id"), F.col("value").alias("content"))


def source_facts(sources: DataFrame) -> DataFrame:
    """What a source text says of its class: parent, tags, disabled and public methods."""
    c = F.col("content")
    tags = F.regexp_extract(c, r"(?m)^\s+tags\s*=\s*\[([^\]]*)\]", 1)
    return sources.select(
        "council_id",
        "content",
        F.nullif(F.regexp_extract(c, r"class Scraper\((\w+)\):", 1), F.lit("")).alias("parent_class"),
        F.regexp_extract_all(tags, F.lit(r"""["']([^"']+)["']"""), F.lit(1)).alias("tags"),
        c.rlike(r"(?m)^\s+disabled\s*=\s*True").alias("disabled"),
        F.regexp_extract_all(c, F.lit(r"def (\w+)\(self"), F.lit(1)).alias("methods"),
    )


def person_documents(spark: SparkSession, root: str) -> DataFrame:
    """council_id and the stored fields of each office-holder, one level of folders below the root."""
    rows = spark.read.schema(schemas.PERSON_DOCUMENT).option("multiLine", True).json(f"{root}/*/json/*.json")
    return rows.withColumn("council_id", council_of(_folder(2)))


def from_stored(documents: DataFrame) -> DataFrame:
    """Stored documents as records: no prefixes, empty optional fields as null, no standing-down date."""
    return documents.select(
        "council_id",
        "url",
        *[F.col(f"raw_{n}").alias(n) for n in ("identifier", "name", "party", "division")],
        *[F.nullif(n, F.lit("")).alias(n) for n in ("email", "photo_url")],
    )


def queue_tasks(messages: DataFrame, body: str = "value") -> DataFrame:
    """(scraper_type, council) of each record of queue messages given as JSON text."""
    records = messages.select(F.explode(F.from_json(body, schemas.QUEUE_MESSAGE)["Records"]).alias("record"))
    return records.select(F.from_json("record.body", schemas.TASK).alias("task")).select("task.*")


def unwrapped_results(results: DataFrame) -> DataFrame:
    """Run results with a payload's fields in place of its wrapper's; rows without any are dropped."""
    names = [f.name for f in schemas.RUN_RESULT.fields if f.name != "Payload"]
    whole = F.coalesce("Payload", F.struct(*names))
    rows = results.select(whole.alias("r")).where(~F.forall(F.array(*[F.col(f"r.{n}").cast("string") for n in names]), lambda x: x.isNull()))
    return rows.select("r.*")


def staged_over_base(staged: DataFrame, base: DataFrame, key: str = "path") -> DataFrame:
    """Read-through: staged content where there is any, else what is stored."""
    both = staged.withColumnRenamed("content", "new").join(base.withColumnRenamed("content", "old"), key, "full")
    return both.select(key, F.coalesce("new", "old").alias("content"))


def with_metadata(folders: DataFrame, documents: DataFrame) -> DataFrame:
    """Every council of the registry with its metadata; one without a document has an empty record."""
    return folders.select("council_id").distinct().join(documents, "council_id", "left")


def failing_runs(spark: SparkSession, path: str) -> DataFrame:
    """(council_id, log_text) of a JSON listing of councils whose latest run failed."""
    rows = spark.read.schema(schemas.FAILING).option("multiLine", True).json(path)
    return rows.select("council_id", F.col("latest_run.log_text").alias("log_text"))


def tree_size(spark: SparkSession, root: str) -> DataFrame:
    """(files, bytes) of a directory tree; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def report_of(reports: DataFrame, execution_id: str, key: str = "key") -> DataFrame:
    """The reports whose key has the first eight characters of a run's id."""
    return reports.where(F.contains(key, F.lit(execution_id[:8])))


def outstanding(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose output isn't there yet."""
    return rows.join(done.select(key), key, "left_anti")


def large_enough(rows: DataFrame, size: str = "content_length", least: int = 4000) -> DataFrame:
    """Payloads of so many bytes or more; an unknown size passes."""
    return rows.where(F.coalesce(F.col(size) >= least, F.lit(True)))


def remote_files(listing: DataFrame) -> DataFrame:
    """Files of a repository listing: blobs that aren't hidden, a readme or a license, with inline content decoded."""
    name = F.substring_index("path", "/", -1)
    kept = listing.where((F.col("type") == "blob") & ~name.startswith(".") & ~F.upper(name).rlike("^(README|LICENSE)"))
    return kept.withColumn("content", F.coalesce(F.try_to_binary("encoded", F.lit("base64")), F.encode("raw", "UTF-8")))
