"""Sinks. Staged rows are written by one job; partitions that have no rows are left alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.functions import text

DOCUMENT = ("email", "photo_url", "raw_division", "raw_identifier", "raw_name", "raw_party", "standing_down", "url")


def file_name(identifier: Column, name: Column, ext: str) -> Column:
    return F.concat(text.slugify(identifier), F.lit("-"), text.slugify(name), F.lit(f".{ext}"))


def as_documents(people: DataFrame) -> DataFrame:
    """council_id, the file's name and the stored JSON document of each office-holder: raw_ names, keys in order, nulls
    kept."""
    raw = {n: F.col(n[4:]) if n.startswith("raw_") else F.col(n) for n in DOCUMENT}
    body = F.to_json(F.struct(*[c.alias(n) for n, c in raw.items()]), {"ignoreNullFields": "false"})
    return people.select("council_id", file_name(F.col("identifier"), F.col("name"), "json").alias("file_name"), body.alias("content"))


def as_raw(people: DataFrame, content: Column, ext: str = "html") -> DataFrame:
    """council_id, the file's name and the payload that each office-holder came from, as it was captured."""
    return people.select("council_id", file_name(F.col("identifier"), F.col("name"), ext).alias("file_name"), content.alias("content"))


def replace_partitions(rows: DataFrame, path: str, key: str = "council_id", form: str = "parquet") -> None:
    """Replace the partitions that ``rows`` has rows for, and no others."""
    out = rows.write.partitionBy(key).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.format(form).save(path)


def export_rows(people: DataFrame) -> DataFrame:
    """The columns of the CSV export, in its order; nulls are empty."""
    names = ("council_id", "raw_division", "raw_identifier", "email", "url", "raw_name", "raw_party")
    return people.select(*[F.coalesce(n, F.lit("")).alias(n) for n in names])


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def tab_lines(rows: DataFrame, *columns: str) -> DataFrame:
    """Lines of tab-separated values without a header, for a text sink."""
    return rows.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))


def json_listing(rows: DataFrame, service: str, order: str) -> DataFrame:
    """One JSON text: the service, all rows in order, how many there are. For listings that a person reads."""
    entry = F.struct(F.col(order).alias("k"), F.struct(*rows.columns).alias("v"))
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["v"])
    return rows.agg(F.to_json(F.struct(F.lit(service).alias("service"), entries.alias("councils"), F.count("*").alias("total_count"))).alias("value"))
