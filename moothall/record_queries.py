"""More registered queries: stored records, queues, results, filters and small values, on tables of the same shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moothall.functions import codecs, links, text, values
from moothall.operators import checks, people, registry, runs
from moothall.plans import extract
from moothall.queries import query
from moothall.sources import readers, writers
from moothall.sources.readers import table


def _people(spark: SparkSession, d: str) -> DataFrame:
    """Customers as office-holders of their nation."""
    key = F.col("c_custkey")
    return table(spark, d, "customer").select(
        F.col("c_nationkey").cast("string").alias("council_id"),
        F.concat(F.lit("https://x.org/"), key).alias("url"),
        key.cast("string").alias("identifier"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("party"),
        F.concat(F.lit("Ward "), key % 9).alias("division"),
        F.when(key % 3 == 0, F.concat(F.lit("m"), key, F.lit("@x.org"))).alias("email"),
        F.when(key % 4 == 0, F.concat(F.lit("http://x.org/"), key, F.lit(".jpg"))).alias("photo_url"),
        F.when(key % 5 == 0, F.when(key % 2 == 0, "2019-05-02T00:00:00").otherwise("2021-05-06T00:00:00")).alias("standing_down"),
    )


_PEOPLE_SQL = """SELECT c_nationkey::VARCHAR AS council_id, 'https://x.org/' || c_custkey AS url, c_custkey::VARCHAR AS identifier, c_name AS name, c_mktsegment AS party, 'Ward ' || (c_custkey % 9) AS division,
  CASE WHEN c_custkey % 3 = 0 THEN 'm' || c_custkey || '@x.org' END AS email, CASE WHEN c_custkey % 4 = 0 THEN 'http://x.org/' || c_custkey || '.jpg' END AS photo_url,
  CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '2019-05-02T00:00:00' ELSE '2021-05-06T00:00:00' END END AS standing_down FROM customer"""


@query(
    f"""SELECT council_id, identifier || '-' || regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') || '.json' AS file_name,
    '{{"email":' || coalesce('"' || email || '"', 'null') || ',"photo_url":' || coalesce('"' || photo_url || '"', 'null') || ',"raw_division":"' || division || '","raw_identifier":"' || identifier || '","raw_name":"' || name
    || '","raw_party":"' || party || '","standing_down":' || coalesce('"' || standing_down || '"', 'null') || ',"url":"' || url || '"}}' AS content FROM ({_PEOPLE_SQL})"""
)
def stored_documents(spark: SparkSession, d: str) -> DataFrame:
    """Office-holders as the documents that are stored of them: raw_ names, keys in order, nulls kept."""
    return writers.as_documents(people.checked_schema(_people(spark, d)))


@query(f"SELECT council_id, url, identifier, name, party, division, email, photo_url FROM ({_PEOPLE_SQL})")
def stored_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents read back into records: no prefixes, no standing-down dates."""
    documents = writers.as_documents(people.checked_schema(_people(spark, d)))
    fields = ", ".join(f"{n} string" for n in writers.DOCUMENT)
    return readers.from_stored(documents.select("council_id", F.from_json("content", fields).alias("d")).select("council_id", "d.*"))


@query(f"SELECT council_id, identifier FROM ({_PEOPLE_SQL}) WHERE email IS NOT NULL AND (council_id IN ('3', '7') OR standing_down LIKE '%2019-05%')")
def standing_down_people(spark: SparkSession, d: str) -> DataFrame:
    return people.standing_down(_people(spark, d), ["3", "7"]).select("council_id", "identifier")


@query(f"SELECT council_id, coalesce(division, '') AS raw_division, identifier AS raw_identifier, coalesce(email, '') AS email, url, name AS raw_name, party AS raw_party FROM ({_PEOPLE_SQL})")
def csv_export_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _people(spark, d)
    return writers.export_rows(rows.withColumnsRenamed({n: f"raw_{n}" for n in ("division", "identifier", "name", "party")}))


@query(f"SELECT identifier, replace(photo_url, 'http:', 'https:') AS photo_url FROM ({_PEOPLE_SQL}) WHERE photo_url IS NOT NULL AND identifier NOT LIKE '%8'")
def portrait_links(spark: SparkSession, d: str) -> DataFrame:
    """Photos but for denied words and suffixes, of a host that is asked without encryption, and back again."""
    rows = _people(spark, d).withColumn("photo_url", F.when(F.col("identifier").endswith("8"), F.replace("photo_url", F.lit(".jpg"), F.lit("Logo.jpg"))).otherwise(F.replace("photo_url", F.lit("http:"), F.lit("https:"))))
    kept = extract.photo_links(rows, insecure=("x.org",))
    return kept.select("identifier", F.replace("photo_url", F.lit("http:"), F.lit("https:")).alias("photo_url"))


@query("SELECT event_type AS scraper_type, user_id::VARCHAR AS council FROM events, (SELECT unnest([0, 1]) AS i) WHERE i = 0 OR event_id % 2 = 0")
def queue_messages(spark: SparkSession, d: str) -> DataFrame:
    """Events as queue messages of one or two records each."""
    rows = table(spark, d, "events")
    body = F.to_json(F.struct(F.col("event_type").alias("scraper_type"), F.col("user_id").cast("string").alias("council")))
    record = F.struct(F.col("event_id").cast("string").alias("messageId"), body.alias("body"))
    message = F.to_json(F.struct(F.when(F.col("event_id") % 2 == 0, F.array(record, record)).otherwise(F.array(record)).alias("Records")))
    return readers.queue_tasks(rows.select(message.alias("value")))


@query("SELECT 'C' || user_id AS council, event_type AS scraper_type, CASE WHEN event_id % 4 = 0 THEN 'failed' ELSE 'completed' END AS status FROM events WHERE event_id % 5 > 0")
def unwrapped_run_results(spark: SparkSession, d: str) -> DataFrame:
    """Events as run results, every third of them in a payload's wrapper, every fifth without anything."""
    n, none = F.col("event_id"), F.lit(None).cast("string")
    status = F.when(n % 4 == 0, "failed").otherwise("completed")
    fields = {
        "council": F.concat(F.lit("C"), "user_id"), "scraper_type": F.col("event_type"), "start_time": none, "statusCode": F.lit(None).cast("int"),
        "status": status, "error": none, "runlog_s3_key": none, "files_committed": F.lit(None).cast("long"),
    }
    inside, gone = n % 3 == 0, n % 5 == 0
    own = [F.when(~inside & ~gone, c).alias(k) for k, c in fields.items()]
    wrapped = F.when(inside & ~gone, F.struct(*[c.alias(k) for k, c in fields.items()])).alias("Payload")
    return readers.unwrapped_results(table(spark, d, "events").select(*own, wrapped)).select("council", "scraper_type", "status")


def _councils(spark: SparkSession, d: str) -> DataFrame:
    """Customers as councils with metadata that lacks this and that."""
    key, none = F.col("c_custkey"), F.lit(None).cast("string")
    organisation = F.struct(
        F.when(key % 3 == 0, "parish").otherwise("local-authority").alias("organisation_type"), F.when(key % 4 > 0, F.concat(F.lit("E"), key)).alias("official_identifier"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.col("c_name")).alias("common_name"), F.when(key % 10 > 0, F.upper("c_name")).alias("official_name"),
    )
    service = F.when(key % 6 > 0, F.struct(F.when(key % 2 == 0, "CMIS").alias("cms_type"), none.alias("cms_version"), F.when(key % 7 == 0, "https://x.org").alias("base_url"), none.alias("notes")))
    return table(spark, d, "customer").select(key.cast("string").alias("council_id"), organisation.alias("organisation"), service.alias("service"), (key % 8 == 0).alias("disabled"))


@query(
    """SELECT CASE WHEN c_custkey % 4 > 0 THEN 'E' || c_custkey ELSE c_custkey::VARCHAR END AS council_id, CASE WHEN c_custkey % 5 > 0 THEN c_name WHEN c_custkey % 10 > 0 THEN upper(c_name) ELSE 'Unknown' END AS name,
    CASE WHEN c_custkey % 2 = 0 THEN 'CMIS' END AS cms_type, NULL::VARCHAR AS cms_version, CASE WHEN c_custkey % 7 = 0 THEN 'https://x.org' END AS base_url
    FROM customer WHERE c_custkey % 6 > 0 AND (c_custkey % 2 = 0 OR c_custkey % 7 = 0)"""
)
def council_systems(spark: SparkSession, d: str) -> DataFrame:
    """Councils that have a service, their names and their systems."""
    return registry.systems(_councils(spark, d))


@query("SELECT c_custkey::VARCHAR AS council_id, c_custkey % 8 = 0 AS off, c_custkey % 3 > 0 AS local FROM customer WHERE c_custkey % 8 = 0 OR c_custkey % 3 > 0")
def council_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Councils whose extractor is switched off, and those that are local authorities."""
    rows = _councils(spark, d)
    off = registry.disabled(rows).select("council_id", F.lit(True).alias("off"))
    local = registry.local_authorities(rows).select("council_id", F.lit(True).alias("local"))
    return off.join(local, "council_id", "full").select("council_id", F.coalesce("off", F.lit(False)).alias("off"), F.coalesce("local", F.lit(False)).alias("local"))


@query("SELECT 'councillors' AS scraper_type, c_custkey::VARCHAR AS council FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 8 > 0")
def council_tasks(spark: SparkSession, d: str) -> DataFrame:
    """What workers are told: local authorities less those that are switched off."""
    rows = _councils(spark, d)
    return registry.tasks(registry.missing(registry.local_authorities(rows), registry.disabled(rows)))


@query(
    """SELECT c_custkey::VARCHAR AS council_id, array_to_string(list_filter([CASE WHEN c_custkey % 3 = 0 THEN 'service_name' END, CASE WHEN c_custkey % 5 = 0 THEN 'scraper_object_type' END], lambda x: x IS NOT NULL), ',') AS failed,
    CASE WHEN c_custkey % 11 = 0 THEN 'missing' WHEN c_custkey % 4 = 3 THEN 'wrong base' ELSE 'ok' END AS status FROM customer"""
)
def class_contracts(spark: SparkSession, d: str) -> DataFrame:
    """What extractors' classes must state, and what they may be derived from."""
    key = F.col("c_custkey")
    rows = table(spark, d, "customer").select(key.cast("string").alias("council_id"), F.when(key % 3 > 0, "councillors").alias("service_name"), F.when(key % 5 > 0, "person").otherwise("").alias("scraper_object_type"), key.alias("n"))
    base = F.element_at(F.array(*[F.lit(b) for b in (*checks.BASES[:3], "Thread")]), (F.col("n") % 4 + 1).cast("int"))
    facts = readers.source_facts(rows.where("n % 11 <> 0").select("council_id", F.concat(F.lit("class Scraper("), base, F.lit("):\n    pass")).alias("content")))
    both = checks.failed(rows.select("council_id", *checks.CONTRACT)).join(checks.loaded(rows.select("council_id"), facts), "council_id")
    return both.select("council_id", F.array_join("failed", ",").alias("failed"), "status")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS a, o_orderstatus AS b, '{' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '"a":"' || o_orderpriority || '",' END || '"b":"' || o_orderstatus || '"}' AS compact,
    CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'more' END AS l FROM orders"""
)
def overlaid_values(spark: SparkSession, d: str) -> DataFrame:
    """Records without their nulls, and maps over maps."""
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select("o_orderkey", F.when(key % 4 > 0, F.col("o_orderpriority")).alias("a"), F.col("o_orderstatus").alias("b"))
    top = F.when(key % 3 == 0, F.create_map(F.lit("k"), F.lit("new"), F.lit("l"), F.lit("more")))
    both = values.overlaid(F.create_map(F.lit("k"), F.col("b")), top)
    return rows.select("o_orderkey", "a", "b", values.compact("a", "b").alias("compact"), both["k"].alias("k"), F.try_element_at(both, F.lit("l")).alias("l"))


@query("SELECT doc_id, substr(text, 1, list_max(list_filter(range(0, 100), lambda n: strlen(substr(text, 1, n)) <= 99))) AS cut FROM documents")
def cut_messages(spark: SparkSession, d: str) -> DataFrame:
    """Texts of at most 99 bytes, without half a character at the end."""
    return table(spark, d, "documents").select("doc_id", codecs.cut_bytes(F.col("text"), 99).alias("cut"))


@query(
    """SELECT event_id, n FROM (SELECT event_id, CASE WHEN event_id % 6 > 0 THEN value * 100 END AS n, 'run-' || printf('%08d', user_id) || '.json' AS key FROM events)
    WHERE coalesce(n >= 4000, true) AND event_id % 7 > 0 AND contains(key, '00000008')"""
)
def small_filters(spark: SparkSession, d: str) -> DataFrame:
    """Payloads that are large enough, whose output isn't there yet, of one run's reports."""
    n = F.col("event_id")
    rows = table(spark, d, "events").select("event_id", F.when(n % 6 > 0, F.col("value") * 100).alias("n"), F.concat(F.lit("run-"), F.lpad(F.col("user_id").cast("string"), 8, "0"), F.lit(".json")).alias("key"))
    kept = readers.outstanding(readers.large_enough(rows, "n"), rows.where(n % 7 == 0), "event_id")
    return readers.report_of(kept, "00000008-rest").select("event_id", "n")


@query(
    """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https:' || u WHEN page_id % 3 = 2 THEN u END AS link, CASE WHEN page_id % 2 = 0 THEN '/a.jpg' END AS style, 'see ' || page_id || ' of x at X' AS said,
    CASE WHEN page_id % 5 > 1 THEN p END AS path, CASE WHEN contains(url, '?page') THEN 'paged' WHEN contains(url, '#') THEN 'part' ELSE 'plain' END AS kind, page_id % 2 = 0 OR page_id % 4 = 1 AS same
    FROM (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN '//x.org/' || page_id WHEN 1 THEN 'data:x' ELSE 'http://x.org/' || page_id END AS u,
      CASE page_id % 5 WHEN 0 THEN '/etc/x' WHEN 1 THEN 'a/../b' WHEN 2 THEN 'a..b/c' ELSE 'a/b' END AS p FROM pages)"""
)
def link_forms(spark: SparkSession, d: str) -> DataFrame:
    """Schemes, styles, templates, paths and labels."""
    n, u = F.col("page_id"), F.col("page_id").cast("string")
    raw = F.when(n % 3 == 0, F.concat(F.lit("//x.org/"), u)).when(n % 3 == 1, "data:x").otherwise(F.concat(F.lit("http://x.org/"), u))
    style = F.when(n % 2 == 0, "background: url('/a.jpg?w=1')").otherwise("color: red")
    path = F.when(n % 5 == 0, "/etc/x").when(n % 5 == 1, "a/../b").when(n % 5 == 2, "a..b/c").otherwise("a/b")
    said = text.filled(F.lit("see $name of $n at $nn"), {"n": F.lit("x"), "name": u, "nn": F.lit("X")})
    same = values.same_system(F.when(n % 2 == 0, "CMIS").otherwise("Other"), F.when(n % 4 == 1, F.lit(None)).otherwise("cmis"))
    kind = text.label_by_keyword(F.col("url"), {"?page": "paged", "#": "part"}, "plain")
    return table(spark, d, "pages").select("page_id", links.with_scheme(raw).alias("link"), links.style_url(style).alias("style"), said.alias("said"), text.path_checked(path).alias("path"), kind.alias("kind"), same.alias("same"))


@query("SELECT event_id, floor(value * 10)::DOUBLE AS duration_seconds, substr(string_split(said, chr(10))[1], 1, 150) AS headline FROM (SELECT event_id, value, repeat(event_type || ' ', 40) || chr(10) || 'more' AS said FROM events)")
def run_durations(spark: SparkSession, d: str) -> DataFrame:
    """Events as runs: how long they took, and the headline of what they said."""
    rows = table(spark, d, "events").withColumn("start", F.col("ts").cast("timestamp"))
    whole = F.floor(F.col("value") * 10)
    rows = rows.withColumn("end", F.timestamp_micros(F.unix_micros("start") + whole * 1_000_000))
    said: Column = F.concat(F.repeat(F.concat("event_type", F.lit(" ")), 40), F.lit("\nmore"))
    done = runs.finished(rows.select("event_id", "start", "end", said.alias("said")))
    return done.select("event_id", F.round("duration_seconds", 3).alias("duration_seconds"), text.first_line(F.col("said")).alias("headline"))


@query("SELECT 'd' || doc_id || '/f.json' AS path, CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END AS content FROM documents WHERE doc_id % 5 = 0")
def remote_listing(spark: SparkSession, d: str) -> DataFrame:
    """Documents as a repository's listing: folders, hidden files, readmes and licenses left out, contents decoded."""
    n = F.col("doc_id")
    name = F.when(n % 5 == 1, ".hidden").when(n % 5 == 2, "Readme.md").when(n % 5 == 3, "LICENSE").otherwise("f.json")
    kind = F.when(n % 5 == 4, "tree").otherwise("blob")
    listing = table(spark, d, "documents").select(
        F.concat(F.lit("d"), n, F.lit("/"), name).alias("path"), kind.alias("type"), F.when(n % 2 == 0, F.base64(F.encode("lang", "UTF-8"))).alias("encoded"), F.col("source").alias("raw")
    )
    return readers.remote_files(listing).select("path", F.decode("content", "UTF-8").alias("content"))
