"""The live page source against a server of its own, and the small readers, writers and checks."""

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from moothall.functions import values
from moothall.operators import checks, nodes, registry, selectors
from moothall.plans import extract
from moothall.sources import readers, web, writers


@pytest.fixture(scope="module")
def server():
    asked = Counter()

    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            n = asked[self.path]
            status = {"/busy": 429 if n < 3 else 200, "/down": 500, "/none": 404}.get(self.path, 200)
            following = {"/p1": "p2", "/p2": "p3", "/p3": "p1"}.get(self.path, "")
            body = f'<a class="next" href="{following}">{self.path}</a>'.encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    it = ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=it.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{it.server_port}", asked
    it.shutdown()


def read(spark, urls, **options):
    spark.dataSource.register(web.PageSource)
    return spark.read.format("pages").options(urls=json.dumps(urls), pause=0.01, **options).load()


def test_pages_are_asked_for_again(spark, server):
    base, asked = server
    rows = {r["url"].rsplit("/", 1)[1]: r for r in read(spark, [f"{base}/{p}" for p in ("busy", "down", "none", "p1")], per_partition=2).collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"busy": 200, "down": 500, "none": 404, "p1": 200}
    assert rows["down"]["content"] is None and "500" in rows["down"]["error"] and rows["busy"]["error"] is None
    assert (asked["/busy"], asked["/down"], asked["/none"]) == (3, 3, 1)


def test_following_pages(spark, server):
    base, _ = server
    link = 'class="next" href="([^"]+)"'
    rows = read(spark, [f"{base}/p1"], next_pattern=link).orderBy("page").collect()
    assert [(r["page"], r["error"], r["content"][-7:-4]) for r in rows] == [(0, None, "/p1"), (1, None, "/p2"), (2, None, "/p3")]
    rows = read(spark, [f"{base}/p1"], next_pattern=link, max_pages=2).orderBy("page").collect()
    assert [(r["page"], r["error"]) for r in rows] == [(0, None), (1, "more pages than 2")]


def test_filters_go_to_the_server(spark, server):
    base, asked = server
    assert read(spark, [f"{base}/q?page=2"], query=json.dumps({"official_identifier": "ABC"})).first()["status"] == 200
    assert asked["/q?page=2&official_identifier=ABC"] == 1


def test_a_server_that_is_not_there(spark):
    row = read(spark, ["http://127.0.0.1:9/x"], retries=2, timeout=2).first()
    assert row["status"] == 0 and row["content"] is None and row["error"]


def test_failing_runs_and_tree_size(spark, tmp_path):
    (tmp_path / "failing.json").write_text(json.dumps([{"council_id": "A", "latest_run": {"log_text": "no"}}, {"council_id": "B"}]))
    got = readers.failing_runs(spark, str(tmp_path / "failing.json"))
    assert sorted(tuple(r) for r in got.collect()) == [("A", "no"), ("B", None)]
    below = tmp_path / "tree" / "a" / "b"
    below.mkdir(parents=True)
    (below / "x").write_bytes(b"123")
    (tmp_path / "tree" / "y").write_bytes(b"4567")
    assert tuple(readers.tree_size(spark, str(tmp_path / "tree")).first()) == (2, 7)


def test_metadata_that_is_not_there(spark):
    folders = spark.createDataFrame([("A", "A-x"), ("B", "B-y")], "council_id string, folder string")
    documents = spark.createDataFrame([("A", "2020")], "council_id string, last_updated string")
    assert sorted(map(tuple, readers.with_metadata(folders, documents).collect())) == [("A", "2020"), ("B", None)]


def test_small_filters(spark):
    rows = spark.createDataFrame([("a", 3999), ("b", 4000), ("c", None)], "key string, content_length long")
    assert sorted(r["key"] for r in readers.large_enough(rows).collect()) == ["b", "c"]
    assert sorted(r["key"] for r in readers.outstanding(rows, rows.where("key = 'b'"), "key").collect()) == ["a", "c"]
    reports = spark.createDataFrame([("run-1-12345678-9.json",), ("run-2-87654321.json",)], "key string")
    assert [r["key"] for r in readers.report_of(reports, "12345678-zzzz").collect()] == ["run-1-12345678-9.json"]
    kinds = [("A", ("local-authority", "A")), ("B", ("parish", "B")), ("C", None), ("D", ("local-authority", "D"))]
    councils = spark.createDataFrame(kinds, "council_id string, organisation struct<organisation_type:string,official_identifier:string>")
    assert sorted(r["council_id"] for r in registry.local_authorities(councils).collect()) == ["A", "D"]
    assert [r["council_id"] for r in registry.local_authorities(councils, "D").collect()] == ["D"]


def test_values(spark):
    rows = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"}), (None, {"x": "y"}), ({"k": "v"}, None)], "base map<string,string>, top map<string,string>")
    assert [r[0] for r in rows.select(values.overlaid(F.col("base"), F.col("top"))).collect()] == [{"a": "1", "b": "3", "c": "4"}, {"x": "y"}, {"k": "v"}]
    row = spark.createDataFrame([("x", None)], "a string, b string")
    assert row.select(values.compact("a", "b")).first()[0] == '{"a":"x"}'
    assert row.select(extract.photo_size(F.lit("p/120x150/1.jpg"))).first()[0] == "p/240x300/1.jpg"
    people = spark.createDataFrame([("X", "1", "Ann Lee", "<li>")], "council_id string, identifier string, name string, raw string")
    assert tuple(writers.as_raw(people, F.col("raw")).first()) == ("X", "1-ann-lee.html", "<li>")


def test_checks_of_classes(spark):
    rows = spark.createDataFrame([("A", "councillors", "person"), ("B", "", None)], "council_id string, service_name string, scraper_object_type string")
    assert {r[0]: r[1] for r in checks.failed(rows).collect()} == {"A": [], "B": ["service_name", "scraper_object_type"]}
    own = {"short": F.length("service_name") < 5, "typed": F.col("scraper_object_type") == "person"}
    assert {r[0]: r[1] for r in checks.failed(rows, own).collect()} == {"A": ["short"], "B": ["typed"]}


PAGE = '<ul class="m"><li><a href="1">A</a><b>x</b><li><a href="2">C</a></ul><p>one<p>two <i>three</i>'


@pytest.mark.parametrize("css", ["a", "ul.m > li a", "li:first-child a, p", "a + b", "p i, i", "li li", "ul > a", "*"])
def test_arrays_and_tables_select_alike(spark, css):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<p><a>")], "k int, html string")
    table = selectors.select(nodes.node_table(pages, "k", "html"), css, "k").select("k", "pre")
    array = pages.select("k", nodes.parsed(F.col("html")).alias("tree")).select("k", F.explode(selectors.matched(F.col("tree"), css)).alias("n")).select("k", "n.pre")
    assert sorted(map(tuple, array.collect())) == sorted(map(tuple, table.collect()))


def test_a_page_is_parsed_once(spark):
    pages = spark.createDataFrame([(1, PAGE)], "k int, html string").select("k", nodes.parsed(F.col("html")).alias("tree"))
    found = pages.select("k", F.explode(selectors.matched(F.col("tree"), "ul li, p")).alias("n"), "tree").where("n.tag = 'li'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    assert found.count() == 2


def test_party_of_a_site(spark):
    page = '<div class="PE_People_PersonBlock"><a href="https://x.org/id/1/z"><div class="NameLink">Ann</div></a><em>Green</em><img title="logo"></div>'
    rows = extract.person_blocks(spark.createDataFrame([("X", page)], "council_id string, content string"), party=("em", F.col("text_strip")))
    assert rows.first()["party"] == "Green"
