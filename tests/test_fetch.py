"""Fetching over tables of links, JSON details, filters that reach the server."""

import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from moothall.plans import extract
from moothall.sources import fetch, web

PEOPLE = {"1": ("Ann", "Green", "a@x.org"), "2": ("Bo", "Labour", None), "3": ("Cy", "Con", "c@x.org")}
ORGANISATIONS = [{"official_identifier": f"C{i}", "organisation_type": "local-authority" if i % 2 else "parish", "n": i, "more": {"k": i}} for i in range(7)]


@pytest.fixture(scope="module")
def server():
    asked, times = Counter(), []

    class Api(BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            times.append(time.monotonic())
            url = urlsplit(self.path)
            query = {k: v[0] for k, v in parse_qs(url.query).items()}
            answer = {"path": self.path}
            status = 404 if url.path == "/none" else 200
            if url.path == "/GetAll":
                answer = {"people": [{"memberRef": k} for k in (*PEOPLE, "9")]}
            elif url.path == "/Get":
                name, party, mail = PEOPLE.get(query["ref"], ("", "", None))
                status = 200 if name else 500
                answer = {"fullName": name, "affiliation": party} | ({"emailAddress": mail} if mail else {})
            elif url.path == "/organisations":
                found = [o for o in ORGANISATIONS if all(str(o[k]) == v for k, v in query.items() if k != "page")]
                page = int(query.get("page", 0))
                rest = "&".join(f"{k}={v}" for k, v in query.items() if k != "page")
                answer = {"results": found[page * 3 : page * 3 + 3], "next": f"/organisations?{rest}&page={page + 1}" if len(found) > page * 3 + 3 else None}
            body = json.dumps(answer).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    it = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=it.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{it.server_port}", asked, times
    it.shutdown()


def test_each_address_is_asked_for_once(spark, server):
    base, asked, _ = server
    rows = spark.createDataFrame([(i, f"{base}/p{i % 5}") for i in range(50)] + [(50, None), (51, f"{base}/none"), (52, "http://127.0.0.1:9/x")], "k int, link string").withColumn("status", F.lit("clash"))
    got = fetch.with_fetched(rows, "link", retries=2)
    assert got.count() == 53 and got.where("status = 200").count() == 50
    assert {r["k"]: r["status"] for r in got.where("k >= 50").collect()} == {50: None, 51: 404, 52: 0}
    assert [asked[f"/p{i}"] for i in range(5)] == [1] * 5 and got.where("k = 3").first()["content"] == '{"path": "/p3"}'


@pytest.mark.parametrize("lanes", [1, 3])
def test_one_pace_for_a_host(spark, server, lanes):
    base, _, times = server
    times.clear()
    rows = spark.createDataFrame([(f"{base}/pace{lanes}-{i}",) for i in range(12)], "url string").repartition(6)
    assert fetch.fetched(rows, pace=0.1, lanes=lanes, tasks=4).count() == 12
    # twelve requests at a tenth of a second each; lanes may begin together, and may not be of one length
    assert max(times) - min(times) >= (0.8 if lanes == 1 else 0.3)


def test_lists_whose_details_are_asked_for(spark, server):
    base, asked, _ = server
    councils = spark.createDataFrame([("X", base), ("Y", base), ("Z", f"{base}/none?")], "council_id string, base_url string")
    detail = F.concat("base_url", F.lit("/Get?ref="), "entry.memberRef")
    item, fields = "fullName string, affiliation string, emailAddress string", {"name": "item.fullName", "party": "item.affiliation", "email": "item.emailAddress"}
    got = extract.from_json_with_details(councils, "/GetAll", "$.people", "struct<memberRef:string>", detail, item, fields, retries=1)
    rows = sorted((r["council_id"], r["pos"], r["name"], r["party"], r["email"]) for r in got.where("name IS NOT NULL").collect())
    assert rows == [(c, i, *PEOPLE[str(i + 1)]) for c in "XY" for i in range(3)]
    assert got.where("name IS NULL").count() == 2
    assert asked["/GetAll"] == 1 and [asked[f"/Get?ref={i}"] for i in (1, 2, 3, 9)] == [1] * 4


def test_filters_reach_the_server(spark, server):
    base, asked, _ = server
    spark.dataSource.register(web.RestSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = lambda cols: spark.read.format("rest").schema(cols).options(url=f"{base}/organisations", filters='["official_identifier"]').load()
    rows = source("official_identifier string, n int, more string")
    assert sorted(r["n"] for r in rows.collect()) == list(range(7)) and rows.where("n = 2").first()["more"] == '{"k": 2}'
    one = source("official_identifier string, organisation_type string").where("official_identifier = 'C3' AND organisation_type = 'local-authority'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    before = asked["/organisations?official_identifier=C3"]
    assert [tuple(r) for r in one.collect()] == [("C3", "local-authority")]
    assert asked["/organisations?official_identifier=C3"] == before + 1
    # Spark tests what the server wasn't asked to, and only that
    assert "organisation_type" in plan.split("Filter")[1].split("\n")[0] and "= C3" not in plan.split("Filter")[1].split("\n")[0]


def test_pages_have_their_own_address(spark, server):
    base, _, _ = server
    spark.dataSource.register(web.PageSource)
    rows = spark.read.format("pages").options(urls=json.dumps([f"{base}/organisations"]), next_pattern='"next": "([^"]+)"').load().orderBy("page").collect()
    assert [r["start"] for r in rows] == [f"{base}/organisations"] * 3
    assert [r["url"].split("page=")[-1] for r in rows] == [f"{base}/organisations", "1", "2"]


def test_a_proxy_is_asked(spark, server):
    base, asked, _ = server
    rows = spark.createDataFrame([("http://nowhere.invalid/p",)], "url string")
    assert fetch.fetched(rows, proxy=base).first()["status"] == 200 and asked["http://nowhere.invalid/p"] == 1
