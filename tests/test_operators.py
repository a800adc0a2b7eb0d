import json

import pytest
from pyspark.sql import functions as F

from moothall.operators import axes, checks, merge, nodes, people, registry, runs, selectors
from moothall.plans import extract
from moothall.sources import readers, writers

PAGE = """<html><head><title>Our &amp; members</title></head><body>
<ul class="list main"><li class="p first"><a href="/id/1/x"><b>A</b> <i>B</i></a><p>Ward: <span>East</span><p>Two</li>
<li class="p"><a href="/id/2/y">C</a><img src="a.jpg" title="Labour (logo)"></li></ul>
<table id="t"><tr><td>1<td>2<tr><td>3</table><script>var x = "</p><li>";</script></body></html>"""


@pytest.fixture(scope="module")
def tree(spark):
    return nodes.node_table(spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "k int, html string"), "k", "html").cache()


def texts(rows):
    return [r["text_strip"] for r in rows.orderBy("k", "pre").collect()]


@pytest.mark.parametrize(
    "css, want",
    [
        ("title", ["Our & members"]),
        ("ul.list.main > li.p a", ["AB", "C"]),
        ("li:first-child a", ["AB"]),
        ("li:last-child a", ["C"]),
        ("li:nth-child(2) a", ["C"]),
        ("a[href^='/id/1'], a[href*='/id/']", ["AB", "C"]),
        ("a[href$=y]", ["C"]),
        ("#t tbody > tr > td", ["1", "2", "3"]),
        ("ul > a", []),
        ("p", ["Ward:East", "Two"]),
        ("li li", []),
        ("td + td", ["2"]),
        ("a[href = '/id/1 x'], #t   td:nth-child( 2 )", ["2"]),
    ],
)
def test_select(tree, css, want):
    assert texts(selectors.select(tree, css, "k")) == want


@pytest.mark.parametrize("css", ["td:nth-of-type(2)", "td:not(.q)", "td ~ td", "td[title='x y'", "ul >", "", "a,,b", "a:hover"])
def test_selectors_that_are_not_supported(css):
    with pytest.raises(ValueError):
        selectors.parts(css)


def test_nearest(spark):
    page = "<div><h2>Ward</h2><p>East</p><ul><li>a<b>x</b><li>c</ul><p>West</p></div>"
    tree = nodes.node_table(spark.createDataFrame([(1, page), (2, "<p>other")], "k int, html string"), "k", "html")
    rows = tree.where("tag = 'li'").select("k", "pre", "parent")
    p, label = F.col("tag") == "p", F.col("own_text").rlike("^W")
    for axis, test, name in (("next", p, "next"), ("previous", p, "previous"), ("parent", F.col("tag") == "div", "above"), ("next_sibling", F.col("tag") == "li", "sibling"), ("previous_sibling", F.col("tag") == "li", "before"), ("previous", label, "label")):
        rows = selectors.nearest(rows, tree, axis, test, F.col("own_text") if name != "above" else F.col("tag"), name, "k")
    got = [tuple(r)[3:] for r in rows.orderBy("pre").collect()]
    assert got == [("West", "East", "div", "c", None, "Ward"), ("West", "East", "div", None, "a", "Ward")]


def test_paged_lists(spark):
    page = '<ul><li><a href="p/{a}">A{a}</a><li><a href="p/{b}">A{b}</a></ul><div class="next"><a href="{next}">on</a></div>'
    rows = [("X", "https://x.org/l1", page.format(a=1, b=2, next="l2")), ("X", "https://x.org/l2", page.format(a=3, b=4, next="l3")), ("Y", "https://x.org/l9", "<p>")]
    pages = extract.with_next(spark.createDataFrame(rows, "council_id string, url string, content string"), ".next")
    assert {r["url"][-2:]: r["next_url"] for r in pages.collect()} == {"l1": "https://x.org/l2", "l2": "https://x.org/l3", "l9": None}
    first = spark.createDataFrame([("X", "https://x.org/l1"), ("Y", "https://x.org/l9")], "council_id string, url string")
    got, failures = extract.list_pages(extract.linked_pages(pages, first), "ul", "li", {"name": ("a", F.col("text_strip"))}, paged=True)
    assert [(r["council_id"], r["name"], r["url"]) for r in got.orderBy("pos").collect()] == [("X", f"A{i}", f"https://x.org/p/{i}") for i in (1, 2, 3, 4)]
    assert [tuple(r) for r in failures.collect()] == [("Y", "none")]


def test_select_one_and_intervals(tree):
    assert texts(selectors.select_one(tree, "td", "k")) == ["1"]
    rows = tree.collect()
    for r in rows:
        below = [x for x in rows if r["pre"] < x["pre"] <= r["end"]]
        assert all(x["depth"] > r["depth"] for x in below)
    assert {r["k"] for r in rows} == {1}


def test_container(spark):
    pages = spark.createDataFrame([(1, "<ul><li>a</ul>"), (2, "<ul></ul><ul></ul>"), (3, "<p>x")], "k int, html string")
    got = selectors.one_container(nodes.node_table(pages, "k", "html"), "ul", "k").collect()
    assert {r["k"]: r["status"] for r in got} == {1: "ok", 2: "several", 3: "none"}


def test_ward_listing(spark):
    person = lambda i, end: f"<councillor><councillorid>{i}</councillorid><fullusername> Cllr {i} </fullusername><politicalpartytitle>P</politicalpartytitle><email></email>{end}</councillor>"
    ends = [
        "",
        "<termsofoffice></termsofoffice>",
        "<termsofoffice><termofoffice><enddate>unspecified</enddate></termofoffice></termsofoffice>",
        "<termsofoffice><termofoffice><enddate>01/01/2018</enddate></termofoffice><termofoffice><enddate>02/05/2019</enddate></termofoffice></termsofoffice>",
        "<termsofoffice><termofoffice><enddate>01/05/2023</enddate></termofoffice><termofoffice><enddate>unspecified</enddate></termofoffice></termsofoffice>",
    ]
    xml = "<councillorsbyward><wards><ward><wardtitle>East</wardtitle><councillors>" + "".join(person(i, e) for i, e in enumerate(ends)) + "</councillors></ward></wards></councillorsbyward>"
    rows = extract.ward_listing(spark.createDataFrame([("ABC", "https://x.org/", xml)], "council_id string, base_url string, content string"))
    got = {r["identifier"]: r for r in rows.collect()}
    assert [got[str(i)]["standing_down"] for i in range(5)] == [None, None, None, "2019-05-02T00:00:00", None]
    assert got["1"]["url"] == "https://x.org/mgUserInfo.aspx?UID=1" and got["1"]["email"] is None and got["1"]["division"] == "East"


def test_person_blocks(spark):
    block = '<div class="PE_People_PersonBlock"><a href="https://x.org/id/{i}/z"><div class="NameLink">{n}</div></a><span>Ward:</span><span>East</span><img title="x"><img title="Green (logo)"></div>'
    page = block.format(i=1, n="Ann") + block.format(i=2, n="Vacancy in East")
    details = [("https://x.org/id/1/z", '<p class="Email">a@x.org</p>')]
    rows = extract.person_blocks(
        spark.createDataFrame([("ABC", page)], "council_id string, content string"), spark.createDataFrame(details, "url string, content string")
    ).orderBy("pos").collect()
    assert [(r["identifier"], r["name"], r["party"], r["division"], r["email"], r["skip"]) for r in rows] == [
        ("1", "Ann", "Green", "East", "a@x.org", None),
        ("2", "Vacancy in East", "Green", "East", None, "vacant"),
    ]


def test_list_pages_and_details(spark):
    page = '<ul><li><a href="p/1">A</a><li><a href="p/2">B</a></ul>'
    pages = spark.createDataFrame([("X", "https://x.org/", page), ("Y", "https://y.org/", "<p>")], "council_id string, url string, content string")
    rows, failures = extract.list_pages(pages, "ul", "li", {"name": ("a", F.col("text_strip"))})
    assert [tuple(r) for r in failures.collect()] == [("Y", "none")]
    details = spark.createDataFrame([("https://x.org/p/1", "<h1>Labour</h1>"), ("https://x.org/p/9", "<h1>No</h1>")], "url string, content string")
    got = extract.with_details(rows, details, {"party": ("h1", F.col("text_strip"))}).orderBy("pos").collect()
    assert [(r["name"], r["url"], r["party"]) for r in got] == [("A", "https://x.org/p/1", "Labour"), ("B", "https://x.org/p/2", None)]


def test_linked_pages_stop_at_a_loop(spark):
    pages = spark.createDataFrame([("a", "1", "b"), ("b", "2", "c"), ("c", "3", "a"), ("d", "4", None)], "url string, content string, next_url string")
    first = spark.createDataFrame([("X", "a"), ("Y", "d"), ("Z", "nowhere")], "council_id string, url string")
    got = sorted((r["council_id"], r["n"], r["url"]) for r in extract.linked_pages(pages, first).collect())
    assert got == [("X", 0, "a"), ("X", 1, "b"), ("X", 2, "c"), ("Y", 0, "d")]


def test_linked_pages_of_a_long_chain(spark):
    n = 1500
    pages = spark.range(n).selectExpr("concat('p', id) AS url", "'' AS content", "concat('p', id + 1) AS next_url")
    first = spark.createDataFrame([("X", "p0"), ("Y", "p1490")], "council_id string, url string")
    got = sorted((r["council_id"], r["n"], r["url"]) for r in extract.linked_pages(pages, first).collect())
    assert got == [("X", i, f"p{i}") for i in range(n)] + [("Y", i, f"p{1490 + i}") for i in range(10)]


def test_from_json(spark):
    content = json.dumps({"entries": [{"n": {"first": "Ann"}, "p": ""}, {"n": {"first": "Bo"}, "p": "Green"}]})
    rows = extract.from_json(
        spark.createDataFrame([("X", content)], "council_id string, content string"), "$.entries", "struct<n:struct<first:string>,p:string>", {"name": "item.n.first", "party": "item.p"}, {"party": "Independent"}
    )
    assert [(r["name"], r["party"]) for r in rows.orderBy("pos").collect()] == [("Ann", "Independent"), ("Bo", "Green")]


def test_faces(spark):
    face = {"Gender": {"Value": "F"}, "AgeRange": {"Low": 30, "High": 40}, "Smile": {"Value": True}, "Eyeglasses": {"Value": False}, "Beard": {"Value": False}, "Emotions": [{"Type": "HAPPY", "Confidence": 71.0}]}
    schema = "id int, FaceDetails array<struct<Gender:struct<Value:string>,AgeRange:struct<Low:int,High:int>,Smile:struct<Value:boolean>,Eyeglasses:struct<Value:boolean>,Beard:struct<Value:boolean>,Emotions:array<struct<Type:string,Confidence:double>>>>"
    row = extract.faces(spark.createDataFrame([(1, [face])], schema)).first()
    assert (row["gender"], row["age_low"], row["happy"]) == ("F", 30, True)


def test_gate(spark):
    rows = [("OK", i, str(i % 11), f"N{i}", "P", "D", None) for i in range(12)] + [("FEW", 0, "1", "N", "P", "D", None)]
    rows += [("BAD", i, str(i), "N", "" if i == 3 else "P", "D", None) for i in range(12)] + [("OK", 12, "99", "vacant", None, "D", "vacant")]
    df = spark.createDataFrame(rows, "council_id string, pos int, identifier string, name string, party string, division string, skip string")
    accepted, rejected, councils = people.gate(df)
    assert sorted((r["pos"], r["name"]) for r in accepted.collect()) == [(i, f"N{i}") for i in range(11)]
    assert {r["council_id"]: (r["n_seen"], r["n_kept"], r["status"]) for r in councils.collect()} == {"OK": (12, 11, "ok"), "FEW": (1, 1, "few"), "BAD": (12, 12, "incomplete")}
    reasons = {(r["council_id"], r["pos"]): r["reason"] for r in rejected.collect()}
    assert reasons[("OK", 12)] == "vacant" and reasons[("BAD", 3)] == "lacks party" and reasons[("FEW", 0)] == "council few" and len(reasons) == 14


def test_run_summary(spark):
    rows = [("completed", 429), ("failed", 429), ("failed", 500), ("disabled", 200), (None, None), ("odd", 200)]
    df = spark.createDataFrame(rows, "status string, statusCode int")
    assert tuple(runs.summary(df).first()) == (6, 1, 1, 1, 1, "16.67%")
    assert tuple(runs.summary(df.where("false")).first()) == (0, 0, 0, 0, 0, "0.00%")


def test_checks(spark):
    facts = readers.source_facts(
        spark.createDataFrame(
            [
                ("A", "class Scraper(ModGovCouncillorScraper):\n    pass  # todo"),
                ("B", "class Scraper(HTMLCouncillorScraper):\n    disabled = True\n    tags = ['x', \"y\"]\n    def get(self):\n        pass"),
                ("C", "nothing"),
            ],
            "council_id string, content string",
        )
    )
    services = [("A", ("CMIS", None, "https://x.org", None)), ("B", (None, None, None, None)), ("C", None), ("D", None)]
    councils = spark.createDataFrame(services, "council_id string, service struct<cms_type:string,cms_version:string,base_url:string,notes:string>")
    got = {r["council_id"]: r for r in checks.validated(councils, facts).collect()}
    assert got["A"]["valid"] and len(got["A"]["warnings"]) == 2 and "suggests 'ModernGov'" in got["A"]["warnings"][1]
    assert got["B"]["warnings"] == ["Scraper is disabled"] and len(got["B"]["suggestions"]) == 3 and not got["B"]["errors"]
    assert not got["C"]["valid"] and got["D"]["errors"] == ["No councillors.py file found"]
    assert facts.where("council_id = 'B'").first()["tags"] == ["x", "y"]


def test_loaded(spark):
    facts = readers.source_facts(spark.createDataFrame([("A", "class Scraper(JSONCouncillorScraper):\n    x = 1"), ("B", "class Scraper(Thread):\n    pass"), ("C", "nothing")], "council_id string, content string"))
    codes = spark.createDataFrame([(c,) for c in "ABCD"], "council_id string")
    assert {r[0]: r[1] for r in checks.loaded(codes, facts).collect()} == {"A": "ok", "B": "wrong base", "C": "wrong base", "D": "missing"}


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_neighbours_in_stretches(spark, n):
    rows = [(u, i, i % 5 == u) for u in (0, 1, 9) for i in range(40)] + [(None, 3, False), (None, 4, True), (None, 5, False)]
    df = spark.createDataFrame(rows, "u int, i int, hit boolean").withColumn("v", F.col("i") * 10)
    got = axes.nearest_in_stretches(df, F.col("v"), F.col("hit"), ["u"], ["i"], F.floor(F.col("i") / n), "b", "a")
    want = {(u, i): (max((10 * k for w, k, h in rows if w == u and h and k < i), default=None), min((10 * k for w, k, h in rows if w == u and h and k > i), default=None)) for u, i, _ in rows}
    assert {(r["u"], r["i"]): (r["b"], r["a"]) for r in got.collect()} == want and got.columns == ["u", "i", "hit", "v", "b", "a"]


def test_portraits(spark):
    urls = ["https://a.org/p.jpg", "https://b.org/p.jpg", "http://b.org/LOGO.png", "data:x", "https://c.org/x.svg", None]
    got = extract.photo_links(spark.createDataFrame([(u,) for u in urls], "photo_url string"), insecure=("b.org",))
    assert sorted(r[0] for r in got.collect()) == ["http://b.org/p.jpg", "https://a.org/p.jpg"]


def test_resolved(spark):
    folders = spark.createDataFrame([("ABC-north-town",), ("ABD-north-city",), ("XYZ",), ("NOR-norwich",)], "folder string")
    codes = spark.createDataFrame([("abc",), ("north",), ("XYZ",), ("norwich",), ("QQQ",)], "code string")
    got = {r["code"]: (r["status"], r["folder"]) for r in registry.resolved(codes, folders).collect()}
    assert got == {"abc": ("ok", "ABC-north-town"), "north": ("ambiguous", None), "XYZ": ("ok", "XYZ"), "norwich": ("ok", "NOR-norwich"), "QQQ": ("unknown", None)}


def test_merge(spark):
    schema = "id int, a string, b string, note string, last_updated string"
    old = spark.createDataFrame([(1, "x", None, "kept", "t0"), (2, "y", "z", None, "t0")], schema)
    feed = spark.createDataFrame([(1, "x", "new"), (2, None, "z"), (3, "q", None)], "id int, a string, b string")
    got = {r["id"]: tuple(r) for r in merge.upserted(old, feed, ["id"], ["a", "b"], F.lit("t1")).collect()}
    assert got == {1: (1, "x", "new", "kept", "t1"), 2: (2, "y", "z", None, "t0"), 3: (3, "q", None, None, "t1")}


def test_files_round_trip(spark, tmp_path):
    folder = tmp_path / "ABC-a-town"
    folder.mkdir()
    (folder / "metadata.json").write_text(json.dumps({"everyelectiion_data": {"common_name": "A", "end_date": "2019-01-01"}, "services": {"councillors": {"cms_type": "CMIS"}}}))
    (folder / "councillors.py").write_text("class Scraper(X):\n    pass")
    row = readers.metadata_documents(spark, str(tmp_path)).first()
    assert (row["council_id"], row["end_date"], row["service"]["cms_type"]) == ("ABC", "2019-01-01", "CMIS")
    assert registry.current(readers.metadata_documents(spark, str(tmp_path)), F.lit("2020-01-01").cast("date")).count() == 0
    assert readers.extractor_sources(spark, str(tmp_path)).first()["council_id"] == "ABC"
    assert [tuple(r) for r in readers.registry_folders(spark, str(tmp_path)).collect()] == [("ABC", "ABC-a-town")]
    people_rows = spark.createDataFrame([("ABC", "u", "1", "Siân", "P", "D")], "council_id string, url string, identifier string, name string, party string, division string")
    doc = writers.as_documents(people.checked_schema(people_rows)).first()
    assert doc["file_name"] == "1-sian.json" and list(json.loads(doc["content"])) == list(writers.DOCUMENT)
    out = str(tmp_path / "out")
    writers.replace_partitions(people_rows, out)
    writers.replace_partitions(people_rows.withColumn("council_id", F.lit("DEF")), out)
    assert {r["council_id"] for r in spark.read.parquet(out).collect()} == {"ABC", "DEF"}


def test_queue_and_results(spark):
    body = json.dumps({"Records": [{"messageId": "1", "body": json.dumps({"scraper_type": "councillors", "council": "SFK"})}]})
    assert tuple(readers.queue_tasks(spark.createDataFrame([(body,)], "value string")).first()) == ("councillors", "SFK")
    fields = "council string, scraper_type string, start_time string, statusCode int, status string, error string, runlog_s3_key string, files_committed bigint"
    none = (None,) * 8
    rows = [(*none, ("A", *none[:3], "completed", *none[:3])), (*none, None), ("B", *none[:7], None)]
    df = spark.createDataFrame(rows, f"{fields}, Payload struct<{', '.join(x.replace(' ', ':', 1) for x in fields.split(', '))}>")
    assert sorted(r["council"] for r in readers.unwrapped_results(df).collect()) == ["A", "B"]


def test_small_outputs(spark, tmp_path):
    rows = spark.createDataFrame([("b", 'x "y"', None), ("a", "z, é", "m")], "council_id string, name string, email string")
    writers.write_csv(rows.orderBy("council_id").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text().splitlines()[0] == "council_id,name,email" and len(part.read_text().splitlines()) == 3
    assert spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "out")).count() == 2
    listing = json.loads(writers.json_listing(rows, "councillors", "council_id").first()["value"])
    assert listing["service"] == "councillors" and listing["total_count"] == 2 and [c["council_id"] for c in listing["councils"]] == ["a", "b"]
    assert json.loads(writers.json_listing(rows.where("false"), "councillors", "council_id").first()["value"])["total_count"] == 0
    first = people.by_file_name(spark.createDataFrame([("X", 1, "a"), ("X", 2, "a"), ("Y", 1, "a")], "council_id string, pos int, name string"), F.col("name"), ["pos"])
    assert sorted((r["council_id"], r["pos"]) for r in first.collect()) == [("X", 2), ("Y", 1)]
