"""Trees of pages, selectors in one pass, extractors as data."""

import random
import time

import pytest
from pyspark.sql import functions as F

from moothall.operators import matching, nodes, selectors, tree
from moothall.plans import extract, sites


def outline(html):
    """A page's body (or all of it, if there is anything in the head) as nested brackets."""
    p = tree.Page(html)

    def said(i):
        if p.tag[i] == "#text":
            return repr(p.text[i])
        if p.tag[i][0] == "#":
            return p.tag[i]
        return f"{p.tag[i]}({' '.join(map(said, p.kids(i)))})"

    return " ".join(said(i) for i in range(len(p.tag)) if p.depth[i] == 0)


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("x", "html(head() body('x'))"),
        ("<title>T</title><p>x", "html(head(title('T')) body(p('x')))"),
        ("<!DOCTYPE html><!--c--><body class=a>x</body></html>y", "#doctype #comment html(head() body('xy'))"),
        ("<p>a<div>b</div>c", "html(head() body(p('a') div('b') 'c'))"),
        ("<p>a<p>b", "html(head() body(p('a') p('b')))"),
        ("</p>a", "html(head() body(p() 'a'))"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "html(head() body(ul(li('a') li('b' ul(li('c'))) li('d'))))"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "html(head() body(dl(dt('a') dd('b') dt('c'))))"),
        ("<h1>a<h2>b</h2>", "html(head() body(h1('a') h2('b')))"),
        ("<table><tr><td>1<td>2<tr><th>3</table>", "html(head() body(table(tbody(tr(td('1') td('2')) tr(th('3'))))))"),
        ("<table><td>1", "html(head() body(table(tbody(tr(td('1'))))))"),
        ("<table><div>a</div><tr>b<td>x</table>", "html(head() body(div('a') 'b' table(tbody(tr(td('x'))))))"),
        ("<table><caption>c<tr><td>x</table>y", "html(head() body(table(caption('c') tbody(tr(td('x')))) 'y'))"),
        ("<table><col><tr><td><table><td>in</table>out</table>", "html(head() body(table(colgroup(col()) tbody(tr(td(table(tbody(tr(td('in')))) 'out'))))))"),
        ("<table><thead><tr><th>a<tbody><tr><td>b</table>", "html(head() body(table(thead(tr(th('a'))) tbody(tr(td('b'))))))"),
        ("<div><td>x</div>", "html(head() body(div('x')))"),
        ("<b>1<p>2</b>3</p>", "html(head() body(b('1') p(b('2') '3')))"),
        ("<p>1<b>2<i>3</b>4</i>5</p>", "html(head() body(p('1' b('2' i('3')) i('4') '5')))"),
        ("<a>1<div>2<a>3</div>", "html(head() body(a('1') div(a('2') a('3'))))"),
        ("<p><b>1<p>2", "html(head() body(p(b('1')) p(b('2'))))"),
        ("<b><b><b><b>x</b></b></b></b>y<p>z", "html(head() body(b(b(b(b('x')))) 'y' p('z')))"),
        ("<font><p>a</font>b", "html(head() body(font() p(font('a') 'b')))"),
        ("<table><tr><td><b>x</td></tr></table>y", "html(head() body(table(tbody(tr(td(b('x'))))) 'y'))"),
        ("<select><option>a<option>b</select>c", "html(head() body(select(option('a') option('b')) 'c'))"),
        ("<script>a<b</script><style>p{}</style>x", "html(head(script('a<b') style('p{}')) body('x'))"),
        ("<br></br><img><hr>x", "html(head() body(br() br() img() hr() 'x'))"),
        ("<button>a<button>b", "html(head() body(button('a') button('b')))"),
        ("<div><span>a</div>b</span>", "html(head() body(div(span('a')) 'b'))"),
        ("a<!-- x -->b", "html(head() body('a' #comment 'b'))"),
        ("<textarea><p></textarea>", "html(head() body(textarea('<p>')))"),
    ],
)
def test_trees(html, want):
    assert outline(html) == want


def test_any_tokens_make_a_sound_tree():
    tags = "a b i p div li ul table tr td th tbody h1 h2 span select option button form caption br script title head body html dd dt nobr object col".split()
    for seed in range(600):
        r = random.Random(seed)
        html = "".join(r.choice([f"<{t}>", f"</{t}>", f"<{t} id=x class='k l'>", "x", " ", "&amp;", "<!-- c -->", "<", ">"]) for t in (r.choice(tags) for _ in range(r.randrange(1, 50))))
        p = tree.Page(html)
        for i in range(len(p.tag)):
            assert p.up[i] < i <= p.last[i] and (p.up[i] < 0 or p.last[i] <= p.last[p.up[i]])
            assert 0 <= p.start[i] <= p.stop[i] <= len(html)
        assert [p.tag[k] for k in range(len(p.tag)) if p.up[k] == p.tag.index("html")][:2] != ["body", "head"]


def naive(page, css):
    out = []
    before = lambda i: max((k for k in page.elements if page.up[k] == page.up[i] and k < i), default=None)

    def ups(i):
        while (i := page.up[i]) >= 0:
            yield i

    def holds(i, path):
        (sign, tests), rest = path[-1], path[:-1]
        family = [k for k in page.elements if page.up[k] == page.up[i]]
        if not all(page.tag[i] == t[3] if t[0] == "tag" else matching._holds(page, i, t, family.index(i) + 1, len(family)) for t in tests):
            return False
        if not rest:
            return True
        near = [before(i)] if sign == "+" else [page.up[i]] if sign == ">" else ups(i)
        return any(k is not None and k >= 0 and holds(k, rest) for k in near)

    for i in page.elements:
        if any(holds(i, path) for path in selectors.steps(css)):
            out.append(i)
    return out


CSS = ["div", "div div", "div > p", "p + p, #x", ".k.l b", "div > .k > *", "ul li:first-child", "li:last-child, li:nth-child(2)", "[id]", "div [id^='x'] + *", "body > div", "html body *", "table td", "p b, p i, b b"]


def test_one_pass_matches_what_each_node_says():
    for seed in range(60):
        r = random.Random(seed)
        html = "".join(r.choice(["<div class=k>", "<p id=xy class='l k'>", "<b>", "</b>", "</div>", "<ul><li>a<li id=x>b</ul>", "<i class='k l'>", "</p>", "x", "<table><td>c</table>"]) for _ in range(40))
        page = tree.Page(html)
        found = matching.Program({c: selectors.steps(c) for c in CSS}).run(page)
        for c in CSS:
            assert found[c] == naive(page, c), (html, c)


def test_time_is_in_proportion_to_nodes():
    def seconds(n):
        page = tree.Page("<div class=box>" + "<ul><li class=a><a href=x>b</a><li>c</ul>" * n + "</div>")
        program = matching.Program({"a": selectors.steps("div.box > ul li.a a"), "b": selectors.steps("ul + ul li")})
        start = time.perf_counter()
        found = program.run(page)
        rows = [matching.first(page, found["a"], i) for i in found["b"]]
        assert len(found["a"]) == n and len(rows) == 2 * n - 2
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 20 * max(seconds(2000), 0.005)


def test_body_of_a_fragment(spark):
    pages = spark.createDataFrame([(1, "<div>a</div><p>b"), (2, None), (3, "")], "k int, html string")
    got = {r["k"]: [n["text_strip"] for n in r["x"]] for r in pages.select("k", nodes.found(F.col("html"), x="body > div")["x"].alias("x")).collect()}
    assert got == {1: ["a"], 2: [], 3: []}


def test_texts_and_sources(spark):
    html = "<div>é <b>x &amp; y</b><!-- c --> z<script>no</script></div><p>q<p>r"
    df = spark.createDataFrame([(html,)], "html string").select("html", nodes.all_nodes(F.col("html")).alias("n"))
    div = F.filter("n", lambda x: x["tag"] == "div")[0]
    row = df.select(
        nodes.source_of(F.col("html"), div).alias("outer"), nodes.byte_range(F.col("html"), div).alias("bytes"), nodes.text_of(F.col("n"), div, "|", strip=False).alias("raw"),
        F.transform(nodes.contents(F.col("n"), div), lambda x: F.coalesce(x["text"], x["tag"])).alias("contents"),
        F.transform(F.filter("n", lambda x: x["tag"] == "p"), lambda x: nodes.source_of(F.col("html"), x)).alias("open"),
    ).first()
    assert row["outer"] == html[: html.index("<p>")] and tuple(row["bytes"]) == (0, len(html[: html.index("<p>")].encode()))
    assert row["raw"] == "é |x & y| z" and row["contents"] == ["é ", "b", " c ", " z", "script"] and row["open"] == ["<p>q", "<p>r"]
    page = tree.Page(html)
    i = page.tag.index("div")
    assert page.joined_text(i, "|") == "é|x & y|z" and page.joined_text(i, "", strip=False) == "é x & y z"
    assert page.string(page.tag.index("b")) == "x & y" and page.string(i) is None
    assert tree.Page('<div a="1&quot;"><br>x<pre> y\n<b>z</b></pre><p></p></div>').pretty(3) == '<div a="1&quot;">\n <br/>\n x\n <pre> y\n<b>z</b></pre>\n <p>\n </p>\n</div>\n'


# extractors as data


RULES = {
    "A": {"container": [("select", "ul")], "row": [("select", "li")], "link": [("select", "a"), ("attr", "href")], "name": [("select", "a"), ("text",)], "next": [("select", ".next a")]},
    "B": {
        "container": [("select", "table"), ("select", "tbody")],
        "row": [("select", "td.who"), ("parent", "tr")],
        "link": [("select", "a"), ("attr", "href"), ("replace", " ", "%20")],
        "name": [("select", "td"), ("find", "b", "^Cllr"), ("text",), ("replace", "Cllr ", "")],
        "ward": [("find_text", "Ward:"), ("next_node",), ("text",)],
        "party": [("last", "img"), ("attr", "title"), ("match", r"^(\w+) \(logo\)"), ("default", "none")],
        "skip:vacant": [("find_text", "(?i)vacan")],
        "skip:head": [("select", "th")],
    },
    "C": {"row": [("select", "dt")], "name": [("string",)], "party": [("next_sibling", "dd"), ("text", "/")], "ward": [("previous", "h2"), ("text",)]},
    "bad": {"container": [("select", "ul")], "row": [("select", "li")], "name": [("select", "a"), ("text",), ("match", "(x"), ("strip",)]},
}
A = '<ul><li><a href="p/1">Ann</a><li><a href="p/2">Bo</a></ul><div class=next><a href="l2">on</a></div>'
B = """<table><tr><th>x<tr><td class=who><b>Cllr Cy</b><a href="q 1">_</a><td><strong>Ward:</strong>East<img title="x"><img title="Green (logo)">
<tr><td class=who><b>Vacancy</b></table>"""
C = "<h2>North</h2><dl><dt>Di<dd>Lab<br>our<dt>Ed<dd>Con</dl><h2>South</h2><dl><dt>Flo</dl>"


def test_sites_with_rules_of_their_own(spark):
    rules = sites.rule_table(spark, RULES)
    assert rules.where("css IS NOT NULL").count() > 10
    rows = [("A", "https://a.org/l1", A), ("B", "https://b.org/x/", B), ("C", "https://c.org", C), ("A", "https://a.org/l2", "<p>none"), ("A", "https://a.org/l3", "<ul></ul><ul></ul>"), ("bad", "https://d.org", A), ("none", "https://e.org", A), ("C", "https://c.org/2", None)]
    pages = spark.createDataFrame(rows, "site string, url string, content string")
    got, failures = sites.list_rows(pages, rules, ["name", "ward", "party"])
    assert sorted((r["url"], r["status"].split(":")[0]) for r in failures.collect()) == [("https://a.org/l2", "none"), ("https://a.org/l3", "several"), ("https://d.org", "error"), ("https://e.org", "no rules")]
    plan = got._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("ArrowEvalPython [") == 1
    assert [tuple(r) for r in got.orderBy("site", "pos").drop("pos").collect()] == [
        ("A", "https://a.org/p/1", "Ann", None, None, None),
        ("A", "https://a.org/p/2", "Bo", None, None, None),
        ("B", "https://b.org/x/q%201", "Cy", "East", "Green", None),
        ("B", None, None, None, "none", "vacant"),
        ("C", None, "Di", "North", "Lab/our", None),
        ("C", None, "Ed", "North", "Con", None),
        ("C", None, "Flo", "South", None, None),
    ]
    assert sites.listings(pages, rules).where("url = 'https://a.org/l1'").first()["next_url"] == "https://a.org/l2"


def test_details_by_each_sites_rules(spark):
    rules = sites.rule_table(spark, {"A": {"mail": [("select", "a[href^=mailto]"), ("attr", "href"), ("replace", "mailto:", "")]}, "B": {"mail": [("find_text", "@"), ("text",), ("lower",)]}})
    rows = spark.createDataFrame([("A", "u1", "a"), ("A", "u1", "again"), ("B", "u1", "b"), ("B", "u2", "c"), ("C", "u1", "d")], "site string, url string, name string")
    details = spark.createDataFrame([("u1", '<a href="mailto:x@y.org">me</a> Or@Else'), ("u9", "z")], "url string, content string")
    got = sorted(tuple(r) for r in sites.with_details(rows, details, rules, ["mail"]).select("name", "mail").collect())
    assert got == [("a", "x@y.org"), ("again", "x@y.org"), ("b", "or@else"), ("c", None), ("d", None)]


def test_attributes_by_pattern():
    html = '<img src="/logo.png" alt="x"><img src="a.jpg" alt="Cllr Ann"><img alt="none">'
    rules = {"portrait": [("having", "img", "alt", "(?i)cllr|councillor"), ("attr", "src")], "other": [("lacking", "img", "src", "logo"), ("attr", "alt")], "no": [("having", "img", "title", ".")]}
    program = sites.programs_of({"X": rules})["X"]
    assert sites.Run(sites.Site(program), html, "").values(-1) == {"portrait": "a.jpg", "other": "Cllr Ann", "no": None}


@pytest.mark.parametrize("chain", [[("fly",)], [("select", "a:hover")]])
def test_rules_that_there_are_not(chain):
    with pytest.raises(ValueError):
        sites.rule_rows("X", {"name": chain})


def test_person_blocks_of_several_pages(spark):
    block = '<div class="PE_People_PersonBlock"><a href="https://x.org/id/{i}/z"><div class="NameLink">{n}</div></a><p><b>Ward:</b> {w}</p><img title="Green (logo)"></div>'
    pages = [("ABC", "https://x.org/1", block.format(i=1, n="Ann", w="East")), ("ABC", "https://x.org/2", block.format(i=2, n="Bob", w="West")), ("DEF", "https://y.org", block.format(i=1, n="Cy", w="Hill"))]
    rows = extract.person_blocks(spark.createDataFrame(pages, "council_id string, url string, content string"), party=[("select", "img"), ("attr", "title"), ("lower",)])
    assert [(r["council_id"], r["name"], r["division"], r["party"]) for r in rows.orderBy("council_id", "pos").collect()] == [("ABC", "Ann", "East", "green (logo)".replace("(logo)", "").strip()), ("ABC", "Bob", "West", "green"), ("DEF", "Cy", "Hill", "green")]
    assert rows.select("council_id", "pos").distinct().count() == 3
