"""Councils that fail alone, names found on pages."""

import pandas as pd

from moothall.operators import isolated, mentions


def test_one_council_fails_and_the_others_are_kept(spark):
    rows = spark.createDataFrame([(f"C{i % 7}", i) for i in range(700)] + [(None, 1)], "council_id string, n int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")

    def work(council, batches):
        total = 0
        for b in batches:
            assert set(b["council_id"]) == {council}
            total += int(b["n"].sum())
            yield pd.DataFrame({"n": b["n"], "twice": b["n"] * 2})
            if council == "C3" and total > 1000:
                raise ValueError("a page is gone")
            if council == "C4":
                return
        yield pd.DataFrame({"n": [total], "twice": [-1]})

    try:
        kept, failures = isolated.isolated(rows, work, "n int, twice int", at_once=3)
        assert kept.columns == ["council_id", "n", "twice"]
        assert [(r["council_id"], r["error"]) for r in failures.collect()] == [("C3", "ValueError: a page is gone")] and "work" in failures.first()["trace"]
        got = {r["council_id"]: r["n"] for r in kept.where("twice = -1").collect()}
        assert got == {f"C{c}": sum(i for i in range(700) if i % 7 == c) for c in (0, 1, 2, 5, 6)}
        assert kept.where("council_id = 'C3'").count() == 0 and 0 < kept.where("council_id = 'C4'").count() < 100
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    none, failed = isolated.isolated(rows.where("false"), work, "n int, twice int")
    assert none.count() == failed.count() == 0


def test_names_on_pages(spark):
    page = "<h2>East Ward</h2><ul><li>Cllr Ann-Marie O'Neill (Green)<li>Bo Łuk and Bo Luk</ul><h2>West</h2><p>Bo <b>Luk</b></p><p>annmarie</p><script>Bo Luk</script>A very long name of many words here"
    pages = spark.createDataFrame([("X", page), ("Y", "<p>Bo Luk"), ("Z", None)], "council_id string, content string")
    names = spark.createDataFrame([("X", "Ann-Marie O'Neill"), ("X", "Bo Luk"), ("X", "Bo Luk"), ("X", "Nobody"), ("X", "--"), ("Y", "bo luk"), ("Q", "Bo Luk"), ("X", "long name of many words"), ("X", "long name of many other")], "council_id string, name string")
    found = mentions.mentions(names, pages)
    got = sorted((r["council_id"], r["name"], r["heading"], r["tag"]) for r in found.collect())
    assert got == [("X", "Ann-Marie O'Neill", "East Ward", "li"), ("X", "Bo Luk", "East Ward", "li"), ("X", "Bo Luk", "East Ward", "li"), ("X", "long name of many words", "West", "body"), ("Y", "bo luk", None, "p")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Contains" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_names_are_looked_for_in_blocks(spark, monkeypatch):
    """Texts move once for each block of names; before, each run of a text's words moved with the whole text. Places are the same."""
    monkeypatch.setattr(mentions, "TOGETHER", 2, raising=False)
    said = [f"w{i} w{i + 1} w{i % 3} w{i} and on" for i in range(12)]
    pages = spark.createDataFrame([(k, "<h2>Top</h2>" + "".join(f"<p>{x}</p>" for x in said)) for k in (1, 1, 2, 3)], "council_id long, content string")
    look = [(k, name) for k in (1, 2, 4) for name in ("W3", "w3 w4", "w1 w2 w1 w1 and on", "w1 w2 w1 w1 and off", "and", "on w1", "w11", "a b")]
    found = mentions.mentions(spark.createDataFrame(look, "council_id long, name string"), pages)
    want = []
    for k, name in look:
        n = len(name.split())
        for x in said * {1: 2, 2: 1}.get(k, 0):
            want += [(k, name, x)] * sum(x.split()[i : i + n] == name.lower().split() for i in range(len(x.split())))
    assert sorted(map(tuple, found.select("council_id", "name", "text").collect())) == sorted(want)
    # no run of words is a row before texts and names have met
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan[plan.index("Join") :]
