import pytest
from pyspark.sql import functions as F

from moothall.functions import codecs, links, text, values


def value(spark, column, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()] or [F.lit(1).alias("one")]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, slug",
    [("Siân Ó Briain", "sian-o-briain"), ("  A -- B!  ", "a-b"), ("Straße", "strasse"), ("", ""), (None, None), ("ŽIŽEK", "zizek")],
)
def test_slug(spark, raw, slug):
    assert value(spark, text.slugify(F.lit(raw).cast("string"))) == slug


@pytest.mark.parametrize(
    "raw, name",
    [("Councillor Ann Lee", "Ann Lee"), ("Depute Provost Jo Ray", "Jo Ray"), (" Cllr. Bo \t", "Bo"), ("Provost X", "X")],
)
def test_titles(spark, raw, name):
    assert value(spark, text.without_titles(F.lit(raw))) == name


def test_names(spark):
    assert value(spark, text.surname_last(F.lit("Lee, Ann"))) == "Ann Lee"
    assert value(spark, text.after_number(F.lit("12 North Ward"))) == "North Ward"
    assert value(spark, text.pair(F.lit("Labour | East")))["second"] == "East"
    assert value(spark, text.pair(F.lit("a | b | c"))) is None
    assert value(spark, text.first_of(F.lit(""), F.lit(None).cast("string"), F.lit("x"))) == "x"
    assert value(spark, text.label_by_keyword(F.lit("a Green one"), {"Green": "G", "Blue": "B"}, "I")) == "G"
    assert value(spark, text.filled(F.lit("$name of $names"), {"name": F.lit("A"), "names": F.lit("B")})) == "A of B"
    assert value(spark, text.first_line(F.lit("one\ntwo"))) == "one"
    assert value(spark, text.path_checked(F.lit("a/../b"))) is None
    assert value(spark, text.path_checked(F.lit("a/b..c"))) == "a/b..c"


@pytest.mark.parametrize(
    "base, href, url",
    [
        ("https://x.org/a/b", "c?d=1", "https://x.org/a/c?d=1"),
        ("https://x.org/a/b", "../c", "https://x.org/c"),
        ("https://x.org/a", "//y.org/z", "https://y.org/z"),
        ("https://x.org/a", None, None),
        ("https://x.org/a", "", "https://x.org/a"),
    ],
)
def test_absolute(spark, base, href, url):
    assert value(spark, links.absolute(F.lit(base), F.lit(href).cast("string"))) == url


def test_links(spark):
    assert value(spark, links.query_value(F.lit("https://x.org/u?UID=7&b=2"), "UID")) == "7"
    assert value(spark, links.query_value(F.lit("https://x.org/u"), "UID")) == "https://x.org/u"
    assert value(spark, links.last_segment(F.lit("https://x.org/a/b/"))) == "b"
    assert value(spark, links.segment_after(F.lit("/x/id/42/y"), "id")) == "42"
    assert value(spark, links.with_scheme(F.lit("//x.org/i.jpg"))) == "https://x.org/i.jpg"
    assert value(spark, links.with_scheme(F.lit("data:image/png;base64,xx"))) is None
    assert value(spark, links.style_url(F.lit("background: url('/a.jpg?w=1')"))) == "/a.jpg"


def test_codecs(spark):
    assert value(spark, codecs.rot13(F.lit("wb[at]rknzcyr.bet"))) == "jo@example.org"
    for address in ("jo@example.org", "é@x.org"):
        assert value(spark, codecs.cloaked_email(codecs.cloak(F.lit(address), 0x3F))) == address
    assert value(spark, codecs.cloaked_email(F.lit("zz"))) is None
    for raw, most, want in (("abc", 2, "ab"), ("aé", 2, "a"), ("aé", 3, "aé"), ("a😀b", 4, "a"), ("日本", 5, "日"), ("", 3, "")):
        assert value(spark, codecs.cut_bytes(F.lit(raw), most)) == want


@pytest.mark.parametrize("n, label", [(0, "0.0 B"), (1023, "1023.0 B"), (1024, "1.0 KB"), (1536, "1.5 KB"), (1 << 30, "1.0 GB"), (1 << 50, "1024.0 TB")])
def test_size(spark, n, label):
    assert value(spark, values.size_label(F.lit(n).cast("long"))) == label


def test_values(spark):
    assert value(spark, values.percent(F.lit(1), F.lit(16))) == "6.2%"
    assert value(spark, values.percent(F.lit(0), F.lit(0), 2)) == "0.00%"
    for raw in ("2019-05-02", "02/05/2019", "2/5/2019", "02 May 2019", "2019-05-02T10:00:00"):
        assert str(value(spark, values.date_of(F.lit(raw)))) == "2019-05-02"
    assert value(spark, values.date_of(F.lit("soon"))) is None
    day = F.lit("2020-01-01").cast("date")
    none = F.lit(None).cast("date")
    assert value(spark, values.current(none, none, day)) is True
    assert value(spark, values.current(day, day, day)) is True
    assert value(spark, values.current(none, F.date_sub(day, 1), day)) is False
    assert value(spark, values.same_system(F.lit("cmis"), F.lit("CMIS"))) is True
    assert value(spark, values.same_system(F.lit(None).cast("string"), F.lit("CMIS"))) is True
