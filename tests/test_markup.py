"""Listing extraction in the JVM against the DOM extractor and golden pages."""

import random

from pyspark.sql import functions as F

from joblens.sources import html as H
from joblens.sources import markup as M
from joblens.sources.listings import read_listings
from joblens.sources.site_pages import site_pages
from test_extract import CAREERLINK, CAREERVIET, ITVIEC, TOPCV, VNW

PAGE = "source string, page_no int, html string"
NESTED = (
    "<!-- <div class='jobs-side-list'><div class='figcaption'>no</div></div> --><DIV id=a CLASS='x jobs-side-list y'><div><div class=\"figcaption\"><div class=salary><p>Lương: 1 Tr</p></div>"
    "<div><div class='other'>deep</div></div><h2>no link <a href='#'>Kỹ <b>sư</b>&nbsp;&lt;Java&gt;</a></h2></div></div>"
    "<div class='figcaption wide'><h2><a>Second</a><a>Third</a></h2><a class='not-company-name'>x</a><a class='company-name big'>Y &amp;amp; Z</a></div></DIV><div class='figcaption'>outside</div>"
)
UNCLOSED = "<div class='jobs-side-list'><div class='figcaption'><h2><a>Open</a></h2><div class='salary'><p>12</p>"
PAGES = [
    ("topcv", 1, TOPCV), ("careerlink", 1, CAREERLINK), ("careerviet", 1, CAREERVIET), ("itviec", 1, ITVIEC), ("vietnamworks", 1, VNW),
    ("careerviet", 2, NESTED), ("careerviet", 3, UNCLOSED), ("careerviet", 4, "<div class='jobs-side-list'></div>"),
    ("careerviet", 5, "<div class='jobs-side-list'>" + "<div class='figcaption'>" + "<div>" * 500 + "</div>" * 500 + "<h2><a>Deep</a></h2></div></div>"),
]


def test_equals_the_dom_extractor(spark):
    pages = spark.createDataFrame(PAGES, PAGE)
    got, want = (sorted(map(tuple, f(pages).select("source", "page_no", "item", *H.LISTING_FIELDS).collect()), key=str) for f in (M.extract_listings, H.extract_listings))
    assert got == want and len(got) == 11
    nested = {r[2]: r for r in got if r[:2] == ("careerviet", 2)}
    assert nested[1][3] == "Kỹ sư <Java>" and nested[2][3:5] == ("Second", "Y &amp; Z") and len(nested) == 2


def test_unread_pages(spark):
    rows = [("topcv", 1, TOPCV), ("topcv", 2, None), ("monster", 3, TOPCV), (None, 4, TOPCV), ("topcv", 5, ""), ("itviec", 6, TOPCV)]
    pages = spark.createDataFrame(rows, PAGE)
    assert {(r.page_no, r.reason) for r in M.unread_pages(pages).collect()} == {(2, "no page"), (3, "unknown site"), (4, "unknown site"), (5, "no list"), (6, "no list")}
    assert {r.page_no for r in M.extract_listings(pages).collect()} == {1}


def test_rendered_pages_read_back_alike_by_both(spark):
    listings = read_listings(spark, "/root/testdata/sf0.001").where("listing_id < 300").withColumn("company", F.when(F.col("listing_id") % 3 != 0, F.col("company")))
    pages = site_pages(listings)
    got, want = (sorted(map(tuple, f(pages).select("source", "page_no", "item", *H.LISTING_FIELDS).collect()), key=str) for f in (M.extract_listings, H.extract_listings))
    assert got == want and len(got) == listings.count()


def test_no_python_in_the_plan(spark):
    plan = M.extract_listings(spark.createDataFrame(PAGES, PAGE))._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "Python" not in plan


def test_selector_parts(spark):
    html = "<div class='card big'><span class='x'>1</span><p><span class=\"x y\">2</span></p></div><div class=card><span class=x>3</span></div>"
    df = spark.createDataFrame([(html,)], "h string")
    of = lambda selector: df.select(F.expr(M.select("h", selector))).first()[0]
    assert of("div.card span") == ["1", "2", "3"] and of("div.big.card span.y.x") == ["2"] and of(".card .y") == ["2"]
    assert of("div.nope") == of("table") == of("div.car") == [] and of(".card")[1] == "<span class=x>3</span>"


def _soup(seed: int) -> list[str]:
    """Random markup: torn tags, other letter cases, names that begin alike, nesting around the pattern's limit."""
    r = random.Random(seed)
    bits = ["<div>", "<div class=\"card\">", "<div class='big card'>", "</div>", "</div>", "</div >", "<DIV class=card ", "<div/>", "<divx>", "<div", "</div", "<span class=\"x y\">", "<Span CLASS=x>", "</span>",
            "<a class='card x'>", "</A>", "<b>", "</b>", "text", "é&amp;", "<", ">", "\"", "'", "/", "\n", " class=card", " class='a <div card'>"]
    torn = ["".join(r.choices(bits, [r.random() ** 3 for _ in bits], k=r.randint(0, r.choice([8, 25, 80])))) for _ in range(600)]
    deep = ["<div class=card>" * n + "x" + "</div>" * n + "<div class=card>y</div>" for n in range(1, M.NESTED + 6)]
    wide = ["<div title='" + "a\U0001f600" * 30_000 + "' class='card'>" + "<b>a\U0001f600</b>" * 30_000 + "<div></div>" * 20_000 + "</div>"]
    return ["", *torn, *deep, *wide]


def test_patterns_equal_the_fold(spark):
    df = spark.createDataFrame([(h,) for h in _soup(7)] + [(None,)], "h string").repartition(4).cache()
    for part in ("div", "div.card", "div.big.card", "span.x", ".card", ".x.y", "a"):
        rows = df.select("h", F.expr(M.elements("h", part)).alias("got"), F.expr(M._folded("h", part)).alias("want")).collect()
        assert [r for r in rows if r.got != r.want] == [] and any(r.got for r in rows)


def test_closed_elements_need_no_fold(spark, monkeypatch):
    monkeypatch.setattr(M, "_folded", lambda html, part: "cast(raise_error('folded') as array<string>)")
    listings = read_listings(spark, "/root/testdata/sf0.001").where("listing_id < 300")
    assert M.extract_listings(site_pages(listings)).count() == 300
    nest = "<div class='jobs-side-list'>" + "<div>" * 5 + "<div class='figcaption'>" * 2 + "<h2><a>In</a></h2>" + "</div>" * 8
    assert [r.position for r in M.extract_listings(spark.createDataFrame([("careerviet", 1, nest)], PAGE)).collect()] == ["In"]


def test_pages_are_cut_once_in_even_shares(spark):
    pages = site_pages(read_listings(spark, "/root/testdata/sf0.001"))
    plan = M.extract_listings(pages)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if line.lstrip("+-: *").startswith("Filter")]
    assert not [line for line in filters if "regexp" in line or "aggregate(" in line]  # a filter by the number of cards would cut again
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "<div" not in plan.split("Exchange", 1)[1]


def test_plain_text_stays_as_rendered(spark):
    r = random.Random(3)
    texts = ["".join(r.choices(["a", "é", " ", "  ", "\t", "\n", "\r", "\f", "\v", " ", "\u0085", " ", " ", "&amp;", "&", "<b>", ">"], [9, 5, 5, *[0.5] * 14], k=r.randint(0, 9))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    # a line break more changes no text, but takes the long way
    for row in df.select("t", M.rendered(F.col("t")).alias("got"), M.rendered(F.concat("t", F.lit("\n"))).alias("want")).collect():
        assert row.got == row.want, row
