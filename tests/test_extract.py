"""Listing extraction from site markup (SRC6, SRC7, PRJ1) and the DOM rules
(unclosed tags, ``</p>`` inside scripts, entities, n-th match)."""

from pyspark.sql import functions as F

from joblens.sources import html as H

TOPCV = """<html><body><div class="job-list-search-result">
 <div class="job-item-search-result"><h3 class="title"><a href="#"><span> Kỹ sư  Java </span></a></h3>
   <a class="company"><span class="company-name">Công ty A &amp; B</span></a>
   <label class="title-salary">Tới 1,500 USD</label><label class="address"><span>Hà Nội</span></label>
   <label class="exp"><span>2 năm</span></label></div>
 <div class="job-item-search-result"><h3 class="title"><a><span>Tester</span></a></h3>
   <label class="title-salary">Thoả thuận</label></div>
</div></body></html>"""

CAREERLINK = """<ul class="list-group mt-4"><li><div class="media-body overflow-hidden">
<h5 class="job-name">Dev</h5><a class="text-dark">Cty</a><span class="job-salary">10 triệu - 20 triệu</span>
<div class="job-location"><div><a>Đà Nẵng</a></div></div></div></li></ul>"""

CAREERVIET = """<div class="jobs-side-list"><div class="figcaption"><h2><a>BA</a></h2><a class="company-name">X</a>
<div class="salary"><p>Lương: 10 Tr - 15 Tr VND</p></div><div class="location"><ul><li>Hà Nội</li><li>Hồ Chí Minh</li></ul></div>
</div></div>"""

ITVIEC = """<div class="col-xl-5 card-jobs-list ips-0 ipe-0 ipe-xl-6"><div class="job-card"><h3 class="imt-3">QA</h3>
<span class="ims-2 small-text text-hover-underline"><a>Itv Co</a></span>
<span class="ips-2 small-text text-rich-grey">At office</span><span class="ips-2 small-text text-rich-grey">Ha Noi</span>
</div><div class="job-card"><h3 class="imt-3">PM</h3><span class="ips-2 small-text text-rich-grey">Remote</span></div></div>"""

VNW = """<div class="block-job-list"><div class="sc-eEbqID jZzXhN"><h2><a>SRE</a></h2><div class="sc-cdaca-d dVvIA"><a>V</a></div>
<span class="sc-fgSWkL gKHoAZ">Tới 2,000 USD</span><span class="sc-kzkBiZ hAkUGp">Cần Thơ</span></div></div>"""


def test_extract_listings_all_sites(spark):
    pages = spark.createDataFrame(
        [("topcv", 1, TOPCV), ("careerlink", 1, CAREERLINK), ("careerviet", 1, CAREERVIET), ("itviec", 1, ITVIEC), ("vietnamworks", 1, VNW)],
        "source string, page_no int, html string",
    )
    got = {(r.source, r.item): r.asDict() for r in H.extract_listings(pages).collect()}
    t1 = got[("topcv", 1)]
    assert (t1["position"], t1["company"], t1["salary"], t1["address"], t1["exp"]) == (
        "Kỹ sư Java", "Công ty A & B", "Tới 1,500 USD", "Hà Nội", "2 năm")
    t2 = got[("topcv", 2)]
    assert (t2["company"], t2["address"], t2["exp"]) == ("Not Available",) * 3  # PRJ1
    c = got[("careerlink", 1)]
    assert (c["position"], c["salary"], c["address"], c["exp"]) == ("Dev", "10 triệu - 20 triệu", "Đà Nẵng", None)
    assert got[("careerviet", 1)]["address"] == "Hà Nội\nHồ Chí Minh"  # list items -> lines
    assert got[("itviec", 1)]["address"] == "Ha Noi"  # the second match
    assert got[("itviec", 2)]["address"] == "Not Available"  # no second match (Q13)
    assert got[("vietnamworks", 1)]["salary"] == "Tới 2,000 USD"


def test_dom_rules():
    html = ('<html><head><script>var t="</p>";</script><style>p{}</style></head><body>'
            '<div id="m" class="a b"><p><b>one<br><p>two &amp; three</p><ul><li>x<li>y</ul></div></body></html>')
    root = H.parse_html(html)
    ps = H.select_all(root, "div#m.a p")
    assert [H.text_of(p) for p in ps] == ["one", "two & three"]
    assert [H.text_of(li) for li in H.select_all(root, "ul li")] == ["x", "y"]
    assert H.select_all(root, "script") and not H.select_all(root, "div.c")
    assert H.text_of(H.select_all(root, "body")[0]) == "one\ntwo & three\nx\ny"


def test_nav_regex_equals_dom(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    a = H.nav_links(pages)
    b = H.extract_items(pages, "nav", "li", {"text": H.FieldSpec("a"), "href": H.FieldSpec("a", attr="href")}, keep=("page_id",))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_legacy_entities_without_semicolon(spark):
    html = "<html><body><article><h1>a &amp;lt; b&amp c &lt d&#39 e</h1></article></body></html>"
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    regex = H.page_titles(pages).collect()[0].title
    dom = H.extract_items(pages, "article", "h1", {"title": H.FieldSpec("")}, keep=("page_id",)).collect()[0].title
    assert regex == dom == "a &lt; b& c < d' e"


def test_selector_grammar():
    html = ('<div id="main" class="card big"><span class="x">1</span><p><span class="x y">2</span></p>'
            '<a href="/u?a=1&amp;b=2" data-k="v">link</a></div><div class="card"><span class="x">3</span></div>')
    root = H.parse_html(html)
    assert [H.text_of(n) for n in H.select_all(root, "#main span.x")] == ["1", "2"]
    assert [H.text_of(n) for n in H.select_all(root, "div.card.big span.x.y")] == ["2"]
    assert [H.text_of(n) for n in H.select_all(root, "div span")] == ["1", "2", "3"]
    assert len(H.select_all(root, "* span")) == 3 and H.select_all(root, "div#nope") == []
    card = H.select_all(root, "div.big")[0]
    assert H.read_field(card, H.FieldSpec("span.x", nth=1)) == "2"
    assert H.read_field(card, H.FieldSpec("span.x", nth=5)) is None
    assert H.read_field(card, H.FieldSpec("a", attr="href")) == "/u?a=1&b=2"
    assert H.read_field(card, H.FieldSpec("a", attr="missing")) is None


def test_extractor_ships_its_code_to_workers():
    """Workers need no installed package: the module pickles by value."""
    from pyspark import cloudpickle

    blob = cloudpickle.dumps(H.extract_page)
    assert b"_TreeBuilder" in blob and b"handle_starttag" in blob  # the class itself, not a reference


def test_table_rows_read_as_lines():
    root = H.parse_html("<table><tr><td>Hà Nội</td><td>10 triệu</td></tr><tr><th>a</th><th>b</th></tr></table>")
    assert H.text_of(H.select_all(root, "table")[0]) == "Hà Nội 10 triệu\na b"


def test_deep_nesting_and_unreadable_pages_do_not_fail_the_job(spark, monkeypatch):
    deep = "<article><h1>" + "<b>" * 5000 + "title</h1></article>"
    pages = spark.createDataFrame([(1, deep), (2, None), (3, "<article><h1>ok</h1></article>")], "page_id bigint, html string")
    got = H.extract_items(pages, "article", "h1", {"title": H.FieldSpec("")}, keep=("page_id",)).collect()
    assert [(r.page_id, r.item, r.title) for r in got] == [(1, 1, "title"), (3, 1, "ok")]

    def broken(html, *spec):
        raise RecursionError

    monkeypatch.setattr(H, "extract_page", broken)
    bad = H.extract_items(pages.where("page_id = 3"), "article", "h1", {"title": H.FieldSpec("")}, keep=("page_id",)).collect()
    assert [(r.page_id, r.item, r.title) for r in bad] == [(3, 0, None)]


def test_nav_links_pair_text_and_href_of_one_anchor(spark):
    html = (
        "<nav><ul><li><a href=\"/a\">A</a></li><li><a>No link</a></li><li class=x><a id=q href=\"/b?x=1&amp;y=2\">B &eacute;&#x27;&#233; <b>c</b></a></li></ul></nav>"
        "<nav><ul><li><a href=\"/second\">other nav</a></li></ul></nav>"
    )
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    got = [(r.item, r.text, r.href) for r in H.nav_links(pages).collect()]
    assert got == [(1, "A", "/a"), (2, "No link", None), (3, "B é'é c", "/b?x=1&y=2")]


def test_character_references(spark):
    import html as stdlib

    texts = ["a &amp;lt; b", "&eacute;&Eacute;", "&#x27;&#39;&#X1F600;", "&unknown; &", "&#0; &#xD800;", "100% &copy 5", "&amp", "&lt&gt", "x & y &euro;&nbsp;z", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", H.unescape(F.col("t")).alias("u"))
    for r in df.collect():
        if r.t != "100% &copy 5":  # a bare name outside the five stays
            assert r.u == stdlib.unescape(r.t), r.t
