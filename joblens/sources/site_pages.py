"""Result pages of the five sites, written from listings: the other way round
from ``sources.markup``, for runs and checks without a crawl."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_PAGE = 20

# A card by site; {field} is its escaped text.  The classes are those that
# ``SITE_SELECTORS`` reads.
CARDS = {
    "topcv": (
        '<div class="job-item-search-result bg"><div><div class="logo"></div></div><h3 class="title"><a href="#x"><span>{position}</span></a></h3>{company}'
        '<label class="title-salary">{salary}</label><label class="address"><span>{address}</span></label><label class="exp"><span>{exp}</span></label></div>'
    ),
    "careerlink": (
        '<li><div class="media-body overflow-hidden"><h5 class="job-name">{position}</h5>{company}<span class="job-salary">{salary}</span>'
        '<div class="job-location"><div><a>{address}</a></div></div></div></li>'
    ),
    "careerviet": (
        '<div class="figcaption"><h2><a>{position}</a></h2>{company}<div class="salary"><p>{salary}</p></div>'
        '<div class="location"><ul><li>{address}</li></ul></div></div>'
    ),
    "itviec": (
        '<div class="job-card"><h3 class="imt-3">{position}</h3>{company}<div class="d-flex align-items-center salary text-rich-grey"><a>{salary}</a></div>'
        '<span class="ips-2 small-text text-rich-grey">At office</span><span class="ips-2 small-text text-rich-grey">{address}</span></div>'
    ),
    "vietnamworks": (
        '<div class="sc-eEbqID jZzXhN"><h2><a>{position}</a></h2>{company}<span class="sc-fgSWkL gKHoAZ">{salary}</span>'
        '<span class="sc-kzkBiZ hAkUGp">{address}</span></div>'
    ),
}
COMPANY = {
    "topcv": '<a class="company"><span class="company-name">{0}</span></a>',
    "careerlink": '<a class="text-dark">{0}</a>',
    "careerviet": '<a class="company-name">{0}</a>',
    "itviec": '<span class="ims-2 small-text text-hover-underline"><a>{0}</a></span>',
    "vietnamworks": '<div class="sc-cdaca-d dVvIA"><a>{0}</a></div>',
}
LISTS = {
    "topcv": '<div class="job-list-search-result">{0}</div>',
    "careerlink": '<ul class="list-group mt-4">{0}</ul>',
    "careerviet": '<div class="jobs-side-list">{0}</div>',
    "itviec": '<div class="col-xl-5 card-jobs-list ips-0 ipe-0 ipe-xl-6">{0}</div>',
    "vietnamworks": "<section class='block-job-list'>{0}</section>",
}
LINE_BREAK = {"careerviet": "</li><li>"}


def _pick(texts: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for site, text in texts.items():
        out = F.when(F.col("source") == site, F.lit(text)).otherwise(out)
    return out


def _escaped(name: str) -> Column:
    out = F.col(name)
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def site_pages(listings: DataFrame, id_col: str = "listing_id", page: Column | None = None) -> DataFrame:
    """(source, page_no, html): the sites' listings in the order of their ids,
    ``PER_PAGE`` consecutive ids of a site a page.  A listing with a null
    company has no company element.  A page groups its own few cards.

    The listings travel, not their markup, and to a fixed number of partitions:
    by the bytes of the shuffle too few tasks would write and read the pages."""
    page = F.floor(F.col(id_col) / (PER_PAGE * len(CARDS))).cast("int") if page is None else page
    parts = int(listings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listings = listings.withColumn("page_no", page).repartition(parts, "source", "page_no")
    card = _pick(CARDS)
    company = F.coalesce(F.replace(_pick(COMPANY), F.lit("{0}"), _escaped("company")), F.lit(""))
    lines = F.coalesce(_pick(LINE_BREAK), F.lit("<br>"))
    texts = {"company": company, "address": F.replace(_escaped("address"), F.lit("\n"), lines)} | {c: _escaped(c) for c in ("position", "salary", "exp")}
    for name, text in texts.items():
        card = F.replace(card, F.lit("{" + name + "}"), text)
    cards = listings.select("source", "page_no", F.struct(F.col(id_col).alias("id"), card.alias("card")).alias("one"))
    made = cards.groupBy("source", "page_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list("one")), lambda c: c["card"]), "\n").alias("cards"))
    body = F.replace(_pick(LISTS), F.lit("{0}"), F.col("cards"))
    # A script whose text looks like markup, and a card outside the list.
    head, foot = "<html><head><script>var a = '</div><div class=\"job-card\">';</script></head><body><div class='top'><div>menu</div></div>", '<div class="figcaption job-card">elsewhere</div></body></html>'
    return made.select("source", "page_no", F.concat(F.lit(head), body, F.lit(foot)).alias("html"))
