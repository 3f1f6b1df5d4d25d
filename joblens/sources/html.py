"""Listing extraction from raw pages (SRC6, SRC7, PRJ1).

The reference drove a browser and read DOM elements by CSS selector.  The
crawl itself is not rebuilt; pages arrive as rows (``html`` text), and
extraction runs where the pages are:

* ``extract_items`` parses each page with the standard library's HTML
  parser inside ``mapInPandas`` (Arrow batches, one parse per page, on the
  executors) and evaluates the small selector grammar the reference used:
  tag, ``.class`` (several), ``#id``, descendant, n-th match, text or an
  attribute.  Rendered text follows the browser rules that matter here:
  script/style hidden, block boundaries and ``<br>`` break lines, runs of
  whitespace collapse, entities decoded.
* ``nav_links`` / ``page_titles`` handle flat markup with JVM regex
  functions only (no Python at all) for the driver's ``pages`` table.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.entities import name2codepoint
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.clean import NOT_AVAILABLE, with_missing_as_na

# The extractor's code runs in Python workers.  Pickling this module by
# value ships the parser with each task, so executors need no installed
# copy of the package (and a driver that only put it on its own sys.path
# still works).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --------------------------------------------------------------------------
# A small DOM

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title".split())
BLOCK = frozenset(
    "address article aside blockquote dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table tr ul".split()
)
CELLS = frozenset({"td", "th"})
# Start tags that implicitly close an open <p> (HTML parsing rules).
CLOSES_P = BLOCK - {"dd", "dt", "tr"}


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict = field(default_factory=dict)
    parent: Node | None = None
    children: list = field(default_factory=list)  # Node or str

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#document")
        self.stack = [self.root]

    def _close_to(self, tag: str, boundary: frozenset = frozenset()) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                del self.stack[i:]
                return
            if t in boundary:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_to("p", frozenset({"button", "table", "td", "th", "html"}))
        if tag == "li":
            self._close_to("li", frozenset({"ul", "ol"}))
        node = Node(tag, {k: (v or "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: (v or "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close_to(tag)

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse_html(html: str) -> Node:
    builder = _TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_COMPOUND = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)")


@dataclass(frozen=True)
class Compound:
    tag: str | None
    classes: frozenset
    ident: str | None

    def matches(self, node: Node) -> bool:
        if self.tag and self.tag != "*" and node.tag != self.tag:
            return False
        if self.ident and node.attrs.get("id") != self.ident:
            return False
        return self.classes <= node.classes


def parse_selector(selector: str) -> tuple[Compound, ...]:
    """``"div.a.b span#x"`` -> compounds joined by the descendant combinator."""
    out = []
    for token in selector.split():
        m = _COMPOUND.fullmatch(token)
        if not m:
            raise ValueError(f"unsupported selector part: {token!r}")
        tag, rest = m.group(1), m.group(2)
        parts = re.findall(r"([.#])([\w-]+)", rest)
        out.append(
            Compound(
                tag.lower() if tag else None,
                frozenset(v for k, v in parts if k == "."),
                next((v for k, v in parts if k == "#"), None),
            )
        )
    return tuple(out)


def _descendants(node: Node) -> Iterator[Node]:
    stack = list(reversed([c for c in node.children if isinstance(c, Node)]))
    while stack:
        n = stack.pop()
        yield n
        stack.extend(reversed([c for c in n.children if isinstance(c, Node)]))


def _matches(node: Node, compounds: tuple[Compound, ...]) -> bool:
    if not compounds[-1].matches(node):
        return False
    i = len(compounds) - 2
    anc = node.parent
    while i >= 0 and anc is not None:
        if compounds[i].matches(anc):
            i -= 1
        anc = anc.parent
    return i < 0


def select_all(scope: Node, selector: str | tuple[Compound, ...]) -> list[Node]:
    """``scope.querySelectorAll(selector)``: descendants of ``scope`` in
    document order; ancestors of a match may lie outside ``scope``."""
    compounds = parse_selector(selector) if isinstance(selector, str) else selector
    return [n for n in _descendants(scope) if _matches(n, compounds)]


def _pieces(nodes: list, out: list) -> None:
    """Text pieces of some nodes in document order; a loop, since unclosed
    tags nest as deeply as a page is long."""
    todo: list = list(reversed(nodes))
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
        elif node.tag == "br":
            out.append("\n")
        elif node.tag not in HIDDEN:
            edge = "\n" if node.tag in BLOCK else ""
            # cells of a row read as one line, space-separated
            todo.append(edge or (" " if node.tag in CELLS else ""))
            todo.extend(reversed(node.children))
            todo.append(edge)


def text_of(node: Node) -> str:
    """Rendered text (``element.text``): lines from blocks and ``<br>``,
    whitespace collapsed within lines, blank lines dropped."""
    parts: list[str] = []
    _pieces(node.children, parts)
    lines = (re.sub("[ \t\r\f\v\u00a0]+", " ", line).strip() for line in "".join(parts).split("\n"))
    return "\n".join(line for line in lines if line)


@dataclass(frozen=True)
class FieldSpec:
    """How to read one field of an item: selector (``""`` = the item
    itself), which match (0-based), and an attribute (``None`` = text)."""

    selector: str
    nth: int = 0
    attr: str | None = None


def read_field(item: Node, spec: FieldSpec) -> str | None:
    found = [item] if not spec.selector else select_all(item, spec.selector)
    if len(found) <= spec.nth:
        return None
    node = found[spec.nth]
    if spec.attr:
        return node.attrs.get(spec.attr)
    return text_of(node).strip()


def extract_page(html: str, container: str, item: str, fields: dict[str, FieldSpec]) -> list[dict]:
    root = parse_html(html)
    boxes = select_all(root, container)
    if not boxes:
        return []
    items = select_all(boxes[0], item)
    return [{name: read_field(it, spec) for name, spec in fields.items()} for it in items]


# --------------------------------------------------------------------------
# Spark side


def extract_items(
    pages: DataFrame,
    container: str,
    item: str,
    fields: dict[str, FieldSpec],
    keep: tuple[str, ...] = (),
    html_col: str = "html",
    site_col: str | None = None,
    sites: dict[str, tuple[str, str, dict[str, FieldSpec]]] | None = None,
) -> DataFrame:
    """SRC7: one output row per item found on a page (``item`` is 1-based).

    Pages reach Python in Arrow batches capped by
    ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default), so a
    worker holds a bounded slice of pages however large the input is.

    With ``site_col`` + ``sites``, each page uses its own site's container,
    item and field selectors (all sites must share the field names).
    Missing fields are null here; ``with_missing_as_na`` applies PRJ1.
    A page that cannot be read gives one row with ``item`` 0 and null fields
    instead of failing the job.
    """
    keep_fields = [pages.schema[c] for c in keep]
    out_schema = StructType(
        [*keep_fields, StructField("item", IntegerType(), False)]
        + [StructField(name, StringType(), True) for name in fields]
    )
    names = list(fields)
    cols = [*keep, html_col] + ([site_col] if site_col and site_col not in keep else [])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in zip(*(pdf[c] for c in cols)):
                rec = dict(zip(cols, row))
                spec = (container, item, fields)
                if site_col:
                    spec = sites.get(rec[site_col]) if sites else None
                    if spec is None:
                        continue
                kept = {k: rec[k] for k in keep}
                try:
                    items = extract_page(rec[html_col], *spec)
                except Exception:  # noqa: BLE001  whatever a page holds, the others go on
                    rows.append({**kept, "item": 0, **dict.fromkeys(names)})
                    continue
                rows.extend({**kept, "item": i, **found} for i, found in enumerate(items, start=1))
            yield pd.DataFrame(rows, columns=[*keep, "item", *names])

    return pages.select(*cols).mapInPandas(run, out_schema)


# Where each site kept its listing cards and fields.
SITE_SELECTORS = {
    "topcv": (
        ".job-list-search-result",
        ".job-item-search-result",
        {
            "position": FieldSpec("h3.title a span"),
            "company": FieldSpec("a.company span.company-name"),
            "salary": FieldSpec("label.title-salary"),
            "address": FieldSpec("label.address span"),
            "exp": FieldSpec("label.exp span"),
        },
    ),
    "careerlink": (
        "ul.list-group.mt-4",
        "div.media-body.overflow-hidden",
        {
            "position": FieldSpec("h5.job-name"),
            "company": FieldSpec("a.text-dark"),
            "salary": FieldSpec("span.job-salary"),
            "address": FieldSpec("div.job-location div a"),
        },
    ),
    "careerviet": (
        "div.jobs-side-list",
        "div.figcaption",
        {
            "position": FieldSpec("h2 a"),
            "company": FieldSpec("a.company-name"),
            "salary": FieldSpec("div.salary p"),
            "address": FieldSpec("div.location ul"),
        },
    ),
    "itviec": (
        "div.col-xl-5.card-jobs-list.ips-0.ipe-0.ipe-xl-6",
        "div.job-card",
        {
            "position": FieldSpec("h3.imt-3"),
            "company": FieldSpec("span.ims-2.small-text.text-hover-underline a"),
            "salary": FieldSpec("div.d-flex.align-items-center.salary.text-rich-grey a"),
            "address": FieldSpec("span.ips-2.small-text.text-rich-grey", nth=1),
        },
    ),
    "vietnamworks": (
        ".block-job-list",
        "div.sc-eEbqID.jZzXhN",
        {
            "position": FieldSpec("h2 a"),
            "company": FieldSpec("div.sc-cdaca-d.dVvIA a"),
            "salary": FieldSpec("span.sc-fgSWkL.gKHoAZ"),
            "address": FieldSpec("span.sc-kzkBiZ.hAkUGp"),
        },
    ),
}
LISTING_FIELDS = ("position", "company", "salary", "address", "exp")


def extract_listings(pages: DataFrame, keep: tuple[str, ...] = ("source", "page_no")) -> DataFrame:
    """SRC6 -> SRC7 -> PRJ1: pages of the five sites -> raw listings.

    Every site yields the same five fields; sites without an experience
    field get a null ``exp`` (their rows never use it).
    """
    sites = {}
    for name, (box, item, fields) in SITE_SELECTORS.items():
        full = {f: fields.get(f, FieldSpec("#--absent--")) for f in LISTING_FIELDS}
        sites[name] = (box, item, full)
    any_fields = {f: FieldSpec("*") for f in LISTING_FIELDS}
    raw = extract_items(pages, "", "", any_fields, keep=keep, site_col="source", sites=sites).filter(F.col("item") > 0)
    filled = with_missing_as_na(raw, ("position", "company", "salary", "address"))
    return filled.withColumn("exp", F.when(F.col("source") == "topcv", F.coalesce(F.col("exp"), F.lit(NOT_AVAILABLE))))


# --------------------------------------------------------------------------
# Flat markup with JVM regex only

# Parsers accept these names without their semicolon (fixed values).
_BARE = "amp|lt|gt|quot|nbsp"
_ENTITY = rf"^(#[xX][0-9a-fA-F]{{1,6}};?|#[0-9]{{1,7}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{_BARE}))"


def unescape(c: Column) -> Column:
    """Character references decoded in one pass (``&amp;lt;`` stays ``&lt;``):
    decimal, hexadecimal, and the HTML 4 names of the standard library."""
    names = F.from_json(F.lit(json.dumps({n: chr(cp) for n, cp in name2codepoint.items()})), "map<string,string>")

    def decoded(part: Column) -> Column:
        found = F.regexp_extract(part, _ENTITY, 1)
        name = F.rtrim(found, F.lit(";"))
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 16)).when(name.startswith("#"), F.conv(F.substr(name, F.lit(2)), 10, 16))
        number = F.conv(digits, 16, 10).cast("long")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        text = F.when(name.startswith("#"), char).otherwise(F.try_element_at(names, name))
        return F.coalesce(F.when(found != "", F.concat(text, F.substr(part, F.length(found) + 1))), F.concat(F.lit("&"), part))

    parts = F.split(c, "&")
    # most texts have no reference: they skip the split
    return F.when(~c.contains("&"), c).otherwise(F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), decoded), "")))


def inner_text(c: Column) -> Column:
    """Tags dropped, entities decoded, whitespace collapsed."""
    no_tags = F.regexp_replace(c, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescape(no_tags), r"[\s\u00a0]+", " "))


LINK = r"(?s)<li\b[^>]*>\s*<a\b.*?</a>"
HREF = r'(?s)^<li\b[^>]*>\s*<a\b[^>]*?\shref="([^"]*)"'


def nav_links(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``nav li a`` of every page's first ``nav``: (page_id, item, text, href).

    Text and href come from one match of the item, so an anchor without
    ``href`` has a null one and shifts no other."""
    nav = F.regexp_extract(F.col("html"), r"(?s)<nav\b[^>]*>(.*?)</nav>", 1)
    exploded = pages.select(id_col, F.posexplode(F.regexp_extract_all(nav, F.lit(LINK), 0)).alias("pos", "link"))
    link = F.col("link")
    return exploded.select(
        id_col,
        (F.col("pos") + 1).cast("int").alias("item"),
        inner_text(F.regexp_extract(link, r"(?s)<a\b[^>]*>(.*)</a>$", 1)).alias("text"),
        F.when(link.rlike(HREF), unescape(F.regexp_extract(link, HREF, 1))).alias("href"),
    )


TITLE = r"(?s)<article\b[^>]*>.*?<h1\b[^>]*>(.*?)</h1>"


def page_titles(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``article h1`` text of every page that has one."""
    h1 = F.regexp_extract(F.col("html"), TITLE, 1)
    return pages.filter(F.col("html").rlike(TITLE)).select(id_col, inner_text(h1).alias("title"))
