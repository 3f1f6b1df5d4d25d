"""Listing extraction with JVM functions only (SRC6, SRC7, PRJ1).

An element is read by one pattern, whose possessive loops follow the tags of
its name some levels deep, so it is a slice of the page however its inside
nests.  Text that a pattern cannot follow (nested deeper, or not closed) is cut
at the start and end tags of that name, and a fold over those tokens keeps the
depth and notes where each matching element begins and ends; both give the
same.  A selector (``div.a.b span.c``: tags and classes, descendants) is one
such cut per part.  Text is rendered by the same rules as ``sources.html``.

The order of the work is a scan and narrow projections; no page leaves the
JVM.  Limits, which the sites' selectors never meet: an element nested in
another match of the same part is read as part of it, ids and ``>`` inside
attribute values are not understood, and end tags must be written out for the
elements that are cut.  Pages that cannot be read are rows of ``unread_pages``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import NOT_AVAILABLE
from .html import BLOCK, CELLS, LISTING_FIELDS, SITE_SELECTORS, FieldSpec, unescape

UNSEEN = r"(?is)<(?:!--.*?-->|(script|style|template|noscript)\b[^>]*>.*?</\1\s*>)"
_PART = re.compile(r"([a-zA-Z][\w-]*)?((?:\.[\w-]+)*)")
_SPAN = "array<struct<a:int,b:int>>"
NESTED = 8  # levels of one name that a pattern follows; the fold takes the others


def visible(html: Column) -> Column:
    """A page without comments, scripts and styles, whose text may hold tags."""
    return F.regexp_replace(html, UNSEEN, "")


def _literal(pattern: str) -> str:
    """A pattern as raw SQL text (it holds both kinds of quotes)."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _has_classes(classes: list[str], stop: str = "") -> str:
    """Pattern behind a tag's name: the class attribute has all of these;
    ``stop`` is looked out for at every character of the attributes (lazily:
    a greedy loop over characters of one and two units would recurse)."""
    within, double, single = (rf"(?:{stop}[^{end}])*?" if stop else f"[^{end}]*" for end in (">", '"', "'"))
    one = r"""(?={1}\sclass\s*=\s*(?:"(?:{2}\s)?{0}(?:\s{2})?"|'(?:{3}\s)?{0}(?:\s{3})?'|{0}(?=[\s>])))"""
    return r"(?=[\s>/])" + "".join(one.format(re.escape(c), within, double, single) for c in classes)


def _part(part: str) -> tuple[str, str, list[str]]:
    """Tag ('' when missing), the pattern of the tags to cut at, classes."""
    found = _PART.fullmatch(part)
    if not found or not part:
        raise ValueError(f"unsupported selector part: {part!r}")
    # A page is cut at the tags of one name, or, without a name, at all tags.
    return found.group(1) or "", found.group(1) or "[a-z][a-z0-9-]*", [c for c in found.group(2).split(".") if c]


def _folded(html: str, part: str) -> str:
    """``elements`` by a fold over all tags of the name: any nesting."""
    _, name, classes = _part(part)
    wanted = f"(?i)^<{name}" + _has_classes(classes)
    # One token: does it match, its tag (of this name), does it end an element?
    token = f"named_struct('wanted', x rlike {_literal(wanted)}, 'tag', lower(regexp_extract(x, {_literal(f'(?i)^</?({name})(?=[{chr(92)}s>/])')}, 1)), 'ends', startswith(x, '</'))"
    step = """named_struct(
        'depth', case when acc.depth = 0 and t.wanted then 1 when acc.depth > 0 and t.tag = acc.tag then acc.depth + if(t.ends, -1, 1) else acc.depth end,
        'tag', if(acc.depth = 0 and t.wanted, t.tag, acc.tag), 'start', if(acc.depth = 0 and t.wanted, acc.at, acc.start), 'at', acc.at + 1,
        'done', if(acc.depth = 1 and t.ends and t.tag = acc.tag, array_append(acc.done, named_struct('a', acc.start, 'b', acc.at)), acc.done))"""
    zero = f"named_struct('depth', 0, 'tag', '', 'start', 0, 'at', 0, 'done', cast(array() as {_SPAN}))"
    # An element that is never closed goes to the end.
    spans = f"aggregate(transform(tokens, x -> {token}), {zero}, (acc, t) -> {step}, acc -> if(acc.depth > 0, array_append(acc.done, named_struct('a', acc.start, 'b', acc.at)), acc.done))"
    inner = "regexp_replace(array_join(slice(tokens, span.a + 1, span.b - span.a), ''), '^<[^>]*>', '')"
    cut = f"split({html}, {_literal(f'(?i)(?=</?{name}[{chr(92)}s>/])')})"
    return f"get(transform(array({cut}), tokens -> transform({spans}, span -> {inner})), 0)"


def _pattern(part: str) -> tuple[str, int]:
    """A pattern for the outermost elements that match ``part`` and the group
    that holds each from its name to its end tag.  The group is empty, and the
    pattern takes the rest, where an element is not closed or holds more than
    ``NESTED`` levels of its own name.  All loops are possessive: one pass over
    the text, and a stack that grows with the levels only."""
    tag, name, classes = _part(part)
    same = tag or r"\1"
    start, end = rf"<{same}(?=[\s>/])", rf"</{same}(?=[\s>/])"
    flat = rf"[^<]*+(?:<(?!/?{same}[\s>/])[^<]*+)*+"
    inside = flat
    for _ in range(NESTED):
        inside = rf"{flat}(?:{start}{inside}{end}{flat})*+"
    wanted = (name if tag else f"({name})") + _has_classes(classes, rf"(?!</?{name}[\s>/])")
    return rf"(?is)<(?={wanted})(?:({same}{inside}){end}|.*)", 1 if tag else 2


def elements(html: str, part: str) -> str:
    """SQL for the inner markup (an array) of the outermost elements of the
    expression ``html`` that match ``tag.class.class`` (either may be
    missing), in document order."""
    pattern, group = _pattern(part)
    inner = "transform(found, x -> if(contains(x, '>'), substr(x, instr(x, '>') + 1), concat('<', x)))"
    # An empty group: the pattern could not follow this text.
    read = f"if(array_contains(found, ''), {_folded(html, part)}, {inner})"
    return f"get(transform(array(regexp_extract_all({html}, {_literal(pattern)}, {group})), found -> {read}), 0)"


def select(html: str, selector: str) -> str:
    """SQL for the inner markup of the matches of a descendant selector."""
    first, *rest = selector.split()
    found = elements(html, first)
    for part in rest:
        found = f"flatten(transform({found}, inside -> {elements('inside', part)}))"
    return found


def field_markup(html: str, spec: FieldSpec) -> str:
    """SQL for the markup of one field of an item; null where it has none."""
    if spec.attr:
        raise ValueError("attributes are read by sources.html")
    return f"get({select(html, spec.selector)}, {spec.nth})"


_NAMES = "|".join(sorted(BLOCK))
_RENDERED = r"[<&\n\t\r\f\x0B\xA0]|  |^ | \z"


def rendered(inner: Column) -> Column:
    """Text as a browser shows it: lines from blocks and ``<br>``, white space
    collapsed within lines, blank lines dropped.  Text that has nothing to
    render, as most fields, stays."""
    lines = F.regexp_replace(inner, rf"(?i)</?(?:{_NAMES})(?=[\s>/])[^>]*>|<br(?=[\s>/])[^>]*>", "\n")
    cells = F.regexp_replace(lines, rf"(?i)<(?:{'|'.join(sorted(CELLS))})(?=[\s>/])[^>]*>", " ")
    text = F.get(F.transform(F.array(F.regexp_replace(cells, r"<[^>]*>", "")), unescape), 0)  # evaluated once
    kept = F.transform(F.split(text, "\n"), lambda line: F.trim(F.regexp_replace(line, "[ \t\r\f\u000b ]+", " ")))
    return F.when(~inner.rlike(_RENDERED), inner).otherwise(F.array_join(F.filter(kept, lambda line: line != ""), "\n"))


def _by_site(value) -> Column:
    """SQL ``value(site)`` of the page's own site; other sites' are not evaluated."""
    return F.expr("case source " + " ".join(f"when '{site}' then {value(site)}" for site in SITE_SELECTORS) + " end")


def _lists(pages: DataFrame) -> DataFrame:
    """Pages with the markup of their listing container (``_list``)."""
    seen = pages.withColumn("_seen", visible(F.col("html")))
    return seen.withColumn("_list", _by_site(lambda site: f"get({select('_seen', SITE_SELECTORS[site][0])}, 0)"))


def listing_cards(pages: DataFrame, keep: tuple[str, ...] = ("source", "page_no")) -> DataFrame:
    """One row per listing card: kept columns, ``source``, ``item`` (from 1), ``card``."""
    cards = _lists(pages).withColumn("_cards", _by_site(lambda site: select("_list", SITE_SELECTORS[site][1])))
    kept = dict.fromkeys([*keep, "source"])
    # Before a plain explode Spark filters by the array's size, and would cut every page twice for it.
    rows = cards.select(*kept, F.posexplode_outer("_cards").alias("item", "card")).where(F.col("item").isNotNull())
    return rows.withColumn("item", F.col("item") + 1)


def extract_listings(pages: DataFrame, keep: tuple[str, ...] = ("source", "page_no")) -> DataFrame:
    """SRC6 -> SRC7 -> PRJ1: pages of the five sites -> raw listings.

    Every site yields the same five fields; a field the card does not have is
    ``Not Available``; sites without an experience field get a null ``exp``.
    """

    def of(name: str) -> Column:
        return _by_site(lambda site: field_markup("card", SITE_SELECTORS[site][2][name]) if name in SITE_SELECTORS[site][2] else "cast(null as string)")

    texts = F.transform(F.array(*map(of, LISTING_FIELDS)), lambda inner: F.when(inner.isNotNull(), rendered(inner)))
    read = listing_cards(pages, keep).withColumn("_texts", texts)
    # a missing ``exp`` is no field of the site, but for topcv
    with_exp = F.col("source").isin(*[site for site, (_, _, fields) in SITE_SELECTORS.items() if "exp" in fields])
    missing = dict.fromkeys(LISTING_FIELDS, F.lit(NOT_AVAILABLE)) | {"exp": F.when(with_exp, F.lit(NOT_AVAILABLE))}
    return read.select(*keep, "item", *[F.coalesce(F.get("_texts", i), missing[n]).alias(n) for i, n in enumerate(LISTING_FIELDS)])


def unread_pages(pages: DataFrame, keep: tuple[str, ...] = ("source", "page_no")) -> DataFrame:
    """Pages that give no listings, and why: the second output of a run, so a
    lost or redesigned page is seen."""
    known = F.coalesce(F.col("source").isin(*SITE_SELECTORS), F.lit(False))
    why = F.when(F.col("html").isNull(), "no page").when(~known, "unknown site").when(F.col("_list").isNull(), "no list")
    return _lists(pages).select(*keep, why.alias("reason")).where(F.col("reason").isNotNull())
