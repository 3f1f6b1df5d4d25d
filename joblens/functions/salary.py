"""Salary and experience normalisation (DOM1-DOM7, MTH1-MTH2, PRJ7-PRJ8).

Units: million VND per month; 0.0 means "not stated".  Each site has an
ordered list of rules.  The reference applied them as successive masked
assignments, so the *last* matching rule decides the row; here each list is
folded into one ``when`` chain that tests the last rule first.

Failure handling (a deliberate departure): where the reference raised and
lost the rest of the site, a row whose chosen rule does not parse keeps
0.0 / 0.0 and gets ``salary_ok = false`` (likewise ``exp_ok``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import (
    col_of,
    drop_commas,
    part,
    py_float,
    py_int,
    strip_ws,
    token,
    first_ws_token,
    ws_token,
    ws_tokens,
)

# Fixed values of the reference's cleaning rules: sites, the words and
# separators the texts are read by, and the conversion constants.
SOURCES = ("topcv", "careerlink", "careerviet", "itviec", "vietnamworks")
YEARS_WORD = "năm"  # experience: "X năm"
UP_TO = "Tới"  # "Tới X USD" / "Tới X triệu"
USD = "USD"
RANGE_MARK = "-"
RANGE_SEP = " - "
MILLION = "triệu"  # careerlink "X triệu" / "Trên X triệu"
ABOVE = "Trên"  # careerviet "Lương: Trên X Tr VND"
LABEL_SEP = ":"
UP_TO_CV = "Lên đến"  # careerviet "Lương: Lên đến X Tr VND"
MILLION_SHORT = "Tr"
USD_TO_MVND = 25000 / 1000000  # 1 USD = 25,000 VND, salaries in millions
ANNUAL_THRESHOLD = 100.0  # a single USD bound above this is read as yearly
MONTHS = 12.0


def _zero() -> Column:
    return F.lit(0.0)


@dataclass(frozen=True)
class Rule:
    """One masked assignment of the reference, as data.

    ``lo`` / ``hi`` are the *texts* of the bounds (``lo=None``: the rule
    leaves the minimum at 0.0); ``unit`` says how the parsed numbers convert:
    ``plain`` as is, ``pair`` x0.025 when the text says USD, ``usd`` always
    x0.025, ``single`` like ``pair`` plus the yearly rule above 100.
    """

    when: Column
    lo: Column | None
    hi: Column
    unit: str


def floor_div(x: Column, d: float) -> Column:
    """MTH2: Python ``x // d`` for floats (exact remainder, then quotient),
    which ``floor(x / d)`` misses when the quotient rounds up to an integer.
    From 2^52 on a double is whole and needs no rounding (``floor`` would
    clip it to a long); infinite amounts give NaN, as in Python."""
    whole = (x - F.pmod(x, F.lit(d))) / F.lit(d)
    return F.when(F.abs(whole) < F.lit(2.0**52), F.floor(whole + F.lit(0.5)).cast("double")).otherwise(whole)


UNITS = {"plain": 0, "pair": 1, "usd": 2, "single": 3}


def _convert_hi(x: Column, unit: Column, usd: Column) -> Column:
    """MTH1 + MTH2 by the rule's unit."""
    dollars = x * F.lit(USD_TO_MVND)
    single = F.when(dollars > F.lit(ANNUAL_THRESHOLD), floor_div(dollars, MONTHS)).otherwise(dollars)
    to_dollars = (unit == UNITS["usd"]) | (usd & (unit == UNITS["pair"]))
    return F.when(to_dollars, dollars).when(usd & (unit == UNITS["single"]), single).otherwise(x)


def _convert_lo(x: Column, unit: Column, usd: Column) -> Column:
    """MTH1 for a lower bound (no rule with a lower bound is ``single``)."""
    to_dollars = (unit == UNITS["usd"]) | (usd & (unit == UNITS["pair"]))
    return F.when(to_dollars, x * F.lit(USD_TO_MVND)).otherwise(x)


# Rule conditions use plain contains/startswith: a null text makes the
# condition null, which a CASE WHEN treats as not matching.

# Every text a rule reads, computed once per row in one flat projection;
# the rules below only pick among these columns.  (Inlining the token
# expressions into each rule made the generated method too long for the
# JIT compiler.)
def _prepared() -> dict[str, Column]:
    s, n = F.col("_s"), F.col("_n")
    after = part(n, LABEL_SEP, 1)  # what follows the label
    tok_after = ws_tokens(after)
    return {
        "_usd": s.contains(USD),
        "_tok1": drop_commas(ws_token(s, 1)),  # second word, without thousands commas
        "_tok_n": ws_tokens(n),  # words of the whole text
        "_d0": part(n, RANGE_SEP, 0),  # all that stands left of the dash
        "_d0_first": first_ws_token(part(n, RANGE_SEP, 0)),  # first word left of the dash
        "_d1_first": first_ws_token(part(n, RANGE_SEP, 1)),  # first word right of the dash
        "_after1": token(tok_after, 1),  # second word after the label
        "_after2": token(tok_after, 2),  # third word after the label
        "_a0": part(after, RANGE_SEP, 0),  # after the label, left of the dash
        "_a0_first": first_ws_token(part(after, RANGE_SEP, 0)),
        "_a1_first": first_ws_token(part(after, RANGE_SEP, 1)),
    }


PREPARED = ("_usd", "_tok1", "_tok_n", "_d0", "_d0_first", "_d1_first", "_after1", "_after2", "_a0", "_a0_first", "_a1_first")


def topcv_rules() -> list[Rule]:
    """DOM2 (also DOM6): ``Tới X [USD|triệu]`` and ``X - Y [USD|triệu]``."""
    s = F.col("_s")
    return [
        Rule(s.startswith(UP_TO), None, F.col("_tok1"), "single"),
        Rule(s.contains(RANGE_MARK), F.col("_d0"), F.col("_d1_first"), "pair"),
    ]


def careerlink_rules() -> list[Rule]:
    """DOM3: ``[Trên] X triệu`` (token count picks the number) and ranges."""
    s, toks = F.col("_s"), F.col("_tok_n")
    single = F.when(F.size(toks) == 2, token(toks, 0)).otherwise(token(toks, 1))
    return [
        Rule(s.contains(MILLION) & ~s.contains(RANGE_MARK), None, single, "single"),
        Rule(s.contains(RANGE_MARK), F.col("_d0_first"), F.col("_d1_first"), "pair"),
    ]


def careerviet_rules() -> list[Rule]:
    """DOM4: text after ``Lương:``; Trên / Lên đến / Tr range / USD range."""
    s = F.col("_s")
    return [
        Rule(s.contains(ABOVE) & ~s.contains(RANGE_MARK), None, F.col("_after1"), "single"),
        Rule(s.contains(UP_TO_CV), None, F.col("_after2"), "single"),
        Rule(s.contains(RANGE_MARK) & s.contains(MILLION_SHORT), F.col("_a0_first"), F.col("_a1_first"), "plain"),
        Rule(s.contains(RANGE_MARK) & s.contains(USD), F.col("_a0"), F.col("_a1_first"), "usd"),
    ]


def itviec_rules() -> list[Rule]:
    """DOM5: the salary is read and discarded."""
    return []


RULES = {
    "topcv": topcv_rules,
    "careerlink": careerlink_rules,
    "careerviet": careerviet_rules,
    "itviec": itviec_rules,
    "vietnamworks": topcv_rules,  # DOM6: the executable rules equal DOM2's
}


def _switch(code: Column, cases: list[tuple[int, Column]], default: Column | None = None) -> Column:
    expr = None
    for k, value in cases:
        expr = F.when(code == k, value) if expr is None else expr.when(code == k, value)
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


def _lookup(code: Column, values: list) -> Column:
    """``values[code]`` (null for a null code)."""
    if not values:
        return F.lit(None)
    return F.element_at(F.array(*[F.lit(v) for v in values]), code + 1)


def _salary_stages(source: str, site: str | None) -> list[dict[str, Column]]:
    """The projections of ``with_salary`` (over columns ``_s`` and ``_n``):
    derived texts; the id of the deciding rule (last match first, per site);
    the two bound texts that rule names; parse once; convert by unit."""
    numbered: list[tuple[int, Rule]] = []
    rule_id = None
    for name in ([site] if site else SOURCES):
        rules = [(len(numbered) + i, r) for i, r in enumerate(RULES[name]())]
        numbered += rules
        chain = None
        for k, rule in reversed(rules):
            chain = F.when(rule.when, F.lit(k)) if chain is None else chain.when(rule.when, F.lit(k))
        if chain is None:
            continue
        picked = chain if site else F.when(F.col(source) == name, chain)
        rule_id = picked if rule_id is None else F.coalesce(rule_id, picked)
    code = F.col("_rule")
    matched = code.isNotNull()
    unit, usd = F.col("_unit"), F.col("_usd")
    good = matched & F.col("_ok")
    return [
        _prepared(),
        {"_rule": rule_id if rule_id is not None else F.lit(None).cast("int")},
        {
            "_lo_text": _switch(code, [(k, r.lo) for k, r in numbered if r.lo is not None]),
            "_hi_text": _switch(code, [(k, r.hi) for k, r in numbered]),
            # per-rule constants: a lookup in a literal array (rule ids are 0..n-1)
            "_unit": _lookup(code, [UNITS[r.unit] for _, r in numbered]),
            "_has_lo": F.coalesce(_lookup(code, [r.lo is not None for _, r in numbered]), F.lit(False)),
        },
        {"_lo": py_float(F.col("_lo_text")), "_hi": py_float(F.col("_hi_text"))},
        {"_ok": ~matched | (F.col("_hi").isNotNull() & (~F.col("_has_lo") | F.col("_lo").isNotNull()))},
        {
            "min_salary": F.when(good & F.col("_has_lo"), _convert_lo(F.col("_lo"), unit, usd)).otherwise(_zero()),
            "max_salary": F.when(good, _convert_hi(F.col("_hi"), unit, usd)).otherwise(_zero()),
            "salary_ok": F.col("_ok"),
        },
    ]


_STAGE_CACHE: dict[tuple, list[dict[str, Column]]] = {}


def _cached_stages(source: str, site: str | None) -> list[dict[str, Column]]:
    """Column expressions are immutable and reusable across DataFrames of
    one SparkContext; building them costs a couple of thousand JVM calls,
    so they are built once per context."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    key = (sc.applicationId if sc is not None else None, source, site)
    if key not in _STAGE_CACHE:
        _STAGE_CACHE.clear()
        _STAGE_CACHE[key] = _salary_stages(source, site)
    return _STAGE_CACHE[key]


def with_salary(df: DataFrame, salary: str = "salary", source: str = "source", site: str | None = None) -> DataFrame:
    """DOM7: min_salary, max_salary (double) and salary_ok for every row.

    One pass over mixed sources in a few flat projections (see
    ``_salary_stages``); ``site`` fixes the site for a single-site frame.
    """
    staged = df.withColumn("_s", strip_ws(F.col(salary))).withColumn("_n", drop_commas(F.col("_s")))
    for stage in _cached_stages(source, site):
        staged = staged.withColumns(stage)
    return staged.drop("_s", "_n", *PREPARED, "_rule", "_lo_text", "_hi_text", "_unit", "_has_lo", "_lo", "_hi", "_ok")


def with_experience(df: DataFrame, exp: str = "exp", source: str = "source") -> DataFrame:
    """DOM1: topcv ``... X năm`` -> X (the second-to-last token); 0 otherwise.
    Adds ``final_exp`` (int) and ``exp_ok``."""
    e = strip_ws(F.col(exp))
    staged = df.withColumn("_e", e)
    applies = (F.col(source) == "topcv") & F.col("_e").contains(YEARS_WORD)
    staged = staged.withColumns(
        {"_applies": F.coalesce(applies, F.lit(False)), "_years": py_int(token(ws_tokens(F.col("_e")), -2))}
    )
    parsed = F.col("_applies") & F.col("_years").isNotNull()
    return staged.withColumns(
        {
            "final_exp": F.when(parsed, F.col("_years")).otherwise(F.lit(0)).cast("int"),
            "exp_ok": ~F.col("_applies") | F.col("_years").isNotNull(),
        }
    ).drop("_e", "_applies", "_years")


def salary_midpoint(min_salary: Column | str = "min_salary", max_salary: Column | str = "max_salary") -> Column:
    """MTH3: a row's salary for averages: midpoint, or half the maximum when
    no minimum is stated (a null minimum also takes the second branch)."""
    lo, hi = col_of(min_salary), col_of(max_salary)
    return F.when(lo > 0, (lo + hi) / 2).otherwise(hi / 2)
