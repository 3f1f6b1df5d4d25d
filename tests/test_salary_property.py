"""Random salary texts built from known amounts: what was put in must come out
(in million VND a month), whatever the padding, commas and unit."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from joblens.operators.clean import parse_listings

PAD = st.sampled_from(["", " ", "  ", "\t", "\n", " ", "　"])
GAP = st.sampled_from([" ", "  ", "\t", " "])

# Site -> forms: (text with {a}, {b} as amounts and {g} as a gap, bounds stated, unit).
MILLION, DOLLAR = "million", "dollar"
FORMS = {
    "topcv": [
        ("Tới{g}{b}{g}triệu", "b", MILLION), ("Tới{g}{b}{g}USD", "b", DOLLAR),
        ("{a} - {b}{g}triệu", "ab", MILLION), ("{a} - {b}{g}USD", "ab", DOLLAR),
        ("Thoả thuận", "", MILLION), ("Trên {b} triệu", "", MILLION), ("{a}-{b} triệu", "?", MILLION), ("Tới", "?", MILLION),
    ],
    "careerlink": [
        ("{b}{g}triệu", "b", MILLION), ("Trên{g}{b}{g}triệu", "b", MILLION),
        ("{a}{g}triệu - {b}{g}triệu", "ab", MILLION), ("{a}{g}USD - {b}{g}USD", "ab", DOLLAR),
        ("Thương lượng", "", MILLION), ("Trên {b} USD", "", DOLLAR),
    ],
    "careerviet": [
        ("Lương: Trên{g}{b}{g}Tr VND", "b", MILLION), ("Lương: Trên{g}{b}{g}USD", "b", DOLLAR),
        ("Lương: Lên đến{g}{b}{g}Tr VND", "b", MILLION), ("Lương: Lên đến{g}{b}{g}USD", "b", DOLLAR),
        ("Lương: {a}{g}Tr - {b}{g}Tr VND", "ab", MILLION), ("Lương: {a} - {b}{g}USD", "ab", DOLLAR),
        ("Lương: Cạnh tranh", "", MILLION), ("Trên {b} Tr VND", "?", MILLION),
    ],
    "vietnamworks": [
        ("Tới{g}{b}{g}USD", "b", DOLLAR), ("{a} - {b}{g}triệu", "ab", MILLION), ("{a} - {b}{g}USD", "ab", DOLLAR),
        ("Thương lượng", "", MILLION), ("Tới $ {b} /tháng", "?", DOLLAR), ("{a}tr-{b}tr ₫/tháng", "?", MILLION),
    ],
    "itviec": [("Sign in to view salary", "", MILLION), ("{a} - {b} triệu", "", MILLION)],
}


@st.composite
def cases(draw):
    site = draw(st.sampled_from(sorted(FORMS)))
    form, stated, unit = draw(st.sampled_from(FORMS[site]))
    a, b = draw(st.integers(0, 9999)), draw(st.integers(1, 9999))
    number = "{:,}" if draw(st.booleans()) else "{}"
    text = draw(PAD) + form.format(a=number.format(a), b=number.format(b), g=draw(GAP)) + draw(PAD)
    lo, hi = (float(a) if "a" in stated else 0.0), (float(b) if "b" in stated else 0.0)
    if unit == DOLLAR:
        lo, hi = lo * 0.025, hi * 0.025
        if stated == "b" and hi > 100:  # a yearly amount
            hi = float(math.floor(hi / 12))
    return site, text, (lo, hi, stated != "?")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cases(), min_size=1, max_size=40))
def test_stated_amounts_come_out(spark, listings):
    df = spark.createDataFrame([(i, s, t, "p", "c", "a") for i, (s, t, _) in enumerate(listings)],
                               "i int, source string, salary string, position string, company string, address string")
    got = {r.i: (r.min_salary, r.max_salary, r.salary_ok) for r in parse_listings(df).collect()}
    for i, (site, text, want) in enumerate(listings):
        assert got[i] == want, (site, text, got[i], want)


# Numbers that are none, or that only a lenient reader takes.
ODD = [("abc", None), ("1.5d", None), ("0x10", None), ("", None), ("10tr", None), ("1.5", 1.5), ("2_000", 2000.0), ("1e3", 1000.0), (".5", 0.5), ("+7", 7.0)]


def test_odd_numbers(spark):
    df = spark.createDataFrame([(i, "topcv", f"Tới {n} triệu", "p", "c", "a") for i, (n, _) in enumerate(ODD)],
                               "i int, source string, salary string, position string, company string, address string")
    for r in parse_listings(df).collect():
        number, value = ODD[r.i]
        if number:
            assert (r.max_salary, r.salary_ok) == ((value, True) if value is not None else (0.0, False)), number


def test_floor_division_of_huge_amounts(spark):
    from joblens.functions.salary import floor_div
    from pyspark.sql import functions as F

    values = [150.0, 1e30, float("inf"), float("nan"), 119.99999999999999, 2.0**60]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(floor_div(F.col("v"), 12)).collect()]
    for v, g in zip(values, got):
        assert (math.isnan(g) and math.isnan(v // 12)) or math.isclose(g, v // 12, rel_tol=1e-15), v
