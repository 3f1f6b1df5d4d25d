"""Golden vectors for the cleaning rules (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from joblens.functions.places import explode_places
from joblens.functions.text import fold_ascii, py_float, py_int, strip_ws, ws_tokens
from joblens.operators.clean import parse_listings

SALARY = [
    # source, text, min, max, ok
    ("topcv", "Thoả thuận", 0, 0, True),
    ("topcv", "Tới 30 triệu", 0, 30, True),
    ("topcv", "Tới 1,500 USD", 0, 37.5, True),
    ("topcv", "Tới 4,000 USD", 0, 100, True),
    ("topcv", "Tới 6,000 USD", 0, 12, True),
    ("topcv", "10 - 15 triệu", 10, 15, True),
    ("topcv", "1,000 - 2,000 USD", 25, 50, True),
    ("topcv", "5,000 - 6,000 USD", 125, 150, True),
    ("topcv", "Trên 20 triệu", 0, 0, True),
    ("topcv", "10-15 triệu", 0, 0, False),
    ("topcv", "  Tới 30 triệu  ", 0, 30, True),
    ("topcv", "5\u00a0 - 10 triệu", 5, 10, True),  # float() ignores NBSP padding
    ("vietnamworks", "5\x1c - 10 triệu", 0, 0, False),  # ...but not \x1c
    ("careerlink", "Thương lượng", 0, 0, True),
    ("careerlink", "15 triệu", 0, 15, True),
    ("careerlink", "Trên 15 triệu", 0, 15, True),
    ("careerlink", "10 triệu - 20 triệu", 10, 20, True),
    ("careerlink", "1,000 USD - 2,000 USD", 25, 50, True),
    ("careerlink", "Trên 1,000 USD", 0, 0, True),
    ("careerlink", "triệu", 0, 0, False),
    ("careerviet", "Lương: Cạnh tranh", 0, 0, True),
    ("careerviet", "Lương: Trên 10 Tr VND", 0, 10, True),
    ("careerviet", "Lương: Trên 1,000 USD", 0, 25, True),
    ("careerviet", "Lương: Trên 6,000 USD", 0, 12, True),
    ("careerviet", "Lương: Lên đến 20 Tr VND", 0, 20, True),
    ("careerviet", "Lương: Lên đến 2,000 USD", 0, 50, True),
    ("careerviet", "Lương: 10 Tr - 15 Tr VND", 10, 15, True),
    ("careerviet", "Lương: 1,000 - 2,000 USD", 25, 50, True),
    ("careerviet", "10 Tr - 15 Tr VND", 0, 0, False),
    ("itviec", "Up to $3000", 0, 0, True),
    ("vietnamworks", "Thương lượng", 0, 0, True),
    ("vietnamworks", "Từ $ 500 /tháng", 0, 0, True),
    ("vietnamworks", "Tới 2,000 USD", 0, 50, True),
    ("vietnamworks", "Tới 6,000 USD", 0, 12, True),
    ("vietnamworks", "10 - 20 triệu", 10, 20, True),
    ("vietnamworks", "Tới $ 2,000 /tháng", 0, 0, False),
    ("vietnamworks", "10tr-20tr ₫/tháng", 0, 0, False),
]


def test_salary_golden(spark):
    rows = [(i, s, t) for i, (s, t, *_rest) in enumerate(SALARY)]
    df = spark.createDataFrame(rows, "i int, source string, salary string")
    df = df.withColumns({"position": F.lit("p"), "company": F.lit("c"), "address": F.lit("a")})
    got = {r.i: (r.min_salary, r.max_salary, r.salary_ok) for r in parse_listings(df).collect()}
    for i, (source, text, lo, hi, ok) in enumerate(SALARY):
        assert got[i] == (lo, hi, ok), (source, text, got[i])


@pytest.mark.parametrize(
    "text,years,ok",
    [("Không yêu cầu", 0, True), ("2 năm", 2, True), ("Dưới 1 năm", 1, True), ("Trên 5 năm", 5, True), ("năm", 0, False)],
)
def test_experience_golden(spark, text, years, ok):
    df = spark.createDataFrame([("topcv", text, "x")], "source string, exp string, salary string")
    df = df.withColumns({"position": F.lit("p"), "company": F.lit("c"), "address": F.lit("a")})
    r = parse_listings(df).collect()[0]
    assert (r.final_exp, r.exp_ok) == (years, ok)


def test_experience_other_sites_is_zero(spark):
    df = spark.createDataFrame([("itviec", "3 năm", "x")], "source string, exp string, salary string")
    df = df.withColumns({"position": F.lit("p"), "company": F.lit("c"), "address": F.lit("a")})
    assert parse_listings(df).collect()[0].final_exp == 0


def test_fold(spark):
    pairs = [("Hà Nội", "Ha Noi"), ("Đà Nẵng", "Da Nang"), ("Hồ Chí Minh", "Ho Chi Minh"), ("Kỹ sư", "Ky su"),
             ("straße", "strasse"), ("Ưu đãi Ơn", "Uu dai On"), ("Œuvre æ", "OEuvre ae"), ("東京", "東京")]
    df = spark.createDataFrame([(a,) for a, _ in pairs], "t string")
    got = [r[0] for r in df.select(fold_ascii("t")).collect()]
    assert got == [b for _, b in pairs]


def test_places(spark):
    cases = {
        "Ha Noi, HCM": ["Ha Noi", "HCM"],
        "Ha Noi,": ["Ha Noi", ""],
        "Ha Noi - , HCM": ["Ha Noi", "", "HCM"],
        "A|B": ["A", "B"],
        "A\n&B": ["A", "B"],
        "TP-HCM": ["TP", "HCM"],
        ",X": ["", "X"],
        "": [""],
    }
    rows = [(i, a) for i, a in enumerate(cases)] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, address string")
    out = {}
    for r in explode_places(df).collect():
        out.setdefault(r.i, []).append(r.address_cleaned)
    for i, (addr, want) in enumerate(cases.items()):
        assert out[i] == want, addr
    assert 99 not in out  # a null address yields no row


def test_python_float_grammar(spark):
    vals = ["12", "1_000", "1e3", " 7 ", "1.5d", "0x10", "$", "", None, "-3.5", ".5", "inf",
            "5\u00a0", "\u30007", "\x1c3", "\t8\n", "1 2", "+nan", "-NaN", "-Infinity"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for fn, py in ((py_float, float), (py_int, int)):
        got = [r[0] for r in df.select(fn("v")).collect()]
        want = []
        for v in vals:
            try:
                want.append(py(v))
            except (TypeError, ValueError):
                want.append(None)
        same = [(g is None and w is None) or (g is not None and w is not None and (g == w or (g != g and w != w)))
                for g, w in zip(got, want)]
        assert all(same), (fn.__name__, got, want)


def test_whitespace_tokens(spark):
    vals = ["  a  b\tc ", "", "x", "\u00a0y\u00a0", "\u00a0z\u3000w\u2009", "\x1cq\x1f", "\u200bkeep"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(ws_tokens("v")).collect()]
    assert got == [v.split() for v in vals]
    got = [r[0] for r in df.select(strip_ws("v")).collect()]
    assert got == [v.strip() for v in vals]
