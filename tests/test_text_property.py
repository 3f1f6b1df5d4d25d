"""Random texts: place split and whitespace handling against Python."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from joblens.functions.places import explode_places
from joblens.functions.text import PY_WHITESPACE, first_ws_token, strip_ws, ws_tokens

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def pieces(alphabet):
    return st.lists(st.sampled_from(alphabet), max_size=12).map("".join)


@SETTINGS
@given(st.lists(pieces(["Hà", " ", "Nội", ",", "-", "&", "\n", "\r", "|", "\t", " ", "HCM"]), min_size=1, max_size=30))
def test_places_match_python(spark, addresses):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, address string")
    got = {}
    for r in explode_places(df).collect():
        got.setdefault(r.i, []).append(r.address_cleaned)
    for i, a in enumerate(addresses):
        want = [p.strip(" ") for p in re.sub(r"[\n\r&,\-]+", "|", a).split("|")]
        assert got[i] == want, repr(a)


@SETTINGS
@given(st.lists(pieces(list(PY_WHITESPACE) + ["a", "b", "10", "​"]), min_size=1, max_size=30))
def test_whitespace_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", strip_ws("t").alias("s"), ws_tokens("t").alias("toks"), first_ws_token("t").alias("f")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.s == t.strip() and r.toks == t.split(), repr(t)
        assert r.f == (t.split()[0] if t.split() else ""), repr(t)


def test_fold_symbols(spark):
    from joblens.functions.text import fold_ascii

    cases = {
        "Bà Rịa – Vũng Tàu": "Ba Ria - Vung Tau", "a—b": "a--b", "“x” ‘y’ …": "\"x\" 'y' ...", "ＡＢＣ１２！": "ABC12!",
        "½ ª × № ₫ •": "1/2 a x No d *", "Ɓ ƒ": "B f", "x\u00a0y\u3000z": "x y z", "日本": "日本", "´ ¨": "´ ¨", "ﬁ Ⅳ": "fi IV",
    }
    df = spark.createDataFrame(list(cases.items()), "a string, b string")
    for r in df.select("a", "b", fold_ascii("a").alias("f")).collect():
        assert r.f == r.b, r.a


def test_fold_covers_every_dash_sign_and_letter_form(spark):
    """Every code point by the rule, in one text per character."""
    import sys
    import unicodedata

    from joblens.functions.text import fold_ascii, fold_tables

    matching, replace, _, multi = fold_tables()
    want = dict(zip(matching, replace)) | multi
    cases = {
        "\u2212": "-", "\ufe58": "-", "\ufe63": "-", "\u2e3a": "-", "\u2460": "1", "\u3251": "21", "\U0001d400": "A", "\ua732": "AA", "\ua749": "l", "\u1e9e": "SS", "\ua7a1": "g",
        "\u33a1": "m2", "\u2474": "(1)", "\u00e6": "ae", "\u0111": "d", "\u3220": None, "\u6f22": None, "\u03b1": None,
    }
    assert all(want.get(ch) == out for ch, out in cases.items() if ch != "\u1e9e")
    every = [chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    assert all(want[c] in ("-", "--") for c in every if unicodedata.category(c) == "Pd") and all(want[c] == " " for c in every if unicodedata.category(c) == "Zs")
    df = spark.createDataFrame([("a" + c + "b" + c, "a" + o + "b" + o) for c, o in want.items()] + [("".join(want), "".join(want.values())), (None, None), ("", "")], "t string, w string")
    assert df.where(~fold_ascii("t").eqNullSafe(df.w)).count() == 0


def test_numbers_in_digits_of_any_script(spark):
    from joblens.functions.text import py_float, py_int

    texts = ["１２", "１２.５", "٣٤", "1٢３", "-９", "１_０", "½", "²", "１２abc", "", "𝟙𝟚", "1२e１"]

    def plain(kind, t):
        try:
            return kind(t)
        except ValueError:
            return None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", py_float("t").alias("f"), py_int("t").alias("i")).collect()
    for r in rows:
        assert (r.f, r.i) == (plain(float, r.t), plain(int, r.t)), r.t
