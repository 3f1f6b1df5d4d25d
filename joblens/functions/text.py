"""String expressions (STR1-STR9, CST1) as native Column functions.

All of these stay inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace (``str.isspace()``): the characters ``str.strip()``
# and ``str.split()`` cut at, derived from the running interpreter.
PY_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_WS_OTHER = PY_WHITESPACE.replace(" ", "")


def _pads_number(ch: str) -> bool:
    try:
        float(ch + "1" + ch)
        return True
    except ValueError:
        return False


# The whitespace float()/int() ignore around a literal: all of the above
# except the four information separators (\x1c-\x1f), which split() cuts at
# but number parsing rejects.
NUMBER_PADDING = "".join(c for c in PY_WHITESPACE if _pads_number(c))

# Python float()/int() literal grammar (digits may carry single underscores);
# Spark's cast alone would also accept forms Python rejects ("1.5d", hex).
_DIGITS = r"\d(?:_?\d)*"
_PY_FLOAT = (
    r"^[+-]?(?:(?:" + _DIGITS + r"\.?(?:" + _DIGITS + r")?|\." + _DIGITS + r")"
    r"(?:[eE][+-]?" + _DIGITS + r")?|(?i:inf|infinity|nan))$"
)
_PY_INT = r"^[+-]?" + _DIGITS + r"$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """STR1: Python ``str.strip()`` (all Unicode whitespace, both ends);
    ``btrim`` with an explicit set is far cheaper than a regex."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def ws_tokens(c: Column | str) -> Column:
    """STR5: Python ``str.split()``: runs of whitespace, no empty tokens.

    Every whitespace character becomes a space (``translate``), the text is
    cut at single spaces (no regex) and the empty pieces between adjacent
    cuts are dropped, which is exactly splitting at runs.
    """
    spaced = F.translate(col_of(c), _WS_OTHER, " " * len(_WS_OTHER))
    return F.array_remove(F.split(spaced, " "), "")


def ws_token(c: Column | str, k: int) -> Column:
    """``s.split()[k]``; null when out of range."""
    return token(ws_tokens(c), k)


def first_ws_token(c: Column | str) -> Column:
    """``s.split()[0]`` without building an array; ``''`` when there is no
    token (it parses to null, like the missing token it stands for)."""
    spaced = F.translate(col_of(c), _WS_OTHER, " " * len(_WS_OTHER))
    return F.substring_index(F.ltrim(spaced), " ", 1)


def token(arr: Column, k: int) -> Column:
    """pandas ``.str[k]`` on a list: k-th element (negative from the end),
    null when out of range."""
    return F.try_element_at(arr, F.lit(k + 1 if k >= 0 else k))


def part(c: Column | str, sep: str, k: int) -> Column:
    """STR7: ``s.split(sep)[k]`` for a literal separator (``' - '``, ``':'``);
    ``''`` when there is no such part (parsed to null downstream)."""
    return F.split_part(col_of(c), F.lit(sep), F.lit(k + 1))


def drop_commas(c: Column | str) -> Column:
    """STR4: remove thousands separators."""
    return F.translate(col_of(c), ",", "")


@lru_cache(maxsize=1)
def decimal_digits() -> tuple[str, str]:
    """All decimal digits (category Nd) outside ASCII, and their values."""
    found = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(found), "".join(str(unicodedata.digit(c)) for c in found)


def _ascii_digits(c: Column) -> Column:
    return F.translate(c, *decimal_digits())


def py_float(c: Column | str) -> Column:
    """CST1: ``float(token)``; null where Python would raise (or the token
    is missing, pandas NaN).  Decimal digits of any script count."""
    c = _ascii_digits(F.btrim(col_of(c), F.lit(NUMBER_PADDING)))
    value = F.replace(c, F.lit("_"), F.lit("")).try_cast("double")
    # Spark's cast rejects a signed NaN, which float() accepts
    signed_nan = F.when(c.rlike(r"^[+-](?i:nan)$"), F.lit(float("nan")))
    return F.when(c.rlike(_PY_FLOAT), F.coalesce(value, signed_nan))


def py_int(c: Column | str) -> Column:
    """CST1: ``int(token)``; null where Python would raise."""
    c = _ascii_digits(F.btrim(col_of(c), F.lit(NUMBER_PADDING)))
    return F.when(c.rlike(_PY_INT), F.replace(c, F.lit("_"), F.lit("")).try_cast("int"))


def contains(c: Column | str, needle: str) -> Column:
    """STR2 with pandas ``na=False``: null text is simply not a match."""
    return F.coalesce(col_of(c).contains(needle), F.lit(False))


def startswith(c: Column | str, prefix: str) -> Column:
    """STR3, null-safe."""
    return F.coalesce(col_of(c).startswith(prefix), F.lit(False))


# --------------------------------------------------------------------------
# STR9: ASCII transliteration.
#
# The map is derived from all code points, not listed: a character keeps the
# ASCII part of its decomposition (NFKD); a Latin letter without one has the
# letter of its Unicode name; dashes and the minus sign become "-", spaces " ";
# combining marks are deleted.  What is left comes from the short fixed list.

# Transliterations without a Unicode decomposition (these are
# the values the wire text must carry).
FOLD_EXTRAS = {
    "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o",
    "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t",
    "ı": "i", "ĸ": "q", "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE",
    "œ": "oe", "Þ": "Th", "þ": "th", "Ŋ": "NG", "ŋ": "ng",
    "Ɓ": "B", "ɓ": "b", "Ɗ": "D", "ɗ": "d", "ƒ": "f", "Ƙ": "K", "ƙ": "k",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"',
    "‹": "<", "›": ">", "«": "<<", "»": ">>", "•": "*", "·": "*", "×": "x", "÷": "/",
    "⁄": "/", "¡": "!", "¿": "?", "₫": "d", "€": "EUR", "£": "GBP", "¥": "JPY",
    "—": "--", "―": "--",
}

# Combining marks of Latin letters (blocks).
_MARKS = ((0x0300, 0x036F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
_LATIN = re.compile(r"LATIN (CAPITAL|SMALL) LETTER ([A-Z]{1,2})(?: WITH .*)?")
_MINUS = "\u2212"


def _folded(ch: str) -> str:
    """ASCII for one character; empty where it has none."""
    if ch in FOLD_EXTRAS:
        return FOLD_EXTRAS[ch]
    kind = unicodedata.category(ch)
    if kind == "Pd" or ch == _MINUS:
        return "-"
    if kind == "Zs":
        return " "
    out = ""
    for x in unicodedata.normalize("NFKD", ch) if unicodedata.decomposition(ch) else "":
        if ord(x) < 128:
            out += x
        elif x in FOLD_EXTRAS or x == _MINUS or unicodedata.category(x) == "Pd":
            out += FOLD_EXTRAS.get(x, "-")
        elif unicodedata.category(x) in ("Lu", "Ll", "Lo", "Lt"):
            return ""  # partly in another script
    if not out.strip():  # a spacing accent decomposes to a blank and a mark
        if kind not in ("Lu", "Ll"):
            return ""
        name = _LATIN.fullmatch(unicodedata.name(ch, ""))
        return (name[2].lower() if name[1] == "SMALL" else name[2]) if name else ""
    return out.strip()


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, str, dict[str, str]]:
    """(matching, replace, deleted) for ``translate``, and what becomes
    several letters."""
    single: dict[str, str] = {}
    multi: dict[str, str] = {}
    for ch in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(ch)[0] not in "CM" and (out := _folded(ch)):
            (single if len(out) == 1 else multi)[ch] = out
    deleted = "".join(chr(cp) for lo, hi in _MARKS for cp in range(lo, hi + 1))
    return "".join(single), "".join(single.values()), deleted, multi


def fold_ascii(c: Column | str) -> Column:
    """STR9: ``Hà Nội`` -> ``Ha Noi``, ``straße`` -> ``strasse``, ``Rịa – Vũng``
    -> ``Ria - Vung``.

    Scripts other than Latin pass through unchanged (documented limit).
    One ``translate`` does all single letters and marks.  What then lies
    beyond ASCII is looked up character by character, each once, so texts
    without such a character pay one comparison of lengths.
    """
    matching, replace, deleted, multi = fold_tables()
    # translate deletes characters that have no replacement: the marks go last
    text = F.translate(col_of(c), matching + deleted, replace)
    table = F.from_json(F.lit(json.dumps(multi)), "map<string,string>")

    def spelled(t: Column) -> Column:
        beyond = F.array_distinct(F.split(F.regexp_replace(t, r"[\x00-\x7f]+", ""), ""))
        return F.aggregate(F.filter(beyond, lambda ch: ch != ""), t, lambda acc, ch: F.replace(acc, ch, F.coalesce(F.try_element_at(table, ch), ch)))

    return F.get(F.transform(F.array(text), lambda t: F.when(F.octet_length(t) == F.char_length(t), t).otherwise(spelled(t))), 0)
