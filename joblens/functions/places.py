"""Place normalisation (DOM8 = STR10 -> STR11 -> ARR1 -> STR12).

One job becomes one row per place.  Separators are newline, CR, ``&``, ``,``
and ``-``; a run of them collapses to one cut, but blank segments survive
(``"Ha Noi - , HCM"`` gives a blank place), and so does a literal ``|``.
Only ASCII spaces are trimmed, as the reference's ``trim`` did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_of

# The separator class and the cut marker of the reference.
PLACE_SEPARATORS = r"[\n\r&,\-]+"
CUT = "|"


def place_array(address: Column | str) -> Column:
    """STR10 + STR11: the address cut into raw segments (null stays null)."""
    marked = F.regexp_replace(col_of(address), PLACE_SEPARATORS, CUT)
    return F.split(marked, r"\|")


def explode_places(df: DataFrame, address: str = "address", out: str = "address_cleaned") -> DataFrame:
    """ARR1 + STR12: one row per place; jobs with a null address vanish."""
    return df.withColumn(out, F.explode(place_array(address))).withColumn(out, F.trim(F.col(out)))
