"""JSON wire format (JSN1-JSN3, SRC2-SRC3, DTE2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import JOB_WIRE


def row_json(df: DataFrame, keep_nulls: bool = True) -> Column:
    """JSN1/JSN3: whole row as a JSON object.

    ``keep_nulls=True`` writes ``null`` fields the way the producer did;
    ``False`` omits them, as the report messages did.
    """
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), options)


def decode_value(value: Column | str = "value") -> Column:
    """SRC2: binary payload -> UTF-8 string."""
    v = F.col(value) if isinstance(value, str) else value
    return v.cast("string")


def parse_json(df: DataFrame, schema: StructType = JOB_WIRE, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC3: typed row from a JSON payload (PERMISSIVE).

    Garbage or null payloads become all-null rows; a single bad field becomes
    null on its own.  Pass a narrower schema to parse only what is used;
    ``keep`` names columns of ``df`` to carry along.
    """
    return df.select(*keep, F.from_json(decode_value(value), schema).alias("data")).select(*keep, "data.*")
