"""Salary reports over a topic that also takes postings back.

A minimum or maximum cannot be un-counted, so the state of a report key is a
counted multiset of its salary pairs: a message adds one, a retraction (the
same row with ``sign`` -1) takes one away, whichever comes first.  Tasks count
equal (key, salaries) before the shuffle, so a key with a third of all
postings moves as its distinct salaries, not as its postings.

A key whose last posting is taken back is emitted once more with a null
``total_jobs``; report tables drop it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.reports import REPORTS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FLUSH_ROWS = 500_000  # distinct counts that a task holds before it passes them on
STATE = "bins array<struct<low:float,high:float,n:bigint>>"
MEASURES = "min_salary float, max_salary float, avg_salary double, total_jobs bigint"
_COUNTS = pa.schema([("dimension", pa.string()), ("key", pa.string()), ("low", pa.float32()), ("high", pa.float32()), ("n", pa.int64())])
COUNTS = "dimension string, key string, low float, high float, n bigint"


def _summed(parts: list[pa.Table]) -> pa.Table:
    keys = ["dimension", "key", "low", "high"]
    return pa.concat_tables(parts).group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"]).select(_COUNTS.names).cast(_COUNTS)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signed counts of each (dimension, key, salaries) of a task's rows."""
    held, size = [], 0
    for batch in batches:
        for dimension, column in (("address", "address_cleaned"), ("source", "source"), ("exp", "final_exp")):
            rows = {"dimension": pa.repeat(dimension, batch.num_rows), "key": batch.column(column), "low": batch.column("min_salary"), "high": batch.column("max_salary"), "n": batch.column("sign")}
            held.append(pa.table(rows, schema=_COUNTS))
            size += batch.num_rows
        if size > FLUSH_ROWS:
            held = [_summed(held)]
            size = held[0].num_rows
            if size > FLUSH_ROWS:
                yield from held.pop().to_batches()
                size = 0
    if held:
        yield from _summed(held).to_batches()


def measures(dimension: str, key: str | None, bins: dict[tuple, int]) -> tuple:
    """(min, max, avg, total) of a multiset of (low, high): the measures of
    the batch reports, or four nulls when no posting is left."""
    live = {pair: n for pair, n in bins.items() if n > 0}
    if not live:
        return None, None, None, None
    low = min((a for a, _ in live if a is not None and a > 0), default=None)
    high = max((b for _, b in live if b is not None), default=None)
    paid, weight = 0.0, 0
    for (a, b), n in live.items():
        if b is not None:
            # 32-bit sum, then halved as a double, like the batch expression
            middle = float(np.float32(a) + np.float32(b)) / 2 if a is not None and a > 0 else b / 2
            paid, weight = paid + n * middle, weight + n
    counted_key = dimension == "address" or key is not None
    return low, high, paid / weight if weight else None, sum(live.values()) if counted_key else 0


class CountedReport(StatefulProcessor):
    """One report key: its multiset, and its measures after every batch."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("salaries", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self.state.get()[0] if self.state.exists() else []
        bins = {(a, b): n for a, b, n in kept}
        for frame in rows:
            for a, b, n in zip(frame["low"].tolist(), frame["high"].tolist(), frame["n"].tolist()):
                pair = (None if a is None or a != a else a, None if b is None or b != b else b)
                bins[pair] = bins.get(pair, 0) + int(n)
        bins = {pair: n for pair, n in bins.items() if n}  # a count below 0 waits for its posting
        self.state.update(([(a, b, n) for (a, b), n in bins.items()],))
        out = dict(zip(("dimension", "key", "min_salary", "max_salary", "avg_salary", "total_jobs"), ([v] for v in (*key, *measures(*key, bins)))))
        frame = pd.DataFrame(out)
        yield frame.astype({"min_salary": "float32", "max_salary": "float32", "avg_salary": "float64", "total_jobs": "Int64"})

    def close(self) -> None:
        pass


def retractable_reports(places: DataFrame) -> DataFrame:
    """The three reports of a stream of job places with a ``sign`` column, in
    the columns of ``operators.reports.market_reports``."""
    rows = places.select(
        "address_cleaned", "source", F.col("final_exp").cast("string").alias("final_exp"), F.col("min_salary").cast("float"), F.col("max_salary").cast("float"),
        F.coalesce("sign", F.lit(1)).cast("bigint").alias("sign"),
    )
    kept = rows.mapInArrow(counted, COUNTS).groupBy("dimension", "key").transformWithStateInPandas(CountedReport(), f"dimension string, key string, {MEASURES}", "Update", "None")
    of = lambda kind: F.when(F.col("dimension") == kind, F.col("key"))
    return kept.select(
        "dimension", "key", *[of(kind).cast("int" if kind == "exp" else "string").alias(column) for kind, (column, _) in REPORTS.items()],
        "min_salary", "max_salary", "avg_salary", "total_jobs",
    )
