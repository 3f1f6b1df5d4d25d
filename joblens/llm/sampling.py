"""Bounded training samples of labelled rows, the same rows on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out


def bounded_share(rows: DataFrame, bound: int, *by: str) -> Column:
    """Condition that keeps about ``bound`` rows (of each value of ``by``),
    chosen by a hash of doc_id; all rows where there are no more than that."""
    counts = rows.groupBy(*by).count().collect() if by else rows.agg(F.count("*").alias("count")).collect()
    dice = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for r in counts:
        here = F.lit(True)
        for c in by:
            here = here & F.col(c).eqNullSafe(F.lit(r[c]))
        keep = keep | (here & (dice <= min(1.0, bound / max(r["count"], 1))))
    return keep


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, y) of at most about ``bound`` labelled rows outside the
    held-out part.  A doc_id labelled twice takes its larger label.  The
    chosen labels number at most ``bound``, so they are broadcast."""
    marked = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    marked = marked.where(bounded_share(marked, bound))
    return docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
