"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios.

Texts are lower-cased and everything but letters becomes a blank.  A feature
is the presence of a hashed character n-gram.  On a bounded sample of
labelled documents each n-gram gets its smoothed naive Bayes log-count ratio
r; the n-grams whose ratio stands out most from chance are kept, and a
logistic regression is fitted on the presence vectors scaled by r.  Scoring
walks every whole text once.

Edge cases: null, empty and letterless texts have no n-gram and get the
score of the intercept; with no labelled rows of one class every score is the share of
label 1 (0 with no labelled rows at all); very long texts are scored whole;
repeated rows are scored one by one; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, release, slices, table, utf8
from .pieces import code_points
from .sampling import labelled_sample

SIZES = (3, 4, 5)  # characters
BINS = 1 << 20
KEPT = 8_000  # n-grams in the regression
SAMPLE = 8_000  # labelled documents in the fit
SMOOTHING = 0.5
PENALTY = 1.0
THRESHOLD = 0.3
STEP = 1 << 18  # bytes of text worked on at once
ROWS_STEP = 1 << 20  # features worked on at once in the regression


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with non-letters of ASCII as blanks, and their byte positions."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead]
    low = np.full(256, 0x20, np.uint32)
    low[ord("a") : ord("z") + 1] = range(ord("a"), ord("z") + 1)
    cp = low[first]
    many = np.flatnonzero(first >= 0xC0)
    if len(many):
        cp[many] = code_points(data, lead[many])
    return cp, lead


def grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    """Per row range [a, b): the places of its texts (b - a + 1 offsets) and,
    per n-gram size, the bin of the n-gram that starts at each place.  A
    blank stands before and after each text."""
    data, offsets = utf8(pc.utf8_lower(column.cast(pa.large_string())))
    for a, b in slices(offsets, STEP):
        cp, lead = letters(data[offsets[a] : offsets[b]])
        ends = np.searchsorted(lead, offsets[a : b + 1] - offsets[a])
        places = ends + 2 * np.arange(b - a + 1)
        text = np.full(places[-1], 0x20, np.uint32)
        text[np.arange(len(cp)) + np.repeat(2 * np.arange(b - a) + 1, np.diff(ends))] = cp
        h, bins = text, []
        for n in range(2, max(SIZES) + 1):
            h = h[: max(len(text) - n + 1, 0)] * np.uint32(0x9E3779B1) + text[n - 1 :]
            if n in SIZES:
                bins.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)) >> np.uint32(12))
        yield a, b, places, bins


def distinct(bins: list[np.ndarray], places: np.ndarray, k: int, stamp: np.ndarray) -> np.ndarray:
    """Distinct bins of the k-th text; ``stamp`` is scratch space of BINS numbers."""
    own = np.concatenate([h[places[k] : max(places[k], places[k + 1] - n + 1)] for n, h in zip(SIZES, bins)])
    order = np.arange(len(own), dtype=np.int32)
    stamp[own] = order
    return own[stamp[own] == order]


def present(column: pa.Array, index: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Distinct (document, kept feature) pairs per row range; ``index`` maps a
    bin to its feature or -1."""
    for a, b, places, bins in grams(column):
        keys = []
        for n, h in zip(SIZES, bins):
            f = index[h]
            at = np.flatnonzero(f >= 0)
            doc = np.searchsorted(places, at, "right") - 1
            inside = at + n <= places[doc + 1]
            keys.append(doc[inside] * np.int64(BINS) + f[at[inside]])
        key = np.unique(np.concatenate(keys))
        yield a, b, key // BINS, key % BINS


def fit(columns: list[pa.Array], y: np.ndarray) -> tuple[np.ndarray, float]:
    """(weight per bin, intercept)."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return np.zeros(BINS, np.float32), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    counts, at, stamp = np.zeros((2, BINS), np.int32), 0, np.zeros(BINS, np.int32)
    for col in columns:
        for a, b, places, bins in grams(col):
            for k in range(b - a):
                counts[y[at + a + k], distinct(bins, places, k, stamp)] += 1
        at += len(col)
    n = np.array([[np.sum(y == 0)], [np.sum(y == 1)]], float)
    rate = (counts + SMOOTHING) / (n + 2 * SMOOTHING)
    ratio = np.log(rate[1]) - np.log(rate[0])
    spread = np.sqrt(1 / (counts[0] + SMOOTHING) + 1 / (counts[1] + SMOOTHING))
    z = np.where(counts.sum(0) >= 3, np.abs(ratio) / spread, 0)
    chosen = np.argsort(-z, kind="stable")[:KEPT]
    chosen = chosen[z[chosen] > 0]
    index = np.full(BINS, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    r = ratio[chosen]
    feats, sizes = [], []
    for col in columns:
        for a, b, d, f in present(col, index):
            feats.append(f.astype(np.int16 if KEPT <= 1 << 15 else np.int32))
            sizes.append(np.bincount(d, minlength=b - a))
    w, bias = logistic(np.concatenate(feats), np.concatenate(sizes), r, y.astype(float), len(chosen))
    weights = np.zeros(BINS, np.float32)
    weights[chosen] = w * r
    return weights, bias


def logistic(feats: np.ndarray, sizes: np.ndarray, r: np.ndarray, y: np.ndarray, size: int, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Penalised logistic regression on features scaled by r, by Adam on the
    whole sample.  ``feats`` holds the features of document after document,
    ``sizes`` their counts; rows are taken some at a time to bound memory."""
    w, bias = np.zeros(size), float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    ends = np.cumsum(sizes)
    cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]) + ROWS_STEP, ROWS_STEP)).clip(0, len(y)))
    cuts = np.unique(np.concatenate([[0], cuts, [len(y)]]))
    for t in range(1, rounds + 1):
        wr, g, missed = w * r, np.zeros(size), 0.0
        for a, b in zip(cuts, cuts[1:]):
            own = feats[ends[a] - sizes[a] : ends[b - 1]]
            doc = np.repeat(np.arange(b - a), sizes[a:b])
            margin = bias + np.bincount(doc, weights=wr[own], minlength=b - a)
            miss = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[a:b]
            g += np.bincount(own, weights=miss[doc], minlength=size)
            missed += miss.sum()
        g = np.append(r * g + PENALTY * w, missed) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9) * min(1, 4 * (1 - t / (rounds + 1)))
        w -= step[:-1]
        bias -= step[-1]
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Model fitted by one task on at most about ``sample`` labelled documents."""

    def fitted(batches):
        columns, ys = [], []
        for batch in batches:
            columns.append(batch.column(0))
            ys.append(batch.column(1).to_numpy(zero_copy_only=False))
        weights, bias = fit(columns, np.concatenate(ys) if ys else np.zeros(0, np.int32))
        columns.clear()
        release()
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], names=["w", "b"])

    rows = labelled_sample(docs, labels, label, sample).orderBy("doc_id").select("text", "y").coalesce(1)
    got = rows.mapInArrow(fitted, "w binary, b double").collect()
    return (np.frombuffer(got[0]["w"], np.float32), got[0]["b"]) if got else (np.zeros(BINS, np.float32), -20.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole ``text``."""
    spark = docs.sparkSession
    weights, bias = model
    kept = np.flatnonzero(weights)
    shared = spark.sparkContext.broadcast((kept.astype(np.int32), weights[kept], bias))  # KEPT entries at most

    @F.arrow_udf("double")
    def scored(texts):
        kept, w, bias = shared.value
        index = np.full(BINS, -1, np.int32)
        index[kept] = np.arange(len(kept))
        out = np.full(len(texts), bias)
        if len(kept):
            for a, b, d, f in present(texts, index):
                out[a:b] += np.bincount(d, weights=w[f], minlength=b - a)
        release()
        return pa.array(1 / (1 + np.exp(-np.clip(out, -40, 40))))

    return docs.withColumn(name, scored(F.col("text")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = score(docs, model).select("doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
