"""Quality: a linear-chain conditional random field over the lines of a document.

Every line has features of its bytes (shares of character kinds, length, word
length, repetition) and the same features of the lines before and after.  The
chain has two labels, bad (0) and good (1); it is fitted on a bounded sample
of labelled documents whose lines all carry the document's label.  A document
scores the mean marginal probability of "good" of its lines, weighted by
their lengths in bytes.

Edge cases: a null, empty or blank text is one empty line and is scored as
such; with no labelled rows of one class every score is the share of label 1
(0 with no labelled rows); very long texts are scored whole, line by line;
repeated rows are scored one by one; other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, release, slices, table, utf8
from .sampling import labelled_sample

SAMPLE = 5_000  # labelled documents in the fit
THRESHOLD = 0.7
STEP = 1 << 20  # bytes of text worked on at once
ROUNDS, RATE, PENALTY = 150, 0.05, 1.0
UPPER, LOWER, DIGIT, BLANK, STOP, BAR, MARK, SYMBOL, QUOTE, WIDE, REST = range(11)
KINDS = 11
OWN = KINDS + 7  # features of a line itself


def kinds() -> np.ndarray:
    """Kind of every byte."""
    t = np.full(256, REST, np.uint8)
    for kind, chars in ((BLANK, b" \t\r"), (STOP, b".,;:"), (BAR, b"|/<>_="), (MARK, b"!?"), (SYMBOL, b"#$%&*@^~+"), (QUOTE, b"'\"-()")):
        t[np.frombuffer(chars, np.uint8)] = kind
    t[ord("A") : ord("Z") + 1], t[ord("a") : ord("z") + 1], t[ord("0") : ord("9") + 1], t[128:] = UPPER, LOWER, DIGIT, WIDE
    return t


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and each text's first line; a text has one line at least."""
    breaks = np.flatnonzero(data == 0x0A)
    marks = np.concatenate([offsets[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((np.arange(len(marks)), marks, text))
    start, text = marks[order], text[order]
    first = np.searchsorted(text, np.arange(len(offsets)))
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[first[1:] - 1] = offsets[1:]
    return start, end, first


def echoes(data: np.ndarray, kind: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """Words of each line that equal the word before them."""
    inner = np.concatenate([[False], kind != BLANK, [False]])
    start, end = np.flatnonzero(inner[1:] & ~inner[:-1]), np.flatnonzero(~inner[1:] & inner[:-1])
    if len(start) < 2:
        return np.zeros(n)
    # Prefix sums of bytes and of bytes times place tell different words apart well enough for a feature.
    byte = data.astype(np.int64) ** 2
    one, two = np.zeros((2, len(data) + 1), np.int64)
    np.cumsum(byte, out=one[1:])
    byte *= np.arange(len(data))
    np.cumsum(byte, out=two[1:])
    a = one[end] - one[start]
    b = two[end] - two[start] - a * start
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (np.diff(end - start) == 0) & (line[start[1:]] == line[start[:-1]])
    return np.bincount(line[start[1:]][same], minlength=n)


def features(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix of all lines, lengths, first line of each text)."""
    start, end, first = lines(data, offsets)
    n, size = len(start), end - start
    line = np.repeat(np.arange(n), np.maximum(np.append(start[1:], len(data)) - start, 0))
    kind = table[data].astype(np.int64)
    kind[data == 0x0A] = BLANK
    count = np.bincount(line * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS)
    x = np.zeros((n, OWN))
    x[:, :KINDS] = count / np.maximum(size, 1)[:, None]
    words = count[:, BLANK] + 1
    x[:, KINDS] = np.log1p(size) / 5
    x[:, KINDS + 1] = np.minimum((size - count[:, BLANK]) / words, 40) / 10
    x[:, KINDS + 2] = size == 0
    x[:, KINDS + 3] = (count[:, UPPER] + 1) / (count[:, LOWER] + count[:, WIDE] + count[:, UPPER] + 2)
    x[:, KINDS + 4] = np.minimum((count[:, SYMBOL] + count[:, BAR] + count[:, MARK]) / words, 2)
    raw = data.tobytes()
    twice = np.zeros(n)
    for d in range(len(offsets) - 1):
        seen: set[int] = set()
        for k in range(first[d], first[d + 1]):
            h = hash(raw[start[k] : end[k]])
            twice[k] = h in seen and size[k] > 0
            seen.add(h)
    x[:, KINDS + 5] = twice
    x[:, KINDS + 6] = echoes(data, kind, line, n) / words
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    edge = np.zeros((n, 3))
    edge[:, 0] = 1
    edge[first[:-1], 1] = 1
    edge[first[1:] - 1, 2] = 1
    return np.concatenate([x, before, after, edge], 1), size, first


def messages(u: np.ndarray, first: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds of label 1 at every line (the line's own
    term counts in the forward ones), for all chains side by side."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    heads, sizes = first[:-1][order], sizes[order]
    live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right") if len(sizes) else []
    m, b = u.copy(), np.zeros_like(u)
    for k in range(1, len(live)):
        at = heads[: live[k]] + k
        p = m[at - 1]
        m[at] = u[at] + np.logaddexp(p + t[1, 1], t[0, 1]) - np.logaddexp(p + t[1, 0], t[0, 0])
    tails = heads + sizes - 1
    for k in range(1, len(live)):
        at = tails[: live[k]] - k
        q = u[at + 1] + b[at + 1]
        b[at] = np.logaddexp(q + t[1, 1], t[1, 0]) - np.logaddexp(q + t[0, 1], t[0, 0])
    return m, b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Field:
    """Weights of the chain: scale, node weights and transitions."""

    def __init__(self, mean, spread, w, t):
        self.mean, self.spread, self.w, self.t = mean, spread, w, t

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        u = ((x - self.mean) / self.spread) @ self.w
        m, b = messages(u, first, self.t)
        return sigmoid(m + b)


def fit(columns: list[pa.Array], y: np.ndarray) -> Field:
    """Maximum-likelihood chain with a quadratic penalty, by Adam on the whole sample."""
    size = 3 * OWN + 3
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        w = np.zeros(size)
        w[3 * OWN] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Field(np.zeros(size), np.ones(size), w, np.zeros((2, 2)))
    table, xs, firsts, lead = kinds(), [], [np.zeros(1, np.int64)], 0
    for col in columns:
        data, offsets = utf8(col)
        for a, b in slices(offsets, STEP):
            x, _, first = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], table)
            xs.append(x.astype(np.float32))
            firsts.append(first[1:] + lead)
            lead += len(x)
    x, first = np.concatenate(xs), np.concatenate(firsts)
    del xs
    mean = x.mean(0, dtype=float)
    spread = np.array([x[:, k].std(dtype=float) for k in range(size)]) + 1e-3
    mean[3 * OWN], spread[3 * OWN] = 0, 1
    x -= mean.astype(np.float32)  # in place: the matrix is the task's largest object
    x /= spread.astype(np.float32)
    chain = np.diff(first)
    label = np.repeat(y.astype(float), chain)
    inner = np.ones(len(x), bool)  # lines with a line after them
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    pair = np.array([[np.sum((label[at] == i) & (label[at + 1] == j)) for j in (0, 1)] for i in (0, 1)], float)
    theta = np.zeros(size + 4)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, ROUNDS + 1):
        w, t = theta[:size], theta[size:].reshape(2, 2)
        u = (x @ w.astype(np.float32)).astype(float)
        m, b = messages(u, first, t)
        miss = sigmoid(m + b) - label
        q = u[at + 1] + b[at + 1]
        joint = np.stack([t[0, 0] + 0 * q, t[0, 1] + q, m[at] + t[1, 0], m[at] + t[1, 1] + q])
        joint = np.exp(joint - joint.max(0))
        joint = (joint / joint.sum(0)).sum(1).reshape(2, 2)
        g = np.concatenate([miss.astype(np.float32) @ x + PENALTY * w, (joint - pair + PENALTY * t).ravel()]) / len(y)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta -= RATE * (1 - 0.9 * r / ROUNDS) * (m1 / (1 - 0.9**r)) / (np.sqrt(m2 / (1 - 0.99**r)) + 1e-9)
    return Field(mean, spread, theta[:size], theta[size:].reshape(2, 2))


def score_local(column: pa.Array, field: Field) -> np.ndarray:
    data, offsets = utf8(column)
    table, out = kinds(), np.zeros(len(column))
    for a, b in slices(offsets, STEP):
        x, size, first = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], table)
        p = field.marginals(x, first)
        weight = size + 1e-6
        doc = np.repeat(np.arange(b - a), np.diff(first))
        out[a:b] = np.bincount(doc, weights=p * weight) / np.bincount(doc, weights=weight)
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Field:
    """Field fitted by one task on at most about ``sample`` labelled documents."""

    def fitted(batches):
        columns, ys = [], []
        for batch in batches:
            columns.append(batch.column(0))
            ys.append(batch.column(1).to_numpy(zero_copy_only=False))
        f = fit(columns, np.concatenate(ys) if ys else np.zeros(0, np.int32))
        columns.clear()
        release()
        yield pa.RecordBatch.from_pydict({k: [v.ravel().tolist()] for k, v in vars(f).items()})

    rows = labelled_sample(docs, labels, label, sample).orderBy("doc_id").select("text", "y").coalesce(1)
    got = rows.mapInArrow(fitted, "mean array<double>, spread array<double>, w array<double>, t array<double>").collect()
    if not got:
        return fit([], np.zeros(0, np.int32))
    mean, spread, w, t = (np.array(got[0][k]) for k in ("mean", "spread", "w", "t"))
    return Field(mean, spread, w, t.reshape(2, 2))


def score(docs: DataFrame, field: Field, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole ``text``."""

    @F.arrow_udf("double")
    def scored(texts):
        found = score_local(texts, field)
        release()
        return pa.array(found)

    return docs.withColumn(name, scored(F.col("text")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    field = train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = score(docs, field).select("doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
