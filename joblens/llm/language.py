"""Language identification with hyperdimensional letter profiles.

Every letter has a random vector of +1 and -1.  An n-gram of three characters
is the elementwise product (binding) of its letters' vectors, permuted by
their place in the n-gram; a document is the sum (bundle) of its n-grams; a
language is the bundle of its training documents, each scaled to unit length.
The language whose prototype has the largest cosine with a document wins.
Runs of non-letters count as one blank; letters are lower-cased.

Edge cases: a null text or one without any letter is ``und`` with score 0; ties
go to the language that sorts first; with no training rows every text is
``und``; very long texts are bundled whole; repeated rows are predicted one
by one; columns that have the names of the output are replaced, all others
pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, held_out, release, slices, table, utf8
from .pieces import LETTER, class_table, code_points
from .sampling import bounded_share

SIZE = 3  # characters in an n-gram
DIMENSIONS = 1024
SAMPLE = 2_000  # training documents of each language
STEP = 1 << 19  # bytes of text worked on at once
BLOCK = 2048  # n-grams bundled at once
UNKNOWN = "und"


class Letters:
    """Random vectors of characters, the same in every process."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions, self.vectors, self.classes = dimensions, {}, class_table()

    def vector(self, cp: int) -> np.ndarray:
        if cp not in self.vectors:
            self.vectors[cp] = np.random.default_rng([cp, 20240607]).integers(0, 2, self.dimensions).astype(np.int8) * 2 - 1
        return self.vectors[cp]

    def grams(self, keys: np.ndarray) -> np.ndarray:
        """Bound and permuted vectors of n-grams given as packed code points."""
        out = np.ones((len(keys), self.dimensions), np.int8)
        for place in range(SIZE):
            cps, back = np.unique(keys >> np.uint64(21 * place) & np.uint64(0x1FFFFF), return_inverse=True)
            out *= np.stack([np.roll(self.vector(int(c)), place) for c in cps])[back]
        return out

    def normalized(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points with one blank for each run of non-letters and around
        each text, and the first place of each text."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        cp = data[lead].astype(np.uint64)
        many = np.flatnonzero(cp >= 0xC0)
        if len(many):
            cp[many] = code_points(data, lead[many])
        cp[self.classes[cp] != LETTER] = 0x20
        ends = np.searchsorted(lead, offsets)
        n = len(offsets) - 1
        text = np.full(len(cp) + 2 * n, 0x20, np.uint64)
        at = np.arange(len(cp)) + np.repeat(2 * np.arange(n) + 1, np.diff(ends))
        text[at] = cp
        first = ends[:-1] + 2 * np.arange(n)
        keep = np.ones(len(text), bool)
        keep[1:] = (text[1:] != 0x20) | (text[:-1] != 0x20)
        keep[first] = True
        return text[keep], np.append(np.cumsum(keep)[first] - 1, keep.sum())

    def bundles(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        """Per row range [a, b): the bundle of each text, zero without letters."""
        data, offsets = utf8(pc.utf8_lower(column.cast(pa.large_string())))
        for a, b in slices(offsets, STEP):
            out = np.zeros((b - a, self.dimensions), np.float32)
            text, first = self.normalized(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if len(text) >= SIZE:
                key = np.zeros(len(text) - SIZE + 1, np.uint64)
                for place in range(SIZE):
                    key |= text[place : place + len(key)] << np.uint64(21 * place)
                doc = np.repeat(np.arange(b - a), np.diff(first))[: len(key)]
                inside = np.arange(len(key)) + SIZE <= first[doc + 1]
                kinds, back = np.unique(key[inside], return_inverse=True)
                doc = doc[inside]
                order = np.argsort(back, kind="stable")
                back, doc = back[order], doc[order]
                for k in range(0, len(kinds), BLOCK):
                    lo, hi = np.searchsorted(back, [k, k + BLOCK])
                    width = min(BLOCK, len(kinds) - k)
                    count = np.bincount(doc[lo:hi] * width + back[lo:hi] - k, minlength=(b - a) * width)
                    out += count.reshape(b - a, width).astype(np.float32) @ self.grams(kinds[k : k + BLOCK]).astype(np.float32)
            yield a, b, out


def train(docs: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of each language from at most about ``sample`` documents of it."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "text", "lang")
    rows = known.where(bounded_share(known.select("doc_id", "lang"), sample, "lang"))

    def bundled(batches):
        letters, sums = Letters(dimensions), {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for a, b, v in letters.bundles(batch.column(0)):
                size = np.linalg.norm(v, axis=1)
                v = v[size > 0] / size[size > 0, None]
                for lang in set(langs[a:b][size > 0]):
                    sums[lang] = sums.get(lang, 0) + v[langs[a:b][size > 0] == lang].sum(0, dtype=float)
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    parts = rows.select("text", "lang").mapInArrow(bundled, "lang string, v array<double>")
    # One row per language: element-wise sums in a fixed order of dimensions.
    flat = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    got = flat.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v")).collect()
    return {r["lang"]: np.array([x for _, x in r["v"]]) for r in got}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS, names_out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its cosine (0 where negative)."""
    names = sorted(prototypes)
    # Rounded so that the order in which partial sums met cannot show.
    matrix = np.stack([prototypes[n] / (np.linalg.norm(prototypes[n]) or 1) for n in names], 1).round(9) if names else np.zeros((dimensions, 0))

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = Letters(dimensions)
        for texts in batches:
            best_of, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if names:
                for a, b, v in letters.bundles(texts):
                    size = np.linalg.norm(v, axis=1)
                    cosine = (v @ matrix) / np.maximum(size, 1e-9)[:, None]
                    best = cosine.argmax(1)
                    best_of[a:b] = np.where(size > 0, np.array(names, object)[best], UNKNOWN)
                    score[a:b] = np.where(size > 0, np.clip(cosine[np.arange(b - a), best], 0, 1), 0.0)
            yield pa.StructArray.from_arrays([pa.array(best_of, pa.string()), pa.array(score)], names=["lang_pred", "score"])
        release()

    own = free_name(docs, "_found")
    found = docs.withColumn(own, predicted(F.col("text")))
    return found.withColumn(names_out[0], F.col(own)["lang_pred"]).withColumn(names_out[1], F.col(own)["score"]).drop(own)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
