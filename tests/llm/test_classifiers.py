"""Toxicity, quality and language: held-out accuracy and edge rows."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from joblens.llm import language, quality, toxicity

ODD = [(100_000, None), (100_001, ""), (100_002, " \n\n "), (100_003, "123 !!"), (100_004, "🙂"), (100_005, "é" * 3), (100_006, "plain words here. " * 20_000), (None, "no id")]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def labelled(spark, n=900, seed=1):
    """Invented prose: insults make a text toxic, menus and shouting make it bad."""
    rnd = random.Random(seed)
    syllables = ["ra", "to", "mi", "sel", "and", "the", "or", "in", "vel", "ku"]
    word = lambda: "".join(rnd.choices(syllables, k=rnd.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        lines = [" ".join(word() for _ in range(rnd.randint(3, 12))) + "." for _ in range(rnd.randint(1, 12))]
        toxic, good = rnd.random() < 0.3, rnd.random() < 0.7
        if toxic:
            k = rnd.randrange(len(lines))
            lines[k] += " " + rnd.choice(["blorf", "zgrunk", "Wixxen"]) + " " + word()
        if not good:
            lines[1:] = [rnd.choice([line.upper().replace(" ", "!! "), line.replace(" ", " | "), (word() + " ") * 12]) for line in lines] + lines[1:2]
        docs.append((i, "\n".join(lines)))
        if rnd.random() < 0.9:
            labels.append((i, int(good), int(toxic)))
    return (
        spark.createDataFrame([(*d, "x", 0.5) for d in docs + ODD], "doc_id long, text string, score string, y double").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {d: (q, t) for d, q, t in labels},
    )


@pytest.mark.parametrize("module,label,place,threshold", [(toxicity, "toxic", 1, 0.3), (quality, "quality", 0, 0.7)])
def test_held_out_accuracy_and_odd_rows(spark, module, label, place, threshold):
    docs, labels, truth = labelled(spark)
    out = module.score(docs, module.train(docs, labels), "s")
    assert out.columns == [*docs.columns, "s"]
    got = [(r.doc_id, r.s) for r in out.collect()]
    assert len(got) == 900 + len(ODD) and all(0 <= s <= 1 and s == s for _, s in got)
    rest = [(s >= threshold) == bool(truth[d][place]) for d, s in got if d in truth and held(d)]
    assert len(rest) > 150 and np.mean(rest) > 0.93
    assert module.score(docs.limit(0), module.train(docs, labels)).count() == 0


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_one_class_no_labels_and_odd_labels(spark, module, label):
    docs, labels, _ = labelled(spark, 60)
    scores = lambda lab: {round(r.s, 6) for r in module.score(docs, module.train(docs, lab, label), "s").collect()}
    assert scores(labels.limit(0)) == {0.0}
    (one,) = scores(labels.withColumn(label, F.lit(1)))
    assert one > 0.99
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (99999, 1, 1), (3, 7, 7)], labels.schema))
    assert len(scores(odd)) > 1


def test_held_out_labels_are_never_used(spark):
    docs, labels, truth = labelled(spark, 300)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, lab) for lab in (labels, flipped))
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_bounded_sample_keeps_about_its_bound(spark):
    from joblens.llm.sampling import labelled_sample

    docs, labels, _ = labelled(spark)
    assert 60 < labelled_sample(docs, labels, "toxic", 100).count() < 140
    assert labelled_sample(docs, labels, "toxic", 10**6).count() == labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).count()


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    t = rng.normal(size=(2, 2))
    first = np.array([0, 1, 4, 9])
    u = rng.normal(size=9)
    m, b = quality.messages(u, first, t)
    got = quality.sigmoid(m + b)
    for a, z in zip(first, first[1:]):
        weight = np.zeros((z - a, 2))
        for y in itertools.product((0, 1), repeat=int(z - a)):
            s = np.exp(sum(u[a + k] * y[k] for k in range(z - a)) + sum(t[y[k], y[k + 1]] for k in range(z - a - 1)))
            for k, v in enumerate(y):
                weight[k, v] += s
        assert np.allclose(got[a:z], weight[:, 1] / weight.sum(1))


def test_lines_of_texts():
    from joblens.llm.common import utf8

    data, offsets = utf8(pa.array(["a\nb", "", None, "\n", "x"]))
    start, end, first = quality.lines(data, offsets)
    assert [data[a:b].tobytes() for a, b in zip(start, end)] == [b"a", b"b", b"", b"", b"", b"", b"x"]
    assert first.tolist() == [0, 2, 3, 4, 6, 7]


def tongues(spark, n=240, seed=2):
    rnd = random.Random(seed)
    parts = {"aa": ["th", "er", "ing", "wh"], "bb": ["ció", "que", "ado", "ñ"], "cc": ["sch", "ung", "ö", "tz"]}
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(parts))
        words = ["".join(rnd.choices(parts[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(5, 200))]
        rows.append((i, " ".join(words).capitalize(), lang if rnd.random() < 0.9 else None, lang))
    return rows


def test_language_held_out_and_odd_rows(spark):
    rows = tongues(spark)
    df = spark.createDataFrame([(d, t, known, "x", 0.1) for d, t, known, _ in rows] + [(d, t, "aa", "y", 0.2) for d, t in ODD[:5]], "doc_id long, text string, lang string, lang_pred string, source double").repartition(3)
    profiles = language.train(df)
    assert sorted(profiles) == ["aa", "bb", "cc"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df.select("doc_id", "text"), profiles).collect()}
    assert np.mean([got[d][0] == lang for d, _, _, lang in rows if held(d)]) > 0.98
    assert all(0 <= s <= 1 for _, s in got.values())
    assert [got[d] for d, _ in ODD[:5]] == [("und", 0.0)] * 5
    assert language.train(df.limit(0)) == {}
    assert {r.lang_pred for r in language.predict(df.select("text"), {}).collect()} == {"und"}


def test_bundles_are_sums_of_bound_letters():
    letters = language.Letters(256)
    ((_, _, v),) = letters.bundles(pa.array(["Ab, c!", None, "12"]))
    text = " ab c "
    want = sum(np.prod([np.roll(letters.vector(ord(c)), k) for k, c in enumerate(text[i : i + 3])], axis=0) for i in range(len(text) - 2))
    assert np.array_equal(v[0], want) and not v[1].any()


def test_predictions_equal_a_plain_statement(spark):
    rows = tongues(spark, 80)
    profiles = language.train(spark.createDataFrame([(d, t, lang) for d, t, lang, _ in rows], "doc_id long, text string, lang string"), dimensions=128)
    letters = language.Letters(128)

    def plain(text):
        chars = " " + re.sub("[^a-zà-öø-ÿ]+", " ", text.lower()).strip() + " "
        total = np.zeros(128)
        for i in range(len(chars) - 2):
            total += np.prod([np.roll(letters.vector(ord(c)).astype(int), k) for k, c in enumerate(chars[i : i + 3])], axis=0)
        cosine = {n: float(total @ p) / np.linalg.norm(total) / np.linalg.norm(p) for n, p in profiles.items()}
        best = max(sorted(cosine), key=cosine.get)
        return best, min(max(cosine[best], 0), 1)

    df = spark.createDataFrame([(d, t, "kept") for d, t, _, _ in rows], "doc_id long, text string, _found string")
    got = language.predict(df, profiles, dimensions=128).collect()
    assert {r._found for r in got} == {"kept"}
    for r in got:
        want = plain(r.text)
        assert r.lang_pred == want[0] and abs(r.score - want[1]) < 1e-5


@pytest.mark.parametrize("work, most", [(lambda texts: toxicity.present(texts, np.zeros(toxicity.BINS, np.int32)), 40 << 20), (lambda texts: language.Letters().bundles(texts), 60 << 20)])
def test_memory_of_one_batch(work, most):
    """Two workers an executor stay small beside a JVM whose heap is full."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 9, 5000)]
    texts = pa.array([" ".join(words[k] for k in rng.integers(0, 5000, 400)) for _ in range(1600)])  # 4 MB
    tracemalloc.start()
    for _ in work(texts):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak MB", peak >> 20)
    assert peak < most
