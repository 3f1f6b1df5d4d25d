import random

import numpy as np
import pytest
from brute import remove_repeats
from pyspark.sql import functions as F

from joblens.llm import suffix_dedup


def sample(seed=2):
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abcdé ") for _ in range(400))
    docs = []
    for i in range(200):
        kinds = [None, "", base[: rnd.randint(0, 400)], base[rnd.randint(0, 200) :], "a" * rnd.randint(0, 400), "ab" * rnd.randint(0, 200), base[:150] + "xyz" + base[150:], base[rnd.randint(0, 100) :][:120] * 3]
        docs.append((i, rnd.choice(kinds)))
    # One passage inside many different texts: many phrases around one trigger.
    docs += [(7000 + i, "".join(rnd.choice("ab") for _ in range(300)) + base[50:170] + "".join(rnd.choice("ab") for _ in range(30))) for i in range(60)]
    docs += [(None, base + "q" * 120), (9000, "日本語のテキスト" * 40), (9001, "x" + "日本語のテキスト" * 40), (9002, base * 200)]
    return docs


def measured(df):
    cols = df.select("doc_id", "repeats.*").select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return {r[0]: tuple(r[1:]) for r in cols.collect()}


@pytest.mark.parametrize("hot", [20_000, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert measured(suffix_dedup.remove_repeats(df)) == remove_repeats(docs)


def test_repeated_rows_other_columns_and_empty_table(spark):
    text = "".join(random.Random(1).choices("abcdefgh", k=500))
    rows = [(1, text, "a", 1), (1, text, "a", 1), (2, text, "b", 2), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, crc string, at int")
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "crc", "at", "repeats"]
    got = sorted((r.doc_id, r.repeats.n_removed) for r in out.collect())
    assert got == [(1, 0), (1, 0), (2, 500), (3, 0)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_readable_text_drops_halves_of_characters(spark):
    text = "é" * 30 + "".join(random.Random(4).choices("abcdefgh", k=200)) + "é" * 30
    df = spark.createDataFrame([(1, text), (2, "x" + text[10:])], "doc_id long, text string")
    for r in suffix_dedup.remove_repeats(df).collect():
        assert r.repeats.readable == bytes(r.repeats.kept).decode("utf-8", "ignore")


def test_suffix_ranks_order_suffixes():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        x = rng.integers(0, rng.integers(2, 5), rng.integers(0, 300)).astype(np.uint8)
        x = np.concatenate([x, x])
        for length in (1, 5, 8, 20, 100):
            rank, raw = suffix_dedup.suffix_ranks(x, length), x.tobytes()
            suffixes = [raw[i : i + length] for i in range(len(raw))]
            order = {s: i for i, s in enumerate(sorted(set(suffixes)))}
            want = np.array([order[s] for s in suffixes], int)
            assert len(set(rank.tolist())) == len(order)
            assert (np.argsort(rank, kind="stable") == np.argsort(want, kind="stable")).all()


def test_every_string_has_exactly_one_phrase():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 99, n).astype(np.uint8) for n in (0, 50, 100, 101, 700, 99, 300)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc, a, b, _ = suffix_dedup.phrases(np.concatenate(texts), offsets, suffix_dedup.weights(11), 100, 32)
    strings = np.concatenate([np.arange(x, y) for x, y in zip(a, b)])
    want = [offsets[d] + i for d, t in enumerate(texts) for i in range(max(len(t) - 99, 0))]
    assert strings.tolist() == want


def colliding(one, two):
    """Both texts with a tail that gives them one crc32."""
    import zlib

    rnd = random.Random(9)
    tails = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(200_000)]
    first, second = zlib.crc32(one.encode()), zlib.crc32(two.encode())
    seen = {zlib.crc32(t.encode(), first): t for t in tails}
    t = next(t for t in tails if zlib.crc32(t.encode(), second) in seen)
    out = one + seen[zlib.crc32(t.encode(), second)], two + t
    assert zlib.crc32(out[0].encode()) == zlib.crc32(out[1].encode())
    return out


@pytest.mark.parametrize("doc_id", [None, 5])
@pytest.mark.parametrize("size", [301, 150])
def test_texts_of_one_id_and_one_crc(spark, doc_id, size):
    """Null ids, or one id twice: texts are told apart by more than crc32."""
    rnd = random.Random(3)
    noise = lambda n: "".join(rnd.choices("abcdefgh", k=n))
    repeat = noise(301)
    a, b = colliding(repeat, noise(size))
    docs = [(doc_id, a), (doc_id, b), (100, repeat), (101, "z" + repeat[:120] + noise(50) + repeat[150:])]
    got = {(r.doc_id, r.text): r.repeats.n_removed for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got[doc_id, a] == got[doc_id, b] == 0
    assert got[100, repeat] == 301 and got[docs[3]] == 120 + 151


def test_many_equal_rows_keep_one_list_of_runs(spark):
    text = "".join(random.Random(1).choices("abcdefgh", k=400))
    rows = [(1, text)] + [(2, text)] * 300
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.repeats.n_removed, r.repeats.n_spans) for r in out.collect()) == [(1, 0, 0)] + [(2, 400, 1)] * 300
