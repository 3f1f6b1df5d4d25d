import random

import numpy as np
import pytest
from brute import jaccard_join as brute
from brute import shingle_set

from joblens.llm import jaccard_join


def families(seed=3):
    rnd, docs = random.Random(seed), []
    words = [f"w{i}" for i in range(3000)]
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 5, 9, 12, 15, 20, 30, 50, 100, 200, 400]))]
        for _ in range(rnd.choice([1, 3, 30])):
            x = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                x[rnd.randrange(len(x))] = rnd.choice(words)
            if rnd.random() < 0.3:
                x += [rnd.choice(words) for _ in range(rnd.randint(1, 3))]
            docs.append((len(docs) * 3 + 1, " ".join(x).upper() if rnd.random() < 0.2 else " \n".join(x)))
    docs += [(100001, None), (100002, ""), (100003, " \t "), (100004, "one"), (100005, "ONE"), (100006, "one two"), (100007, "É é É"), (100008, "é é é")]
    rnd.shuffle(docs)
    return docs


def test_equals_brute_force(spark):
    docs = families()
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, s string, n int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(df).collect()}
    assert got == brute(docs)


def test_nulls_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (5, text), (None, text), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(df).collect()), key=str)
    assert got == sorted([(1, 48, 1), (1, 48, 1), (5, 48, 1), (None, 48, None), (None, 0, None)], key=str)
    assert jaccard_join.jaccard_join(df.limit(0)).count() == 0


def test_sets_that_link_share_a_tile():
    high, differ = jaccard_join.bands()
    rng = np.random.default_rng(1)
    for size in (9, 10, 19, 30, 57, 200, 1000):
        for _ in range(30):
            x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            most = (100 - 90) * len(x) // 100  # dropping so many keeps the Jaccard index at 0.9 or more
            y = np.sort(rng.permutation(x)[: len(x) - rng.integers(0, most + 1)])
            assert set(jaccard_join.tile_keys(x, high, differ).tolist()) & set(jaccard_join.tile_keys(y, high, differ).tolist())


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(2)
    for _ in range(50):
        pool = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
        x, y = (np.sort(rng.permutation(pool)[: rng.integers(1, 250)]) for _ in range(2))
        differing = sum(int(v).bit_count() for v in (jaccard_join.bitmap(x) ^ jaccard_join.bitmap(y)).view(np.uint64))
        assert len(np.intersect1d(x, y)) <= (len(x) + len(y) - differing) / 2


def test_set_sizes_follow_the_words():
    from joblens.llm.common import utf8
    import pyarrow as pa

    texts = ["a b c a b c", "A b", "", None, "x\x0by\x0cz w", "one\xa0two three", "a" * 9000]
    h, size = jaccard_join.shingles(*utf8(pa.array(texts)))
    assert size.tolist() == [len(shingle_set(t)) for t in texts] and len(h) == size.sum()


def test_other_words_and_threshold_keep_tiles_few():
    high, differ = jaccard_join.bands(80)
    rng = np.random.default_rng(4)
    for size in (9, 30, 57, 200, 1000, 3000):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            swapped = len(x) // 9  # x and y share 8/9 of each: a Jaccard index of 0.8 or more
            y = np.sort(np.append(rng.permutation(x)[swapped:], rng.integers(0, 1 << 63, swapped, dtype=np.uint64)))
            own, other = (jaccard_join.tile_keys(s, high, differ) for s in (x, y))
            assert set(own.tolist()) & set(other.tolist())
            assert len(own) < 0.7 * size + 12


@pytest.mark.parametrize("block", [2048, 16])
def test_family_of_near_misses_in_blocks(spark, monkeypatch, block):
    """A template family whose members mostly miss each other, in one block and in many."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(250):
        words = base[:]
        for at in rnd.sample(range(120), rnd.choice([0, 1, 2, 3, 6, 9])):
            words[at] = f"x{rnd.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for threshold, words in ((90, 3), (80, 5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(df, threshold, words).collect()}
        sets = {d: {tuple(t.split()[k : k + words]) for k in range(120 - words + 1)} for d, t in docs}
        root = {d: d for d in sets}

        def find(d):
            while root[d] != d:
                d = root[d]
            return d

        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b]) if a < b else 0
                if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
        assert got == {d: (len(s), find(d)) for d, s in sets.items()}
