"""Top-k search and embedding near-duplicates."""

import numpy as np
import pandas as pd
import pytest
from brute import smallest_reachable

from joblens.llm import embedding_dedup, topk_search

NAN, INF = float("nan"), float("inf")


def search(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    q = topk_search.quantized(df)
    return sorted(tuple(r) for r in topk_search.top_k(q, q.where("vec_id % 50 = 0"), **how).collect())


def plain(rows, k=5):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(x) == len(y))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def vectors(n=400, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0) for i in range(n)]
    rows[7:20] = [(i, rows[0][1], 0) for i in range(7, 20)]  # ties
    rows += [(1000, None, 0), (1001, [1.0] * 7 + [None], 0), (1002, [NAN] * 8, 0), (1003, [INF] * 8, 0), (1004, [], 0), (1050, [1.0, 2.0], 0), (1051, [0.5, 1.0], 0)]
    return rows


@pytest.mark.parametrize("shard,block", [(8192, 512), (60, 3)])
def test_search_equals_brute_force(spark, shard, block):
    rows = vectors()
    assert search(spark, rows, shard=shard, query_block=block) == plain(rows)


def test_search_few_candidates_large_components_and_empty(spark):
    assert search(spark, [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0)]) == [(0, 1, 1, 2 * 512 * 256)]
    big = [(0, [3e6, 1.0], 0), (1, [3e6, 2.0], 0), (2, [3e6, 2.0], 0), (50, [-3e6, 0.0], 0)]
    assert search(spark, big) == plain(big)
    assert search(spark, []) == []


def clustered(n, clusters, dims=16, seed=11, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    return (centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims)) * spread).astype(np.float32)


def test_search_joins_few_shards_on_clustered_vectors(spark):
    x = clustered(20_000, 40)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}), "vec_id long, embedding array<float>")
    v = topk_search.quantized(df)
    pieces = topk_search.Pieces(v, v.where("vec_id % 50 = 0"), 250, 10)
    n_blocks, n_shards = pieces.blocks.count(), pieces.shards.count()
    assert n_blocks >= 40 and n_shards >= 80 and pieces.shards.selectExpr("sum(length(ids) / 8)").first()[0] == len(x)
    pairs = pieces.reached(pieces.floors(5)).count()
    assert n_blocks <= pairs < 0.3 * n_blocks * n_shards, (pairs, n_blocks, n_shards)
    got = sorted(tuple(r) for r in topk_search.top_k(v, v.where("vec_id % 50 = 0"), shard=250, query_block=10).collect())
    whole = np.floor(256 * x.astype(float))
    score = (whole[::50] @ whole.T).astype(np.int64)
    score[np.arange(len(score)), np.arange(0, len(x), 50)] = -(1 << 62)
    best = np.argsort(-score, 1, kind="stable")[:, :5]
    assert got == sorted((50 * q, r + 1, int(i), int(score[q, i])) for q, row in enumerate(best) for r, i in enumerate(row))


def test_search_deals_copies_over_shards(spark):
    rows = [(i, [1.0, 0.5, -2.0], 0) for i in range(300)] + [(300 + i, [float(i), 1.0, 2.0], 0) for i in range(40)]
    v = topk_search.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int"))
    pieces = topk_search.Pieces(v, v.where("vec_id % 50 = 0"), 40, 2)
    assert pieces.shards.selectExpr("max(length(ids) / 8)").first()[0] <= 80  # dealt by a hash, so not exactly 40
    assert search(spark, rows, shard=40, query_block=2) == plain(rows)


def near(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cls string")
    return sorted((tuple(r) for r in embedding_dedup.near_duplicates(df, **how).collect()), key=str)


def links_of(rows, threshold=0.93):
    unit = {}
    for i, (_, v, label, _) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            unit[i] = x / np.sqrt((x * x).sum())
    return [(i, j) for i in unit for j in unit if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]


def expected(rows):
    links = links_of(rows)
    root = smallest_reachable(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        least[root[i]] = min(least.get(root[i], 1 << 60), r[0])
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted(((r[0], n[i], least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(rows)), key=str)


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(30):
        centre = rng.normal(size=24)
        for _ in range(int(rng.choice([1, 2, 25]))):
            rows.append((len(rows) * 2 + 5, (centre + rng.normal(size=24) * rng.choice([0.1, 0.25, 0.3])).astype(np.float32).tolist(), c % 3, "x"))
    rows += [(i, rows[0][1], rows[0][2], "y") for i in (1, 2, 3)]  # copies
    rows += [(900, None, 1, "z"), (901, [0.0] * 24, 1, "z"), (902, [NAN] * 24, 1, "z"), (903, [None] * 24, 1, "z"), (904, rows[0][1], None, "z"), (905, [1.0, 2.0], 0, "z"), (906, [2.0, 4.0], 0, "z"), (907, [], 0, "z"), (908, [INF] * 24, 0, "z")]
    assert near(spark, rows, block=16) == expected(rows)


def test_near_duplicates_repeated_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0], 0, "a"), (1, [0.0, 1.0], 0, "a"), (2, [0.0, 1.0], 0, "a"), (3, [1.0, 0.01], 0, "a")]
    assert near(spark, rows) == expected(rows)
    assert near(spark, []) == []
    assert near(spark, [(4, None, None, None)]) == [(4, 0, 4, True)]


def test_labels_may_be_texts(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.2).tolist(), "ab é"[i % 4] * (i % 3 + 1), "x") for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, block string").repartition(3)
    got = embedding_dedup.near_duplicates(df, block=4).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_tiles_of_one_large_label_are_few(spark):
    x = clustered(100_000, 200, dims=16, spread=0.04)
    frame = pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x), "label": 7})
    df = spark.createDataFrame(frame, "vec_id long, embedding array<float>, label int").repartition(8)
    classes = df.selectExpr("string(label) label", "embedding", "vec_id cls", "1L members")
    axes = embedding_dedup.principal_axes(classes, 16)
    blocks = embedding_dedup._blocks(classes, axes, 256)
    n = blocks.count()
    assert blocks.selectExpr("sum(length(ids) / 8)").first()[0] == len(x) and blocks.selectExpr("max(length(ids) / 8)").first()[0] <= 256
    tiles = embedding_dedup._tiles(blocks, 0.93).selectExpr("sum(size(partners))").first()[0]
    assert n >= 400 and n <= tiles < 0.1 * n * n / 2, (tiles, n)
    some = df.where("vec_id < 4000")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(some, block=64).collect()), key=str)
    assert got == expected([(i, x[i].tolist(), 7, "x") for i in range(4000)])


def test_axis_tree_keeps_every_row():
    rng = np.random.default_rng(8)
    for r in (rng.normal(size=(1000, 5)), np.ones((777, 3)), np.repeat(rng.normal(size=(3, 4)), 300, 0), rng.normal(size=(3, 2))):
        parts = embedding_dedup.axis_tree(r, 2 if len(r) == 3 else 50)
        assert sorted(np.concatenate(parts)) == list(range(len(r))) and max(map(len, parts)) <= 50


def test_bounds_drop_no_pair():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 64))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.2, 0.35, 0.4)])
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j = embedding_dedup.tile_links(x, x, axes, 0.9)
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    assert set(zip(i.tolist(), j.tolist())) == {(int(a), int(b)) for a, b in zip(*np.nonzero(u @ u.T >= 0.9))}


def test_quantized_is_the_floor(spark):
    from joblens.llm.topk_search import quantized

    values = [-1e-20, 1e-20, -5e-324, -0.0, 0.5, -0.5, 1.0, -1.0, 0.00390625, -0.00390625, 1e14, -1e14 - 0.001, 1e300, -1e300]
    got = quantized(spark.createDataFrame([(1, values)], "vec_id long, embedding array<double>")).first().v
    import math

    assert got == [float(math.floor(256 * x)) for x in values]
