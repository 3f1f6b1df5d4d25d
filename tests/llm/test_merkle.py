"""The Merkle manifest against a tree built plainly with hashlib."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from joblens.llm import merkle, midstate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def grow(nodes):
    """Root, and per node its (left, right) siblings level by level."""
    paths, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [(nodes[a : a + 3], own[a : a + 3]) for a in range(0, len(nodes), 3)]
        for run, groups in runs:
            for k, group in enumerate(groups):
                for i in group:
                    paths[i].append((run[:k], run[k + 1 :]))
        nodes, own = [digest("".join(run)) for run, _ in runs], [sum(groups, []) for _, groups in runs]
    return nodes[0], paths


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[s] = own, *grow([leaf_of(r, r[1]) for r in own])
    root, tops = grow([trees[s][1] for s in names])
    for s, top in zip(names, tops):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            hit = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            here = leaf_of(r, r[1].replace("\n", "") if hit else r[1])
            for left, right in path + top:
                here = digest("".join([*left, here, *right]))
            yield r[0], leaf_of(r, r[1]), subroot, root, digest("".join("".join(a + b) for a, b in path + top)), here, here == root


def run(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("clash")).withColumn("pos", F.lit(7)).repartition(3)
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in merkle.op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def test_states_equal_hashlib():
    blocks = np.random.default_rng(1).integers(0, 256, (5, 4, 64)).astype(np.uint8)
    state = midstate.start(5)
    for k in range(5):
        count = np.full(5, k)
        assert midstate.finish(state, count)[2].tobytes().decode() == hashlib.sha256(blocks[2, :k].tobytes()).hexdigest()
        if k < 4:
            state = midstate.absorb(state, blocks[:, k])


ODD = [
    (1, None, None, None, None), (None, "a\nb", "en", "s", 3), (None, "a\nb", "en", "s", 3), (2, "", "", "", 0), (2, "é\n\n", "fr", "s", -4), (2, "é\n\n", "fr", "s", -4),
    (-7, "x" * 200_000 + "\n", "en", "s", 1), (5, "\n", "en", "é", 1), (5, "\n", "en", "z", 1), (9, "plain", "en", "long source " * 40, 5),
]


@pytest.mark.parametrize("height", [2, 8])
def test_equals_plain_tree(spark, tmp_path, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 3**height)
    rows = ODD + [(i, f"text {i}\nline" if i % 3 else f"text {i}", "en", "hot" if i % 3 else f"s{i % 12}", i) for i in range(150)]
    assert run(spark, tmp_path, rows) == sorted(plain(rows), key=str)


def test_one_row_and_none(spark, tmp_path):
    rows = [(3, "only", "en", "s", 4)]
    got = run(spark, tmp_path, rows)
    assert got == list(plain(rows)) and got[0][4] == digest("")
    assert run(spark, tmp_path, []) == []


def test_many_sources(spark, tmp_path):
    rows = [(i, f"t\n{i}", "en", f"source {i}", i) for i in range(40)]
    assert run(spark, tmp_path, rows) == sorted(plain(rows), key=str)


def test_resuming_needs_only_the_state_and_the_right(spark, tmp_path):
    """Stored states before a slot are those of the digests to its left."""
    rows = [(i, f"t{i}", "en", "s", i) for i in range(11)]
    docs = spark.createDataFrame(rows, SCHEMA)
    built = merkle.build(docs.select("source", "doc_id", merkle.leaf().alias("leaf")))
    for node in built.nodes.where("level > 0").collect():
        state = midstate.start(1)
        for child, kept in zip(node.children, node.states):
            assert kept == state[:, 0].astype(">u4").tobytes()
            state = midstate.absorb(state, np.frombuffer(child.encode(), np.uint8).reshape(1, 64))
        assert node.digest == digest("".join(node.children))
