"""SentencePiece ids and texts against the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from joblens.llm import piece_bpe
from joblens.llm.common import utf8

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a", "a  ", " " * 120, "\n\n \n", "<s> </s> <unk> <0x0A>", "x" * 30_000, "ab" * 9_000, "▁▁a▁b ▁", "中文字漢" * 50, "�", "a\x00b", "ｆｕｌｌ ñé 😀‍😀", "word " * 8000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.Model(PATH)


def texts(model, n=1500, seed=5):
    rnd = random.Random(seed)
    letters = "  ▁\n\t'aeinstrhelo.,1230éñ中文😀\x00<s>ABx"
    own = sorted(model.id)
    return (
        ODD
        + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
        + ["".join(rnd.choice(own) for _ in range(rnd.randint(1, 12))) for _ in range(n)]
    )


def test_ids_equal_the_library(model, library):
    some = texts(model)
    for keep in (1_000_000, 3):
        enc = piece_bpe.ChunkEncoder(model)
        enc.keep, enc.step = keep, 5000
        got = [f[a:b].tolist() for _, f, o in enc.encode(*utf8(pa.array(some, pa.string()))) for a, b in zip(o, o[1:])]
        assert got == [library.encode(t or "") for t in some]


def test_walk_equals_the_plain_merges(model):
    for t in texts(model, 300, 6):
        t = "▁" + (t or "").replace(" ", "▁")[:300]
        if set(t) <= model.chars:
            assert [model.text[i] for i in model.walk(t)] == model.merged(t)


def test_every_reachable_piece_is_its_own_encoding(model):
    assert all(len(model.merged(p)) == 1 for p in random.Random(1).sample(sorted(model.id), 2000))


def test_failed_positions_keep_the_walk_linear(model):
    """A text that makes the walk step back asks for few pairs more than it has characters."""
    asked = []
    plain = type(model).compatible
    for t in ("▁" + "tion" * 3000, "▁" + "aab" * 3000):
        asked.clear()
        model.compatible = lambda a, b: asked.append(1) or plain(model, a, b)
        model.walk(t)
        assert len(asked) < 20 * len(t)
    del model.compatible


def test_decoding_equals_the_library(model, library):
    dec, rnd = piece_bpe.Decoder(model), random.Random(2)
    pool = [0, 1, 2, *(3 + b for b in (0xE2, 0x96, 0x81, 0x41, 0xED, 0xA0, 0xF0)), 259, 300, 5000, 28705, 28713]
    for _ in range(5000):
        ids = [rnd.choice(pool) for _ in range(rnd.randint(0, 8))]
        assert dec.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_query_on_odd_rows(spark, tmp_path, model, library):
    rows = [(i, t, "x") for i, t in enumerate(texts(model, 60))] + [(None, "no id", "y"), (3, "  a", "z"), (3, "  a", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumn("ids", F.lit(1)).repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in piece_bpe.op12_piece_bpe(spark, str(tmp_path)).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    coded = [(d, library.encode(t or "")) for d, t, _ in rows]
    assert got == sorted(((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for d, ids in coded), key=str)
    kept = piece_bpe.encode(df, PATH, "piece_ids")
    assert kept.columns == [*df.columns, "piece_ids"] and kept.where("ids <> 1").count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert piece_bpe.encode(empty, PATH).count() == 0
