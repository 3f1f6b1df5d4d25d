"""Token files, BPE and packing against the public libraries."""

import base64
import hashlib
import io
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from joblens.llm import byte_bpe, packing, pieces, token_store
from joblens.llm.common import fresh_path, utf8

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", None, " ", "  ", "\n\n a", "don't 'tis  'tis we'll we'LL ''s 's's it'd! x 　　  y  ", "a\x1cb\x85c\x0bd", "<|endoftext|> hi", "x" * 5000, " " * 3000, "😀😀 ñandú 123 ١٢٣ ½", " \n 'll", "漢字かな交じり文", "áb é é", "word " * 4000]


def texts(n=300, seed=1):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice(" \n'stremvld!?1½éñ 　\tAb😀") for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def public():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_equal_the_pattern():
    import regex

    classes = pieces.class_table()
    for t in texts():
        if not t:
            continue
        buf, _ = pieces.padded(*utf8(pa.array([t])))
        cut = pieces.split_pieces(buf, classes)
        got = [buf[a:b].tobytes().decode() for a, b in zip(cut[1:-1], cut[2:])]
        # The module's white space has four control characters that White_Space lacks.
        if not set("\x1c\x1d\x1e\x1f") & set(t):
            assert got == regex.findall(public_tokenizers.PATTERN, t)


def test_word_ids_equal_the_library(library):
    for keep in (1_500_000, 3):
        enc = pieces.PieceEncoder(pieces.library_words(JSON), keep=keep, step=500)
        got = [f[a:b].tolist() for _, f, o in enc.encode(*utf8(pa.array(texts()))) for a, b in zip(o, o[1:])]
        assert got == [library(t) for t in texts()]


def test_store_round_trip(spark, library):
    rows = [(i * 3, t, "x", 0) for i, t in enumerate(texts())] + [(6, "again", "y", 1), (None, "no id", "z", 2)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, n_tokens int").repartition(4)
    path = fresh_path(spark, "test-store")
    token_store.write_store(df, path, JSON, frame_bytes=3000)
    got = [tuple(r) for r in token_store.read_store(spark, path).collect()]
    want, start = [], 0
    for d, t, _, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library(t), 0], "<u4")
        want.append((d, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted(w for w in want if w[0] is not None)
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == [w[0] for w in want] and [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    picked = token_store.read_store(spark, path, [9, 30, 77777], with_ids=True).collect()
    texts_of = {r[0]: r[1] for r in rows}
    assert {r.doc_id: list(r.ids) for r in picked} == {d: [*library(texts_of[d]), 0] for d in (9, 30)}


def test_store_of_an_empty_table(spark):
    path = fresh_path(spark, "test-store")
    token_store.write_store(spark.createDataFrame([], "doc_id long, text string"), path, JSON)
    assert token_store.read_store(spark, path).count() == 0


def test_frames_stand_alone_and_carry_checksums():
    out = io.BytesIO()
    writer = token_store.ShardWriter(out, 1000)
    docs = [(i, np.arange(i * 7, dtype=np.uint32)) for i in range(60)]
    for d in docs:
        writer.add(*d)
    writer.close()
    raw = out.getvalue()
    reader = token_store.ShardReader(io.BytesIO(raw))
    assert [(d, x.tolist()) for d, x in reader.documents()] == [(d, x.tolist()) for d, x in docs]
    opened = []
    plain = reader.frame
    reader.frame = lambda k: opened.append(k) or plain(k)
    assert [d for d, _ in reader.documents({41})] == [41] and len(opened) == 1
    # Any zstandard reader gets the contents: the tables are skippable frames.
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(plain(k) for k in range(len(reader.seek)))
    bad = bytearray(raw)
    bad[len(bad) - 12] ^= 1  # a checksum in the seek table
    with pytest.raises(ValueError):
        list(token_store.ShardReader(io.BytesIO(bytes(bad))).documents())


def test_store_paths_are_those_of_spark(spark, tmp_path):
    assert token_store.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert token_store.qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
    assert token_store.open_store(f"file:{tmp_path}")[1] == str(tmp_path)


def test_bpe_equals_the_public_library_and_decodes(spark, public):
    rows = [(i, t, 7) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    coded = byte_bpe.encode(df, RANKS).withColumn("back", byte_bpe.decoded(F.col("ids"), RANKS))
    for r in coded.collect():
        assert list(r.ids) == public.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    assert byte_bpe.encode(df.limit(0), RANKS).count() == 0


def test_native_fold_equals_the_public_library(spark, public):
    words = [w.encode() for w in [" the", "x", "", " thhaer", "ñandú", "漢字", "aaaaaaa", "'ll", "\n\n\n", "notinvocabulary"]]
    df = spark.createDataFrame([(w,) for w in words], "w binary").select("w", byte_bpe.encode_words_native(F.col("w"), RANKS).alias("ids"))
    for r in df.collect():
        assert list(r.ids) == (public._core_bpe.encode_single_piece(bytes(r.w)) if r.w else [])


def test_long_pieces_merge_through_the_heap(public):
    merges = byte_bpe.Merges(byte_bpe.read_ranks(RANKS))
    rnd = random.Random(5)
    for n in (129, 400, 3000):
        word = bytes(rnd.choice(b"aeinorst") for _ in range(n))
        assert merges.heap(word) == public._core_bpe.encode_single_piece(word)


def test_query_digests(spark, public):
    got = byte_bpe.op8_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        ids = public.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def packed(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, length int")
    from joblens.llm.common import saved

    return packing.pack_pieces(saved(packing.token_pieces(df, JSON, how.get("capacity", 64)), "pieces"), **how).collect()


def check_packing(got, ids_of, capacity):
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for d, ids in ids_of.items():
        ids, at = np.array(ids, "<u4"), 0
        for k, (piece, start, length, crc) in enumerate(sorted(docs[d])):
            assert (piece, start) == (k, at) and (length == capacity or k == 0)
            assert crc == zlib.crc32(ids[at : at + length].tobytes())
            at += length
        assert at == len(ids) and len(docs[d]) == -(-len(ids) // capacity)
    return len(seqs)


@pytest.mark.parametrize("group", [16_384, 20])
def test_packing_is_whole_gapless_and_tight(spark, library, group):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())]
    got = packed(spark, rows, capacity=64, group=group)
    ids_of = {d: [*library(t), 0] for d, t, _, _ in rows}
    n = check_packing(got, ids_of, 64)
    least = -(-sum(map(len, ids_of.values())) // 64)
    assert n <= least * 1.01 + 1


def test_packing_edges(spark):
    assert packed(spark, []) == []
    rows = [(1, None, "a", 1), (1, None, "a", 1), (None, "word", "b", 2)]
    got = packed(spark, rows)
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3 and len({r.sequence_id for r in got}) == 1


def test_trades_empty_bins():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        sizes = rng.integers(1, 60, 200)
        start = packing.best_fit_decreasing(sizes, 100)
        spread = [[i] for i in range(len(sizes))]
        for bins in (start, spread):
            out = packing.local_search([list(b) for b in bins], sizes, 100)
            assert sorted(i for b in out for i in b) == list(range(len(sizes)))
            assert all(sum(sizes[i] for i in b) <= 100 for b in out) and len(out) <= len(bins)
            fill = lambda bins: sum(sum(int(sizes[i]) for i in b) ** 2 for b in bins)
            assert fill(out) >= fill(bins)
            assert len(out) <= -(-int(sizes.sum()) // 100) * 1.1


def test_an_exchange_saves_a_bin():
    sizes = np.array([70, 20, 30, 80])
    assert len(packing.local_search([[0, 1], [2], [3]], sizes, 100)) == 2  # 30 against 20, then 20 moves
    sizes = np.array([70, 25, 12, 18, 75])
    assert len(packing.local_search([[0, 1], [2, 3], [4]], sizes, 100)) == 2  # 12 and 18 against 25


def trades_left(bins, sizes, capacity):
    """Legal trades of a packing, by plain enumeration of bins and items."""
    fills = [int(sum(sizes[i] for i in b)) for b in bins]
    for g, f in enumerate(fills):
        outs = [int(sizes[i]) for i in bins[g]]
        outs += [a + b for k, a in enumerate(outs) for b in outs[k + 1 :]]
        for t, room in enumerate(capacity - x for x in fills):
            if t != g and f <= fills[t] < capacity:
                backs = [0, *(int(sizes[i]) for i in bins[t])]
                yield from ((g, t, out, back) for out in outs for back in backs if 0 < out - back <= room)


@pytest.mark.parametrize("low,high,n,capacity", [(20, 50, 60, 100), (1, 60, 80, 100), (30, 70, 90, 128), (5, 6, 40, 17)])
def test_the_search_ends_only_when_no_trade_is_left(low, high, n, capacity):
    for seed in range(10):
        sizes = np.random.default_rng(seed).integers(low, high, n)
        out = packing.local_search(packing.best_fit_decreasing(sizes, capacity), sizes, capacity)
        assert sorted(i for b in out for i in b) == list(range(n))
        assert len(out) == -(-int(sizes.sum()) // capacity) or not list(trades_left(out, sizes, capacity))


def test_bins_of_middling_pieces_are_emptied():
    sizes = np.random.default_rng(1).integers(300, 1000, 3000)
    start = packing.best_fit_decreasing(sizes, 2048)
    assert len(start) == 998 and len(packing.local_search(start, sizes, 2048)) <= 988


def test_rounds_of_bins_come_near_one_group(spark):
    from joblens.llm.common import saved

    sizes = np.random.default_rng(1).integers(300, 1000, 3000)
    pieces = saved(spark.createDataFrame([(k, int(s)) for k, s in enumerate(sizes)], "row long, length long"), "pieces")
    got = packing.pack_pieces(pieces.withColumn("doc_id", F.col("row")), group=500).collect()
    spans = defaultdict(list)
    for r in got:
        assert r.length == sizes[r.doc_id]
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        own.sort()
        assert [a for a, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 2048
    assert len(got) == 3000 and len(spans) < 998


END = "<|endoftext|>"
MARKED = [END, END * 2, f"a{END}b", f"x {END}  y", f"  {END}", f"a  {END}'s\n", END[:-1], END[4:], f"<|endof{END}text|>", f"é{END}漢 \x1c{END}", f"{END} " * 900]


@pytest.fixture(scope="module")
def whole():
    """The library as it comes: added tokens in a text have their own ids."""
    tok = Tokenizer.from_file(JSON)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def test_added_tokens_equal_the_library(whole):
    rnd = random.Random(7)
    mixed = MARKED + texts() + ["".join(rnd.choice([END, " ", "'s", "ab", "\n ", "1", END[:6], END[6:]]) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    for step in (500, 1 << 20):
        enc = pieces.PieceEncoder(pieces.library_words(JSON), step=step, added=pieces.added_tokens(JSON))
        got = [f[a:b].tolist() for _, f, o in enc.encode(*utf8(pa.array(mixed))) for a, b in zip(o, o[1:])]
        assert got == [whole(t) for t in mixed]


def test_store_and_packing_give_added_tokens_their_ids(spark, whole, tmp_path):
    rows = [(i, t) for i, t in enumerate(MARKED)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ids_of = {d: [*whole(t), 0] for d, t in rows}
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.op6_token_store(spark, str(tmp_path)).collect()}
    starts = np.cumsum([0, *map(len, ids_of.values())])
    assert got == {d: (starts[d], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in ids_of.items()}
    check_packing(packing.op10_packing(spark, str(tmp_path)).collect(), ids_of, 2048)
    import corpus_pipeline

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    check_packing(corpus_pipeline.pack(spark, docs, str(tmp_path)).collect(), ids_of, 2048)


def test_added_tokens_with_other_rules_are_refused(tmp_path):
    odd = tmp_path / "odd.json"
    odd.write_text('{"added_tokens": [{"id": 1, "content": "<x>", "single_word": false, "lstrip": true, "rstrip": false, "normalized": false}]}')
    with pytest.raises(ValueError):
        pieces.added_tokens(str(odd))
