"""Byte-level BPE by ranked merges of distinct words, and decoding.

``encode_words_native`` is the method in DataFrame functions alone: a literal
rank map, and a fold that merges the leftmost pair of lowest rank in the byte
array of each word.  Corpora go through ``encode``: the same ranked merges,
run on all distinct words of a task side by side in arrays, since the fold
spends tens of microseconds on a word (README gives the figures).  Decoding
concatenates the binary pieces of the ids with a higher-order function over a
literal array of pieces.

Edge cases: null and empty texts have no ids and decode to empty bytes; very
long pieces (a text without breaks) merge through a heap; repeated rows are
encoded one by one; bytes that have no rank of their own raise an error; a
column that has the name of the output is replaced, all others pass through.
"""

from __future__ import annotations

import base64
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, utf8
from .pieces import worker_encoder

LONG_PIECE = 128  # bytes above which a piece is merged through a heap
BUCKETS = 16_384  # of the literal rank map
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a public rank file: base64 piece, blank, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


class Merges:
    """Ranked merges over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        # Every split of a piece into two pieces is a pair that merges into it.
        left, right, whole = [], [], []
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    whole.append(rank)
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.bits = max(4, int(2 * max(len(keys), 1)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.merged = np.full(1 << self.bits, NONE)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            one = np.unique(slot[todo[free]], return_index=True)[1]
            put = todo[free][one]
            self.keys[slot[put]], self.merged[slot[put]] = keys[put], np.array(whole, np.int32)[put]
            todo = np.setdiff1d(todo, put)
            slot[todo] = (slot[todo] + 1) % len(self.keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair merges into, NONE where it does not."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = self._slot(keys)
        out = np.full(len(keys), NONE)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.merged[slot[todo[hit]]]
            todo = todo[~hit & (there != np.uint64(2**64 - 1))]
            slot[todo] = (slot[todo] + 1) % len(self.keys)
        return out

    def table(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the rows of a padded matrix of ids in place; their final sizes."""
        n, width = words.shape
        if width < 2:
            return words, sizes
        cols = np.arange(width)
        rank = np.full((n, width), NONE)
        real = cols[None, 1:] < sizes[:, None]
        rank[:, :-1][real] = self.pairs(words[:, :-1][real], words[:, 1:][real])
        live = np.arange(n)
        sizes = sizes.copy()
        while True:
            at = rank[live].argmin(1)
            low = rank[live, at]
            go = low < NONE
            live, at, low = live[go], at[go], low[go]
            if not len(live):
                return words, sizes
            move = np.minimum(cols[None, :] + (cols[None, :] > at[:, None]), width - 1)
            words[live] = np.take_along_axis(words[live], move, 1)
            shifted = np.take_along_axis(rank[live], move, 1)
            shifted[:, -1] = NONE
            words[live, at] = low
            sizes[live] -= 1
            for side in (at, at - 1):
                ok = (side >= 0) & (side + 1 < sizes[live])
                row = np.flatnonzero(ok)
                k = side[row]
                shifted[row, k] = self.pairs(words[live[row], k], words[live[row], k + 1])
                late = np.flatnonzero((side >= 0) & ~ok)
                shifted[late, side[late]] = NONE
            rank[live] = shifted

    def heap(self, word: bytes) -> list[int]:
        """One long piece: pairs wait in a heap by rank, then place."""
        ids = [int(x) for x in self.byte[np.frombuffer(word, np.uint8)]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        alive = [True] * len(ids)
        first = self.pairs(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(ids):
                r = int(self.pairs(np.array([ids[i]]), np.array([ids[j]]))[0])
                if r < NONE:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= len(ids) or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x, on in zip(ids, alive) if on]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, counts) of distinct words; a word with a rank is one id."""
        parts: list = [None] * len(words)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            rank = self.ranks.get(w)
            if rank is not None:
                parts[i] = (rank,)
            elif len(w) > LONG_PIECE:
                parts[i] = self.heap(w)
            else:
                groups.setdefault(-(-len(w) // 4) * 4, []).append(i)
        for width, some in groups.items():
            for k in range(0, len(some), 20_000):
                own = some[k : k + 20_000]
                raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in own), np.uint8).reshape(-1, width)
                ids, sizes = self.table(self.byte[raw], np.array([len(words[i]) for i in own]))
                for i, row, size in zip(own, ids.tolist(), sizes.tolist()):
                    parts[i] = row[:size]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter((x for p in parts for x in p), np.int64, int(counts.sum()))
        if len(flat) and flat.min() < 0:
            raise ValueError("a byte has no rank")
        return flat.astype(np.uint32), counts


def rank_words(path: str):
    """Word encoder of a rank file."""
    return Merges(read_ranks(path)).encode


def encode(docs: DataFrame, ranks_path: str, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole ``text``, without special tokens."""

    @F.arrow_udf("array<int>")
    def ids_of(texts):
        enc = worker_encoder("ranks", ranks_path, rank_words)
        flats, counts = [], []
        for _, flat, offs in enc.encode(*utf8(texts)):
            flats.append(flat)
            counts.append(np.diff(offs))
        sizes = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = np.concatenate(flats).astype(np.int32) if flats else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return docs.withColumn(name, ids_of(F.col("text")))


def piece_table(ranks_path: str) -> Column:
    """Literal array of the pieces, as hexadecimal text, at their ranks."""
    ranks = read_ranks(ranks_path)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    return F.from_json(F.lit(json.dumps(pieces)), "array<string>")


def decoded(ids: Column, ranks_path: str) -> Column:
    """Bytes of an array of ids: their binary pieces, concatenated."""
    pieces = piece_table(ranks_path)
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def rank_map(ranks_path: str) -> Column:
    """Literal rank map, dealt into small maps: a map is searched entry by entry."""
    import xxhash

    maps: list[dict] = [{} for _ in range(BUCKETS)]
    for piece, rank in read_ranks(ranks_path).items():
        h = piece.hex()
        # xxhash64() of a string column has seed 42; pmod of the signed value.
        value = xxhash.xxh64_intdigest(h.encode(), seed=42)
        maps[(value - (1 << 64) if value >> 63 else value) % BUCKETS][h] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def encode_words_native(words: Column, ranks_path: str) -> Column:
    """Ids of one binary word by DataFrame functions alone: bytes as
    hexadecimal pieces, then a fold of ranked merges."""
    ranks = rank_map(ranks_path)
    rank_of = lambda h: F.try_element_at(F.get(ranks, F.pmod(F.xxhash64(h), F.lit(BUCKETS)).cast("int")), h)
    text = F.lower(F.hex(words))
    size = F.length(words)
    bytes_ = F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda k: F.substring(text, 2 * k - 1, F.lit(2)))).otherwise(F.array().cast("array<string>"))

    # A lambda over a one-element array binds a value that is used more than once.
    let = lambda value, body: F.get(F.transform(F.array(value), body), 0)

    def merge(pieces, _):
        pairs = F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p, k: rank_of(F.concat(p, F.get(pieces, k + 1))))
        at = let(pairs, lambda r: F.coalesce(F.array_position(r, F.array_min(r)), F.lit(0)).cast("int"))
        join = lambda k: F.concat(F.slice(pieces, 1, k - 1), F.array(F.concat(F.get(pieces, k - 1), F.get(pieces, k))), F.slice(pieces, k + 2, F.size(pieces)))
        return let(at, lambda k: F.when(k > 0, join(k)).otherwise(pieces))

    steps = F.when(size > 1, F.sequence(F.lit(2), size)).otherwise(F.array().cast("array<int>"))
    whole = rank_of(text)
    folded = F.transform(F.aggregate(steps, bytes_, merge), rank_of)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(folded)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids"), path), 256).alias("decoded_sha256"),
    )
