"""Best-fit packing improved by swap-based local search.

Pieces are dealt at random into groups of a bounded number of pieces.  Each
group starts from best-fit decreasing; then underfull bins trade documents: a
move, a one-for-one or a two-for-one exchange is made when it raises the sum
of squared fills, which drains the emptiest bins until they disappear.  All
bins of a group are candidates of every trade, and a group ends when none is
left.  The underfull bins of all groups, as wholes, are then dealt anew, round
after round, until one group holds what is left or a round empties at most
``least_gain`` of them.  Only lengths travel, never texts.

Edge cases: a null or empty text is one piece holding only the end id; a
document of exactly the capacity is one piece; repeated rows are packed as
documents of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from itertools import chain, combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table, utf8
from .pieces import library_words, worker_encoder

CAPACITY = 2048
END_ID = 0
GROUP = 16_384  # pieces packed together by one task
LEAST_GAIN = 0.001  # the rounds end with one that empties no more than this share of the bins
NEVER = 1 << 60
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: only longer documents
    are cut, the first piece takes the remainder.  ``added`` gives the added
    tokens of the tokenizer file their own ids, as the library does on whole
    texts; without it they are text like any other."""

    def cut(batches):
        enc = worker_encoder("library", tokenizer, library_words, added)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for r0, flat, offs in enc.encode(*utf8(batch.column(1))):
                rows: list[tuple] = []
                for i in range(len(offs) - 1):
                    ids = np.append(flat[offs[i] : offs[i + 1]], np.uint32(end_id)).astype("<u4")
                    ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity)
                    for k, end in enumerate(ends):
                        at = max(0, end - capacity) if k else 0
                        rows.append((doc_ids[r0 + i], k, at, end - at, zlib.crc32(ids[at:end].tobytes())))
                names = ("doc_id", "piece", "start", "length", "ids_crc32")
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES.rpartition(",")[0]).withColumn("row", F.monotonically_increasing_id())


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers; the fullest bin that still takes an item gets it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if size and fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(i)
        room -= size
        by_room[room].append(at)
        rooms |= 1 << room
    return bins


class Live:
    """Underfull bins, indexed by what a trade needs to know of them.

    An item of size v in a bin of fill f is entered at its base f - v, the fill
    without it; size 0 at base f stands for giving nothing back, a move.  One
    bit set a base says which sizes are there, another says which bases are in
    use, so the best trade is found among all bins without a walk over them.
    """

    def __init__(self, bins: list[list[int]], size: list[int], capacity: int):
        self.bins, self.size, self.capacity = bins, size, capacity
        self.fill = [sum(size[i] for i in b) for b in bins]
        self.sizes, self.bases = [0] * (capacity + 1), 0
        self.where: dict[tuple[int, int], set[int]] = {}
        # Totals for which no bin of at least this fill takes part in a trade.
        self.barren = np.full(2 * capacity + 1, NEVER)

    def add(self, k: int) -> None:
        fill = self.fill[k]
        for v in {0, *(self.size[i] for i in self.bins[k])}:
            base = fill - v
            self.where.setdefault((base, v), set()).add(k)
            self.sizes[base] |= 1 << v
            self.bases |= 1 << base
            self.barren[v + 1 : self.capacity - base + 1] = NEVER

    def drop(self, k: int) -> None:
        fill = self.fill[k]
        for v in {0, *(self.size[i] for i in self.bins[k])}:
            base = fill - v
            held = self.where[base, v]
            held.discard(k)
            if not held:
                del self.where[base, v]
                self.sizes[base] &= ~(1 << v)
                if not self.sizes[base]:
                    self.bases &= ~(1 << base)

    def taker(self, total: int, least: int) -> tuple[int, int] | None:
        """(bin, size given back) of the trade that fills a bin of at least
        ``least`` most with ``total``; among equals the one that drains most."""
        if total > 2 * self.capacity or self.barren[total] <= least:
            return None
        top = self.capacity - total
        bases = self.bases & ((1 << (top + 1)) - 1) if top >= 0 else 0
        while bases:
            base = bases.bit_length() - 1
            low = max(least - base, 0)
            if low >= total:
                break
            fits = (self.sizes[base] >> low) & ((1 << (total - low)) - 1)
            if fits:
                v = low + (fits & -fits).bit_length() - 1
                return min(self.where[base, v]), v
            bases &= ~(1 << base)
        self.barren[total] = least
        return None


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Drain the emptiest bins by trades that raise the sum of squared fills.

    Giving bins come by rising fill; one item, or two, go to a bin at least as
    full, which gives nothing or one smaller item back.  Net length moves from
    the emptier to the fuller bin, so the sum of squares rises with every trade
    and the search ends: when a pass over all bins finds no trade, or when
    there are as few bins as the total length allows.
    """
    size = sizes.tolist()
    fill_of = lambda b: sum(size[i] for i in b)
    least = -(-sum(size) // capacity)
    done = [b for b in bins if fill_of(b) >= capacity]
    live = [b for b in bins if fill_of(b) < capacity]
    traded = True
    while traded and len(done) + len(live) > least:
        traded = False
        now = Live(live, size, capacity)
        order = sorted(range(len(live)), key=lambda k: (now.fill[k], k))
        for k in order:
            now.add(k)
        for giver, after in zip(order, [*order[1:], None]):
            before = now.fill[giver]
            if before >= capacity:  # filled up as a taker
                continue
            now.drop(giver)
            while trade := _trade(now, giver):
                taker, out, back = trade
                now.drop(taker)
                swap = [next(i for i in now.bins[taker] if size[i] == back)] if back else []
                now.bins[giver] = [i for i in now.bins[giver] if i not in out] + swap
                now.bins[taker] = [i for i in now.bins[taker] if i not in swap] + out
                net = fill_of(out) - back
                now.fill[giver] -= net
                now.fill[taker] += net
                if now.fill[taker] < capacity:
                    now.add(taker)
                traded = True
            # Later bins are at least as full; only an equal one can still give to this one.
            if after is not None and now.fill[giver] == before == now.fill[after]:
                now.add(giver)
        done += [b for b, f in zip(now.bins, now.fill) if f >= capacity]
        live = [b for b, f in zip(now.bins, now.fill) if b and f < capacity]
    return done + live


def _trade(now: Live, giver: int) -> tuple[int, list[int], int] | None:
    """The first trade of a giving bin: (taker, items given, size given back)."""
    of: dict[int, list[int]] = {}  # items by size: equal ones trade alike
    for i in now.bins[giver]:
        if now.size[i]:
            of.setdefault(now.size[i], []).append(i)
    sizes = sorted(of, reverse=True)
    twos = ((a, b) for a, b in combinations_with_replacement(sizes, 2) if a != b or len(of[a]) > 1)
    for given in chain(((a,) for a in sizes), twos):
        if found := now.taker(sum(given), now.fill[giver]):
            out = of[given[0]][:2] if len(given) == 2 and given[0] == given[1] else [of[a][0] for a in given]
            return found[0], out, found[1]
    return None


def pack_group(sizes: np.ndarray, capacity: int, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Best-fit decreasing, or the bins at hand if those are no more, and the search."""
    fresh = best_fit_decreasing(sizes, capacity)
    if bins is None or len(fresh) < len(bins):
        bins = fresh
    if len(bins) > -(-int(sizes.sum()) // capacity):
        bins = local_search(bins, sizes, capacity)
    return bins


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, least_gain: float = LEAST_GAIN) -> DataFrame:
    """sequence_id and offset for every piece (a written table with ``row``)."""
    schema = "row long, length long, sequence_id long, offset long, fill long"

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", ignore_index=True)
        sizes, rows = pdf["length"].to_numpy(np.int64), pdf["row"].to_numpy()
        held = None if pdf["sequence_id"].isna().any() else [b.tolist() for b in pdf.groupby("sequence_id").indices.values()]
        seq, off, fill = (np.zeros(len(pdf), np.int64) for _ in range(3))
        # A bin is named by its smallest row, which no other bin holds.
        for b in pack_group(sizes, capacity, held):
            b = np.array(sorted(b))
            seq[b] = rows[b[0]]
            off[b] = np.cumsum(sizes[b]) - sizes[b]
            fill[b] = sizes[b].sum()
        return pd.DataFrame({"row": rows, "length": sizes, "sequence_id": seq, "offset": off, "fill": fill})

    items = pieces.select("row", "length")
    whole = items.where(F.col("length") >= capacity).select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    place = ("row", "sequence_id", "offset")
    placed = whole
    todo = items.where(F.col("length") < capacity).withColumn("sequence_id", F.lit(None).cast("long"))
    n, bins, round_no = todo.count(), None, 0
    while n:
        # Pieces are dealt one by one at first, afterwards bins as wholes.
        groups = -(-n // group)
        deal = F.pmod(F.xxhash64(F.coalesce("sequence_id", "row"), F.lit(round_no)), F.lit(groups))
        result = saved(todo.withColumn("deal", deal).groupBy("deal").applyInPandas(pack, schema), "packed")
        open_bins = result.where(F.col("fill") < capacity)
        heads = F.count(F.when(F.col("row") == F.col("sequence_id"), 1))
        left, now, full = result.select(F.count(F.when(F.col("fill") < capacity, 1)), heads, F.count(F.when((F.col("row") == F.col("sequence_id")) & (F.col("fill") >= capacity), 1))).first()
        # A round of all groups that empties next to no bin is the last pass.
        if groups == 1 or bins is not None and bins - now <= least_gain * bins:
            placed = placed.unionByName(result.select(*place))
            break
        placed = placed.unionByName(result.where(F.col("fill") >= capacity).select(*place))
        todo, n, bins, round_no = open_bins.select("row", "length", "sequence_id"), left, now - full, round_no + 1
    return pieces.join(placed, "row").drop("row")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack_pieces(saved(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True), "pieces"))
