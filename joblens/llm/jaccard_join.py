"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

A document's set holds the hashes of its distinct shingles of ``words`` words.  Two sets
link when 100 * |x & y| >= threshold * |x | y|, so their sizes lie within one
step of a geometric band and they differ in at most d(band) shingles.

* **Tiles.**  Within a band the hash space is cut into more than d parts; sets
  that link are equal on at least one part, so a tile is a band, a part and
  the hash of the set's members in it.  A tile of many members (a family of
  near copies) is compared in blocks of ``BLOCK`` by as many tasks.  Sets with so many empty parts
  that an empty one could be the only match also use further cuts.
* **Bounds.**  Each set carries a bitmap in which every member flips one
  hashed bit.  Bits that differ count members that differ, so bit counts
  bound the overlap from above; only pairs that can still link go on.  The
  bound holds for every size; sets of ``WIDE_FROM`` members or more, whose
  differences would fill the small bitmap, carry a wide one as well.
* **Exact check.**  Sorted hash arrays are intersected.

Equal sets are linked to the smallest doc_id that has the set, and it alone
stands in tiles.  In each tile every member first meets the tile's smallest
document; then members outside a tile's largest component meet those of its
other components, best bounds first, until every pair that shares a tile and
that the bounds allow is either inside one component or has been
intersected.  No link between different texts is lost; copies are
never expanded into all pairs.

Edge cases: null, empty and wordless texts have an empty set and no links;
texts of fewer words than a shingle are one; a null doc_id is kept as its own
component (null); repeated rows of a doc_id are one document if their sets
are equal, else the largest set speaks for the doc_id in links and each row
reports its own size; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import release, saved, slices, table, utf8
from .graph import components
from .suffix_dedup import _mix, range_hash

WORDS = 3
THRESHOLD = 90  # percent
BITS = 512
WIDE_BITS, WIDE_FROM = 4096, 600  # sets of so many members carry a wide bitmap too
LEVELS = 8  # cuts tried before empty parts are keys themselves
STEP = 1 << 20  # bytes of text worked on at once
GROUP = 2000  # sets compared with one other by one task
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
GAPS = b"\x20\x09\x0a\x0b\x0c\x0d"  # fixed value: separators of words


def bands(threshold: int = THRESHOLD, top: int = 1 << 33) -> tuple[np.ndarray, np.ndarray]:
    """(largest size of each band, most members in which two linked sets
    differ whose larger one is of the band).  The smaller set of a link is of
    the same band or the one before."""
    high, sizes = [1], 1
    while sizes < top:
        sizes = max(sizes + 1, sizes * 100 // threshold)
        high.append(sizes)
    high = np.array(high, np.int64)
    return high, 2 * high * (100 - threshold) // (100 + threshold)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts one after another, sizes)."""
    n = len(offsets) - 1
    data = FOLD[data]
    gap = np.zeros(256, bool)
    gap[np.frombuffer(GAPS, np.uint8)] = True
    inner = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inner & (np.append(True, ~inner[:-1]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(inner & (np.append(~inner[1:], True) | edge[1:])) + 1 if len(data) else start
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    word = range_hash(data, start, end)
    doc = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    h = np.zeros(len(word), np.uint64)
    for k in range(words):
        # Texts of fewer words: the words they have; other starts lack a word and are dropped.
        here = np.zeros(len(word), np.uint64)
        here[: max(len(word) - k, 0)] = word[k:]
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(k < count[doc], here, np.uint64(k))
    h = _mix(h)
    place = np.arange(len(word)) - first[doc]
    whole = place <= np.maximum(count[doc] - words, 0)
    h, doc = h[whole], doc[whole]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))
    return h[new], np.bincount(doc[new], minlength=n)


def bitmap(h: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity bitmap of a set as longs."""
    odd = np.bincount((h >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


@cache
def parts_of(differ: int, least: int) -> int:
    """Parts of a band: more than the differing members, by as many as sets of
    ``least`` members are likely to leave empty, so that one cut is enough."""
    for parts in range(differ + 2, 2 * differ + 3):
        empty = parts * math.exp(-least / parts)
        if parts - differ >= 2 + int(empty + math.sqrt(empty)):
            return parts
    return differ + 2


def tile_keys(h: np.ndarray, high: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Tiles of one set: of its own band and, as a smaller set, of the next."""
    own = int(np.searchsorted(high, len(h)))
    out = []
    for band in (own, own + 1):
        parts = parts_of(int(differ[band]), int(high[max(band - 2, 0)]) + 1)
        for level in range(LEVELS):
            part = (_mix(h + np.uint64(level * 2 + 1)) % np.uint64(parts)).astype(np.int64)
            total = np.zeros(parts, np.uint64)
            total += _sums(part, h, parts)
            filled = np.bincount(part, minlength=parts) > 0
            # At least parts - d parts are equal; with fewer empty ones some equal part is filled.
            enough = parts - int(filled.sum()) < parts - int(differ[band])
            use = np.flatnonzero(filled) if enough or level < LEVELS - 1 else np.arange(parts)
            tag = np.uint64((band * LEVELS + level) * 0x9E3779B97F4A7C15 % (1 << 64))
            out.append(_mix(_mix(total[use]) + use.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + tag))
            if enough:
                break
    return np.concatenate(out)


def _sums(part: np.ndarray, h: np.ndarray, parts: int) -> np.ndarray:
    """Sum modulo 2^64 of the members of every part."""
    order = np.argsort(part, kind="stable")
    run = np.concatenate([[np.uint64(0)], np.cumsum(h[order], dtype=np.uint64)])
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    return run[ends[1:]] - run[ends[:-1]]


def signatures(docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS) -> DataFrame:
    """(doc_id, n, one, two, bits, wide, tiles): size, 128-bit identity, bitmaps and tiles of each set."""

    def sign(batches):
        high, differ = bands(threshold)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for r0, r1 in slices(offsets, STEP):
                h, size = shingles(data[offsets[r0] : offsets[r1]], offsets[r0 : r1 + 1] - offsets[r0], words)
                ends = np.cumsum(size)
                one, two, bits, wide, tiles = np.zeros((2, r1 - r0), np.int64).tolist() + [[], [], []]
                for k in range(r1 - r0):
                    own = h[ends[k] - size[k] : ends[k]]
                    if len(own):
                        one[k], two[k] = (int(v.view(np.int64)) for v in (_mix(own).sum(), _mix(own ^ np.uint64(0xABCDEF)).sum()))
                    bits.append(bitmap(own).tolist())
                    wide.append(bitmap(own, WIDE_BITS).tolist() if len(own) >= WIDE_FROM else [])
                    tiles.append(tile_keys(own, high, differ).view(np.int64).tolist() if len(own) else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(r0, r1 - r0).cast(pa.int64()), pa.array(size), pa.array(one, pa.int64()), pa.array(two, pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in (bits, wide, tiles))],
                    names=["doc_id", "n", "one", "two", "bits", "wide", "tiles"],
                )
        release()

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n long, one long, two long, bits array<long>, wide array<long>, tiles array<long>")


def differing(a: str, b: str, name: str, bits: int):
    """Bits in which two bitmaps differ; null where one has no such bitmap."""
    count = lambda k: F.bit_count(F.get(f"{a}.{name}", F.lit(k)).bitwiseXOR(F.get(f"{b}.{name}", F.lit(k))))
    return sum((count(k) for k in range(1, bits // 64)), count(0))


def can_link(a: str, b: str, name: str, bits: int, threshold: int = THRESHOLD):
    """Bit counts leave the pair enough overlap: 2 |x & y| <= |x| + |y| - differing bits."""
    return differing(a, b, name, bits) * (100 + threshold) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - threshold)


def _both(threshold: int):
    return can_link("x", "y", "bits", BITS, threshold) & F.coalesce(can_link("x", "y", "wide", WIDE_BITS, threshold), F.lit(True))


def verified(pairs: DataFrame, docs: DataFrame, threshold: int, words: int = WORDS) -> DataFrame:
    """Those pairs (a, b) whose sets link, by intersection of sorted arrays.
    The sets of one a are met by its b's; many b's are dealt over several groups."""
    count = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    told = pairs.join(count, "a")
    asked = told.select("a", F.col("b").alias("doc_id"), F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("role"))
    heads = count.select("a", F.col("a").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("role"))
    needs = asked.unionByName(heads)
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").join(needs.select("doc_id").distinct(), "doc_id", "left_semi")

    def arrays(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for r0, r1 in slices(offsets, STEP):
                h, size = shingles(data[offsets[r0] : offsets[r1]], offsets[r0 : r1 + 1] - offsets[r0], words)
                ends = np.cumsum(size)
                sets = [h[e - s : e].tobytes() for e, s in zip(ends, size)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(r0, r1 - r0).cast(pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "members"])
        release()

    sets = texts.mapInArrow(arrays, "doc_id long, members binary")
    # A doc_id with several texts speaks through its largest set.
    sets = saved(sets.groupBy("doc_id").agg(F.max_by("members", F.struct(F.length("members"), "members")).alias("members")), "sets")

    def intersect(batches):
        head, key = None, None
        for batch in batches:
            a, b = [], []
            for pivot, part, doc, role, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "doc_id", "role", "members"))):
                own = np.frombuffer(raw, "<u8")
                if role == 0:
                    head, key = own, (pivot, part)
                    continue
                assert key == (pivot, part)
                small, large = (own, head) if len(own) < len(head) else (head, own)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                if 100 * both >= threshold * (len(own) + len(head) - both):
                    a.append(pivot)
                    b.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        release()

    met = needs.join(sets, "doc_id").repartition("a", "part").sortWithinPartitions("a", "part", "role", "doc_id")
    return met.select("a", "part", "doc_id", "role", "members").mapInArrow(intersect, "a long, b long")


def jaccard_join(docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and tested
    links (a, b) joined into components."""
    signed = saved(signatures(docs, threshold, words), "signatures")
    good = signed.where("doc_id is not null and n > 0")
    best = F.max_by(F.struct("n", "one", "two", "bits", "wide"), F.struct("n", "one", "two")).alias("s")
    light = saved(good.groupBy("doc_id").agg(best), "sets")
    # One document speaks for all that have its set and stands in tiles alone.
    identity = [F.col(f"s.{c}").alias(c) for c in ("n", "one", "two")]
    owners = light.select("doc_id", *identity)
    lead = owners.groupBy("n", "one", "two").agg(F.min("doc_id").alias("lead"))
    twins = saved(owners.join(lead, ["n", "one", "two"]).select("doc_id", "lead"), "twins")
    leads = twins.where("doc_id = lead").select("doc_id")
    # One shuffle of all tiles: those of a single document go where they arrive.
    within = Window.partitionBy("tile")
    every = good.join(leads, "doc_id", "left_semi").select("doc_id", F.explode("tiles").alias("tile"))
    every = every.select("tile", "doc_id", F.min("doc_id").over(within).alias("head"), F.max("doc_id").over(within).alias("tail"))
    found = saved(every.where("head <> tail").select("tile", "doc_id", "head").distinct(), "tile-members")
    # Tiles of the same members are one: a pair that agrees on many parts meets once.
    who = [F.bit_xor(F.xxhash64("doc_id", F.lit(k))).alias(f"who{k}") for k in (1, 2)]
    tiles = found.groupBy("tile", "head").agg(F.count("*").alias("n"), *who).groupBy("n", "head", "who1", "who2").agg(F.min("tile").alias("tile"))
    members = saved(found.join(tiles.select("tile"), "tile", "left_semi").select("tile", "doc_id", "head"), "tile-members")

    stars = saved(members.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct(), "stars")
    seen = saved(_bounded(stars, light, threshold), "pairs")
    copies = twins.where("doc_id <> lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b"))
    links = saved(_links(seen, docs, threshold, words).unionByName(copies), "links")
    # Rounds: 4, 256, ... untested partners of each document and component,
    # until a round leaves none untested.
    take = 4
    while True:
        joined = components(links.select("a", "b"))
        untested = saved(_across(members, joined, light, seen, threshold), "pairs")
        fresh = untested.where(F.col("place") <= take).select("a", "b", F.lit(False).alias("same")).distinct()
        if untested.isEmpty():
            break
        last = untested.where(F.col("place") > take).isEmpty()
        seen = seen.unionByName(fresh)
        links = saved(links.unionByName(_links(fresh, docs, threshold, words)), "links")
        if last:
            joined = components(links.select("a", "b"))
            break
        take *= 64
    rows = signed.select("doc_id", F.col("n").alias("n_shingles")).join(joined.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
    linked = F.when(F.col("n_shingles") > 0, F.col("component"))
    return rows.select("doc_id", "n_shingles", F.coalesce(linked, "doc_id").alias("component_id"))


def _with_sets(pairs: DataFrame, light: DataFrame) -> DataFrame:
    return pairs.join(light.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a").join(light.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b")


def _bounded(pairs: DataFrame, light: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose bounds allow a link; ``same`` marks equal sets."""
    same = (F.col("x.n") == F.col("y.n")) & (F.col("x.one") == F.col("y.one")) & (F.col("x.two") == F.col("y.two"))
    return _with_sets(pairs, light).where(_both(threshold)).select("a", "b", same.alias("same"))


def _links(pairs: DataFrame, docs: DataFrame, threshold: int, words: int) -> DataFrame:
    return pairs.where("same").select("a", "b").unionByName(verified(pairs.where("not same").select("a", "b"), docs, threshold, words))


def _across(members: DataFrame, joined: DataFrame, light: DataFrame, seen: DataFrame, threshold: int) -> DataFrame:
    """Untested pairs that share a tile, lie in different components and can
    link, with their place, best bound first, among those of a document and
    component.  One side lies outside the tile's largest component: a settled
    tile costs nothing.  The bitmaps of a tile are compared block by block in
    arrays; only pairs that the bounds allow become rows."""
    known = joined.select(F.col("id").alias("doc_id"), "component")
    placed = members.select("tile", "doc_id").join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    sizes = placed.groupBy("tile", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("tile").agg(F.count("*").alias("kinds"), F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("m")).where("kinds > 1")
    main = main.select("tile", F.col("m.component").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    # A member meets every block of its tile once: each pair of blocks is a task's unit.
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    full = placed.join(main, "tile").select("tile", "doc_id", "component", F.when(F.col("component") != F.col("main"), True).otherwise(False).alias("odd"), own.alias("block"), "blocks")
    units = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "component", "odd"
    )
    rows = units.join(light.select("doc_id", F.col("s.n").alias("n"), F.col("s.bits").alias("bits"), F.col("s.wide").alias("wide")), "doc_id")
    dealt = rows.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "block", "doc_id")
    close = dealt.select(*UNIT).mapInArrow(_comparer(threshold), "p long, q long, qc long, gap int").distinct()
    close = close.withColumns({"a": F.least("p", "q"), "b": F.greatest("p", "q")}).join(seen.select("a", "b"), ["a", "b"], "left_anti")
    nearest = F.row_number().over(Window.partitionBy("p", "qc").orderBy("gap", "q"))
    return close.select("a", "b", nearest.alias("place"))


BLOCK = 2048  # members of a tile in one block
UNIT = ("tile", "i", "j", "block", "doc_id", "component", "odd", "n", "bits", "wide")


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which each row of one matrix of bitmaps differs from each of the other."""
    out = np.zeros((len(x), len(y)), np.int32)
    for k in range(x.shape[1]):
        out += np.bitwise_count(x[:, None, k] ^ y[None, :, k])
    return out


def _comparer(threshold: int):
    """Batches of units (``UNIT``, in order) -> pairs (p, q, component of q,
    differing bits) of different components that the bounds allow; p lies
    outside the tile's largest component."""

    def compare(unit: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(unit).combine_chunks()
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        block, ids, component, odd, n = (rows.column(c).to_numpy() for c in ("block", "doc_id", "component", "odd", "n"))
        flat = lambda c, width: rows.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, width)
        bits, wide = flat("bits", BITS // 64), flat("wide", WIDE_BITS // 64)
        has_wide = rows.column("wide").combine_chunks().value_lengths().to_numpy() > 0
        wide_at = np.cumsum(has_wide) - 1
        left, right = np.flatnonzero((block == i) & odd), np.flatnonzero(block == j)
        sides = [(left, right)] + ([(np.flatnonzero((block == j) & odd), np.flatnonzero(block == i))] if i != j else [])
        for ps, qs in sides:
            for at in range(0, len(ps), 128):
                p = ps[at : at + 128]
                apart = _apart(bits[p], bits[qs])
                ok = (component[p][:, None] != component[qs][None, :]) & (apart * (100 + threshold) <= (n[p][:, None] + n[qs][None, :]) * (100 - threshold))
                a, b = np.nonzero(ok)
                gap = apart[a, b]
                a, b = p[a], qs[b]
                both = np.flatnonzero(has_wide[a] & has_wide[b])
                if len(both):
                    far = np.bitwise_count(wide[wide_at[a[both]]] ^ wide[wide_at[b[both]]]).sum(1, dtype=np.int32)
                    gap[both] = far
                    keep = np.ones(len(a), bool)
                    keep[both] = far * (100 + threshold) <= (n[a[both]] + n[b[both]]) * (100 - threshold)
                    a, b, gap = a[keep], b[keep], gap[keep]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(component[b]), pa.array(gap, pa.int32())], names=["p", "q", "qc", "gap"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("tile", "i", "j")])
            cuts = np.append(np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1), batch.num_rows)
            for x, y in zip(cuts, cuts[1:]):
                key = tuple(keys[:, x])
                if held and key != now:
                    yield from compare(held)
                    held = []
                now = key
                held.append(batch.slice(int(x), int(y - x)))
        if held:
            yield from compare(held)
        release()

    return run


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))


OP2_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) g from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) i from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 90 * (x.n + y.n - i)),
e as (select a, b from l union select b, a from l),
walk as (select a, b from e union select walk.a, e.b from walk join e on walk.b = e.a),
m as (select a, min(b) m from walk group by a)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) component_id
from documents d left join n on n.doc_id = d.doc_id left join m on m.a = d.doc_id
"""
