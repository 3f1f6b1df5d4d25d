"""Removal of repeated byte strings by prefix-free parsing and suffix arrays.

A byte is removed when a string of ``length`` bytes that covers it also starts
earlier in the corpus (smaller doc_id, or same document and earlier start).

* **Parse.**  A rolling hash of ``GRAM`` bytes runs over every document.  A
  place is a trigger when its hash is the smallest of a string of ``length``
  bytes around it (the leftmost of equal ones), so every such string holds
  exactly one deciding trigger, which depends on its bytes alone; a hash
  taken modulo a number would leave strings without any.  The strings decided
  by one trigger are neighbours; together they are a phrase.
* **Dictionary.**  Phrases whose trigger occurs once in the corpus cannot hold
  a repeated string and leave at once.  Of equal phrases all but the first
  are repeats as a whole, however often they occur, and only the first goes on.
* **Order.**  Different phrases around the same trigger are sorted by a suffix
  array (prefix doubling up to ``length`` bytes).  A phrase reaches ``length``
  bytes past each of its strings, so its own suffixes decide the order that
  phrase suffix and following parse give in the usual combination.  In each
  run of equal strings the earliest stays.

Triggers with more than ``HOT`` different phrases (a passage inside very many
different texts) are compared through one fingerprint for each string,
summed before the shuffle, instead of in one suffix array.

Equality is that of 128-bit fingerprints for whole phrases (trigger and
phrase, 64 bits each) and of bytes in the suffix arrays.

Edge cases: null text is empty; texts shorter than ``length`` lose nothing; a
null doc_id sorts before all others; repeated rows (same doc_id and text) are
one document and each row reports the same result; different texts under one
doc_id compare by start, equal starts by the texts' hashes; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, saved, slices, table, utf8

LENGTH = 100
GRAM = 32  # bytes under the rolling hash, a power of two below LENGTH
HOT = 20_000  # different phrases of one trigger that one task may sort
CHUNK = 1 << 19  # bytes in one suffix array
STEP = 1 << 19  # bytes of text worked on at once
FIRST = -(1 << 63)  # stands for a null doc_id
PLACES = "doc long, at long, tag long"  # at: start << 32 | crc32 of the text; tag: another hash of it
_POS = np.uint64((1 << 32) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def rolling(data: np.ndarray, weight: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at every place, by doubling."""
    h, n, power = weight[data], 1, 0x9E3779B97F4A7C15
    while n < gram:
        h = h[: len(h) - n] * np.uint64(power) + h[n:]
        power, n = power * power % (1 << 64), 2 * n
    return _mix(h)


def weights(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def phrases(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray, length: int, gram: int):
    """(document, first string, end of strings, trigger hash) of every phrase
    of some texts, places counted in ``data``; a slice holds below 4 GB."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    h = rolling(data, weight, gram)
    span, n = length - gram + 1, 1
    low = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)  # equal hashes: leftmost
    while 2 * n <= span:
        low, n = np.minimum(low[: len(low) - n], low[n:]), 2 * n
    if span > n:
        low = np.minimum(low[: len(low) - span + n], low[span - n :])
    at = (low & _POS).astype(np.int64)
    places = np.arange(len(at))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    inside = places + length <= offsets[doc + 1]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(at))
    ok = inside[start]
    start, end = start[ok], end[ok]
    return doc[start], start, end, h[at[start]]


def range_hash(data: np.ndarray, a: np.ndarray, b: np.ndarray, seed: int = 7) -> np.ndarray:
    """64-bit hash of the byte ranges [a, b), whatever their place."""
    base = 0xD1342543DE82EF95
    step = np.full(len(data) + 1, base, np.uint64)
    step[0] = 1
    power = np.cumprod(step, dtype=np.uint64)
    step[1:] = pow(base, -1, 1 << 64)
    undo = np.cumprod(step, dtype=np.uint64)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(weights(seed)[data] * power[: len(data)], out=run[1:])
    return _mix((run[b] - run[a]) * undo[a] + (b - a).astype(np.uint64))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, crc, tag, text) with defined values for nulls."""
    return docs.select(*_identity("doc_id", "text"), F.coalesce("text", F.lit("")).alias("text"))


def _identity(doc_id: str, text: str) -> list[Column]:
    """Which text this is: its id, and 96 bits of hashes, since rows without
    an id (or with one id) hold different texts."""
    text = F.coalesce(F.col(text), F.lit(""))
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("doc"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("tag")]


def parse(docs: DataFrame, length: int, gram: int, only_triggers: bool) -> DataFrame:
    """Phrases of ``keyed`` documents, or just their triggers and counts."""

    def run(batches):
        weight = weights(11)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("doc").to_numpy()
            crc, tag = batch.column("crc").to_numpy(), batch.column("tag").to_numpy()
            for r0, r1 in slices(offsets, STEP):
                own, off = data[offsets[r0] : offsets[r1]], offsets[r0 : r1 + 1] - offsets[r0]
                doc, a, b, trigger = phrases(own, off, weight, length, gram)
                if only_triggers:
                    kinds, counts = np.unique(trigger, return_counts=True)
                    yield pa.RecordBatch.from_arrays([_long(kinds), pa.array(counts)], names=["trigger", "n"])
                    continue
                phrase = range_hash(own, a, b + length - 1)
                at = (a - off[doc]) << 32 | crc[r0 + doc]
                yield pa.RecordBatch.from_arrays(
                    [_long(trigger), _long(phrase), pa.array(ids[r0 + doc]), pa.array(at), pa.array(tag[r0 + doc]), pa.array((b - a).astype(np.int32))],
                    names=["trigger", "phrase", "doc", "at", "tag", "strings"],
                )
        release()

    schema = "trigger long, n long" if only_triggers else f"trigger long, phrase long, {PLACES}, strings int"
    return docs.select("doc", "crc", "tag", "text").mapInArrow(run, schema)


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix of ``data`` by its first ``length`` bytes, by
    prefix doubling; shorter suffixes sort before those they begin.  A rank is
    the number of smaller suffixes, so one that is alone keeps it for good and
    only ties are sorted again."""
    size = len(data)
    n = min(7, length)  # bytes, each plus one to leave 0 for the end, in one 63-bit number
    key = np.zeros(size, np.int64)
    for k in range(n):
        key *= 257
        key[: max(size - k, 0)] += data[k:].astype(np.int64) + 1
    rank = np.zeros(size + 1, np.int64)  # the last one is the empty suffix

    def place(at: np.ndarray, key: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Rank the suffixes ``at`` by a key that begins with their rank
        ``base``; returns those still tied."""
        order = np.argsort(key)
        key, base = key[order], base[order]
        new, other = np.ones((2, len(at)), bool)
        new[1:], other[1:] = key[1:] != key[:-1], base[1:] != base[:-1]
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        first = np.flatnonzero(other)[np.cumsum(other) - 1]
        rank[at[order]] = base + heads[group] - first
        return at[order[np.diff(np.append(heads, len(at)))[group] > 1]]

    tied = place(np.arange(size), key, np.ones(size, np.int64)) if size else np.zeros(0, np.int64)
    while n < length and len(tied):
        step, own = min(n, length - n), rank[tied]
        tied = place(tied, own * (size + 1) + rank[np.minimum(tied + step, size)], own)
        n += step
    return rank[:size]


def repeats_in_order(rows: list[tuple[int, int, int, bytes, int]], length: int) -> list[tuple[int, int, int, int]]:
    """(doc, at, tag, strings) ranges of strings that an earlier place holds
    too, among phrases (doc, at, tag, bytes, strings); ``at`` is that of the range."""
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    first = np.cumsum(sizes) - sizes
    strings = np.array([r[4] for r in rows])
    which = np.repeat(np.arange(len(rows)), strings)
    shift = np.arange(len(which)) - np.repeat(np.cumsum(strings) - strings, strings)
    rank = suffix_ranks(data, length)[first[which] + shift]
    doc = np.array([r[0] for r in rows])[which]
    at = np.array([r[1] for r in rows])[which] + (shift << 32)
    tag = np.array([r[2] for r in rows])[which]
    order = np.lexsort((tag, at, doc, rank))
    r, d, p, g = rank[order], doc[order], at[order], tag[order]
    head = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
    lead = np.repeat(head, np.diff(np.append(head, len(r))))
    late = (d != d[lead]) | (p != p[lead]) | (g != g[lead])
    gone = np.zeros(len(r), bool)
    gone[order] = late
    hit = np.flatnonzero(gone)
    if not len(hit):
        return []
    cut = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (which[hit][1:] != which[hit][:-1])))
    run = np.diff(np.append(cut, len(hit)))
    return list(zip(doc[hit[cut]].tolist(), at[hit[cut]].tolist(), tag[hit[cut]].tolist(), run.tolist()))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, at, tag, strings): runs of strings that start earlier elsewhere."""
    texts = keyed(docs)
    counts = parse(texts, length, gram, True).groupBy("trigger").agg(F.sum("n").alias("n"))
    common = saved(counts.where("n > 1").select("trigger"), "triggers")
    some = saved(parse(texts, length, gram, False).join(common, "trigger", "left_semi"), "phrases")
    place = F.struct("doc", "at", "tag")
    firsts = saved(some.groupBy("trigger", "phrase").agg(F.min(place).alias("first"), F.first("strings").alias("strings")), "dictionary")
    later = some.join(firsts.select("trigger", "phrase", "first"), ["trigger", "phrase"]).where(place != F.col("first")).select("doc", "at", "tag", "strings")

    shared = firsts.groupBy("trigger").agg(F.count("*").alias("kinds")).where("kinds > 1")
    entries = firsts.join(shared, "trigger").select("trigger", "kinds", "first.doc", "first.at", "first.tag", "strings")
    # The bytes of these phrases, cut from the texts of their first places.
    wanted = entries.withColumn("crc", F.col("at").bitwiseAND(0xFFFFFFFF)).groupBy("doc", "crc", "tag").agg(F.collect_list(F.struct("trigger", "kinds", "at", "strings")).alias("cuts"))
    start = F.shiftright(F.col("c.at"), 32).cast("int")
    cut = texts.join(wanted, ["doc", "crc", "tag"]).select("doc", "tag", F.col("text").cast("binary").alias("raw"), F.explode("cuts").alias("c"))
    cut = cut.select("c.trigger", "c.kinds", "doc", "c.at", "tag", "c.strings", F.substring("raw", start + 1, F.col("c.strings") + F.lit(length - 1)).alias("raw"))
    entries = saved(cut, "entries")

    def sort(batches):
        held: list[tuple] = []
        size, trigger = 0, None

        def emit():
            found = repeats_in_order(held, length)
            cols = list(zip(*found)) if found else [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["doc", "at", "tag", "strings"])

        for batch in batches:
            for t, doc, at, tag, strings, raw in zip(*(batch.column(c).to_pylist() for c in ("trigger", "doc", "at", "tag", "strings", "raw"))):
                if t != trigger and size >= CHUNK:
                    yield emit()
                    held, size = [], 0
                trigger = t
                held.append((doc, at, tag, raw, strings))
                size += len(raw)
        if held:
            yield emit()
        release()

    cool = entries.where(F.col("kinds") <= HOT).repartition("trigger").sortWithinPartitions("trigger", "doc", "at")
    ordered = cool.select("trigger", "doc", "at", "tag", "strings", "raw").mapInArrow(sort, f"{PLACES}, strings int")

    def strings_of(batches):
        for batch in batches:
            for doc, at, tag, strings, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "at", "tag", "strings", "raw"))):
                a = np.arange(strings)
                data = np.frombuffer(raw, np.uint8)
                one, two = (range_hash(data, a, a + length, seed) for seed in (7, 8))
                yield pa.RecordBatch.from_arrays([_long(one), _long(two), pa.array(np.full(strings, doc)), pa.array(at + (a << 32)), pa.array(np.full(strings, tag))], names=["one", "two", "doc", "at", "tag"])

    hot = entries.where(F.col("kinds") > HOT).select("doc", "at", "tag", "strings", "raw").mapInArrow(strings_of, f"one long, two long, {PLACES}")
    lead = hot.groupBy("one", "two").agg(F.min(place).alias("first"))
    single = hot.join(lead, ["one", "two"]).where(place != F.col("first")).select("doc", "at", "tag", F.lit(1).alias("strings"))
    return later.unionByName(ordered).unionByName(single)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, into: str = "repeats") -> DataFrame:
    """``docs`` with one more column ``into``: a struct of kept (binary, the
    remaining bytes), readable (string, the same without the halves of
    characters that a cut left), n_bytes, n_removed and n_spans.  A column that
    has its name, in any case of letters, is replaced."""
    found = repeated_ranges(docs, length, gram)
    # Equal rows give the same runs: a set of them.
    runs = found.groupBy("doc", F.col("at").bitwiseAND(0xFFFFFFFF).alias("crc"), "tag").agg(
        F.collect_set(F.struct(F.shiftright("at", 32).alias("a"), (F.shiftright("at", 32) + F.col("strings") + (length - 1)).alias("b"))).alias("runs")
    )

    @F.arrow_udf("kept binary, readable string, n_bytes long, n_removed long, n_spans long")
    def strip(texts, runs):
        data, offsets = utf8(texts)
        flat = runs.flatten()
        a, b = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)) if len(flat) else (np.zeros(0, np.int64),) * 2
        sizes = np.array([0 if n is None else n for n in runs.value_lengths().to_pylist()], np.int64)
        ends = np.cumsum(sizes)
        kept, readable, lengths, removed, n_spans = [], [], [], [], []
        for i in range(len(texts)):
            raw = data[offsets[i] : offsets[i + 1]]
            own = slice(ends[i] - sizes[i], ends[i])
            if not sizes[i]:
                kept.append(raw.tobytes())
                n, spans = 0, 0
            else:
                depth = np.bincount(a[own], minlength=len(raw) + 1)[: len(raw) + 1] - np.bincount(b[own], minlength=len(raw) + 1)[: len(raw) + 1]
                gone = np.cumsum(depth)[: len(raw)] > 0
                kept.append(raw[~gone].tobytes())
                n, spans = int(gone.sum()), int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
            readable.append(kept[-1].decode("utf-8", "ignore"))
            lengths.append(len(raw))
            removed.append(n)
            n_spans.append(spans)
        release()
        columns = [pa.array(kept, pa.binary()), pa.array(readable, pa.string()), *(pa.array(c, pa.int64()) for c in (lengths, removed, n_spans))]
        return pa.StructArray.from_arrays(columns, names=["kept", "readable", "n_bytes", "n_removed", "n_spans"])

    # The place of a row joins its runs; the row itself passes through as one struct.
    rows = docs.select(F.struct(*docs.columns).alias("row")).select("row", *_identity("row.doc_id", "row.text"))
    joined = rows.join(runs, ["doc", "crc", "tag"], "left").select("row", strip(F.col("row.text"), "runs").alias(into))
    return joined.select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() != into.lower()), into)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "repeats.*")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, octet_length(encode(coalesce(text, ''))) n from documents),
s as (select doc_id, p, substr(h, (2 * p + 1)::bigint, 200) g from (select doc_id, h, unnest(range(0, greatest(n - 99, 0))) p from d)),
f as (select doc_id, p from s qualify row_number() over (partition by g order by doc_id, p) > 1),
t as (select doc_id, p, coalesce(p > lag(p) over (partition by doc_id order by p) + 100, true)::int fresh from f),
r as (select doc_id, p, sum(fresh) over (partition by doc_id order by p) k from t),
c as (select doc_id, k, min(p) a, max(p) + 100 b from r group by doc_id, k),
g as (select c.doc_id, a, b, lag(b, 1, 0) over (partition by c.doc_id order by a) z from c),
x as (select g.doc_id, sum(b - a) removed, count(*) spans, max(b) last, string_agg(substr(h, (2 * z + 1)::bigint, (2 * (a - z))::bigint), '' order by a) kept
      from g join d using (doc_id) group by g.doc_id)
select d.doc_id, n::bigint n_bytes, coalesce(removed, 0)::bigint n_removed, coalesce(spans, 0)::bigint n_spans,
       sha256(unhex(case when x.doc_id is null then h else kept || substr(h, (2 * last + 1)::bigint) end)) kept_sha256
from d left join x on x.doc_id = d.doc_id
"""
