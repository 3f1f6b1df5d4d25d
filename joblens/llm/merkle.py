"""Merkle manifest of a dataset: a tree of SHA-256 midstates.

Every document is a leaf.  The leaves of a source, in ascending order, and
then the subroots of the sources are folded by threes.  A parent retains a
copy of its hash state before each child slot, so the digest that follows
from a replaced child costs the matching state, the replacement and the
siblings to its right; those to its left are never hashed again.

Leaves get their places by one range sort (source, doc_id), so a source of
any size lies over many tasks.  A task then builds one aligned block of
3**HEIGHT leaves, whole with all its states; tops of blocks are the leaves of
the next stage.  Checking a claimed leaf reads its block's stored nodes and
the path above the block: no other leaf, no text.

Edge cases: a null field is ``-`` in its leaf; a null doc_id sorts first;
rows that share a source and doc_id are ordered by leaf, equal rows are
leaves of their own; a null source is a source, before all others; a lone
leaf is its source's subroot and a lone subroot the root, with no siblings
(proof of the empty string); an empty table has no rows and no root; other
columns of the input take no part and none of the result's names clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import midstate
from .common import saved, table

ARITY = 3  # fixed by the contract
HEIGHT = 8  # levels that one task builds
BLOCK = ARITY**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree int, source string, block long, n long, level int, idx long, children array<string>, states array<binary>, digest string, top boolean"
STEP = "array<struct<state:binary,left:array<string>,right:array<string>>>"
SOURCES, SUBROOTS = 0, 1  # trees: one of leaves a source, one of subroots


def leaf(text: Column | None = None) -> Column:
    """Digest of a row's fields, each its UTF-8 length, a colon and itself;
    ``text`` stands in for the text."""

    def part(name: str) -> Column:
        value = (F.col(name) if name != "text" or text is None else text).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(part, FIELDS)).cast("binary"), 256)


def _letters(column: pa.Array) -> np.ndarray:
    """(rows, 64) letters of an Arrow column of digests."""
    return np.frombuffer("".join(column.to_pylist()).encode(), np.uint8).reshape(-1, 64)


def _texts(letters: np.ndarray) -> list[str]:
    raw = letters.tobytes().decode()
    return [raw[i : i + 64] for i in range(0, len(raw), 64)]


def _big(words: np.ndarray) -> bytes:
    return words.astype(">u4").tobytes()


def _build(nodes: pa.Table) -> pa.Table:
    """All levels of one block, with the states before each child slot."""
    nodes = nodes.sort_by("pos")
    tree, source, block, n = (nodes.column(c)[0].as_py() for c in ("tree", "source", "block", "n"))
    here, whole, level = _letters(nodes.column("digest")), n, 0
    rows: dict[str, list] = {k: [] for k in ("level", "idx", "children", "states", "digest", "top")}
    if whole == 1:
        rows = {"level": [0], "idx": [0], "children": [[]], "states": [[]], "digest": _texts(here), "top": [True]}
    while whole > 1 and level < HEIGHT:
        kids = np.arange(len(here))
        first = kids[::ARITY]
        count = np.minimum(ARITY, len(here) - first)
        state, before = midstate.start(len(first)), []
        for slot in range(ARITY):
            before.append(state)
            has = np.flatnonzero(count > slot)
            state = state.copy()
            state[:, has] = midstate.absorb(state[:, has], here[first[has] + slot])
        texts = _texts(here)
        here, whole, level = midstate.finish(state, count), -(-whole // ARITY), level + 1
        rows["level"] += [level] * len(first)
        rows["idx"] += range(len(first))
        rows["children"] += [texts[a : a + c] for a, c in zip(first.tolist(), count.tolist())]
        rows["states"] += [[_big(before[s][:, i]) for s in range(c)] for i, c in enumerate(count.tolist())]
        rows["digest"] += _texts(here)
        rows["top"] += [whole == 1 or level == HEIGHT] * len(first)
    size = len(rows["level"])
    same = {"tree": [tree] * size, "source": [source] * size, "block": [block] * size, "n": [n] * size}
    return pa.table(same | rows, schema=_SCHEMA)


_SCHEMA = pa.schema(
    [
        ("tree", pa.int32()), ("source", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
        ("children", pa.list_(pa.string())), ("states", pa.list_(pa.binary())), ("digest", pa.string()), ("top", pa.bool_()),
    ]
)


class _Levels:
    """Stored nodes of one block, level by level."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by([("level", "ascending"), ("idx", "ascending")])
        self.levels = []
        level = np.asarray(nodes.column("level"))
        for k in range(1, int(level.max(initial=0)) + 1):
            part = nodes.slice(int(np.searchsorted(level, k)), int((level == k).sum()))
            kids, states = part.column("children").combine_chunks(), part.column("states").combine_chunks()
            count = np.diff(np.asarray(kids.offsets)).astype(np.int64)
            words = np.frombuffer(b"".join(states.flatten().to_pylist()), ">u4").reshape(-1, 8).T.astype(np.uint32)
            self.levels.append((count, _letters(kids.flatten()), words))

    def steps(self, at: np.ndarray):
        """Per level: state before the slot, slot, children of the parent and where they begin."""
        for count, kids, words in self.levels:
            up, slot = at // ARITY, at % ARITY
            yield words[:, at], slot, count[up], kids, up * ARITY
            at = up


def _paths(nodes: pa.Table, tree: pa.Table) -> pa.Table:
    """Path of each node through its block: state before it, siblings left and right."""
    nodes = nodes.sort_by("pos")
    at = np.asarray(nodes.column("pos")) % BLOCK
    path: list[list[dict]] = [[] for _ in at]
    for state, slot, count, kids, first in _Levels(tree).steps(at):
        texts = _texts(kids)
        for i in range(len(at)):
            a, s, c = int(first[i]), int(slot[i]), int(count[i])
            path[i].append({"state": _big(state[:, i]), "left": texts[a : a + s], "right": texts[a + s + 1 : a + c]})
    return pa.table({"tree": nodes.column("tree"), "source": nodes.column("source"), "pos": nodes.column("pos"), "path": pa.array(path, _PATH)})


_PATH = pa.list_(pa.struct([("state", pa.binary()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))


def _fold(leaves: pa.Table, tree: pa.Table) -> pa.Table:
    """Folded roots and proofs of the leaves of one block."""
    path_row = tree.filter(pa.compute.equal(tree.column("level"), -1)).slice(0, 1).to_pylist()[0]
    leaves = leaves.sort_by("pos")
    at = np.asarray(leaves.column("pos")) % BLOCK
    here, n = _letters(leaves.column("claimed")), len(at)
    proof, proof_blocks = midstate.start(n), np.zeros(n, np.int64)
    for state, slot, count, kids, first in _Levels(tree.filter(pa.compute.greater(tree.column("level"), 0))).steps(at):
        state = midstate.absorb(state, here)
        for k in range(ARITY):
            right = np.flatnonzero((k > slot) & (k < count))
            state[:, right] = midstate.absorb(state[:, right], kids[first[right] + k])
            other = np.flatnonzero((k != slot) & (k < count))
            proof[:, other] = midstate.absorb(proof[:, other], kids[first[other] + k])
            proof_blocks[other] += 1
        here = midstate.finish(state, count)
    same = lambda digest: np.broadcast_to(np.frombuffer(digest.encode(), np.uint8), (n, 64))
    for step in path_row["path"]:
        state = np.repeat(np.frombuffer(step["state"], ">u4").astype(np.uint32)[:, None], n, 1)
        state = midstate.absorb(state, here)
        for digest in step["right"]:
            state = midstate.absorb(state, same(digest))
        siblings = step["left"] + step["right"]
        for digest in siblings:
            proof = midstate.absorb(proof, same(digest))
        proof_blocks += len(siblings)
        here = midstate.finish(state, np.full(n, len(siblings) + 1))
    folded = _texts(here)
    return pa.table(
        {
            "doc_id": leaves.column("doc_id"),
            "leaf": leaves.column("leaf"),
            "subroot": [path_row["subroot"]] * n,
            "root": [path_row["root"]] * n,
            "proof_sha256": _texts(midstate.finish(proof, proof_blocks)),
            "folded_root": folded,
            "verified": [f == path_row["root"] for f in folded],
        },
        schema=_FOLDED,
    )


_FOLDED = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])
FOLDED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


@dataclass
class Manifest:
    """Written tables of a tree: places of the leaves, nodes with their
    states, and per block of leaves the path to the root."""

    leaves: DataFrame  # source, doc_id, leaf, further columns, pos, n, block
    nodes: DataFrame  # NODES, of the blocks of leaves
    paths: DataFrame  # source, block, path, subroot, root


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their position ``pos`` and the number ``n`` of rows of their
    source, by one range sort; equal rows may take each other's places."""
    rows = rows.withColumn("_salt", F.monotonically_increasing_id())
    keys = ["source", *order, "_salt"]
    ordered = saved(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt").withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33)
    parts = ordered.groupBy("source", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # The windows hold one row per source and partition.
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("source").alias("_source"), "_part", "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy("source")).alias("n"),
    )
    joined = ordered.join(parts, ordered["source"].eqNullSafe(parts["_source"]) & (part == parts["_part"]))
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    return joined.withColumn("pos", pos).withColumn("block", F.floor(pos / BLOCK)).drop("_at", "_part", "_first", "_before", "_source")


def _stage(nodes: DataFrame, name: str) -> DataFrame:
    """Blocks of ``nodes`` (tree, source, pos, n, block, digest), built and written."""
    nodes = nodes.select("tree", "source", "pos", "n", "block", "digest")
    return saved(nodes.groupBy("tree", "source", "block").applyInArrow(_build, NODES), name)


def _tops(built: DataFrame) -> DataFrame:
    """Tops of blocks as the nodes of the next stage."""
    return built.where("top").select("tree", "source", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.floor(F.col("block") / BLOCK).alias("block"), "digest")


def _climb(nodes: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Stages (their nodes, what was built) until each source has one top; the tops.
    A stage has 6561 times fewer nodes than the one before."""
    stages = []
    while True:
        built = _stage(nodes, "merkle-nodes")
        stages.append((nodes, built))
        nodes = _tops(built)
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return stages, nodes


def _block_paths(stages: list[tuple[DataFrame, DataFrame]], above: DataFrame) -> DataFrame:
    """Paths of the nodes that ``stages`` begin with; ``above`` has the paths
    (source, path) of their tops."""
    for nodes, built in reversed(stages):
        own = nodes.groupBy("tree", "source", "block").cogroup(built.groupBy("tree", "source", "block")).applyInArrow(_paths, f"tree int, source string, pos long, path {STEP}")
        up = above.select(F.col("source").alias("_source"), F.col("pos").alias("_pos"), F.col("path").alias("_path"))
        joined = own.join(up, own["source"].eqNullSafe(up["_source"]) & (F.floor(own["pos"] / BLOCK) == up["_pos"]))
        above = joined.select("source", "pos", F.concat("path", "_path").alias("path"))
    return above


def build(leaves: DataFrame) -> Manifest:
    """Manifest of ``leaves`` (source, doc_id, leaf; further columns stay)."""
    leaves = saved(_placed(saved(leaves, "merkle-leaves"), "doc_id", "leaf"), "merkle-placed")
    bottom = _stage(leaves.select(F.lit(SOURCES).alias("tree"), "source", "pos", "n", "block", F.col("leaf").alias("digest")), "merkle-nodes")
    stages, subroots = _climb(_tops(bottom))
    subroots = subroots.select("source", F.col("digest").alias("subroot"))
    # One tree of the subroots: they are its only "source" (null); their own names give the order.
    named = saved(_placed(subroots.select(F.lit(None).cast("string").alias("source"), F.col("source").alias("name"), "subroot"), "name"), "merkle-subroots")
    over, root = _climb(named.select(F.lit(SUBROOTS).alias("tree"), "source", "pos", "n", "block", F.col("subroot").alias("digest")))
    root = root.select(F.col("source"), "pos", F.array().cast(STEP).alias("path"), F.col("digest").alias("root"))
    to_root = _block_paths(over, root).withColumnRenamed("pos", "_at").drop("source")
    top = root.first()  # one row
    subroot_paths = named.join(to_root, named["pos"] == to_root["_at"]).select(F.col("name").alias("source"), F.lit(0).cast("long").alias("pos"), "path")
    paths = _block_paths(stages, subroot_paths).select("source", F.col("pos").alias("block"), "path")
    ends = subroots.select(F.col("source").alias("_source"), "subroot", F.lit(top and top["root"]).alias("root"))
    paths = paths.join(ends, paths["source"].eqNullSafe(ends["_source"])).select("source", "block", "path", "subroot", "root")
    return Manifest(leaves, bottom, saved(paths, "merkle-paths"))


def verify(manifest: Manifest) -> DataFrame:
    """Fold the ``claimed`` digest of every leaf to the root with the stored
    states and siblings: doc_id, leaf, subroot, root, proof_sha256 (of all
    siblings on the way), folded_root, verified."""
    nothing = lambda kind: F.lit(None).cast(kind)
    nodes = manifest.nodes.select("source", "block", "level", "idx", "children", "states", nothing(STEP).alias("path"), nothing("string").alias("subroot"), nothing("string").alias("root"))
    ways = manifest.paths.select("source", "block", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("idx"), nothing("array<string>").alias("children"), nothing("array<binary>").alias("states"), "path", "subroot", "root")
    key = ("source", "block")
    leaves = manifest.leaves.select(*key, "pos", "doc_id", "leaf", "claimed")
    return leaves.groupBy(*key).cogroup(nodes.unionByName(ways).groupBy(*key)).applyInArrow(_fold, FOLDED)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *FIELDS)
    damaged = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    # The second digest only where the damage changes the text.
    hit = damaged & F.coalesce(F.contains("text", F.lit("\n")), F.lit(False))
    claimed = F.when(hit, leaf(F.replace("text", F.lit("\n"), F.lit("")))).otherwise(leaf())
    return verify(build(docs.select("source", "doc_id", leaf().alias("leaf"), claimed.alias("claimed"))))


#: crc32 of the decimal doc_id: its letters in turn, eight shifts each.
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"""

_LEAF = """sha256(coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') || coalesce(strlen({0}) || ':' || {0}, '-'))"""

OP13_SQL = f"""
with recursive leaves as (
  select doc_id, source, leaf, claimed, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n
  from (select doc_id, source, {_LEAF.format("text")} as leaf,
          case when doc_id is not null and {_CRC} % 2 = 0 then {_LEAF.format("replace(text, chr(10), '')")} else {_LEAF.format("text")} end as claimed
        from documents)),
level(depth, source, pos, n, digest) as (
  select 0, source, pos, n, leaf from leaves
  union all
  select any_value(depth) + 1, source, pos // 3, any_value(n + 2) // 3, sha256(string_agg(digest, '' order by pos)) from level where n > 1 group by source, pos // 3),
run as (select depth, source, pos // 3 as parent, list(digest order by pos) as kids from level where n > 1 group by depth, source, pos // 3),
walk(depth, doc_id, leaf, source, pos, n, folded, siblings) as (
  select 0, doc_id, leaf, source, pos, n, claimed, '' from leaves
  union all
  select w.depth + 1, doc_id, leaf, w.source, pos // 3, (n + 2) // 3,
    sha256(array_to_string(list_transform(kids, lambda x, i: case when i = pos % 3 + 1 then folded else x end), '')), siblings || array_to_string(list_filter(kids, lambda x, i: i <> pos % 3 + 1), '')
  from walk w join run r on w.depth = r.depth and w.source is not distinct from r.source and w.pos // 3 = r.parent where n > 1),
subroots as (select source, digest as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from level where n = 1),
level2(depth, pos, n, digest) as (
  select 0, pos, n, subroot from subroots
  union all
  select any_value(depth) + 1, pos // 3, any_value(n + 2) // 3, sha256(string_agg(digest, '' order by pos)) from level2 where n > 1 group by pos // 3),
run2 as (select depth, pos // 3 as parent, list(digest order by pos) as kids from level2 where n > 1 group by depth, pos // 3),
walk2(depth, doc_id, leaf, subroot, pos, n, folded, siblings) as (
  select 0, doc_id, leaf, subroot, s.pos, s.n, folded, siblings from walk w join subroots s on w.source is not distinct from s.source where w.n = 1
  union all
  select w.depth + 1, doc_id, leaf, subroot, pos // 3, (n + 2) // 3,
    sha256(array_to_string(list_transform(kids, lambda x, i: case when i = pos % 3 + 1 then folded else x end), '')), siblings || array_to_string(list_filter(kids, lambda x, i: i <> pos % 3 + 1), '')
  from walk2 w join run2 r on w.depth = r.depth and w.pos // 3 = r.parent where n > 1),
top as (select digest as root from level2 where n = 1)
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, folded as folded_root, folded = root as verified from walk2, top where n = 1
"""
