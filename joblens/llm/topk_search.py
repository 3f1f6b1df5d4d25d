"""Exact top-k inner-product search with a ball tree per shard.

A coarse tree of planes, fitted on a bounded sample, gives every row a cell of
like vectors, and a cell is dealt by row number into shards of a bounded
size, so a group of copies is only more shards.  Each
shard becomes one row that holds its ball tree.  Queries travel in blocks cut
the same way.  The roots of the shards (centre and radius, no vectors) form
small directories.  A block first searches the shard whose centre promises
most, whose k-th best scores are true lower bounds.  Then it is held against
the directories, and only shards whose root bound q.c + |q| r reaches some
query's k-th score are joined with the block; they are visited carrying the
k-th scores along.  In a tree, nodes are ordered by the same bound, and a node
no query can still use is skipped with all below it.  The sample decides only
which vectors lie together: every row stands in a shard.

Vectors are integers (components scaled and floored), so scores are exact.

Edge cases: vectors that are null, empty or hold null or non-finite
components take no part; fewer than k candidates give fewer rows; ties go to
the smaller vec_id; vectors of another length than the query's are no
candidates; a repeated vec_id is a candidate once per row, but a row is never
a candidate of a query with its own vec_id; other columns are ignored.
Components beyond 2^20 after scaling are handled in exact integer arithmetic
and scores are held to the range of a long.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import saved, table

K, SCALE, QUERY_EVERY = 5, 256, 50
SHARD = 8192  # candidates in a shard
QUERY_BLOCK = 512
LEAF = 128
CELLS = 256  # cells of the coarse tree, at most
SAMPLE = 16384  # about so many rows fit the coarse tree
DIRECTORY = 256  # shard roots in a directory
EXACT = float(1 << 52)  # sums below this are exact in double precision
LONG = (1 << 63) - 1


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, dims) of the usable rows: v holds floor(scale * x) as doubles."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # A double of 2^52 or more is whole; floor to a long and back would clip large ones.
    whole = lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)
    floored = F.transform(v, lambda x: whole(x.cast("double") * scale))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite & (F.size(v) > 0), F.lit(False)))
    return rows.select("vec_id", floored.alias("v"), F.size(v).alias("dims"))


def ball_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """(row order, nodes, centres, radii).  A node is (first row, end row,
    right child); its left child follows it, a leaf has right child 0."""
    order, nodes, centres, radii = np.arange(len(x)), [], [], []

    def build(a: int, b: int) -> None:
        own = x[order[a:b]]
        c = own.mean(0)
        d = np.sqrt(((own - c) ** 2).sum(1))
        at = len(nodes)
        nodes.append((a, b, 0))
        centres.append(c)
        radii.append(d.max() * (1 + 1e-12) + 1e-9 * (1 + np.abs(c).max()))
        if b - a <= leaf or radii[at] == 0:
            return
        # Split halfway between the two far ends of the ball.
        p = own[d.argmax()]
        q = own[((own - p) ** 2).sum(1).argmax()]
        side = own @ (p - q)
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(side, half)]
        build(a, a + half)
        nodes[at] = (a, b, len(nodes))
        build(a + half, b)

    if len(x):
        build(0, len(x))
    return order, nodes, np.array(centres).reshape(len(nodes), -1), np.array(radii)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held to the range of a long."""
    if not q.size or not x.size or np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.array([[int(c) for c in r] for r in q], object) @ np.array([[int(c) for c in r] for r in x], object).T
    return np.vectorize(lambda s: max(-LONG, min(LONG, s)), otypes=[np.int64])(whole)


class Best:
    """The k best (score, vec_id) of every query of a block so far."""

    def __init__(self, n: int, k: int):
        self.score, self.ids = np.full((n, k), -LONG - 1, np.int64), np.full((n, k), LONG, np.int64)
        self.k = k

    def kth(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of some queries: matrices of scores and vec_ids, -LONG - 1 where none."""
        score, ids = np.concatenate([self.score[rows], score], 1), np.concatenate([self.ids[rows], ids], 1)
        take = _order(score, ids)[:, : self.k]
        self.score[rows], self.ids[rows] = np.take_along_axis(score, take, 1), np.take_along_axis(ids, take, 1)


def _order(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Column order by score descending, then vec_id."""
    by_id = np.argsort(ids, 1, kind="stable")
    by_score = np.argsort(~np.take_along_axis(score, by_id, 1), 1, kind="stable")  # ~x reverses the order of longs
    return np.take_along_axis(by_id, by_score, 1)


def search(q: np.ndarray, q_ids: np.ndarray, tree, x: np.ndarray, x_ids: np.ndarray, best: Best) -> None:
    """Branch and bound over one shard for a block of queries."""
    order, nodes, centres, radii = tree
    if not len(nodes) or not len(q):
        return
    norm = np.sqrt((q * q).sum(1))
    bound = q @ centres.T + norm[:, None] * radii[None, :]
    bound += 1e-9 * (np.abs(bound) + 1)
    top = bound.max(0)
    heap = [(-top[0], 0)]
    while heap:
        _, at = heapq.heappop(heap)
        # A tie with the k-th score can still win by its vec_id.
        rows = np.flatnonzero(bound[:, at] >= best.kth())
        if not len(rows):
            continue
        a, b, right = nodes[at]
        if right:
            for child in (at + 1, right):
                heapq.heappush(heap, (-top[child], child))
            continue
        own = order[a:b]
        score = products(q[rows], x[own])
        other = q_ids[rows][:, None] != x_ids[own][None, :]
        useful = (score >= best.kth()[rows][:, None]) & other
        some = np.flatnonzero(useful.any(1))
        if len(some):
            best.add(rows[some], np.where(useful[some], score[some], -LONG - 1), np.where(useful[some], x_ids[own][None, :], LONG))


def coarse_tree(x: np.ndarray, cells: int = CELLS) -> list[tuple[np.ndarray, float, int, int]]:
    """Planes (direction, cut, left, right) over a sample; a negative child
    -1 - c is cell c.  The cell with the largest sum of squared distances from
    its centre is cut next, halfway between its far ends, until there are
    ``cells`` or all vectors of a cell are equal."""
    planes: list = []
    open_cells: list = []
    n_cells = offers = 0

    def offer(rows: np.ndarray, parent: int, side: int) -> None:
        nonlocal offers
        offers += 1
        own = x[rows]
        d = ((own - own.mean(0)) ** 2).sum(1)
        heapq.heappush(open_cells, (-float(np.nan_to_num(d.sum())), offers, rows, parent, side, own[d.argmax()]))

    if len(x):
        offer(np.arange(len(x)), -1, 0)
    done = []
    while open_cells:
        _, _, rows, parent, at, far = heapq.heappop(open_cells)
        own = x[rows]
        other = own[((own - far) ** 2).sum(1).argmax()]
        direction = far - other
        cut = float((far + other) @ direction / 2)
        low = own @ direction < cut
        if len(done) + len(open_cells) + 1 >= cells or not low.any() or low.all():
            done.append((parent, at))
            continue
        here = len(planes)
        planes.append([direction, cut, 0, 0])
        if parent >= 0:
            planes[parent][at] = here
        offer(rows[low], here, 2)
        offer(rows[~low], here, 3)
    for parent, at in done:
        if parent >= 0:
            planes[parent][at] = -1 - n_cells
        n_cells += 1
    return [tuple(p) for p in planes]


def cell_of(x: np.ndarray, planes: list) -> np.ndarray:
    """Cell of every row."""
    cell = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))] if planes else []
    while todo:
        at, rows = todo.pop()
        if at < 0:
            cell[rows] = -1 - at
            continue
        direction, cut, left, right = planes[at]
        low = x[rows] @ direction < cut
        todo += [(left, rows[low]), (right, rows[~low])]
    return cell


def roots_reached(q: np.ndarray, kth: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """True for balls in which some query of a block can still find a score of at least its k-th."""
    bound = q @ centres.T + np.sqrt((q * q).sum(1))[:, None] * radii[None, :]
    bound += 1e-9 * (np.abs(bound) + 1)
    return ~(bound < kth[:, None]).all(0)


def _components(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _celled(rows: DataFrame, samples: dict[int, np.ndarray], cells: int) -> DataFrame:
    """Rows with their cell; lengths that the sample has not seen are cell 0."""
    trees = {d: coarse_tree(x, min(CELLS, cells)) for d, x in samples.items()}

    def run(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                cell[own] = cell_of(_components(batch.column("v").take(pa.array(own)), int(d)), trees.get(int(d), []))
            yield batch.append_column("cell", pa.array(cell))

    return rows.mapInArrow(run, StructType([*rows.schema, StructField("cell", LongType())]))


class Pieces:
    """Shards, query blocks and directories of one search, as written tables."""

    def __init__(self, vectors: DataFrame, queries: DataFrame, shard: int = SHARD, query_block: int = QUERY_BLOCK):
        n = max(1, vectors.count())
        # Chosen by row number: repeats of one vec_id cannot swell the sample.
        dice = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
        self.n = n
        sample = vectors.where(dice <= int((1 << 30) * min(1.0, SAMPLE / n))).select("dims", "v").toArrow()
        samples = {}
        for d in sample.column("dims").unique().to_pylist():
            own = sample.filter(pa.compute.equal(sample.column("dims"), d)).column("v").combine_chunks()
            samples[d] = _components(own, d)
        self.lengths = list(samples)
        self.shards = saved(self._pack(saved(_celled(vectors, samples, -(-n // shard)), "vectors"), "shard", shard, True), "shards")
        m = max(1, queries.count())
        blocks = self._pack(saved(_celled(queries, samples, -(-m // query_block)), "queries"), "block", query_block, False)
        self.blocks = saved(blocks.select("block", "dims", F.col("ids").alias("q_ids"), F.col("v").alias("q")), "query-blocks")
        self.n_directories = max(1, -(-self.shards.count() // DIRECTORY))
        number = F.pmod(F.xxhash64("shard"), F.lit(self.n_directories))
        roots = self.shards.groupBy(number.alias("directory"), "dims").agg(F.collect_list(F.struct("shard", "root")).alias("roots"))
        self.directories = saved(roots, "directories")

    def _pack(self, rows: DataFrame, name: str, size: int, with_tree: bool) -> DataFrame:
        """One row per piece and vector length: ids, components, the tree and its root."""
        schema = f"{name} long, dims int, ids binary, v binary, nodes binary, centres binary, radii binary, root binary"

        def packed(key, group):
            dims = key[1].as_py()
            x = _components(group.column("v").combine_chunks(), dims)
            ids = group.column("vec_id").to_numpy()
            by = np.lexsort((*x.T[::-1], ids))
            x, ids = x[by], ids[by].astype("<i8")
            nodes, centres, radii = [], np.zeros((0, dims)), np.zeros(0)
            if with_tree:
                order, nodes, centres, radii = ball_tree(x)
                x, ids = x[order], ids[order]
            root = np.append(centres[:1].ravel(), radii[:1])
            row = {name: key[0].as_py(), "dims": dims, "ids": ids.tobytes(), "v": x.astype("<f8").tobytes(), "nodes": np.array(nodes, "<i8").tobytes(), "centres": centres.tobytes(), "radii": radii.tobytes(), "root": root.astype("<f8").tobytes()}
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 6
            return pa.Table.from_arrays([pa.array([c], t) for c, t in zip(row.values(), kinds)], names=list(row))

        # At most CELLS cells for each length of the sample, so their counts are small enough to
        # broadcast; a length the sample missed has hardly ever over 20 / SAMPLE of the rows.
        counts = rows.where(F.col("dims").isin(self.lengths)).groupBy("dims", "cell").agg(F.ceil(F.count("*") / size).alias("parts"))
        unseen = -(-20 * self.n // (SAMPLE * size))
        # Dealt by row number, so that a repeated row does not fill one piece.
        dice = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("parts", F.lit(unseen)))
        dealt = rows.join(F.broadcast(counts), ["dims", "cell"], "left").withColumn(name, F.col("cell") * F.lit(1 << 32) + dice)
        return dealt.select(name, "dims", "vec_id", "v").groupBy(name, "dims").applyInArrow(packed, schema)

    def _against_roots(self, blocks: DataFrame, pick, schema: str) -> DataFrame:
        """``pick`` for every block and directory: balls only, no vectors of shards."""

        def run(batches):
            for batch in batches:
                for t in batch.to_pylist():
                    q = np.frombuffer(t["q"], "<f8").reshape(-1, t["dims"])
                    balls = np.array([np.frombuffer(r["root"], "<f8") for r in t["roots"]])
                    shards = np.array([r["shard"] for r in t["roots"]], np.int64)
                    yield pick(t, q, shards, balls[:, :-1], balls[:, -1])

        number = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.n_directories - 1).cast("long")))
        return blocks.withColumn("directory", number).join(self.directories, ["directory", "dims"]).mapInArrow(run, schema)

    def homes(self) -> DataFrame:
        """(block, dims, shard): the shard whose centre promises a block most."""

        def pick(t, q, shards, centres, radii):
            promise = np.nan_to_num(centres @ q.sum(0))
            at = np.lexsort((shards, -promise))[:1]
            return pa.RecordBatch.from_pydict({"block": pa.array([t["block"]], pa.int64()), "dims": pa.array([t["dims"]], pa.int32()), "shard": shards[at], "promise": promise[at]})

        found = self._against_roots(self.blocks, pick, "block long, dims int, shard long, promise double")
        best = F.max_by("shard", F.struct("promise", "shard")).alias("shard")
        return found.groupBy("block", "dims").agg(best)

    def reached(self, ready: DataFrame) -> DataFrame:
        """(block, dims, shard) left by the root bounds; ``ready`` has blocks with ``kth``."""

        def pick(t, q, shards, centres, radii):
            hit = shards[roots_reached(q, np.frombuffer(t["kth"], "<i8"), centres, radii)]
            return pa.RecordBatch.from_pydict({"block": np.full(len(hit), t["block"], np.int64), "dims": np.full(len(hit), t["dims"], np.int32), "shard": hit})

        return self._against_roots(ready, pick, "block long, dims int, shard long")

    def floors(self, k: int) -> DataFrame:
        """Blocks with the k-th scores of their home shard."""
        home = self.homes().join(self.blocks, ["block", "dims"]).join(self.shards, ["shard", "dims"])
        kth = saved(home.mapInArrow(_searched(k, True), "block long, dims int, kth binary"), "floors")
        return self.blocks.join(kth, ["block", "dims"], "left").withColumn("kth", F.coalesce("kth", _lowest(F.col("q_ids"))))


def _searched(k: int, first: bool):
    """Function over rows of a block beside a shard: its k-th scores, or what it found."""

    def run(batches):
        shared: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for t in batch.to_pylist():
                dims = t["dims"]
                q, q_ids = np.frombuffer(t["q"], "<f8").reshape(-1, dims), np.frombuffer(t["q_ids"], "<i8")
                x, x_ids = np.frombuffer(t["v"], "<f8").reshape(-1, dims), np.frombuffer(t["ids"], "<i8")
                nodes = [tuple(r) for r in np.frombuffer(t["nodes"], "<i8").reshape(-1, 3).tolist()]
                tree = (np.arange(len(x)), nodes, np.frombuffer(t["centres"]).reshape(len(nodes), -1), np.frombuffer(t["radii"]))
                best = Best(len(q), k)
                # The k-th score so far enters as k places no vec_id fills.
                floor = np.full(len(q), -LONG - 1, np.int64) if first else np.frombuffer(t["kth"], "<i8")
                floor = np.maximum(floor, shared.get((t["block"], dims), floor))
                best.score[:] = floor[:, None]
                search(q, q_ids, tree, x, x_ids, best)
                if len(shared) > 64:
                    shared.clear()
                shared[t["block"], dims] = best.kth().copy()
                if first:
                    yield pa.RecordBatch.from_pydict({"block": [t["block"]], "dims": pa.array([dims], pa.int32()), "kth": [best.kth().astype("<i8").tobytes()]})
                else:
                    real = best.ids < LONG
                    yield pa.RecordBatch.from_pydict({"query_id": np.broadcast_to(q_ids[:, None], real.shape)[real], "vec_id": best.ids[real], "score": best.score[real]})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) over quantized frames (vec_id, v, dims)."""
    pieces = Pieces(vectors, queries, shard, query_block)
    ready = pieces.floors(k)
    met = pieces.reached(ready).join(ready, ["block", "dims"]).join(pieces.shards, ["shard", "dims"])
    found = met.mapInArrow(_searched(k, False), "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _lowest(ids):
    """k-th scores of a block that found no shard: the lowest long, as often as there are queries."""
    return F.unhex(F.repeat(F.lit("0000000000000080"), (F.length(ids) / 8).cast("int")))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


OP3_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
r as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s)
select * from r where rank <= 5
"""
