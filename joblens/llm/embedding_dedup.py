"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to unit length and turned into the principal axes of the
whole table (one 64 x 64 style moment matrix, summed over all rows).  Within
a label they are sorted by the cell of a coarse tree, fitted on a bounded
sample, and the leading coordinate, and cut into runs; a tree over the
principal axes cuts each run into blocks.  Runs and blocks have a centre and a
radius.  Two runs, then two of their blocks, form a tile unless these balls
lie further apart than linked unit vectors can.  Only then do the vectors
travel: a block meets its partners in one other run as one row of tiles and is
sent once for it.  In a tile the products of the leading dimensions are
accumulated first; a pair stops as soon as its partial product plus the
product of the two suffix norms cannot reach the threshold.  Pairs that
survive all dimensions are computed again from the given components, in
double precision, so the result is exact.

A tile sends link counts and the spanning edges of its links, never its pairs,
so a group of copies costs rows in proportion to its size.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing and are their own
component; labels may be numbers or texts; equal vectors of one label link; vectors of different lengths
never link; a repeated vec_id counts each row as a vector and reports each
row; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import saved, table
from .graph import components
from .topk_search import cell_of, coarse_tree

THRESHOLD = 0.93
BLOCK = 512  # vectors in a block, at most
RUN = 32  # blocks' worth of vectors in a run
SALT = 16  # parts of a label's pairs of runs
SAMPLE = 16384  # about so many classes fit the coarse tree
STAGES = (16, 32)  # leading dimensions after which pairs are stopped
SLACK = 1e-9  # rounding of the rotated products


def usable(vector: str = "embedding"):
    """True for vectors of finite components that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length of an Arrow list column, in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """Eigenvectors of the second moments of all unit vectors of one length, the leading one first."""

    def moments(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = unit(matrix(batch.column(0)))
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"m": [total.ravel().tolist()]})

    parts = vectors.where(F.size("embedding") == dims).select("embedding").mapInArrow(moments, "m array<double>")
    cells = parts.select(F.posexplode("m").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()  # dims x dims
    total = np.zeros(dims * dims)
    for c in cells:
        total[c["k"]] = c["x"]
    return np.linalg.eigh(total.reshape(dims, dims))[1][:, ::-1]


def tile_links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks with cosine of at least ``threshold``."""
    ux, uy = unit(x), unit(y)
    rx, ry = ux @ axes, uy @ axes
    dims = x.shape[1]
    cuts = [c for c in STAGES if c < dims]
    rest = lambda r, c: np.sqrt(np.maximum((r[:, c:] ** 2).sum(1), 0))
    first = cuts[0] if cuts else dims
    partial = rx[:, :first] @ ry[:, :first].T
    bound = partial + np.outer(rest(rx, first), rest(ry, first)) if first < dims else partial
    i, j = np.nonzero(bound >= threshold - SLACK)
    partial = partial[i, j]
    for a, b in zip(cuts, [*cuts[1:], dims]):
        keep = []
        for k in range(0, len(i), 1 << 15):
            s = slice(k, k + (1 << 15))
            partial[s] += np.einsum("ij,ij->i", rx[i[s], a:b], ry[j[s], a:b])
            keep.append(partial[s] + (rest(rx, b)[i[s]] * rest(ry, b)[j[s]] if b < dims else 0) >= threshold - SLACK)
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j, partial = i[keep], j[keep], partial[keep]
    exact = np.concatenate([np.einsum("ij,ij->i", ux[i[k : k + (1 << 15)]], uy[j[k : k + (1 << 15)]]) for k in range(0, len(i), 1 << 15)] or [np.zeros(0)])
    return i[exact >= threshold], j[exact >= threshold]


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest vertex joined to each of n vertices by the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def ball(r: np.ndarray) -> tuple[np.ndarray, float]:
    """Centre and radius, rounded up, of some vectors."""
    c = r.mean(0)
    return c, float(np.sqrt(((r - c) ** 2).sum(1).max())) + SLACK


def axis_tree(r: np.ndarray, block: int) -> list[np.ndarray]:
    """Row numbers of blocks of at most ``block`` vectors: the axis of largest
    variance is cut where the variance between the two sides is largest (no
    side under an eighth of a block), until all blocks are small.  A small
    block is cut on while such a cut takes away a quarter of its whole variance,
    so that vectors from two clusters do not share a block."""
    done, todo = [], [np.arange(len(r))]
    while todo:
        rows = todo.pop()
        if len(rows) < 2:
            done.append(rows)
            continue
        spread = r[rows].var(0)
        axis = int(spread.argmax())
        by = rows[np.argsort(r[rows, axis], kind="stable")]
        v = r[by, axis] - r[by, axis].mean()
        n = np.arange(1, len(by))
        between = np.cumsum(v)[:-1] ** 2 / (n * (len(by) - n))
        low = max(1, block // 8) if len(by) > block else 1
        cut = low + int(between[low - 1 : len(by) - low].argmax())
        apart = ((r[by[:cut]].mean(0) - r[by[cut:]].mean(0)) ** 2).sum() * cut * (len(by) - cut) / len(by) ** 2
        if len(by) <= block and apart <= spread.sum() / 4 + SLACK:
            done.append(rows)
            continue
        todo += [by[cut:], by[:cut]]
    return done


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", "embedding", "label")
    good = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable())
    # Copies are one class: a class is a label and a vector, named by its smallest vec_id.
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members"))
    classes = saved(classes.withColumn("dims", F.size("embedding")).withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    counted = linked = None
    for (dims,) in classes.select("dims").distinct().collect():
        some = classes.where(F.col("dims") == dims)
        axes = principal_axes(some, dims)
        c, e = _compare(some, axes, threshold, block)
        counted, linked = (c, e) if counted is None else (counted.unionByName(c), linked.unionByName(e))
    if counted is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    joined = components(linked).withColumnRenamed("id", "cls")
    least = classes.join(joined, "cls").groupBy("component").agg(F.min("rep").alias("least"))
    named = joined.join(least, "component").select("cls", "least")
    per_class = (
        classes.join(counted, "cls", "left").join(named, "cls", "left")
        .select("label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component_id"))
    )
    # Small classes table against all rows, on the class key, which spreads evenly: copies meet their class.
    found = rows.join(per_class, ["label", "embedding"], "left")
    n = F.coalesce("n_links", F.lit(0)).cast("long")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", n.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _blocks(classes: DataFrame, axes: np.ndarray, block: int) -> DataFrame:
    """One row per block: label, run and its ball, block, its ball, ids, members and vectors."""
    share = min(1.0, SAMPLE / max(1, classes.count()))
    dice = F.pmod(F.xxhash64("cls"), F.lit(1 << 30))
    sample = classes.where(dice <= int(share * (1 << 30))).select("embedding").toArrow().column(0).combine_chunks()
    planes = coarse_tree(unit(matrix(sample)) @ axes) if len(sample) else []

    def placed(batches):
        for batch in batches:
            r = unit(matrix(batch.column("embedding"))) @ axes
            yield batch.append_column("cell", pa.array(cell_of(r, planes))).append_column("lead", pa.array(r[:, 0]))

    def packed(batches):
        held = []

        def emit(rows):
            x = matrix(rows.column("embedding").combine_chunks())
            cls, members = (rows.column(c).to_numpy().astype("<i8") for c in ("cls", "members"))
            r = unit(x) @ axes
            centre, radius = ball(r)
            for own in axis_tree(r, block):
                c, d = ball(r[own])
                # Each class stands in one block, so its smallest class names a block, and a run.
                values = (rows.column("label")[0].as_py(), int(cls.min()), centre.tolist(), radius, int(cls[own].min()), c.astype("<f8").tobytes(), d, cls[own].tobytes(), members[own].tobytes(), x[own].astype("<f8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                if held and (held[0].column("label")[0] != part.column("label")[0] or sum(map(len, held)) + len(part) > RUN * block):
                    yield from emit(pa.Table.from_batches(held))
                    held = []
                for k in range(0, len(part), RUN * block):
                    piece = part.slice(k, RUN * block)
                    if len(piece) == RUN * block:
                        yield from emit(pa.Table.from_batches([piece]))
                    else:
                        held.append(piece)
        if held:
            yield from emit(pa.Table.from_batches(held))

    schema = "label string, run long, run_centre array<double>, run_radius double, block long, centre binary, radius double, ids binary, members binary, vectors binary"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int64(), pa.binary(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
    rows = classes.select(F.col("label").cast("string").alias("label"), "embedding", "cls", "members")
    rows = rows.mapInArrow(placed, StructType([*rows.schema, StructField("cell", LongType()), StructField("lead", DoubleType())]))
    ordered = rows.repartitionByRange("label", "cell", "lead", "cls").sortWithinPartitions("label", "cell", "lead", "cls")
    return saved(ordered.mapInArrow(packed, schema), "vector-blocks")


def _tiles(blocks: DataFrame, threshold: float) -> DataFrame:
    """(block_a, run_b, partners): the blocks of run_b that block_a has to meet; balls only, no vectors."""
    # |x - y|^2 = 2 - 2 cos bounds the distance of linked unit vectors.
    gap = float(np.sqrt(max(2 - 2 * threshold, 0))) + 1e-6
    held = F.collect_list(F.struct("block", "centre", "radius")).alias("balls")
    runs = saved(blocks.groupBy("label", "run").agg(F.first("run_centre").alias("centre"), F.first("run_radius").alias("radius"), held), "runs")
    left, right = (runs.select("label", *(F.col(c).alias(f"{c}_{s}") for c in ("run", "centre", "radius"))) for s in "ab")
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    right = right.withColumn("salt", F.pmod(F.xxhash64("run_b"), F.lit(SALT)).cast("int"))
    apart = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    near = left.join(right, ["label", "salt"]).where((F.col("run_a") <= F.col("run_b")) & (apart <= F.col("radius_a") + F.col("radius_b") + gap))
    pairs = near.select("run_a", "run_b")
    for s in "ab":
        pairs = pairs.join(runs.select(F.col("run").alias(f"run_{s}"), F.col("balls").alias(f"balls_{s}")), f"run_{s}")

    def met(batches):
        for batch in batches:
            for t in batch.to_pylist():
                (names_a, c_a, d_a), (names_b, c_b, d_b) = (
                    ([o["block"] for o in t[k]], np.array([np.frombuffer(o["centre"], "<f8") for o in t[k]]), np.array([o["radius"] for o in t[k]])) for k in ("balls_a", "balls_b")
                )
                same = t["run_a"] == t["run_b"]
                for k, name in enumerate(names_a):
                    near = np.flatnonzero(np.sqrt(((c_b - c_a[k]) ** 2).sum(1)) <= d_b + d_a[k] + gap)
                    partners = [names_b[j] for j in near if not same or names_b[j] >= name]
                    if partners:
                        yield pa.RecordBatch.from_pydict({"block_a": [name], "run_b": [t["run_b"]], "partners": [partners]})

    return pairs.mapInArrow(met, "block_a long, run_b long, partners array<long>")


def _compare(classes: DataFrame, axes: np.ndarray, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Linked members of other classes per class, and spanning edges."""
    blocks = _blocks(classes, axes, block)
    strips = saved(_tiles(blocks, threshold), "tiles")
    payload = blocks.select("block", "ids", "members", "vectors")
    one = strips.select(F.col("block_a").alias("block"), F.col("run_b").alias("run")).join(payload.toDF(*payload.columns), "block")
    many = strips.select("block_a", "run_b", F.explode("partners").alias("block")).join(payload, "block")
    dims = axes.shape[0]
    schema = pa.schema([("cls", pa.int64()), ("others", pa.int64()), ("root", pa.int64())])

    def opened(t):
        return np.frombuffer(t["ids"], "<i8"), np.frombuffer(t["members"], "<i8"), np.frombuffer(t["vectors"], "<f8").reshape(-1, dims)

    def compare(left, right):
        out = []
        for a in left.to_pylist():
            ids_a, size_a, x = opened(a)
            for k in range(right.num_rows):  # one partner at a time is unpacked
                b = right.slice(k, 1).to_pylist()[0]
                ids_b, size_b, y = opened(b)
                i, j = tile_links(x, y, axes, threshold)
                same = a["block"] == b["block"]
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                off = 0 if same else len(x)
                every, members = (ids_a, size_a) if same else (np.concatenate([ids_a, ids_b]), np.concatenate([size_a, size_b]))
                others = np.bincount(i, weights=members[j + off], minlength=len(every)) + np.bincount(j + off, weights=members[i], minlength=len(every))
                root = spanning(i, j + off, len(every))
                hit = np.flatnonzero(others)
                out.append(pa.Table.from_arrays([pa.array(every[hit]), pa.array(others[hit].astype(np.int64)), pa.array(every[root[hit]])], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    met = one.groupBy("block", "run").cogroup(many.groupBy("block_a", "run_b"))
    found = saved(met.applyInArrow(compare, "cls long, others long, root long"), "tile-links")
    return found.groupBy("cls").agg(F.sum("others").alias("others")), found.select(F.col("cls").alias("a"), F.col("root").alias("b"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


OP9_SQL = """
with v as (
  select row_number() over () r, vec_id, label, embedding::double[] e, sqrt(list_inner_product(embedding::double[], embedding::double[])) n
  from embeddings
  where embedding is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.r, a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e)
      where list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.93),
reach as (
  with recursive walk(a, b) as (
    select a, b from l union select w.a, l.b from walk w join l on w.b = l.a)
  select a, min(b) m from walk group by a),
c as (select a, count(*) n from l group by a)
select e.vec_id, coalesce(c.n, 0)::bigint n_links, least(e.vec_id, coalesce(reach.m, e.vec_id)) component_id,
       e.vec_id = least(e.vec_id, coalesce(reach.m, e.vec_id)) kept
from embeddings e left join c on c.a = e.vec_id left join reach on reach.a = e.vec_id
"""
