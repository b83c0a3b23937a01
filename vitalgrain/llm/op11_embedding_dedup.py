"""Embedding near-duplicates by an epsilon grid order join over principal dimensions.

Vectors of one label and length are scaled to length one, so a cosine of `least` is a distance of
epsilon = sqrt(2 - 2 * least). Equal vectors are one class from the start. The classes are turned to
their principal axes, sorted by label and by the cells, of width epsilon, of the leading axes, and cut
into sequence intervals of BLOCK_ROWS classes, each with its bounding box along these axes. Intervals
of FANOUT neighbours make the next level's interval, up to one a label. The join goes down from the
pairs (root, root): a pair of intervals whose boxes are further apart than epsilon is skipped, any other
one is replaced by the pairs of its parts. A pair of lowest intervals is one row of a task; its parts of
LEAF_ROWS classes are skipped if their boxes or balls are provably too far, count as linked throughout if
their balls are provably near enough, and are compared by a matrix product otherwise.

Only sums of links by class and one edge from each linked class to its tile's least relative leave a
task, so a group of near copies costs time but no rows. Cosines within CLOSE of the bound are computed
again from the given components. Boxes and balls have SLACK for rounding. Axes come from a sample of
at most SAMPLE_BYTES of vectors of the FITTED most frequent lengths (others keep their first axes); they
decide what is skipped, never what is linked. An interval has at most BLOCK_BYTES, one class at least.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows with
a null label, are linked with nothing, n_links 0; vectors of different length are not linked; rows that
repeat an id count as vectors of their own; null ids never name a component unless it has no other, and
`kept` compares nulls as equal; an empty table stays empty; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_groups, materialise
from .op9_near_dedup import components

LEAST = 0.98
#: Leading principal axes: cells and boxes are kept along these.
AXES = 16
SAMPLE_BYTES = 8 << 20
FITTED = 16
#: Classes of a lowest interval, its bytes as doubles, and the classes of the parts that are compared within it.
BLOCK_ROWS, BLOCK_BYTES, LEAF_ROWS = 8192, 4 << 20, 256
#: Rows with the vectors of two intervals that a worker gets at once.
PAIR_ROWS = 4
#: Intervals that the next level's interval holds.
FANOUT = 8
CLOSE, SLACK = 1e-9, 1e-7


def _norm(vectors: np.ndarray) -> np.ndarray:
    """Lengths in double precision; scaled first, so that squares neither overflow nor vanish."""
    top = np.abs(vectors).max(axis=1)
    scaled = vectors / np.where(top > 0, top, 1)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def _rows_of(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the valid vectors of each length, as doubles."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    sizes = np.diff(vectors.offsets.to_numpy())
    whole = vectors.is_valid().to_numpy(zero_copy_only=False)
    starts = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    flat = vectors.flatten() if whole.all() else None
    for dim in np.unique(sizes[whole]):
        if not dim:
            continue
        rows = np.flatnonzero(whole & (sizes == dim))
        if flat is not None and len(rows) == len(sizes):
            matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
        else:
            values = vectors.values.to_numpy(zero_copy_only=False)
            base = vectors.offsets[0].as_py()
            matrix = values[(base + starts[rows])[:, None] + np.arange(dim)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield rows[good], matrix[good]


def _units(kind: str):
    """vec_id, label, dim and the vector as bytes of the given kind of numbers; dim and bytes are null where it can't be linked."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims: list[int | None] = [None] * batch.num_rows
            found: list[bytes | None] = [None] * batch.num_rows
            labelled = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            for rows, matrix in _rows_of(batch.column(2)):
                for at, v in zip(rows[labelled[rows]].tolist(), matrix[labelled[rows]].astype(kind)):
                    dims[at], found[at] = len(v), v.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(found, pa.binary())], names=["vec_id", "label", "dim", "unit"])

    return units


def _stacked(units: bytes, count: int, dim: int) -> np.ndarray:
    """Vectors of single or double precision as doubles."""
    kind = np.float32 if len(units) == 4 * count * dim else np.float64
    return np.frombuffer(units, kind).reshape(count, dim).astype(np.float64)


def _leading(axes: dict[int, np.ndarray], dim: int) -> np.ndarray:
    found = axes.get(dim)
    return np.eye(min(AXES, dim), dim) if found is None else found


def _axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """The leading principal axes of the most frequent vector lengths, by a bounded sample."""
    lengths = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(FITTED)
    dims = {r["dim"]: r["n"] for r in lengths.collect()}
    room = SAMPLE_BYTES // max(1, len(dims))
    axes = {}
    for dim, n in dims.items():
        size = max(2, room // (8 * dim))
        hashed = F.xxhash64("unit", F.lit("axes"))
        share = min(1.0, 2 * size / n)
        chosen = classes.where((F.col("dim") == dim) & (F.pmod(hashed, F.lit(1 << 20)) <= math.ceil(share * (1 << 20)))).orderBy(hashed).limit(size).select("unit")
        sample = [r[0] for r in chosen.collect()]
        rows = _norm(_stacked(b"".join(sample), len(sample), dim))
        spread = np.linalg.svd(rows - rows.mean(axis=0), full_matrices=False)[2] if len(rows) > 1 else np.eye(dim)
        axes[dim] = np.ascontiguousarray(spread[:AXES])
    return axes


_BLOCK = "label string, dim int, block long, nodes array<long>, weights array<long>, units binary, low array<double>, high array<double>"


def _turned(axes, eps: float):
    """Adds the cells of each class along the axes of its length."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            units = batch.column(2).to_pylist()
            cells: list[list[int]] = [[] for _ in units]
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                along = _norm(_stacked(b"".join(units[i] for i in rows), len(rows), int(dim))) @ _leading(axes.value, int(dim)).T
                for i, c in zip(rows.tolist(), np.floor(along / eps).astype(int).tolist()):
                    cells[i] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    return turn


def _cut(axes, block_rows: int):
    """Sorted classes to intervals of one label and length: their vectors as one matrix, and its box."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, count = None, [], 0

        def block() -> pa.RecordBatch:
            label, dim = key
            units = b"".join(h[1] for h in held)
            along = _norm(_stacked(units, len(held), dim)) @ _leading(axes.value, dim).T
            values = [label, dim, count, [h[0] for h in held], [h[2] for h in held], units, along.min(axis=0).tolist(), along.max(axis=0).tolist()]
            types = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=["label", "dim", "block", "nodes", "weights", "units", "low", "high"])

        for batch in batches:
            for node, label, dim, unit, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and ((label, dim) != key or len(held) >= min(block_rows, BLOCK_BYTES // (8 * dim))):
                    yield block()
                    held, count = [], count + 1
                key = (label, dim)
                held.append((node, unit, n))
        if held:
            yield block()

    return cut


def _apart(a: str, b: str) -> Column:
    """The squared distance of two boxes."""
    gaps = F.zip_with(F.zip_with(f"{a}low", f"{b}high", lambda x, y: x - y), F.zip_with(f"{b}low", f"{a}high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)


def _levels(blocks: DataFrame, fanout: int) -> list[DataFrame]:
    """Tables of intervals (level, at, parent, low, high) from the lowest to one a label and length."""
    level = blocks.select("label", "dim", "at", "low", "high")
    out = []
    while True:
        level = materialise(level.withColumn("parent", F.floor(F.col("at") / fanout)), "level")
        out.append(level)
        if level.groupBy("label", "dim").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return out
        box = {side: F.array(*(f(F.get(side, F.lit(i))) for i in range(AXES))) for side, f in (("low", F.min), ("high", F.max))}
        up = level.groupBy("label", "dim", "parent").agg(*(b.alias(side) for side, b in box.items()))
        # axes beyond the vectors' length are null
        level = up.select("label", "dim", F.col("parent").alias("at"), *(F.filter(side, lambda x: x.isNotNull()).alias(side) for side in box))


def _pairs(blocks: DataFrame, eps: float, fanout: int) -> DataFrame:
    """(label, dim, a, b), a <= b, of the lowest intervals whose boxes are within eps of each other."""
    levels = _levels(blocks, fanout)
    pairs = levels[-1].select("label", "dim", F.col("at").alias("a"), F.col("at").alias("b"))
    for level in reversed(levels[:-1]):
        one = level.select("label", "dim", F.col("parent").alias("a"), F.col("at").alias("x"), F.col("low").alias("x_low"), F.col("high").alias("x_high"))
        two = level.select("label", "dim", F.col("parent").alias("b"), F.col("at").alias("y"), F.col("low").alias("y_low"), F.col("high").alias("y_high"))
        near = pairs.join(one, ["label", "dim", "a"]).join(two, ["label", "dim", "b"])
        near = near.where((F.col("x") <= F.col("y")) & (_apart("x_", "y_") <= eps * eps + SLACK))
        pairs = materialise(near.select("label", "dim", F.col("x").alias("a"), F.col("y").alias("b")), "intervals")
    return pairs


class _Side:
    """The vectors of an interval, with box and ball of each leaf."""

    def __init__(self, nodes: list[int], weights: list[int], units: bytes, dim: int, axes: np.ndarray):
        self.given = _stacked(units, len(nodes), dim)
        self.units = _norm(self.given)
        self.nodes, self.weights = np.array(nodes, np.int64), np.array(weights, np.int64)
        self.starts = np.arange(0, len(self.units), LEAF_ROWS)
        along = self.units @ axes.T
        self.low, self.high = np.minimum.reduceat(along, self.starts), np.maximum.reduceat(along, self.starts)
        sizes = np.diff(np.append(self.starts, len(self.units)))
        self.centre = np.add.reduceat(self.units, self.starts) / sizes[:, None]
        off = self.units - np.repeat(self.centre, sizes, axis=0)
        self.radius = np.sqrt(np.maximum.reduceat((off * off).sum(axis=1), self.starts))

    def leaf(self, i: int) -> slice:
        return slice(int(self.starts[i]), min(int(self.starts[i]) + LEAF_ROWS, len(self.units)))


def _block_links(a: _Side, b: _Side | None, least: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """For the classes of a, then those of b (None: a with itself): the weight of what each is linked to, and its root."""
    same = b is None
    other = a if same else b
    n = len(a.units)
    links = np.zeros(n + (0 if same else len(other.units)), np.int64)
    roots = np.arange(len(links))
    shift = 0 if same else n
    if same:
        links += a.weights - 1
    for i in range(len(a.starts)):
        left = a.leaf(i)
        gap = np.maximum(0, np.maximum(a.low[i] - other.high, other.low - a.high[i]))
        apart = np.sqrt(((a.centre[i] - other.centre) ** 2).sum(axis=1))
        reach = a.radius[i] + other.radius
        wanted = ((gap * gap).sum(axis=1) <= eps * eps + SLACK) & (apart - reach <= eps + SLACK)
        for j in np.flatnonzero(wanted).tolist():
            if same and j < i:
                continue
            right = other.leaf(j)
            inside = same and i == j
            if apart[j] + reach[j] <= eps - SLACK:
                near = np.ones((left.stop - left.start, right.stop - right.start), bool)
            else:
                cosine = a.units[left] @ other.units[right].T
                near = cosine >= least
                for x, y in np.argwhere(np.abs(cosine - least) <= CLOSE).tolist():
                    near[x, y] = exact_cosine(a.given[left.start + x], other.given[right.start + y]) >= least
            if inside:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            links[left] += near @ other.weights[right]
            if not inside:
                links[right.start + shift : right.stop + shift] += a.weights[left] @ near
            for x, y in _connected(near):
                labels = np.unique(roots[np.concatenate([left.start + x, right.start + shift + y])])
                if len(labels) > 1:
                    roots[np.isin(roots, labels)] = labels[0]
    return links, roots


def _connected(near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the parts that the links connect."""
    rows, columns = near.any(axis=1), near.any(axis=0)
    while rows.any():
        front = np.zeros_like(rows)
        front[np.argmax(rows)] = True
        own_rows, own_columns = front.copy(), np.zeros_like(columns)
        while front.any():
            fresh = near[front].any(axis=0) & ~own_columns
            own_columns |= fresh
            front = near[:, fresh].any(axis=1) & ~own_rows
            own_rows |= front
        rows &= ~own_rows
        yield np.flatnonzero(own_rows), np.flatnonzero(own_columns)


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """From the given components; scaled by powers of two, so that nothing overflows and nothing is rounded."""
    x, y = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (x, y))
    return float(math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)))


def _compared(axes, least: float, eps: float):
    """Pairs of intervals to (node, links, root) of the classes that have links there."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, a, b, *sides in zip(*(c.to_pylist() for c in batch.columns)):
                turned = _leading(axes.value, dim)
                one = _Side(*sides[:3], dim, turned)
                two = None if a == b else _Side(*sides[3:], dim, turned)
                links, roots = _block_links(one, two, least, eps)
                nodes = one.nodes if two is None else np.concatenate([one.nodes, two.nodes])
                some = np.flatnonzero(links)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[roots[some]])], names=["node", "links", "root"])

    return compare


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST, block_rows: int = BLOCK_ROWS, fanout: int = FANOUT) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    eps = math.sqrt(2 - 2 * least)
    kind = "float32" if vectors.schema[vector].dataType.elementType == T.FloatType() else "float64"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    units = rows.mapInArrow(_units(kind), "vec_id long, label string, dim int, unit binary")
    units = materialise(units.withColumn("twin", F.md5("unit")), "units")
    known = units.where("dim is not null")
    classes = known.groupBy("label", "dim", "twin").agg(F.first("unit").alias("unit"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("node"), "label", "dim", "unit", "n", "least", "twin"), "classes")
    total = classes.count()
    axes = spark.sparkContext.broadcast(_axes(classes) if total else {})

    turned = classes.select("label", "dim", "unit", "n", "node").mapInArrow(_turned(axes, eps), "label string, dim int, unit binary, n long, node long, cells array<int>")
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // block_rows)))
    order = ["label", "dim", "cells", "node"]
    turned = turned.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = turned.select("node", "label", "dim", "unit", "n").mapInArrow(_cut(axes, block_rows), _BLOCK)
    # the number of the partition comes first, so intervals keep their order
    blocks = materialise(blocks.withColumn("at", F.monotonically_increasing_id()), "blocks")
    place = F.row_number().over(Window.partitionBy("label", "dim").orderBy("at"))
    placed = materialise(blocks.select("label", "dim", "at", "low", "high").select("label", "dim", (place - 1).cast("long").alias("place"), F.col("at").alias("block_at"), "low", "high"), "placed")
    pairs = _pairs(placed.withColumnRenamed("place", "at"), eps, fanout)

    of = placed.select("label", "dim", "place", F.col("block_at").alias("at"))
    data = blocks.select("at", "nodes", "weights", "units").join(of, "at").drop("at")
    for side in "ab":
        pairs = pairs.join(data.select("label", "dim", F.col("place").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("nodes", "weights", "units"))), ["label", "dim", side])
    tiles = pairs.select("dim", "a", "b", "nodes_a", "weights_a", "units_a", "nodes_b", "weights_b", "units_b")
    found = materialise(tiles.mapInArrow(_compared(axes, least, eps), "node long, links long, root long"), "found", batch_rows=PAIR_ROWS)

    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = materialise(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), rows=total), "roots")
    named = roots.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("members"))
    named = attach_groups(roots, named, "root", "members", max(1, total)).select("node", "component")
    of_class = classes.select("node", "label", "dim", "twin", "n", "least").join(linked, "node", "left").join(named, "node", "left")
    of_class = of_class.select(F.concat_ws(":", "dim", "twin", "label").alias("key"), F.col("n").alias("size"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    keyed = known.select("vec_id", F.concat_ws(":", "dim", "twin", "label").alias("key"))
    whole = attach_groups(keyed, of_class, "key", "size", max(1, total)).select("vec_id", "n_links", "component_id")
    alone = units.where("dim is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with recursive valid as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links as (select a.vec_id as a, b.vec_id as b from valid a join valid b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id where list_cosine_similarity(a.v, b.v) >= 0.98),
reach as (select vec_id as a, vec_id as b from valid union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a as vec_id, min(b) as component_id from reach group by a),
counts as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id, coalesce(component_id, vec_id) = vec_id as kept
from embeddings left join least using (vec_id) left join counts using (vec_id)
"""
