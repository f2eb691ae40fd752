"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits recursively: a node draws a random direction and a random quantile near the middle, and vectors within a
margin of the split go to both sides (spill). Vectors in one leaf are compared exactly, in double precision; pairs found in
any tree are links. Equal vectors are compared once, as a class with a weight.

The first splits are fitted on a bounded sample of the classes (a parameter); every vector is then put into its leaves. Leaves
that are still large are split further, each by a tree fitted on a bounded sample of its own, all of them in parallel, until
leaves are small or a clump of alike vectors that no split parts: so trees deepen with the number of vectors. A clump of more
than a block is compared block against block, so that no task holds more than two blocks.

A pair that meets in several leaves counts in one of them only: each vector brings the list of its leaves, and the least
common leaf owns the pair. Pairs never leave their task: what comes out of a leaf is a row for each linked vector, with the
number of its links there and a vector that it reaches by them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize


@dataclass(frozen=True)
class Forest:
    """trees, leaf: how many, and about how many classes a leaf should have. margin: spill on each side of a split, in units of the unit sphere.

    sample: vectors that the first splits are fitted on; inner: those that the splits of a large leaf are fitted on, about.
    block: classes that are compared at once; leaves of more than twice as many are split further, levels times at most.
    """

    trees: int = 8
    leaf: int = 400
    margin: float = 0.02
    sample: int = 16_384
    inner: int = 2048
    block: int = 4096
    levels: int = 8
    seed: int = 5


def _matrix(column: pa.ListArray, dimensions: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a column as rows, and which of them count: not null, not zero, only finite components, of the expected length."""
    n = len(column)
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    good = lengths == dimensions
    out = np.zeros((n, dimensions), kind)
    if good.any():
        flat = column.filter(pa.array(good)).flatten()
        out[good] = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    good &= np.isfinite(out).all(1) & (out != 0).any(1)
    return out + np.zeros(1, kind), good  # adding 0 makes -0.0 equal to 0.0


def units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that neither very large nor very small components are lost."""
    out = vectors.astype(np.float64)
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def grow(sample: np.ndarray, n: int, forest: Forest, rng: np.random.Generator) -> dict[int, tuple[np.ndarray, float]]:
    """A tree: inner nodes by their number (the root is 1, below k are 2 k and 2 k + 1), each a direction and a split. n: how many vectors the sample stands for.

    It ends at leaves of the wanted size, and at those of which the sample has too few to go on.
    """
    nodes: dict[int, tuple[np.ndarray, float]] = {}
    todo = [(1, np.arange(len(sample)))]
    while todo:
        k, rows = todo.pop()
        if n * len(rows) / max(1, len(sample)) <= forest.leaf or len(rows) < 8:
            continue
        direction = rng.standard_normal(sample.shape[1])
        direction /= np.linalg.norm(direction)
        at = sample[rows] @ direction
        split = float(np.quantile(at, rng.uniform(0.42, 0.58)))
        left, right = rows[at <= split + forest.margin], rows[at >= split - forest.margin]
        if len(left) > 0.9 * len(rows) or len(right) > 0.9 * len(rows) or k >= 1 << 40:
            continue  # a clump that no split parts
        nodes[k] = (direction, split)
        todo += [(2 * k, left), (2 * k + 1, right)]
    return nodes


def leaves(vectors: np.ndarray, nodes: dict, margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows) for the rows of vectors; a row comes in each leaf that it reaches."""
    todo = [(1, np.arange(len(vectors)))]
    while todo:
        k, rows = todo.pop()
        if not len(rows):
            continue
        if k not in nodes:
            yield k, rows
            continue
        direction, split = nodes[k]
        at = vectors[rows] @ direction
        todo += [(2 * k, rows[at <= split + margin]), (2 * k + 1, rows[at >= split - margin])]


def _number(*parts: int) -> int:
    """A number of 63 bits for a leaf, from what names it."""
    return xxhash.xxh3_64_intdigest(repr(parts)) >> 1


def shared_below(own: int, row: np.ndarray, leaf: np.ndarray, n_rows: int) -> np.ndarray:
    """Bits for each row: its leaves with a number below own, as far as several rows have them; the fullest leaves first. row, leaf: the leaves of all rows."""
    below = leaf < own
    row, leaf = row[below], leaf[below]
    _, at, times = np.unique(leaf, return_inverse=True, return_counts=True)
    place = np.argsort(np.argsort(-times, kind="stable"), kind="stable")[at]
    several = times[at] > 1
    row, place = row[several], place[several]
    bits = np.zeros((n_rows, -(-int((times > 1).sum()) // 64)), np.uint64)
    np.bitwise_or.at(bits, (row, place // 64), np.uint64(1) << (place % 64).astype(np.uint64))
    return bits


def apart(x: np.ndarray, y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which pairs (x, y) of rows have no bit in common."""
    left, start, width = np.arange(len(x)), 0, 1
    while start < bits.shape[1] and len(left):  # near pairs share one of the fullest leaves, as a rule
        words = bits[:, start : start + width]
        step = max(1, 4_000_000 // words.shape[1])
        left = np.concatenate([part[~(words[x[part]] & words[y[part]]).any(1)] for part in (left[k : k + step] for k in range(0, len(left), step))])
        start, width = start + width, min(64, 4 * width)
    return left


def near_pairs(a: np.ndarray, b: np.ndarray | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of a and b, or i < j within a, with cosine >= least; those of a few rows of a at a time."""
    step = 256
    right = a if b is None else b
    for at in range(0, len(a), step):
        i, j = np.nonzero(a[at : at + step] @ right.T >= least)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def join_labels(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Let linked rows have one label, the least row that they reach. Labels are of rows that are their own label; they change in place."""
    while True:
        a, b = label[x], label[y]
        unlike = a != b
        if not unlike.any():
            return
        x, y = x[unlike], y[unlike]
        np.minimum.at(label, np.maximum(a, b)[unlike], np.minimum(a, b)[unlike])
        while ((up := label[label]) != label).any():
            label[:] = up


def _deepened(places: DataFrame, classes: DataFrame, forest: Forest, matrix) -> DataFrame:
    """places(leaf, c) with large leaves split further, in parallel, until no split parts them. classes: c, u."""
    done = None  # leaves that are clumps
    for level in range(forest.levels):
        large = places.groupBy("leaf").agg(F.count("*").alias("size")).where(F.col("size") > 2 * forest.block)
        large = materialize(large if done is None else large.join(done, "leaf", "left_anti"), "large-leaves")
        if large.isEmpty():
            break
        inside = places.join(large, "leaf")
        drawn = inside.where(F.pmod(F.xxhash64("c", F.lit(level)), F.col("size")) < forest.inner).join(classes.select("c", "u"), "c").select("leaf", "size", "u")

        def fit(group: pa.Table) -> pa.Table:
            leaf, size = group["leaf"][0].as_py(), group["size"][0].as_py()
            nodes = grow(matrix(group["u"]), size, forest, np.random.default_rng(leaf))
            return pa.table({"leaf": [leaf], "nodes": pa.array([pickle.dumps(nodes) if nodes else None], pa.binary())})

        fitted = materialize(drawn.groupBy("leaf").applyInArrow(fit, "leaf long, nodes binary"), "inner-trees")
        clumps = fitted.where("nodes is null").select("leaf")
        done = clumps if done is None else done.unionByName(clumps)

        def place(rows: pa.Table, tree: pa.Table) -> pa.Table:
            if not rows.num_rows or not tree.num_rows:
                return pa.table({"leaf": pa.array([], pa.int64()), "c": pa.array([], pa.int64())})
            leaf, c = tree["leaf"][0].as_py(), rows["c"].to_numpy()
            found = list(leaves(matrix(rows["u"]), pickle.loads(tree["nodes"][0].as_py()), forest.margin))
            return pa.table({"leaf": np.concatenate([np.full(len(at), _number(leaf, k)) for k, at in found]), "c": np.concatenate([c[at] for _, at in found])})

        # a leaf's rows come in chunks, each with a copy of the leaf's tree
        parted = fitted.where("nodes is not null")
        chunks = F.ceil(F.col("size") / forest.block).cast("int")
        trees = parted.join(large, "leaf").withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).select("leaf", "chunk", "nodes")
        members = inside.join(parted.select("leaf"), "leaf", "left_semi").join(classes.select("c", "u"), "c").select("leaf", F.pmod(F.xxhash64("c", "leaf"), chunks).cast("int").alias("chunk"), "c", "u")
        moved = members.groupBy("leaf", "chunk").cogroup(trees.groupBy("leaf", "chunk")).applyInArrow(place, "leaf long, c long")
        places = materialize(places.join(parted.select("leaf"), "leaf", "left_anti").unionByName(moved), "places")
    return places


def near_vectors(vectors: DataFrame, least: float = 0.9, forest: Forest | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for each row of vectors.

    n_links: other rows with cosine >= least; component_id: the smallest id reachable by links, the row's own included;
    kept: whether it is its component's. Vectors are compared with those of their own length; those that are null or zero or
    hold null or non-finite components link with nothing. Rows with equal ids are rows of their own with shared links; rows
    with a null id link with nothing and have a null component. No rows: an empty table.
    """
    forest = forest or Forest()
    kind = "<f4" if vectors.schema[vector_column].dataType.simpleString() == "array<float>" else "<f8"
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"))
    width = np.dtype(kind).itemsize

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw: list[bytes | None] = [None] * b.num_rows
            lengths = b.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            known = ~np.asarray(b.column(0).is_null())
            for dimensions in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero((lengths == dimensions) & known)
                matrix, good = _matrix(b.column(1).take(pa.array(at)), int(dimensions), kind)
                for k, v in zip(at[good], matrix[good], strict=True):
                    raw[k] = v.tobytes()
            digest = [None if v is None else xxhash.xxh3_128_digest(v) for v in raw]
            yield pa.record_batch([b.column(0), pa.array(digest, pa.binary()), pa.array(raw, pa.binary())], ["id", "d", "u"])

    def matrix(column) -> np.ndarray:
        vectors = column.to_pylist()
        return units(np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1))

    keyed = materialize(rows.mapInArrow(classed, "id long, d binary, u binary"), "vectors")
    classes = materialize(keyed.where("d is not null").groupBy("d").agg(F.min("id").alias("c"), F.count("*").alias("n"), F.first("u").alias("u")), "classes")
    classes = classes.withColumn("dims", (F.octet_length("u") / width).cast("int"))
    n_classes = {r.dims: r.n for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    drawn: dict[int, list[bytes]] = {}
    for r in classes.orderBy(F.xxhash64("d"), "d").limit(forest.sample).select("u", "dims").collect():
        drawn.setdefault(r.dims, []).append(bytes(r.u))
    # a length with few classes is one leaf of one tree
    forests = {}
    for k, v in sorted(drawn.items()):
        if n_classes[k] > forest.leaf:
            rng, sample = np.random.default_rng(forest.seed), units(np.frombuffer(b"".join(v), kind).reshape(-1, k))
            forests[k] = [grow(sample, n_classes[k], forest, rng) for _ in range(forest.trees)]
    trees = vectors.sparkSession.sparkContext.broadcast(forests)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(2).to_numpy()
            for dimensions in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == dimensions)
                here = matrix(b.column(1).take(pa.array(mine)))
                for t, nodes in enumerate(trees.value.get(dimensions, [{}])):
                    for k, at in leaves(here, nodes, forest.margin):
                        yield pa.record_batch([pa.array(np.full(len(at), _number(dimensions, t, k))), b.column(0).take(pa.array(mine[at]))], ["leaf", "c"])

    places = materialize(classes.select("c", "u", "dims").mapInArrow(placed, "leaf long, c long"), "places")
    places = _deepened(places, classes, forest, matrix)
    sizes = places.groupBy("leaf").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / forest.block).cast("int")
    spread = places.join(sizes, "leaf").withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("c", "leaf"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # each class with its leaves, of which there are as many as trees and spill make
    with_leaves = classes.select("c", "u", "n").join(places.groupBy("c").agg(F.collect_list("leaf").alias("all")), "c")
    tiles = spread.withColumn("other", other).select("leaf", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "c").join(with_leaves, "c")

    def compare(tile: pa.Table) -> pa.Table:
        i, j = tile["i"][0].as_py(), tile["j"][0].as_py()
        here = matrix(tile["u"])
        c, mine, n = tile["c"].to_numpy(), tile["mine"].to_numpy(), tile["n"].to_numpy().astype(np.float64)  # sums below 2 ** 53 are exact
        lists = tile["all"].combine_chunks()
        row = np.repeat(np.arange(len(c)), lists.value_lengths().to_numpy())
        bits = shared_below(tile["leaf"][0].as_py(), row, lists.flatten().to_numpy(), len(c))
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        linked, label = np.zeros(len(c)), np.arange(len(c))
        for x, y in near_pairs(here, None, least) if i == j else near_pairs(here[left], here[right], least):
            if i != j:
                x, y = left[x], right[y]
            own = apart(x, y, bits)
            x, y = x[own], y[own]
            linked += np.bincount(x, n[y], len(c)) + np.bincount(y, n[x], len(c))
            join_labels(label, x, y)
        some = np.flatnonzero(linked)
        return pa.table({"c": c[some], "linked": linked[some].astype(np.int64), "to": c[label[some]]})

    found = materialize(tiles.groupBy("leaf", "i", "j").applyInArrow(compare, "c long, linked long, to long"), "linked")
    linked = found.groupBy("c").agg(F.sum("linked").alias("linked"))
    roots = components(found.select("c", "to"))
    out = classes.select("c", "d", "n").join(linked, "c", "left").join(roots.withColumnRenamed("node", "c"), "c", "left")
    out = out.select("d", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("root", "c").alias("component_id"))
    joined = keyed.select("id", "d").join(out, "d", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def oracle(least: float = 0.9) -> str:
    """DuckDB SQL for near_vectors() of embeddings: all pairs, and what each vector reaches. For small tables."""
    return f"""
    with recursive v as (select vec_id, embedding::double[] as e from embeddings),
    good as (select vec_id, e from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
    links as (select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= {least}),
    reach(node, root) as (select vec_id, vec_id from v union select links.b, reach.root from reach join links on reach.node = links.a),
    roots as (select node, min(root) as component_id from reach group by node),
    counts as (select a, count(*) as n from links group by a)
    select v.vec_id, coalesce(counts.n, 0)::bigint as n_links, component_id, v.vec_id = component_id as kept
    from v join roots on roots.node = v.vec_id left join counts on counts.a = v.vec_id"""
