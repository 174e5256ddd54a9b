"""Near-duplicate embeddings by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.components import components
from cohortspark.sources.scratch import Scratch

COSINE = 0.95
LEADING = 4  # principal dimensions of the grid
BOX = 16  # principal dimensions of the boxes that tell intervals apart
BLOCK = 16_384  # vectors of a block; two blocks are joined in one task
LEAF = 512  # vectors of an interval that is compared without further recursion
_SAFE = 1e-9  # rounding errors of distances stay far below


def usable(embedding: str) -> Column:
    """Whether a vector has a direction: no null or non-finite component, not zero."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of one length in double precision."""
    flat = column.flatten().to_numpy(False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _normalized(vectors: np.ndarray) -> np.ndarray:
    # Scale first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Principal axes of all unit vectors, the widest first, as columns."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                units = _normalized(_units(batch.column("embedding")))
                total += units.T @ units
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
            ["i", "j", "s"],
        )

    sums = vectors.select("embedding").mapInArrow(moments, "i int, j int, s double")
    matrix = np.zeros((size, size))
    for i, j, s in sums.groupBy("i", "j").agg(F.sum("s")).collect():  # size ** 2 / 2 rows
        matrix[i, j] = matrix[j, i] = s
    _, axes = np.linalg.eigh(matrix)
    return axes[:, ::-1].copy()


class GridOrderJoin:
    """Links between vectors in epsilon grid order, by recursion over sequence intervals."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, axes: np.ndarray, cosine: float):
        # Scaled by powers of two, which changes no cosine, so that products stay finite.
        powers = np.frexp(np.abs(vectors).max(1, initial=0))[1]
        self.vectors, self.cosine = np.ldexp(vectors, -powers[:, None]), cosine
        self.units = _normalized(vectors)
        self.eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + _SAFE
        self.space = self.units @ axes[:, :BOX]
        self.weights = weights
        self.links = np.zeros(len(vectors), np.int64)
        self.label = np.arange(len(vectors))
        self.forest: list[tuple[int, int]] = []

    def order(self, members: np.ndarray) -> np.ndarray:
        cells = np.floor(self.space[members, :LEADING] / self.eps)
        keys = [*self.space[members, :LEADING].T[::-1], *cells.T[::-1]]
        return members[np.lexsort(keys)]

    def _exact(self, i: int, j: int) -> bool:
        a, b = self.vectors[i], self.vectors[j]
        return float(a @ b) / math.sqrt(float(a @ a) * float(b @ b)) >= self.cosine

    def _compare(self, left: np.ndarray, right: np.ndarray, same: bool) -> None:
        close = self.units[left] @ self.units[right].T
        linked = close >= self.cosine - _SAFE
        if same:
            np.fill_diagonal(linked, False)
        for i, j in zip(*np.nonzero(linked & (close < self.cosine + _SAFE))):
            linked[i, j] = self._exact(left[i], right[j])
        if not linked.any():
            return
        self.links[left] += linked @ self.weights[right]
        if not same:
            self.links[right] += self.weights[left] @ linked
        for i in np.flatnonzero(linked.any(1)):
            x = left[i]
            others = right[linked[i]]
            labels, first = np.unique(self.label[others], return_index=True)
            for label, y in zip(labels.tolist(), others[first].tolist()):
                if label != self.label[x]:
                    self.forest.append((int(x), y))
                    self.label[self.label == label] = self.label[x]

    def join(self, left: np.ndarray, right: np.ndarray | None = None) -> None:
        """Compare two sequences, or one with itself."""
        same = right is None
        right = left if same else right
        if not len(left) or not len(right):
            return
        if not same:
            a, b = self.space[left], self.space[right]
            gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
            if gap @ gap > self.eps * self.eps:
                return
        if max(len(left), len(right)) <= LEAF:
            self._compare(left, right, same)
            return
        if same:
            half = len(left) // 2
            self.join(left[:half])
            self.join(left[half:])
            self.join(left[:half], left[half:])
        elif len(left) >= len(right):
            half = len(left) // 2
            self.join(left[:half], right)
            self.join(left[half:], right)
        else:
            half = len(right) // 2
            self.join(left, right[:half])
            self.join(left, right[half:])


def _in_grid_order(vectors: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """Adds the leading coordinates (p0, ...) and their cells (c0, ...)."""
    leading = axes[:, :LEADING]
    names = [f"p{k}" for k in range(leading.shape[1])] + [f"c{k}" for k in range(leading.shape[1])]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = _normalized(_units(batch.column("embedding"))) @ leading
            columns = [pa.array(c) for c in at.T]
            columns += [pa.array(np.floor(c / eps).astype(np.int64)) for c in at.T]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], [*batch.schema.names, *names]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    added = ", ".join(f"{n} {'double' if n[0] == 'p' else 'long'}" for n in names)
    return vectors.mapInArrow(project, f"{kinds}, {added}")


def _block_joiner(axes: np.ndarray, cosine: float):
    def join(table: pa.Table) -> pa.Table:
        """Numbers of links (b null) and links that connect (n null) between two blocks."""
        table = table.sort_by([("block", "ascending"), ("rep", "ascending")])
        reps, block = table.column("rep").to_numpy(), table.column("block").to_numpy()
        vectors = _units(table.column("embedding").combine_chunks())
        work = GridOrderJoin(vectors, table.column("copies").to_numpy(), axes, cosine)
        at = np.arange(len(reps))
        work.join(*(work.order(at[block == b]) for b in np.unique(block)))
        some = np.flatnonzero(work.links)
        pairs = reps[np.asarray(work.forest, np.int64).reshape(-1, 2)]
        nothing, none = pa.nulls(len(some), pa.int64()), pa.nulls(len(pairs), pa.int64())
        return pa.table(
            {
                "a": pa.array(np.concatenate((reps[some], pairs[:, 0]))),
                "b": pa.chunked_array([nothing, pa.array(pairs[:, 1])]),
                "n": pa.chunked_array([pa.array(work.links[some]), none]),
            }
        )

    return join


def _linked_blocks(blocks: DataFrame, eps: float, dims: int) -> DataFrame:
    """Pairs i <= j of blocks whose boxes come within eps of each other."""
    # Cells of the first dimension say which blocks to look at; boxes decide.
    cells = blocks.withColumn("cell", F.explode(F.sequence("low_cell", "high_cell")))
    left = cells.select([F.col(c).alias(f"l_{c}") for c in cells.columns])
    near = F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1))
    right = cells.withColumn("cell", near).select([F.col(c).alias(f"r_{c}") for c in cells.columns])
    gaps = []
    for k in range(dims):
        apart = F.greatest(
            F.col(f"l_low{k}") - F.col(f"r_high{k}"),
            F.col(f"r_low{k}") - F.col(f"l_high{k}"),
            F.lit(0.0),
        )
        gaps.append(apart * apart)
    return (
        left.join(right, F.col("l_cell") == F.col("r_cell"))
        .filter(F.col("l_block") <= F.col("r_block"))
        .filter(sum(gaps[1:], gaps[0]) <= eps * eps)
        .select(F.col("l_block").alias("i"), F.col("r_block").alias("j"))
        .distinct()
    )


def _join_size(vectors: DataFrame, scratch: Scratch, size: int, cosine: float, block: int):
    """Rows (a, b, n) of all block pairs among vectors of one length, or None for too few."""
    vectors = scratch.save(
        f"vectors-{size}", vectors.filter(F.size("embedding") == size).dropDuplicates(["rep"])
    )
    count = vectors.count()
    if count < 2:
        return None
    axes = principal_axes(vectors, size)
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + _SAFE
    dims = min(LEADING, size)
    order = [f"c{k}" for k in range(dims)] + [f"p{k}" for k in range(dims)] + ["rep"]
    blocks = -(-count // block)
    ranged = scratch.save(
        f"ranges-{size}",
        _in_grid_order(vectors, axes, eps)
        .repartitionByRange(blocks, *order)
        .withColumn("range", F.spark_partition_id()),
    )
    # Ranges become blocks by how many vectors lie before them. One row per range: broadcast.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.groupBy("range").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    numbered = numbered.select("range", F.floor(before / block).alias("block"))
    placed = ranged.join(F.broadcast(numbered), "range").drop("range")
    boxes = [F.min(f"p{k}").alias(f"low{k}") for k in range(dims)]
    boxes += [F.max(f"p{k}").alias(f"high{k}") for k in range(dims)]
    summary = placed.groupBy("block").agg(
        F.min("c0").alias("low_cell"), F.max("c0").alias("high_cell"), *boxes
    )
    tasks = _linked_blocks(summary, eps, dims)
    either = F.explode(F.array_distinct(F.array("i", "j"))).alias("block")
    return scratch.save(
        f"joined-{size}",
        placed.select("rep", "copies", "embedding", "block")
        .join(tasks.select("i", "j", either), "block")
        .groupBy("i", "j")
        .applyInArrow(_block_joiner(axes, cosine), "a long, b long, n long"),
    )


def embedding_components(
    embeddings: DataFrame, scratch: Scratch, cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Equal vectors are one item with a number of copies. Items are sorted in epsilon grid order
    (cells of the leading principal dimensions, side eps, the distance of unit vectors at the
    cosine) and cut into blocks. Pairs of blocks whose boxes are within eps are joined in a task
    each: intervals are halved until they are small or provably apart, then compared in double
    precision. A task returns a number of links per item and the links that connect
    its items, never all pairs. Vectors of different lengths have no cosine and do not link.

    Needs vec_id (long) and embedding (array of float or double). A vector that is null, empty,
    zero or has null or non-finite components links with nothing, nor does a row without vec_id,
    whose component is null and which is not kept. A repeated row is a copy. Rows that share a
    vec_id but not the vector are vectors of their own, each with its own links, and belong to
    one component, as they have one vec_id.
    """
    digest = [F.xxhash64("embedding"), F.xxhash64("embedding", F.lit(1))]
    rows = embeddings.select(
        "vec_id",
        "embedding",
        (usable("embedding") & F.col("vec_id").isNotNull()).alias("usable"),
        digest[0].alias("h1"),
        digest[1].alias("h2"),
    )
    good = rows.filter("usable")
    groups = good.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")
    )
    # Items have numbers of their own: one vec_id may stand for several of them.
    groups = scratch.save("groups", groups.withColumn("item", F.monotonically_increasing_id()))
    mapped = scratch.save(
        "mapped",
        good.join(groups, ["h1", "h2"]).select(
            "vec_id",
            "rep",
            "item",
            "copies",
            F.when(F.col("vec_id") == F.col("rep"), F.col("embedding")).alias("embedding"),
        ),
    )
    items = mapped.filter("embedding IS NOT NULL").select(
        F.col("item").alias("rep"), "copies", "embedding"
    )
    sizes = [r[0] for r in items.select(F.size("embedding")).distinct().collect()]
    parts = [p for s in sizes if (p := _join_size(items, scratch, s, cosine, block)) is not None]
    joined = embeddings.sparkSession.createDataFrame([], "a long, b long, n long")
    for part in parts:
        joined = joined.unionByName(part)
    numbers = joined.filter("n IS NOT NULL").groupBy(F.col("a").alias("item")).agg(
        F.sum("n").alias("n")
    )
    edges = joined.filter("b IS NOT NULL").select("a", "b")
    for end in ("a", "b"):
        named = groups.select(F.col("item").alias(end), F.col("rep").alias(f"{end}_rep"))
        edges = edges.join(named, end).drop(end)
    # A vec_id whose rows hold different vectors ties their items together.
    several = mapped.groupBy("vec_id").agg(F.min("item").alias("low"), F.max("item").alias("high"))
    several = several.filter("low <> high").select("vec_id")
    ties = mapped.join(several, "vec_id").select(
        F.col("vec_id").alias("a"), F.col("rep").alias("b")
    )
    edges = edges.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).unionByName(ties)
    found = components(edges, scratch, "found").withColumnRenamed("id", "rep")
    linked = (
        mapped.select("vec_id", "rep", "item", "copies")
        .join(numbers, "item", "left")
        .join(found, "rep", "left")
        .select(
            "vec_id",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
