"""Hard negatives by best-first search in an STR-packed R-tree."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.session import releasing
from cohortspark.sources.scratch import Scratch

SCALE = 256  # components become floor(SCALE * x)
POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
TILE_VALUES = 65_536  # components of a tile, the smallest box that is stored
NODE_TILES = 16  # tiles that go to a task together
GROUP_SLABS = 32
BLOCK_ANCHORS = 8192  # anchors that go to a task together
LEAF = 256  # rows of a box without further boxes, inside a task
FAN = 8
WAVE = 8
CHUNK = 128  # anchors that share a queue
_SALTS = 16
_LEAST, _MOST = 1 - 2**63, 2**63 - 1  # scores beyond saturate


def _whole(lists: pa.Array, count: int, size: int) -> np.ndarray:
    """Vectors of one length, their components as whole numbers in double precision."""
    flat = lists.flatten().to_numpy(False).astype(np.float64)
    return np.floor(flat * SCALE).reshape(count, size)


class Tree:
    """An R-tree in memory, packed by sorting and tiling along the widest coordinates."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.boxes: list[tuple[np.ndarray, np.ndarray, int, int, list[int]]] = []
        self._pack(vectors, 0, len(vectors))

    def _pack(self, vectors: np.ndarray, start: int, stop: int) -> int:
        inside = vectors[self.order[start:stop]]
        low, high = inside.min(0), inside.max(0)
        number, children = len(self.boxes), []
        self.boxes.append((low, high, start, stop, children))
        if stop - start > LEAF:
            if inside.shape[1]:
                along = np.argsort(inside[:, np.argmax(high - low)], kind="stable")
                self.order[start:stop] = self.order[start:stop][along]
            slabs = min(FAN, -(-(stop - start) // LEAF))
            cuts = np.linspace(start, stop, slabs + 1).astype(int).tolist()
            children += [self._pack(vectors, a, b) for a, b in zip(cuts, cuts[1:])]
        return number


class Search:
    """The first k rows of every anchor's score windows among the rows of one tree."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.tree = Tree(vectors)
        order = self.tree.order
        self.vectors, self.ids = vectors[order], ids[order]
        self.labels, self.rows = labels[order], rows[order]

    def _products(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Inner products as 64-bit numbers."""
        if left.dtype != object:
            return (left @ right.T).astype(np.int64)
        exact = left @ right.T
        return np.clip(exact, _LEAST, _MOST).astype(np.int64)

    def run(self, anchors: dict[str, np.ndarray], same: bool, k: int) -> list[np.ndarray]:
        """Anchor, window, candidate and score of what is found.

        ``anchors`` holds vectors, labels, rows and, per window, the scores ``low`` and ``high``
        and ``floor``, below which an anchor has k candidates already.
        """
        vectors, stored = anchors["vectors"], self.vectors
        reach = max((np.abs(v).max(initial=0) for v in (vectors, stored)))
        if not reach * reach * max(1, vectors.shape[1]) < 2**53:
            # Sums of such products are not exact in double precision.
            whole = np.frompyfunc(int, 1, 1)
            vectors, self.vectors = whole(vectors), whole(stored).astype(object)
            vectors = vectors.astype(object)
            self.tree.boxes = [
                (whole(a).astype(object), whole(b).astype(object), *rest)
                for a, b, *rest in self.tree.boxes
            ]
        parts = [
            self._chunk({**anchors, "vectors": vectors}, np.arange(s, min(s + CHUNK, len(vectors))), same, k)
            for s in range(0, len(vectors), CHUNK)
        ]
        return [np.concatenate(c) for c in zip(*parts)]

    def _chunk(self, anchors: dict, chosen: np.ndarray, same: bool, k: int) -> list[np.ndarray]:
        vectors, labels = anchors["vectors"][chosen], anchors["labels"][chosen]
        rows, low, high = (anchors[c][chosen] for c in ("rows", "low", "high"))
        floor = anchors["floor"][chosen].copy()
        positive, negative = np.maximum(vectors, 0), np.minimum(vectors, 0)
        windows = low.shape[1]
        slot, score, at = (np.zeros(0, np.int64) for _ in range(3))

        def bounds(numbers: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
            """Inner products that rows of each box can have, coordinate by coordinate."""
            lows = np.stack([self.tree.boxes[i][0] for i in numbers])
            highs = np.stack([self.tree.boxes[i][1] for i in numbers])
            upper = positive @ highs.T + negative @ lows.T
            lower = positive @ lows.T + negative @ highs.T
            return np.clip(upper.T, _LEAST, _MOST), np.clip(lower.T, _LEAST, _MOST)

        queue: list[tuple] = []

        def push(numbers: Sequence[int]) -> None:
            for i, upper, lower in zip(numbers, *bounds(numbers)):
                heapq.heappush(queue, (-upper.max(), i, upper, lower))

        push([0])
        while queue:
            _, number, upper, lower = heapq.heappop(queue)
            open_to = (upper[:, None] >= np.maximum(floor, low)) & (lower[:, None] <= high)
            active = np.flatnonzero(open_to.any(1))
            if not len(active):
                continue
            _, _, start, stop, children = self.tree.boxes[number]
            if children:
                push(children)
                continue
            products = self._products(vectors[active], self.vectors[start:stop])
            fits = (self.labels[start:stop] == labels[active][:, None]) == same
            fits &= self.rows[start:stop] != rows[active][:, None]
            new = []
            for w in range(windows):
                least = np.maximum(floor[active, w], low[active, w])[:, None]
                q, r = np.nonzero(fits & (products >= least) & (products <= high[active, w][:, None]))
                if len(q):
                    new.append((active[q] * windows + w, products[q, r], r + start))
            if not new:
                continue
            slot, score, at = (
                np.concatenate((old, *more)) for old, more in zip((slot, score, at), zip(*new))
            )
            order = np.lexsort((self.ids[at], ~score, slot))  # ~ turns 64-bit numbers around
            slot, score, at = slot[order], score[order], at[order]
            opens = np.concatenate(([True], slot[1:] != slot[:-1]))
            place = np.arange(len(slot)) - np.maximum.accumulate(np.where(opens, np.arange(len(slot)), 0))
            last = place == k - 1
            floor.reshape(-1)[slot[last]] = score[last]
            first = place < k
            slot, score, at = slot[first], score[first], at[first]
        return [chosen[slot // windows], slot % windows, at, score]


def _axes(vectors: DataFrame, number: int = 2) -> list[int]:
    """The coordinates that vary most, by sums over all rows; two rows come to the driver."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, 0))
        for batch in batches:
            column = batch.column("embedding")
            flat = np.clip(column.flatten().to_numpy(False).astype(np.float64), -1e100, 1e100)
            if not len(flat):
                continue
            lengths = np.diff(column.offsets.to_numpy())
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            size = max(sums.shape[1], int(lengths.max()))
            sums = np.pad(sums, ((0, 0), (0, size - sums.shape[1])))
            for i, weights in enumerate((None, flat, flat * flat)):
                sums[i] += np.bincount(place, weights, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(sums.shape[1])), *map(pa.array, sums)], ["axis", "n", "s", "q"]
        )

    rows = vectors.select("embedding").mapInArrow(moments, "axis long, n double, s double, q double")
    widest = rows.groupBy("axis").agg(F.expr("sum(q) - sum(s) * sum(s) / sum(n)").alias("spread"))
    return [r["axis"] for r in widest.orderBy(F.desc("spread"), "axis").limit(number).collect()]


def _tiles(
    batches: Iterator[pa.RecordBatch], tile_values: int
) -> Iterator[pa.RecordBatch]:
    """One row per tile from sorted rows: up to ``tile_values`` components, of one length, and,
    unless a label has few rows, of one label."""
    slab = TaskContext.get().partitionId()
    made, waiting, held = 0, [], 0
    state: tuple[int | None, int | None] = (None, None)
    rows_before = 0

    def tile() -> pa.RecordBatch:
        nonlocal made, waiting, held, rows_before
        table = pa.Table.from_batches(waiting).combine_chunks()
        size = state[0]
        vectors = table.column("embedding").chunk(0)
        whole = _whole(vectors, len(vectors), size)
        labels = table.column("label").to_numpy()

        def listed(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        first = (slab << 40) + rows_before
        columns = {
            "slab": pa.array([slab], pa.int64()),
            "node": pa.array([(slab << 32) + made // NODE_TILES], pa.int64()),
            "size": pa.array([size], pa.int32()),
            "label_low": pa.array([labels.min()], pa.int64()),
            "label_high": pa.array([labels.max()], pa.int64()),
            "low": listed(pa.array(whole.min(0))),
            "high": listed(pa.array(whole.max(0))),
            "ids": listed(table.column("vec_id").chunk(0)),
            "labels": listed(table.column("label").chunk(0)),
            "rows": listed(pa.array(np.arange(first, first + len(labels)))),
            "asks": listed(table.column("asks").chunk(0)),
            "vectors": listed(vectors.flatten()),
        }
        rows_before += len(labels)
        made, waiting, held = made + 1, [], 0
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    for batch in releasing(batches):
        sizes, labels = batch.column("size").to_numpy(), batch.column("label").to_numpy()
        changes = np.flatnonzero((sizes[1:] != sizes[:-1]) | (labels[1:] != labels[:-1])) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            size, label = int(sizes[start]), int(labels[start])
            limit = max(16, tile_values // max(1, size))
            if held and (size != state[0] or (label != state[1] and held >= limit // 8)):
                yield tile()
                if size != state[0]:
                    made += -made % NODE_TILES  # nodes hold one length
            state = (size, label)
            while start < stop:
                some = min(stop - start, limit - held)
                waiting.append(batch.slice(start, some))
                held, start = held + some, start + some
                if held == limit:
                    yield tile()
    if held:
        yield tile()


_BOX_KIND = "label_low long, label_high long, low array<double>, high array<double>"


def _boxed(names: Sequence[str], labels: tuple[int, int], low: np.ndarray, high: np.ndarray, values):
    """One row: the columns ``values`` under ``names`` and a box."""
    columns = [pa.array([v], pa.int32() if n == "size" else pa.int64()) for n, v in zip(names, values)]
    columns += [pa.array([v], pa.int64()) for v in labels]
    columns += [pa.array([v.tolist()], pa.list_(pa.float64())) for v in (low, high)]
    return pa.table(columns, [*names, "label_low", "label_high", "low", "high"])


def _around(boxes: DataFrame, key: str, *keep: str) -> DataFrame:
    """Boxes around the boxes of every key and vector length; groups are small by construction."""
    names = [key, "size", *keep]

    def merge(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        low, high = (
            table.column(c).combine_chunks().flatten().to_numpy(False).reshape(len(table), size)
            for c in ("low", "high")
        )
        ends = pc.min(table.column("label_low")).as_py(), pc.max(table.column("label_high")).as_py()
        values = [table.column(n)[0].as_py() for n in names]
        return _boxed(names, ends, low.min(0), high.max(0), values)

    kinds = ", ".join(f"{n} {'int' if n == 'size' else 'long'}" for n in names)
    narrow = boxes.select(*names, "label_low", "label_high", "low", "high")
    return narrow.groupBy(key, "size").applyInArrow(merge, f"{kinds}, {_BOX_KIND}")


def pack(vectors: DataFrame, scratch: Scratch, tile_values: int = TILE_VALUES) -> DataFrame:
    """Tiles of all rows (vec_id, label, asks, embedding), in sort-tile-recursive order.

    Rows are sorted by vector length, label and the coordinate that varies most, and cut into
    slabs, as many as the root of the number of tiles; each slab is sorted by the next
    coordinate and cut into tiles. vec_id breaks ties, so equal vectors do not pile up.
    """
    axes = _axes(vectors)
    x0, x1 = (F.get("embedding", F.lit(i)) for i in (*axes, 0, 0)[:2])
    sized = vectors.withColumn("size", F.size("embedding"))
    values = sized.agg(F.sum(F.col("size").cast("long") + 1)).first()[0] or 0
    slabs = max(1, round((values / tile_values) ** 0.5))
    kind = vectors.schema["embedding"].dataType.simpleString()
    return scratch.save(
        "tiles",
        sized.withColumns({"x0": x0, "x1": x1})
        .repartitionByRange(slabs, "size", "label", "x0", "vec_id")
        .sortWithinPartitions("size", "label", "x1", "vec_id")
        .select("vec_id", "label", "size", "asks", "embedding")
        .mapInArrow(
            lambda batches: _tiles(batches, tile_values),
            f"slab long, node long, size int, {_BOX_KIND}, ids array<long>, labels array<long>, "
            f"rows array<long>, asks array<boolean>, vectors {kind}",
        ),
    )


def _anchors(tiles: DataFrame, scratch: Scratch) -> DataFrame:
    """block, size, row, anchor_id, label and vector of the rows that ask, in blocks by slab."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            for tile in range(batch.num_rows):
                one = {c: batch.column(c)[tile] for c in batch.schema.names}
                chosen, size = np.flatnonzero(one["asks"].values.to_numpy(False)), one["size"].as_py()
                if not len(chosen):
                    continue
                places = (chosen[:, None] * size + np.arange(size)).reshape(-1)
                offsets = pa.array(np.arange(len(chosen) + 1) * size, pa.int32())
                fixed = {c: one[c].as_py() for c in ("slab", "node", "size")}
                columns = [
                    pa.array(np.full(len(chosen), v), pa.int32() if c == "size" else pa.int64())
                    for c, v in fixed.items()
                ]
                columns += [one[c].values.take(pa.array(chosen)) for c in ("rows", "ids", "labels")]
                vectors = one["vectors"].values.take(pa.array(places))
                columns.append(pa.ListArray.from_arrays(offsets, vectors))
                names = [*fixed, "row", "anchor_id", "label", "vector"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = tiles.schema["vectors"].dataType.simpleString()
    rows = scratch.save(
        "anchors",
        tiles.select("slab", "node", "size", "rows", "ids", "labels", "asks", "vectors").mapInArrow(
            pick,
            "slab long, node long, size int, row long, anchor_id long, label long, "
            f"vector {kind}",
        ),
    )
    earlier = Window.partitionBy("slab", "size").orderBy("node")
    before = F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = (
        rows.groupBy("slab", "size", "node")
        .agg(F.count("*").alias("n"))
        .select("node", (F.col("slab") * 2**32 + F.floor(before / BLOCK_ANCHORS)).alias("block"))
    )
    return rows.join(blocks, "node").drop("slab", "node")


def _block_boxes(anchors: DataFrame) -> DataFrame:
    """A box and the ends of all score windows for every block of anchors."""

    def merge(table: pa.Table) -> pa.Table:
        names, size = ["block", "size", "least", "most"], table.column("size")[0].as_py()
        whole = _whole(table.column("vector").combine_chunks(), table.num_rows, size)
        labels = table.column("label")
        values = [table.column(n)[0].as_py() for n in ("block", "size")]
        values += [pc.min(pc.list_flatten(table.column("lows"))).as_py()]
        values += [pc.max(pc.list_flatten(table.column("highs"))).as_py()]
        ends = pc.min(labels).as_py(), pc.max(labels).as_py()
        return _boxed(names, ends, whole.min(0), whole.max(0), values)

    rows = anchors.select("block", "size", "label", "lows", "highs", "vector")
    kinds = f"block long, size int, least long, most long, {_BOX_KIND}"
    return rows.groupBy("block", "size").applyInArrow(merge, kinds)


_ENDS = ("label_low", "label_high", "low", "high")


def _reachable(blocks: DataFrame, nodes: DataFrame, same: bool) -> DataFrame:
    """block, node and upper: the nodes whose boxes can hold a score that a block looks for.

    Goes down from groups of slabs to slabs to nodes and leaves out boxes that lie outside the
    block's score window or have no label that it looks for.
    """
    slabs = _around(nodes, "slab", "grp")
    groups = _around(slabs, "grp")
    asking = blocks.select(
        "block", "size", *[F.col(c).alias(f"q_{c}") for c in (*_ENDS, "least", "most")]
    )
    # One length is the usual case: without salt, all blocks would be one task's.
    salted = asking.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(_SALTS)))
    roots = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).select(
        "grp", "size", F.col("salt").cast("long"), *_ENDS
    )
    terms = (
        "transform(arrays_zip(q_low, q_high, low, high), x -> array("
        "x.q_low * x.low, x.q_low * x.high, x.q_high * x.low, x.q_high * x.high))"
    )
    # Sums of doubles: wide enough for their rounding.
    sums = (
        f"aggregate({terms}, struct(0D AS up, 0D AS down, 0D AS size), (s, t) -> struct("
        "s.up + array_max(t) AS up, s.down + array_min(t) AS down, "
        "s.size + greatest(abs(array_max(t)), abs(array_min(t))) AS size))"
    )
    single = "label_low = label_high AND q_label_low = q_label_high AND label_low = q_label_low"
    labels = "label_low <= q_label_high AND label_high >= q_label_low" if same else f"NOT ({single})"

    def prune(rows: DataFrame, *keep: str) -> DataFrame:
        reach = rows.filter(labels).withColumn("s", F.expr(sums))
        reach = reach.selectExpr(
            "*",
            f"greatest(s.up + 1e-9D * s.size, CAST({_LEAST}L AS DOUBLE)) AS upper",
            f"least(s.down - 1e-9D * s.size, CAST({_MOST}L AS DOUBLE)) AS lower",
        )
        # Sums that are no number, as of opposite infinities, count as the highest: boxes stay.
        near = reach.filter(
            "upper >= q_least AND (isnan(s.down - s.size) OR lower <= q_most)"
        )
        return near.select(*keep)

    mine = list(asking.columns)
    found = prune(salted.join(roots, ["size", "salt"]), *mine, "grp")
    found = prune(found.join(slabs, ["grp", "size"]), *mine, "slab")
    return prune(found.join(nodes, ["slab", "size"]), "block", "size", "node", "upper")


def _searcher(same: bool, k: int):
    def search(asking: pa.Table, tiles: pa.Table) -> pa.Table:
        names = ["row", "anchor_id", "place", "found_id", "score"]
        kinds = pa.schema([(n, pa.int64()) for n in names])
        if not asking.num_rows or not tiles.num_rows:
            return kinds.empty_table()
        size = asking.column("size")[0].as_py()

        def flat(name: str) -> np.ndarray:
            return tiles.column(name).combine_chunks().flatten().to_numpy(False)

        def windows(name: str) -> np.ndarray:
            values = asking.column(name).combine_chunks()
            return values.flatten().to_numpy(False).reshape(len(values), len(values[0]))

        ids = flat("ids")
        vectors = _whole(tiles.column("vectors").combine_chunks(), len(ids), size)
        work = Search(vectors, ids, flat("labels"), flat("rows"))
        own = asking.column("vector").combine_chunks()
        anchors = {
            "vectors": _whole(own, asking.num_rows, size),
            "labels": asking.column("label").to_numpy(),
            "rows": asking.column("row").to_numpy(),
            "low": windows("lows"),
            "high": windows("highs"),
            "floor": windows("floors"),
        }
        who, window, at, score = work.run(anchors, same, k)
        rows = asking.select(["row", "anchor_id"]).take(pa.array(who))
        columns = [*rows.columns, pa.array(window), pa.array(work.ids[at]), pa.array(score)]
        return pa.table(columns, names).cast(kinds)

    return search


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(f"rank <= {k}")


def search(
    anchors: DataFrame, tiles: DataFrame, nodes: DataFrame, scratch: Scratch, same: bool, k: int
) -> DataFrame:
    """row, anchor_id, place, found_id, score and rank: the first k of every score window.

    ``anchors`` as from ``pack``'s tiles, with arrays ``lows`` and ``highs`` of score windows;
    place counts them. ``same`` looks among rows of the anchor's label, else among the others.
    Nodes are visited in rounds, those with the highest bounds first, ``WAVE`` times as many in
    each: the k-th scores found so far are floors for the next round, which leaves out nodes and
    boxes strictly below. So a window gets few rows that others push out again.
    """
    anchors = scratch.save("asking", anchors)
    blocks = scratch.save("blocks", _block_boxes(anchors))
    nearest = Window.partitionBy("block", "size").orderBy(F.desc("upper"), "node")
    ranked = _reachable(blocks, nodes, same).withColumn("rank", F.row_number().over(nearest))
    pairs = scratch.save("pairs", ranked)
    held = tiles.select("node", "ids", "labels", "rows", "vectors")
    last = pairs.agg(F.max("rank")).first()[0] or 0
    found = anchors.sparkSession.createDataFrame(
        [], "row long, anchor_id long, place long, found_id long, score long"
    )
    begin, end = 1, 1
    while begin <= last:
        kth = (
            _first(found, k)
            .filter(f"rank = {k}")
            .groupBy("row")
            .agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("kth"))
        )
        floors = f"transform(lows, (x, i) -> coalesce(try_element_at(kth, CAST(i AS LONG)), {_LEAST}L))"
        floored = scratch.save(
            "floored",
            anchors.join(kth, "row", "left").withColumn("floors", F.expr(floors)).drop("kth"),
        )
        # A window without end points (low above high) asks for nothing.
        wanted = (
            "array_min(transform(filter(arrays_zip(lows, highs, floors), w -> w.lows <= w.highs), "
            "w -> w.floors))"
        )
        least = floored.groupBy("block", "size").agg(F.min(F.expr(wanted)).alias("floor"))
        chosen = (
            pairs.filter(F.col("rank").between(begin, end))
            .join(least, ["block", "size"])
            .filter("upper >= floor")
            .select("block", "size", "node")
        )
        left = floored.join(chosen, ["block", "size"]).groupBy("block", "node")
        right = held.join(chosen, "node").groupBy("block", "node")
        visited = left.cogroup(right).applyInArrow(_searcher(same, k), found.schema)
        found = scratch.save("found", _first(found.unionByName(visited), k).drop("rank"))
        begin, end = end + 1, end * WAVE
    return _first(found, k)


def hard_negatives(
    embeddings: DataFrame,
    scratch: Scratch,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    tile_values: int = TILE_VALUES,
) -> DataFrame:
    """Negatives that score nearly as high as the positives of every anchor.

    Needs vec_id (long), label (integer), embedding (array of float or double) and asks (boolean:
    whether the row is an anchor). Components become floor(256 * x); a score is the inner
    product of two rows, saturated at plus and minus 2^63 - 1. Higher scores come first, then smaller
    vec_ids; vectors of any finite size have exact scores. An anchor's positives are the first ``positives`` other rows of its label; for each,
    the first ``negatives`` rows of other labels with low_percent * positive <= 100 * score <=
    high_percent * positive are returned, as anchor_id, positive_id, rank, negative_id,
    positive_score and negative_score.

    All rows are packed into tiles by sort-tile-recursion; the boxes around tiles are joined
    into nodes, slabs and groups. Per-coordinate intervals of two boxes bound the scores between
    them, and so tell which nodes a block of anchors has to see. Inside a task, a queue takes the
    box with the highest bound first and drops boxes outside all score windows or strictly below
    the k-th score. Two searches: among the same label without a window, then with windows among
    the others.

    Rows without vec_id, label or embedding, or with a component that is null or not finite (as
    it is or times 256), take no part. Vectors of different lengths have no score. A row that
    repeats another's vec_id is a row of its own, an "other" row to it, and an anchor of its own.
    """
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf")),
    )
    rows = embeddings.filter(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(finite, F.lit(False))
    ).select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.coalesce("asks", F.lit(False)).alias("asks"),
        "embedding",
    )
    tiles = pack(rows, scratch, tile_values)
    grouped = tiles.withColumn("grp", F.expr(f"slab DIV {GROUP_SLABS}"))
    nodes = scratch.save("nodes", _around(grouped, "node", "slab", "grp"))
    anchors = _anchors(tiles, scratch)
    everything = {"lows": F.array(F.lit(_LEAST)), "highs": F.array(F.lit(_MOST))}
    best = search(anchors.withColumns(everything), tiles, nodes, scratch, True, positives)
    best = scratch.save("positives", best.select("row", "anchor_id", "found_id", "score", "rank"))

    def share(percent: int, rounded: str) -> str:
        return f"{percent} * (p.score DIV 100) + ({percent} * (p.score % 100) {rounded}) DIV 100"

    # Nothing lies between two shares of a score below zero.
    lows = f"transform(found, p -> CASE WHEN p.score < 0 THEN 1L ELSE {share(low_percent, '+ 99')} END)"
    highs = f"transform(found, p -> CASE WHEN p.score < 0 THEN 0L ELSE {share(high_percent, '')} END)"
    windows = (
        best.groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found"))
        .filter("exists(found, p -> p.score >= 0)")
        .selectExpr("row", f"{lows} AS lows", f"{highs} AS highs")
        # Windows of all anchors are as many, the missing ones empty.
        .selectExpr(
            "row",
            f"concat(lows, array_repeat(1L, {positives} - size(lows))) AS lows",
            f"concat(highs, array_repeat(0L, {positives} - size(highs))) AS highs",
        )
    )
    found = search(anchors.join(windows, "row"), tiles, nodes, scratch, False, negatives)
    pairs = best.selectExpr(
        "row", "CAST(rank - 1 AS LONG) AS place", "found_id AS positive_id", "score AS positive_score"
    )
    return found.join(pairs, ["row", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
