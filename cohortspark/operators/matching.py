"""Perfect matching of two tables' rows within a tolerance, several numbers at a time.

Rows of which every number is within the tolerance of the other's may be paired; the question
is whether all rows can be. Sorted by one number, rows more than the tolerance apart cannot be
joined by any chain of pairs, so each such gap cuts the tables into blocks that are matched on
their own. Sweeps over one number after the other cut until blocks get no smaller. Most blocks are
then decided by their sums alone; in the others, augmenting paths find a matching if there
is one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

from cohortspark.jobs import let_workers_import
from cohortspark.sources.scratch import Scratch

#: Distinct rows of a block that is matched in one task; larger ones are paired by order.
MATCH_ROWS = 2048
_ROUNDS = 3  # of sweeps over all numbers, if blocks go on getting smaller

Near = Callable[[Column, Column, object], Column]


def assignable(near: np.ndarray, supply: np.ndarray, demand: np.ndarray) -> bool:
    """Can all supply go to the demand along pairs that are near? Both add up to the same.

    Gives greedily, then moves what was given along shortest augmenting paths.
    """
    supply, demand = supply.copy(), demand.copy()
    flow = np.zeros(near.shape, np.int64)
    for i in range(len(supply)):
        for j in np.flatnonzero(near[i] & (demand > 0)):
            given = min(supply[i], demand[j])
            flow[i, j] += given
            supply[i] -= given
            demand[j] -= given
            if not supply[i]:
                break
    while supply.any():
        giver = np.full(len(demand), -1)
        taken = np.full(len(supply), -1)
        seen, reached = supply > 0, np.zeros(len(demand), bool)
        frontier, end = np.flatnonzero(seen), -1
        while len(frontier) and end < 0:
            open_to = near[frontier] & ~reached
            columns = np.flatnonzero(open_to.any(0))
            if not len(columns):
                return False
            giver[columns] = frontier[open_to[:, columns].argmax(0)]
            reached[columns] = True
            free = columns[demand[columns] > 0]
            if len(free):
                end = int(free[0])
                break
            back = (flow[:, columns] > 0) & ~seen[:, None]
            frontier = np.flatnonzero(back.any(1))
            taken[frontier] = columns[back[frontier].argmax(1)]
            seen[frontier] = True
        if end < 0:
            return False
        path, j = [], end
        while True:
            i = int(giver[j])
            path.append((i, j))
            if taken[i] < 0:
                break
            j = int(taken[i])
        given = min(
            int(demand[end]), int(supply[i]), *(int(flow[a, int(taken[a])]) for a, _ in path[:-1])
        )
        for a, b in path:
            flow[a, b] += given
            if a != i:
                flow[a, int(taken[a])] -= given
        supply[i] -= given
        demand[end] -= given
    return True


def _cut(
    rows: DataFrame, by: str, column: str, rest: list[str], near: Column, scratch: Scratch
) -> DataFrame:
    """Rows with ``block`` numbered anew: cut where ``by`` changes or ``column`` leaves a gap.

    Sorted in ranges, each numbered by itself; what crosses from one to the next, one row per
    range, is broadcast. ``near`` compares ``before`` and ``column``.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [by, column, *rest]
    sliced = scratch.save(
        "sliced",
        rows.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id()),
    )
    mark = F.struct(F.col(by).alias("by"), F.col(column).alias("before"))
    in_order = Window.orderBy("slice")
    ends = sliced.groupBy("slice").agg(F.max(mark).alias("end"))
    ends = ends.select("slice", F.lag("end").over(in_order).alias("end"))
    inside = Window.partitionBy("slice").orderBy(*order)
    previous = F.coalesce(F.lag(mark).over(inside), F.col("end"))
    marked = sliced.join(F.broadcast(ends), "slice").withColumn("previous", previous)
    marked = marked.withColumn("before", F.col("previous.before"))
    joined = F.col("previous").isNotNull() & F.col("previous.by").eqNullSafe(F.col(by)) & near
    flagged = scratch.save(
        "flagged",
        marked.withColumn("opens", F.when(joined, 0).otherwise(1)).drop("previous", "before", "end"),
    )
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = flagged.groupBy("slice").agg(F.sum("opens").alias("n"))
    offsets = offsets.select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    so_far = F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        flagged.withColumn("so_far", so_far)
        .join(F.broadcast(offsets), "slice")
        .withColumn("block", F.col("offset") + F.col("so_far"))
        .drop("slice", "opens", "offset", "so_far")
    )


def _kind(value: Column) -> Column:
    """Null, not a number and either infinity equal only themselves."""
    number = value.cast("double")
    endless = F.abs(number) == float("inf")
    return (
        F.when(value.isNull(), 0)
        .when(F.isnan(number), 1)
        .when(endless & (number > 0), 2)
        .when(endless, 3)
        .otherwise(4)
    )


def _matcher(kinds: list[tuple[str, int]], tolerance: float):
    def match(table: pa.Table) -> pa.Table:
        ours = table.column("n_ours").to_numpy()
        theirs = table.column("n_theirs").to_numpy()
        left, right = np.flatnonzero(ours), np.flatnonzero(theirs)
        near = np.ones((len(left), len(right)), bool)
        for i, (kind, scale) in enumerate(kinds):
            values = table.column(f"m{i}").combine_chunks()
            if values.null_count == len(values):
                continue
            numbers = values.to_numpy(False)
            if kind != "whole":
                numbers = numbers.astype(np.float32 if kind == "float" else np.float64)
            with np.errstate(invalid="ignore", over="ignore"):
                apart = np.abs(numbers[left][:, None] - numbers[right])
                if kind == "whole":
                    apart = apart.astype(np.float64) / 10.0**scale
                close = apart <= tolerance
            # All rows of a block are of one kind: endless ones and those without a number equal.
            near &= close | ~np.isfinite(numbers[:1].astype(np.float64))[0]
        fits = assignable(near, ours[left], theirs[right])
        return pa.table({"block": table.column("block").slice(0, 1), "fits": pa.array([fits])})

    return match


def matched(
    actual: DataFrame,
    reference: DataFrame,
    near: Near,
    tolerance: float,
    scratch: Scratch,
    by_order: Callable[[DataFrame, DataFrame, list[str]], bool],
    match_rows: int = MATCH_ROWS,
) -> bool | None:
    """Can all rows of two tables of one schema and length be paired within the tolerance?

    ``near(left, right, type)`` says whether two cells are. Exact for blocks of up to
    ``match_rows`` distinct rows, and for larger ones in which only one number varies by
    more than the tolerance, as those pair in its order. Other large blocks are paired by order
    too (``by_order``); if that does not work out, the answer is None.
    """
    fields = actual.schema.fields
    numbers = [f for f in fields if isinstance(f.dataType, NumericType)]
    others = [f.name for f in fields if not isinstance(f.dataType, NumericType)]
    sides = actual.withColumns({"n_ours": F.lit(1), "n_theirs": F.lit(0)}).unionByName(
        reference.withColumns({"n_ours": F.lit(0), "n_theirs": F.lit(1)})
    )
    named = [F.col(f.name).alias(f"v{i}") for i, f in enumerate(numbers)]
    exact = F.struct(
        *[F.col(c).alias(f"e{i}") for i, c in enumerate(others)],
        *[_kind(F.col(f.name)).alias(f"k{i}") for i, f in enumerate(numbers)],
    )
    values = [f"v{i}" for i in range(len(numbers))]
    rows = (
        sides.select(exact.alias("exact"), *named, "n_ours", "n_theirs")
        .groupBy("exact", *values)
        .agg(F.sum("n_ours").alias("n_ours"), F.sum("n_theirs").alias("n_theirs"))
    )
    if not values:
        return rows.filter("n_ours <> n_theirs").isEmpty()
    by = "exact"
    for _ in range(_ROUNDS):
        for i, f in enumerate(numbers):
            rest = [v for v in values if v != f"v{i}"]
            close = near(F.col("before"), F.col(f"v{i}"), f.dataType)
            rows, by = _cut(rows, by, f"v{i}", rest, close, scratch), "block"
        rows = scratch.save("rows", rows)
        wide = [~near(F.min(v), F.max(v), f.dataType) for v, f in zip(values, numbers)]
        stats = scratch.save(
            "stats",
            rows.groupBy("block").agg(
                F.sum("n_ours").alias("all_ours"),
                F.sum("n_theirs").alias("all_theirs"),
                F.count("*").alias("size"),
                *[w.alias(f"w{i}") for i, w in enumerate(wide)],
                *[F.min(v).alias(f"low{i}") for i, v in enumerate(values)],
                *[F.max(v).alias(f"high{i}") for i, v in enumerate(values)],
            ),
        )
        uneven, largest = stats.agg(
            F.count_if(F.expr("all_ours <> all_theirs")),
            F.max("size"),
        ).first()
        if uneven:
            return False
        # Further sweeps are for blocks that no task can take.
        if len(values) == 1 or (largest or 0) <= match_rows:
            break
    # Where no number varies by more than the tolerance, any pairing will do.
    open_blocks = stats.filter(" OR ".join(f"w{i}" for i in range(len(values))))
    kinds, shipped, ranges = [], [], []
    for i, f in enumerate(numbers):
        if isinstance(f.dataType, (DoubleType, FloatType)):
            kinds.append(("float" if isinstance(f.dataType, FloatType) else "double", 0))
            shipped.append(F.col(f"v{i}").alias(f"m{i}"))
            continue
        # Whole numbers and decimals as whole numbers from the least of their block.
        scale = f.dataType.scale if isinstance(f.dataType, DecimalType) else 0
        kinds.append(("whole", scale))
        unit = f"decimal(38,{scale})"
        least = F.try_subtract(F.col(f"v{i}").cast(unit), F.col(f"low{i}").cast(unit))
        steps = F.try_multiply(least, F.lit(10**scale).cast("decimal(38,0)"))
        shipped.append(steps.try_cast("long").alias(f"m{i}"))
        reach = F.try_subtract(F.col(f"high{i}").cast(unit), F.col(f"low{i}").cast(unit))
        reach = reach.cast("double") * float(10**scale)
        ranges.append(F.col(f"low{i}").isNull() | F.coalesce(reach < 2.0**53, F.lit(False)))
    fits_task = F.col("size") <= match_rows
    for inside in ranges:
        fits_task = fits_task & inside
    sized = open_blocks.withColumn("fits_task", fits_task)
    lows = [f"low{i}" for i in range(len(values))]
    let_workers_import(rows.sparkSession)
    small = rows.join(sized.filter("fits_task").select("block", *lows), "block")
    unmatched = (
        small.select("block", "n_ours", "n_theirs", *shipped)
        .groupBy("block")
        .applyInArrow(_matcher(kinds, tolerance), "block long, fits boolean")
        .filter("NOT fits")
    )
    if not unmatched.isEmpty():
        return False
    large = sized.filter("NOT fits_task")
    if large.isEmpty():
        return True
    several = sum(F.col(f"w{i}").cast("int") for i in range(len(values))) > 1
    decided = large.filter(several).isEmpty()
    # Expanded again, as pairing by order counts copies itself.
    apart = rows.join(large.select("block"), "block")
    left, right = (
        apart.filter(f"{n} > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
        .select("block", *values)
        for n in ("n_ours", "n_theirs")
    )
    for v in values:
        if by_order(left, right, ["block", *[o for o in values if o != v], v]):
            return True
        if by_order(left, right, ["block", v, *[o for o in values if o != v]]):
            return True
    return False if decided else None
