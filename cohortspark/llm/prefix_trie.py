"""The trie of conversation prefixes, by fixed-length block hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.session import releasing
from cohortspark.sources.scratch import Scratch

BLOCK_TURNS = 4  # turns of a block
_SEGMENT = 1024  # blocks whose digests are summed up in one group
_HALF = 15  # hexadecimal digits of a half digest, so that it is never negative


def _halves(content: Column) -> list[Column]:
    """120 bits of SHA-256 in two columns."""
    digest = F.sha2(content, 256)
    return [
        F.conv(F.substr(digest, F.lit(1 + _HALF * i), F.lit(_HALF)), 16, 10).cast("long")
        for i in (0, 1)
    ]


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the place, from 1, among the rows of one conversation in it."""
    part, current, so_far = TaskContext.get().partitionId(), None, 0
    for batch in releasing(batches):
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        opens = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        counts = np.diff(np.append(opens, len(ids)))
        place = np.arange(len(ids)) - np.repeat(opens, counts) + 1
        if ids[0] == current:
            place[: counts[0]] += so_far
        current, so_far = ids[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(ids), part)), pa.array(place)],
            [*batch.schema.names, "part", "place"],
        )


def number_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, place (from 1), t1, t2 (digest of role and text) and chars of every turn.

    Turns are ordered by turn, null first, and where several of a conversation have one turn
    number, by role and text. Rows are numbered in sorted ranges that cut through a
    conversation wherever they like, so one with a third of all rows is many ranges' work. Only
    digests are shuffled; texts are where turn numbers repeat with different texts.
    """
    # Texts that are not read twice: digests are stored first.
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    t1, t2 = _halves(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    digests = [t1.alias("t1"), t2.alias("t2"), F.length("text").cast("long").alias("chars")]
    narrow = scratch.save("turns", turns.select("conv_id", "turn", *digests))
    tied = scratch.save(
        "tied",
        narrow.groupBy("conv_id", "turn")
        .agg(F.min("t1").alias("low"), F.max("t1").alias("high"))
        .filter("low <> high")
        .select(F.col("conv_id").alias("tied_id"), F.col("turn").alias("tied_turn")),
    )
    if tied.isEmpty():
        rows = narrow.withColumns({"role": F.lit(""), "text": F.lit("")})
    else:
        same = F.col("conv_id").eqNullSafe(F.col("tied_id")) & F.col("turn").eqNullSafe(
            F.col("tied_turn")
        )
        apart = {c: F.when(F.col("tied_id").isNotNull(), F.col(c)) for c in ("role", "text")}
        rows = (
            turns.withColumns({"t1": t1, "t2": t2, "chars": digests[2]})
            .join(tied, same, "left")
            .withColumns(apart)
            .drop("tied_id", "tied_turn")
        )
    order = ["conv_id", "turn", "role", "text"]
    numbered = scratch.save(
        "numbered",
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "t1", "t2", "chars")
        .mapInArrow(
            _number, "conv_id long, t1 long, t2 long, chars long, part long, place long"
        ),
    )
    # Only the first conversation of a range can have begun before it: at most one row a range.
    earlier = Window.partitionBy("conv_id").orderBy("part")
    before = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    continued = (
        numbered.groupBy("conv_id", "part")
        .agg(F.count("*").alias("n"))
        .withColumn("before", before)
        .filter("before > 0")
        .drop("n")
    )
    return numbered.join(F.broadcast(continued), ["conv_id", "part"], "left").select(
        "conv_id",
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
        "t1",
        "t2",
        "chars",
    )


def _blocks(turns: DataFrame) -> DataFrame:
    """Blocks of every conversation: block, digests of all turns before it (b1, b2) and up to
    its end (a1, a2), and its turns.

    A digest of turns is the exclusive or of digests of (place, turn): digests of blocks add up
    to those of prefixes, so long conversations are summed up in segments.
    """
    salted = _halves(F.concat_ws(":", "place", "t1", "t2"))
    inner = Window.partitionBy("conv_id", "segment").orderBy("block")
    outer = Window.partitionBy("conv_id").orderBy("segment")
    grouped = (
        turns.select(
            "conv_id",
            F.expr(f"(place - 1) DIV {BLOCK_TURNS}").alias("block"),
            "place",
            "chars",
            salted[0].alias("s1"),
            salted[1].alias("s2"),
        )
        .groupBy("conv_id", "block")
        .agg(
            F.bit_xor("s1").alias("x1"),
            F.bit_xor("s2").alias("x2"),
            F.array_sort(F.collect_list(F.struct("place", "s1", "s2", "chars"))).alias("turns"),
        )
        .withColumn("segment", F.expr(f"block DIV {_SEGMENT}"))
    )
    segments = grouped.groupBy("conv_id", "segment").agg(
        F.bit_xor("x1").alias("g1"), F.bit_xor("x2").alias("g2")
    )
    past = outer.rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select(
        "conv_id", "segment", *[F.bit_xor(f"g{i}").over(past).alias(f"g{i}") for i in (1, 2)]
    ).filter("segment > 0")
    sums = {
        f"a{i}": F.bit_xor(f"x{i}").over(inner.rowsBetween(Window.unboundedPreceding, 0))
        for i in (1, 2)
    }
    whole = {f"a{i}": F.expr(f"a{i} ^ coalesce(g{i}, 0L)") for i in (1, 2)}
    start = {f"b{i}": F.expr(f"a{i} ^ x{i}") for i in (1, 2)}
    return (
        grouped.withColumns(sums)
        .join(segments, ["conv_id", "segment"], "left")
        .withColumns(whole)
        .withColumns(start)
        .select("conv_id", "block", "b1", "b2", "a1", "a2", "turns")
    )


def _nodes(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes below the root: their digest (d1, d2), that of the parent (p1, p2), depth, conv_id,
    n_convs and saved.

    Conversations are grouped by blocks. A block without siblings is a chain of nodes with the
    same members. Only where blocks follow the same prefix side by side, their turns' prefixes
    are grouped again, one row per distinct block and turn, not per conversation.
    """
    distinct = scratch.save(
        "distinct",
        blocks.groupBy("block", "b1", "b2", "a1", "a2").agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.first("turns").alias("turns"),
        ),
    )
    prefix = ["block", "b1", "b2"]
    siblings = distinct.filter("block > 0").groupBy(*prefix).agg(F.count("*").alias("siblings"))

    def up_to(half: int) -> str:
        sums = f"aggregate(slice(turns, 1, j), b{half}, (x, t) -> x ^ t.s{half})"
        return f"{sums} AS d{half}, {sums} ^ turns[j - 1].s{half} AS p{half}"

    turn = f"struct(turns[j - 1].place AS depth, turns[j - 1].chars AS chars, {up_to(1)}, {up_to(2)})"
    # All first blocks follow the root: known without a join, on a key they would all share.
    first = distinct.filter("block = 0")
    first = first.withColumn("siblings", F.lit(first.count()))
    later = distinct.filter("block > 0").join(siblings, prefix)
    each = first.unionByName(later).selectExpr(
        "siblings",
        "conv_id",
        "n_convs",
        f"inline(transform(sequence(1, size(turns)), j -> {turn}))",
    )
    each = scratch.save("turn_prefixes", each)
    key = ["depth", "d1", "d2"]
    refined = each.filter("siblings > 1").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        *[F.min(c).alias(c) for c in ("p1", "p2", "chars")],
    )
    both = each.filter("siblings = 1").drop("siblings").unionByName(refined)
    return both.selectExpr(
        *key, "p1", "p2", "conv_id", "n_convs", "(n_convs - 1) * chars AS saved"
    )


def _subtree_sums(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """d1, d2, n_leaves and saved, summed over each node's subtree, by pointer doubling.

    In round k a node knows the sums of its descendants less than 2 ** k levels below, and its
    ancestor 2 ** k levels above, to which it adds them. Rounds are the logarithm of the depth.
    """
    state, number = nodes.select("d1", "d2", "u1", "u2", "n_leaves", "saved"), 0
    while not state.filter("u1 IS NOT NULL").isEmpty():
        climbing = state.filter("u1 IS NOT NULL")
        sums = climbing.groupBy(F.col("u1").alias("d1"), F.col("u2").alias("d2")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        above = climbing.select(
            F.col("d1").alias("u1"), F.col("d2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2")
        )
        number += 1
        state = scratch.save(
            f"sums-{number}",
            state.join(sums, ["d1", "d2"], "left")
            .join(above, ["u1", "u2"], "left")
            .selectExpr(
                "d1",
                "d2",
                "w1 AS u1",
                "w2 AS u2",
                "n_leaves + coalesce(more_leaves, 0) AS n_leaves",
                "saved + coalesce(more_saved, 0) AS saved",
            ),
        )
    return state.drop("u1", "u2")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's ids, joined by commas."""
    for batch in releasing(batches):
        d1, d2, ids = (batch.column(c).to_numpy() for c in ("d1", "d2", "conv_id"))
        if not len(ids):
            continue
        changes = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        opens = np.flatnonzero(np.concatenate(([True], changes)))
        texts = [",".join(map(str, run.tolist())) for run in np.split(ids, opens[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(d1[opens]), pa.array(d2[opens]), pa.array(ids[opens]), pa.array(texts)],
            ["d1", "d2", "first", "ids"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node from its sorted runs, fed run by run."""
    node, digest, done = None, None, []

    def rows() -> pa.RecordBatch:
        d1, d2, texts = zip(*done) if done else ((), (), ())
        kinds = (pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip((d1, d2, texts), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["d1", "d2", "ends_sha256"])

    for batch in releasing(batches):
        for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
            if (d1, d2) == node:
                digest.update(b"," + ids.encode())
                continue
            if node:
                done.append((*node, digest.hexdigest()))
            node, digest = (d1, d2), hashlib.sha256(ids.encode())
        yield rows()
        done = []
    if node:
        done.append((*node, digest.hexdigest()))
    yield rows()


def _end_digests(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """d1, d2 and the digest of the sorted conv_ids that end there.

    Ids are sorted in ranges that may cut through a node, and each range joins its runs; only
    the runs of a node, a row for thousands of ids, come together.
    """
    order = ["d1", "d2", "conv_id"]
    runs = scratch.save(
        "runs",
        ends.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_listed, "d1 long, d2 long, first long, ids string"),
    )
    return (
        runs.repartition("d1", "d2")
        .sortWithinPartitions("d1", "d2", "first")
        .select("d1", "d2", "ids")
        .mapInArrow(_hashed, "d1 long, d2 long, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, conv_ids: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per distinct sequence of first turns, from the empty one (the root) on.

    ``turns`` are rows as ``number_turns`` makes them, places of a conversation from 1 without
    gaps; ``conv_ids`` has each conv_id once, also of conversations without turns, which end in
    the root. Without any, there is no root.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves and saved_tokens (summed over the subtree: what members but one need
    not store of each node's last text, in code points), ends_sha256 (of the ids of members that
    end there, ascending, joined by commas).

    Conversations are cut into blocks of ``BLOCK_TURNS`` turns, chained by digests of 120 bits.
    Turn boundaries are looked at only in distinct blocks with siblings. Sums over subtrees take
    a logarithmic number of rounds. Nothing is grouped in one task but a block's turns, so
    popular openings, ends and long conversations are no harm.
    """
    blocks = scratch.save("blocks", _blocks(turns))
    ends = blocks.groupBy("conv_id").agg(F.max(F.struct("block", "a1", "a2")).alias("last"))
    ends = conv_ids.select("conv_id").join(ends, "conv_id", "left").select(
        "conv_id",
        F.coalesce("last.a1", F.lit(0)).alias("d1"),
        F.coalesce("last.a2", F.lit(0)).alias("d2"),
    )
    ends = scratch.save("ends", ends)
    lowest, n_convs = ends.agg(F.min("conv_id"), F.count("*")).first()
    nodes = scratch.save("nodes", _nodes(blocks, scratch))
    children = nodes.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count("*").alias("n_children")
    )
    parents = nodes.selectExpr("d1 AS p1", "d2 AS p2", "conv_id AS parent_conv_id")
    nodes = scratch.save(
        "linked",
        # The parents of the first level are the root, which is in no join: no hot key.
        nodes.join(children, ["d1", "d2"], "left")
        .withColumns({f"u{i}": F.expr(f"CASE WHEN depth > 1 THEN p{i} END") for i in (1, 2)})
        .join(parents.selectExpr("p1 AS u1", "p2 AS u2", "parent_conv_id"), ["u1", "u2"], "left")
        .selectExpr(
            "d1", "d2", "u1", "u2", "conv_id", "depth", "n_convs", "saved",
            f"CASE WHEN depth > 1 THEN parent_conv_id ELSE {lowest or 0}L END AS parent_conv_id",
            "coalesce(n_children, 0) AS n_children",
            "CASE WHEN n_children IS NULL THEN 1L ELSE 0L END AS n_leaves",
        ),
    )
    sums = _subtree_sums(nodes, scratch).withColumnRenamed("saved", "saved_tokens")
    whole = nodes.agg(
        F.expr("count_if(depth = 1)").alias("n_children"),
        F.expr("coalesce(sum(n_leaves), 1L)").alias("n_leaves"),
        F.expr("coalesce(sum(saved), 0L)").alias("saved_tokens"),
    )
    root = whole.filter(F.lit(n_convs > 0)).selectExpr(
        "0L AS d1", "0L AS d2", f"{lowest or 0}L AS conv_id", "0L AS depth",
        "CAST(NULL AS LONG) AS parent_conv_id", f"{n_convs}L AS n_convs",
        "n_children", "n_leaves", "saved_tokens",
    )
    below = nodes.drop("u1", "u2", "n_leaves", "saved").join(sums, ["d1", "d2"])
    return (
        below.unionByName(root)
        .join(_end_digests(ends, scratch), ["d1", "d2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def with_borrowed_openings(
    turns: DataFrame, scratch: Scratch, century: int = 100, longest: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Turns and conv_ids after each conversation's beginning was replaced.

    Of conversation c the first h = crc32(decimal c) % (longest + 1) turns make way for as many
    of conversation c - c % century, or as it has. Such conversations share openings in the way
    logged samples of one prompt do.
    """
    turns = scratch.save("placed", turns)
    conv_ids = scratch.save("conv_ids", turns.select("conv_id").distinct())
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    base = F.col("conv_id") - F.col("conv_id") % century
    asked = conv_ids.select("conv_id", h.alias("h"), base.alias("base")).filter("h > 0")
    openings = turns.filter(
        (F.col("conv_id") % century == 0) & (F.col("place") <= longest)
    ).withColumnRenamed("conv_id", "base")
    borrowed = asked.join(openings, "base").filter("place <= h").drop("base", "h")
    # How many turns fewer than asked for there are to borrow.
    there = openings.groupBy("base").agg(F.count("*").alias("there"))
    short = asked.join(there, "base", "left").selectExpr(
        "conv_id", "h - least(h, coalesce(there, 0)) AS short"
    )
    own = turns.filter(F.col("place") > h).join(short.filter("short > 0"), "conv_id", "left")
    own = own.withColumn("place", F.expr("place - coalesce(short, 0)")).drop("short")
    return borrowed.unionByName(own), conv_ids
