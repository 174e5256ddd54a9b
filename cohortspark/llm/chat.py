"""Chat formatting after collapsing cumulative snapshots. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.sources.scratch import Scratch

# The marks around a turn.
START, END = "<|im_start|>", "<|im_end|>"
ROLE = "user"  # of a turn that names none
_SUMS = ("h0", "h1", "h2", "h3")


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn with its place in the conversation and a hash of all turns up to it.

    The rolling hash is the running sum of hashes of (place, role, text), 128 bits of each in
    four parts, so a window needs to keep four numbers and no list of turns.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit(ROLE)).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_last(), "role", "text"
    )
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    content = F.concat_ws(
        ":", F.col("place").cast("string"), F.length("role").cast("string"), "role", "text"
    )
    digest = F.md5(content)
    parts = {
        h: F.conv(F.substr(F.col("digest"), F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long")
        for i, h in enumerate(_SUMS)
    }
    return (
        turns.withColumn("place", F.row_number().over(ordered))
        .withColumn("digest", digest)
        .withColumns(parts)
        .withColumns({h: F.sum(h).over(so_far) for h in _SUMS})
        .withColumn("n_turns", F.count("*").over(Window.partitionBy("conv_id")))
        .select("conv_id", "place", "role", "text", *_SUMS, "n_turns")
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id and n_copies of conversations that begin no longer one.

    Of equal conversations the smallest conv_id stays. Copies and shared beginnings are
    aggregated by hash ahead of the anti-join, so that no popular opening is joined row by row.
    """
    key = ["place", *_SUMS]
    whole = (
        prefixes.filter("place = n_turns")
        .groupBy(*key)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    continued = prefixes.filter("place < n_turns").select(*key).distinct()
    return whole.join(continued, key, "left_anti").select("conv_id", "n_copies")


def format_chats(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of every maximal conversation.

    Needs conv_id, turn, role and text. Turns are ordered by turn (null last), then role and
    text; repeated rows are repeated turns. Turns without conv_id belong to no conversation and
    are left out. A null role is ``user``, a null text is empty.
    """
    prefixes = scratch.save("turn_prefixes", turn_prefixes(conversations))
    kept = maximal_conversations(prefixes)
    rendered = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    return (
        prefixes.join(kept, "conv_id")
        .groupBy("conv_id", "n_copies")
        .agg(
            F.count("*").alias("n_turns"),
            F.array_sort(F.collect_list(F.struct("place", rendered.alias("turn")))).alias("turns"),
        )
        .select(
            "conv_id",
            "n_turns",
            "n_copies",
            F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("text"),
        )
    )
