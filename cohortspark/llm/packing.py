"""Best-fit packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.bpe import small_batches, word_codec
from cohortspark.sources.scratch import Scratch

CAPACITY = 2048
SEPARATOR = 0  # the id that ends every document
SLACK = 16  # a bin with no more free tokens than this counts as full
TASK_ITEMS = 20_000  # bins that one task packs


def token_pieces(
    documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every document's ids and the separator, cut where it is longer than a sequence.

    doc_id, piece (from 0), start, length, ids_crc32 (of little-endian 32-bit ids), and ``ids``
    on request. A null or empty text is its separator alone. Repeated rows are cut one by one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(path)
        end = np.asarray([SEPARATOR], "<i4").tobytes()
        for doc_ids, texts in small_batches(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            all_ids = []
            for i, ids in enumerate(codec.encode(texts)):
                ids = ids.astype("<i4", copy=False).tobytes() + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    values = (i, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(rows, values):
                        column.append(value)
                    if with_ids:
                        all_ids.append(np.frombuffer(part, "<i4"))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(rows[1:], kinds)]
            names = ["piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            of = doc_ids.take(pa.array(rows[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([of, *columns], ["doc_id", *names])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place inside it of every item, the largest first, each into the fullest bin that
    still has room. A bit mask of the free spaces that occur finds that bin at once."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    bins, places, count = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            target = room[space].pop()
            if not room[space]:
                free ^= 1 << space
        else:
            space, target = capacity, count
            count += 1
        bins[i], places[i] = target, capacity - space
        left = space - size
        room[left].append(target)
        free |= 1 << left
    return bins, places


def _pack_group(table: pa.Table, stage: int, group: int, capacity: int, slack: int) -> pa.Table:
    """Pack the bins of one task as items; their rows move along."""
    table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
    bins = table.column("sequence_id").to_numpy()
    lengths = table.column("length").to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    item = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(bins))))
    sizes = np.add.reduceat(lengths, starts)
    target, place = best_fit(sizes, capacity)
    filled = np.bincount(target, weights=sizes).astype(np.int64)
    new_bin = (stage << 58) | (group << 28) | target
    moved = {
        "sequence_id": new_bin[item],
        "offset": table.column("offset").to_numpy() + place[item],
        "open": capacity - filled[target[item]] > slack,
    }
    for name, values in moved.items():
        at = table.schema.get_field_index(name)
        table = table.set_column(at, name, pa.array(values))
    return table


def _packer(stage: int, capacity: int, slack: int):
    return lambda key, table: _pack_group(table, stage, key[0].as_py(), capacity, slack)


def pack(
    pieces: DataFrame,
    scratch: Scratch,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    task_items: int = TASK_ITEMS,
) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece and length (1 to ``capacity``).

    In every round each task packs the bins that it holds by best fit, largest first. Bins that
    are full up to ``slack`` tokens leave; the others go on as items of fewer tasks, so many
    that a task again gets about ``task_items``, until one task is left or a round joins
    next to nothing. Items are dealt out evenly by hash, whatever document they come from.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    schema = f"{kinds}, sequence_id long, offset long, open boolean"
    items = pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    ).withColumn("open", F.lit(True))
    rounds, stage = [], 0
    waiting = scratch.save("items", items)
    count = waiting.count()
    while count:
        groups = -(-count // task_items)
        dealt = F.pmod(F.xxhash64("sequence_id", F.lit(stage)), F.lit(groups)).cast("int")
        packed = scratch.save(
            f"round-{stage}",
            waiting.withColumn("open", F.lit(True))
            .groupBy(dealt.alias("task"))
            .applyInArrow(_packer(stage, capacity, slack), schema),
        )
        rounds.append(packed.filter("NOT open"))
        left = packed.filter("open")
        before, count = count, left.select("sequence_id").distinct().count()
        if groups == 1 or count > 0.98 * before:
            rounds.append(left)
            break
        waiting, stage = left, stage + 1
    result = waiting if not rounds else rounds[0]
    for more in rounds[1:]:
        result = result.unionByName(more)
    return result.drop("open")


def pack_documents(
    documents: DataFrame, path: str, scratch: Scratch, capacity: int = CAPACITY
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Needs doc_id and text. A null text counts as empty, which is one separator. Only documents
    longer than ``capacity`` are cut; of those only the last piece may be short.
    """
    return pack(token_pieces(documents, path, capacity), scratch, capacity)
