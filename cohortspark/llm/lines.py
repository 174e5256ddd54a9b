"""Repeated lines across documents, found in sharded minimal perfect hash tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.session import releasing
from cohortspark.sources.scratch import Scratch

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_LINES = 200_000  # lines, repeats included, that one shard's table is made for on average
TASK_PROBES = 100_000  # lookups of one task
_SPACE = " \t\n\v\f\r"
_GAMMA = 2  # cells per key in every level of a table


def line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """128-bit hash of every line's key (stripped, A-Z in lower case); None for short keys."""
    keys: list[bytes | None] = []
    for line in text.split("\n"):
        line = line.strip(_SPACE)
        short = len(line) < min_chars
        keys.append(None if short else xxhash.xxh3_128_digest(line.encode().lower()))
    return keys


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of every value."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalHash:
    """A minimal perfect hash of distinct 64-bit keys.

    Level by level, keys that are alone in their cell of a bit array get that cell; the others
    go to the next level. A key's index is the number of cells taken before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.taken = [np.cumsum(level, dtype=np.int64) for level in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalHash:
        levels: list[np.ndarray] = []
        while len(keys):
            size = max(64, _GAMMA * len(keys))
            cell = (_mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            level = np.bincount(cell, minlength=size) == 1
            levels.append(level)
            keys = keys[~level[cell]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key; for keys of other sets any index, or -1."""
        found = np.full(len(keys), -1, np.int64)
        waiting, base = np.arange(len(keys)), 0
        for seed, (level, taken) in enumerate(zip(self.levels, self.taken)):
            cell = (_mixed(keys[waiting], seed) % np.uint64(len(level))).astype(np.int64)
            hit = level[cell]
            found[waiting[hit]] = base + taken[cell[hit]] - 1
            waiting, base = waiting[~hit], base + int(taken[-1])
        return found

    def to_bytes(self) -> bytes:
        sizes = np.asarray([len(self.levels), *map(len, self.levels)], np.int64).tobytes()
        return sizes + b"".join(np.packbits(level).tobytes() for level in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> MinimalHash:
        count = int(np.frombuffer(data, np.int64, 1)[0])
        at, levels = 8 * (count + 1), []
        for size in np.frombuffer(data, np.int64, count, 8).tolist():
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += -(-size // 8)
        return cls(levels)


def _long_lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """doc_id and the two halves of the hash of each distinct long line of every document."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            rows, keys = [], []
            for i, text in enumerate(batch.column("text")):
                distinct = set(line_keys(text.as_py() or "", min_chars))
                distinct.discard(None)
                rows.extend([i] * len(distinct))
                keys.extend(distinct)
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                ],
                ["doc_id", "key", "print"],
            )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(hashes, f"doc_id {kind}, key long, print long")


def _unsigned(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().view(np.uint64)


def _build_shard(key: tuple, table: pa.Table) -> pa.Table:
    """One row: the table of a shard's distinct lines and its arrays in the table's order."""
    # Keys are 64 bits; of lines that share one (about none in 10**10), the print tells.
    keys = _unsigned(table, "key")
    _, first = np.unique(keys, return_index=True)
    extra = np.setdiff1d(np.arange(len(keys)), first)
    made = MinimalHash.build(keys[first])
    order = np.empty(len(first), np.int64)
    order[made.index(keys[first])] = first
    rows = table.take(pa.array(np.concatenate((order, extra))))

    def whole(name: str) -> pa.Array:
        values = rows.column(name).combine_chunks()
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    lookups = int(np.sum(table.column("n_docs").to_numpy()))
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int64()),
            "lookups": pa.array([lookups], pa.int64()),
            "cells": pa.array([made.to_bytes()], pa.binary()),
            "keys": whole("key"),
            "prints": whole("print"),
            "n_docs": whole("n_docs"),
            "keepers": whole("keeper"),
        }
    )


def _prober(min_docs: int):
    def probe(lines: pa.Table, shard: pa.Table) -> pa.Table:
        """The lines of documents that are to go."""
        if not lines.num_rows or not shard.num_rows:
            return lines.select(["doc_id", "key", "print"]).slice(0, 0)
        row = {c: shard.column(c)[0] for c in ("cells", "keys", "prints", "n_docs", "keepers")}
        prints = row["prints"].values.to_numpy()
        counts = row["n_docs"].values.to_numpy()
        made = MinimalHash.from_bytes(row["cells"].as_py())
        at = made.index(_unsigned(lines, "key"))
        odd = prints[at] != lines.column("print").to_numpy()
        if odd.any():
            keys = row["keys"].values.to_numpy()
            place = {k: i for i, k in enumerate(zip(keys.tolist(), prints.tolist()))}
            wanted = zip(
                lines.column("key").to_numpy()[odd].tolist(),
                lines.column("print").to_numpy()[odd].tolist(),
            )
            at[odd] = [place[k] for k in wanted]
        keeper = row["keepers"].values.take(pa.array(at))
        own = lines.column("doc_id").combine_chunks()
        stays = pc.fill_null(pc.equal(keeper, own), False).to_numpy(False)
        # Without any doc_id there is no document to keep the line for: it stays.
        stays |= keeper.is_null().to_numpy(False)
        going = (counts[at] >= min_docs) & ~stays
        return lines.select(["doc_id", "key", "print"]).filter(pa.array(going))

    return probe


def repeated_lines(
    documents: DataFrame,
    scratch: Scratch,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """doc_id, key and print of every line that its document loses."""
    lines = scratch.save("lines", _long_lines(documents, min_chars))
    shards = max(1, -(-lines.count() // SHARD_LINES))
    kind = lines.schema["doc_id"].dataType.simpleString()
    in_shard = F.pmod("key", F.lit(shards)).alias("shard")
    counts = lines.groupBy("key", "print").agg(
        F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")
    )
    tables = scratch.save(
        "tables",
        counts.groupBy(in_shard).applyInArrow(
            _build_shard,
            "shard long, lookups long, cells binary, keys array<long>, prints array<long>, "
            f"n_docs array<long>, keepers array<{kind}>",
        ),
    )
    # A line that a third of all documents share makes its shard's lookups many: those are
    # split by document over as many copies of the shard's table as it takes.
    copies = F.ceil(F.col("lookups") / TASK_PROBES).alias("copies")
    probes = lines.withColumn("shard", in_shard).join(tables.select("shard", copies), "shard")
    probes = probes.withColumn("copy", F.pmod(F.xxhash64("doc_id", "print"), "copies"))
    copied = tables.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return (
        probes.select("doc_id", "key", "print", "shard", "copy")
        .groupBy("shard", "copy")
        .cogroup(copied.drop("lookups").groupBy("shard", "copy"))
        .applyInArrow(_prober(min_docs), f"doc_id {kind}, key long, print long")
    )


def drop_repeated_lines(
    documents: DataFrame,
    scratch: Scratch,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    report: bool = False,
) -> DataFrame:
    """Documents without the long lines that at least ``min_docs`` documents share.

    The largest doc_id with such a line keeps all its copies of it. Distinct line hashes are
    dealt to shards; each makes a minimal perfect hash over its lines with arrays of
    fingerprints, counts and keepers, and documents' lines look themselves up in these arrays.

    All columns stay, ``text`` without the lines, ``n_chars`` (if there is one) its new length.
    ``report`` returns doc_id, n_lines (before), n_dropped and text instead, null text as empty.
    A null or empty text is one empty line. doc_id identifies documents: rows that repeat one
    share its decisions, and each counts as a document; a row without doc_id is never the one
    to keep a line, unless no document that has it has a doc_id.
    """
    gone = repeated_lines(documents, scratch, min_chars, min_docs)
    names, number = documents.columns, 0
    while (taken := f"gone_{number}") in {n.lower() for n in names}:
        number += 1
    per_doc = gone.groupBy(F.col("doc_id").alias(f"{taken}_id")).agg(
        F.collect_list(F.struct("key", "print")).alias(taken)
    )
    rows = documents.select("doc_id", "text") if report else documents
    joined = rows.join(
        per_doc, rows["doc_id"].eqNullSafe(per_doc[f"{taken}_id"]), "left"
    ).drop(f"{taken}_id")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            texts = batch.column("text").to_pylist()
            n_lines = [1 + t.count("\n") if t else 1 for t in texts]
            n_dropped = [0] * len(texts)
            for i, some in enumerate(batch.column(taken)):
                if not some.is_valid:
                    continue
                values = some.values
                halves = np.stack(
                    [values.field("key").to_numpy(), values.field("print").to_numpy()], 1
                ).tobytes()
                going = {halves[j : j + 16] for j in range(0, len(halves), 16)}
                text = texts[i] or ""
                kept = [
                    line
                    for line, key in zip(text.split("\n"), line_keys(text, min_chars))
                    if key not in going
                ]
                n_dropped[i] = n_lines[i] - len(kept)
                texts[i] = "\n".join(kept)
            if report:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(n_lines, pa.int64()),
                        pa.array(n_dropped, pa.int64()),
                        pa.array([t or "" for t in texts], pa.string()),
                    ],
                    ["doc_id", "n_lines", "n_dropped", "text"],
                )
                continue
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                lengths = [n if not d else len(t) for n, d, t in zip(
                    columns["n_chars"].to_pylist(), n_dropped, texts)]
                columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
            del columns[taken]
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = rows.schema["doc_id"].dataType.simpleString()
    if report:
        return joined.mapInArrow(
            clean, f"doc_id {kind}, n_lines long, n_dropped long, text string"
        )
    return joined.mapInArrow(clean, documents.schema)
