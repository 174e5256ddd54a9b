"""Scoring texts by context-tree weighting over bytes, beside a unigram model of words."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortspark.sources.scratch import Scratch

DEPTH = 4  # bytes of context
END = 0xFF  # ends every text and stands before it; no byte of UTF-8
CHUNK_BYTES = 10 << 20  # of text that looks up its words and contexts together
SLICE_BYTES = 1 << 20  # of text whose contexts are counted or looked up at once
TASK_GRAMS = 150_000  # contexts with a following byte that one task of the model gets
_TOP = 2  # levels from here down are built in tasks, those above from their sums
_LN2 = math.log(2)


def held_out(doc_id) -> bool:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 of 5."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


# ------------------------------------------------------------------ contexts of texts


def context_keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text and its end: the ``depth`` bytes before, the nearest in the
    highest place, and the byte itself in the lowest; and the number of keys of every text."""
    pad, end = bytes([END]) * depth, bytes([END])
    data = np.frombuffer(b"".join([x for t in texts for x in (pad, t, end)]), np.uint8)
    keys = np.zeros(max(0, len(data) - depth), np.uint64)
    for back in range(1, depth + 1):
        keys <<= np.uint64(8)
        keys |= data[depth - back : len(data) - back]
    keys <<= np.uint64(8)
    keys |= data[depth:]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    # Places of the padding ahead of every text but the first, which lies outside the keys.
    own = np.ones(len(keys), bool)
    ahead = np.cumsum(lengths + depth)[:-1] - depth
    for back in range(depth):
        own[ahead + back] = False
    return keys[own], lengths


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in lists of about ``SLICE_BYTES``, so that their keys stay in the cache."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_BYTES:
            yield texts[start : at + 1]
            start, size = at + 1, 0
    if start < len(texts):
        yield texts[start:]


def _distinct_keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct context keys of texts, and how often each occurs."""
    found, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for some in _slices(texts):
        keys, n = np.unique(context_keys(some, depth)[0], return_counts=True)
        found.append(keys)
        counts.append(n)
    every, n = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))[: len(every)]
    return every[starts], np.add.reduceat(n, starts) if len(starts) else n


def _lower_words(text: bytes) -> list[bytes]:
    return text.lower().split()


# ------------------------------------------------------------------ the model


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        shift += np.log(y)
        y += 1
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with so many zeros and ones (Krichevsky-Trofimov)."""
    return (
        _log_gamma(zeros + 0.5)
        + _log_gamma(ones + 0.5)
        - math.log(math.pi)
        - _log_gamma(zeros + ones + 1.0)
    )


class Level:
    """Binary nodes of one depth: context << 8 | place in the tree of a byte's bits."""

    def __init__(self, ids, zeros, ones, below):
        self.ids, self.zeros, self.ones = ids, zeros, ones
        self.total = zeros + ones
        own = log_kt(zeros, ones)
        if below is None:
            self.log_weighted, self.stop = own, np.ones(len(ids))
        else:
            self.log_weighted = np.logaddexp(own, below) - _LN2
            self.stop = np.exp(own - _LN2 - self.log_weighted)
        self.one = (ones + 0.5) / (self.total + 1)

    def above(self) -> tuple[Level, np.ndarray]:
        """The level of contexts shorter by their farthest byte, and each node's place there."""
        shorter = (self.ids >> np.uint64(16) << np.uint64(8)) | (self.ids & np.uint64(255))
        ids, at = np.unique(shorter, return_inverse=True)
        zeros, ones, below = (
            np.bincount(at, weights=x, minlength=len(ids))
            for x in (self.zeros, self.ones, self.log_weighted)
        )
        return Level(ids, zeros, ones, below), at


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node id at full depth and bit, for the eight decisions of every key's last byte."""
    byte, context = keys & np.uint64(255), keys >> np.uint64(8)
    ids = np.empty((len(keys), 8), np.uint64)
    bits = np.empty((len(keys), 8), bool)
    for j in range(8):
        node = (byte >> np.uint64(8 - j)) | np.uint64(1 << j)
        ids[:, j] = (context << np.uint64(8)) | node
        bits[:, j] = (byte >> np.uint64(7 - j)) & np.uint64(1)
    return ids, bits


def lower_levels(keys: np.ndarray, counts: np.ndarray, depth: int):
    """Levels from ``depth`` up to the top ones, the places of nodes in the level above, and
    where the decisions of every key are at full depth."""
    ids, bits = _bits(keys)
    nodes, at = np.unique(ids.ravel(), return_inverse=True)
    weights = np.repeat(counts.astype(float), 8)
    ones = np.bincount(at, weights=weights * bits.ravel(), minlength=len(nodes))
    zeros = np.bincount(at, weights=weights, minlength=len(nodes)) - ones
    levels, up = [Level(nodes, zeros, ones, None)], []
    for _ in range(depth - _TOP):
        level, places = levels[-1].above()
        levels.append(level)
        up.append(places)
    return levels, up, at.reshape(-1, 8), bits


class TopLevels:
    """Contexts of one byte and none, from sums over the levels below."""

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        order = np.argsort(ids)
        first = Level(ids[order].astype(np.uint64), zeros[order], ones[order], below[order])
        none, _ = first.above()
        self.tables = []
        for level, size in ((first, 1 << 16), (none, 1 << 8)):
            stop, one, total = np.full(size, 0.5), np.full(size, 0.5), np.zeros(size)
            at = level.ids.astype(np.int64)
            stop[at], one[at], total[at] = level.stop, level.one, level.total
            self.tables.append((stop, one, total))

    def mix(self, ids: np.ndarray, ahead: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Probability of a one from that of the level below and whether it was seen there."""
        shorter = (ids >> np.uint64(16) << np.uint64(8)) | (ids & np.uint64(255))
        for (stop, one, total), at in zip(self.tables, (shorter, ids & np.uint64(255))):
            at = at.astype(np.int64)
            share = np.where(seen, stop[at], 1.0)
            ahead = share * one[at] + (1 - share) * ahead
            seen = total[at] > 0
        return ahead


def gram_scores(keys: np.ndarray, counts: np.ndarray, depth: int, top: TopLevels) -> np.ndarray:
    """log10 probability of every key's byte after its context.

    From the deepest context up, a node's own estimate and what comes from below are mixed by
    the weight that training left with the node; unseen contexts leave it to the shorter ones.
    """
    levels, up, at, bits = lower_levels(keys, counts, depth)
    ahead, seen, place = levels[0].one, levels[0].total > 0, np.arange(len(levels[0].ids))
    for level, places in zip(levels[1:], up):
        place = places[place]
        share = np.where(seen, level.stop[place], 1.0)
        ahead = share * level.one[place] + (1 - share) * ahead
        seen = level.total[place] > 0
    ahead = top.mix(levels[-1].ids[place], ahead, seen)[at]
    return np.log10(np.where(bits, ahead, 1 - ahead)).sum(1)


# ------------------------------------------------------------------ on Spark


def _chunks(documents: DataFrame) -> DataFrame:
    """One row for some megabytes of documents: chunk, doc_ids, sizes, compressed texts."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            whole = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                    pa.array([zstandard.compress(b"".join(texts))], pa.binary()),
                ],
                ["chunk", "doc_ids", "sizes", "data"],
            )

        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            start = 0
            for i, text in enumerate(column):
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    ids.append(batch.column("doc_id").slice(start, i + 1 - start))
                    yield row()
                    number, ids, texts, size, start = number + 1, [], [], 0, i + 1
            if start < batch.num_rows:
                ids.append(batch.column("doc_id").slice(start))
        if texts:
            yield row()

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(
        gather, f"chunk long, doc_ids array<{kind}>, sizes array<int>, data binary"
    )


def _texts(sizes: list[int], data: bytes) -> list[bytes]:
    whole, at, texts = zstandard.decompress(data), 0, []
    for size in sizes:
        texts.append(whole[at : at + size])
        at += size
    return texts


def _chunk_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, list, list[bytes]]]:
    for i in range(batch.num_rows):
        sizes, data = batch.column("sizes")[i].as_py(), batch.column("data")[i].as_py()
        yield (
            batch.column("chunk")[i].as_py(),
            batch.column("doc_ids")[i].as_py(),
            _texts(sizes, data),
        )


def _word_counts(chunks: DataFrame) -> DataFrame:
    """chunk, word and how often its documents for training have it (0: only others do)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, texts in _chunk_rows(batch):
                seen: Counter[bytes] = Counter()
                others: set[bytes] = set()
                for doc_id, text in zip(ids, texts):
                    (others if held_out(doc_id) else seen).update(_lower_words(text))
                others.difference_update(seen)
                words = [*seen, *others]
                n = [*seen.values(), *[0] * len(others)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(words), chunk, np.int64)),
                        pa.array(words, pa.binary()),
                        pa.array(n, pa.int64()),
                    ],
                    ["chunk", "word", "n"],
                )

    return chunks.mapInArrow(count, "chunk long, word binary, n long")


def _gram_counts(chunks: DataFrame, depth: int) -> DataFrame:
    """chunk, gram (context and byte) and its count in documents for training, or 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, texts in _chunk_rows(batch):
                parts: dict[bool, list[bytes]] = {False: [], True: []}
                for doc_id, text in zip(ids, texts):
                    parts[held_out(doc_id)].append(text)
                grams, n = _distinct_keys(parts[False], depth)
                others, _ = _distinct_keys(parts[True], depth)
                others = np.setdiff1d(others, grams, assume_unique=True)
                every = np.concatenate((grams, others))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(every), chunk, np.int64)),
                        pa.array(every.astype(np.int64)),
                        pa.array(np.concatenate((n, np.zeros(len(others), np.int64)))),
                    ],
                    ["chunk", "gram", "n"],
                )

    return chunks.mapInArrow(count, "chunk long, gram long, n long")


def _train(grams: DataFrame, depth: int) -> DataFrame:
    """gram and the log10 probability of its byte, for every gram of the corpus."""
    count = grams.count()
    tasks = max(1, -(-count // TASK_GRAMS))
    # A task has whole subtrees under contexts of two bytes.
    subtree = F.shiftright("gram", 8 * (depth + 1 - _TOP))
    dealt = grams.groupBy(F.pmod(F.xxhash64(subtree), F.lit(tasks)).alias("task"))

    def sums(table: pa.Table) -> pa.Table:
        keys = table.column("gram").to_numpy().view(np.uint64)
        level = lower_levels(keys, table.column("n").to_numpy(), depth)[0][-1]
        shorter = (level.ids >> np.uint64(16) << np.uint64(8)) | (level.ids & np.uint64(255))
        ids, at = np.unique(shorter, return_inverse=True)
        columns = {"id": ids.astype(np.int64)}
        for name, x in (("a", level.zeros), ("b", level.ones), ("w", level.log_weighted)):
            columns[name] = np.bincount(at, weights=x, minlength=len(ids))
        return pa.table(columns)

    # At most 2 ** 16 rows: one-byte contexts with the inner nodes of a byte.
    rows = (
        dealt.applyInArrow(sums, "id long, a double, b double, w double")
        .groupBy("id")
        .agg(F.sum("a"), F.sum("b"), F.sum("w"))
        .collect()
    )
    top = TopLevels(*(np.asarray([r[i] for r in rows], float if i else np.int64) for i in range(4)))

    def scores(table: pa.Table) -> pa.Table:
        keys = table.column("gram").to_numpy().view(np.uint64)
        values = gram_scores(keys, table.column("n").to_numpy(), depth, top)
        return pa.table({"gram": table.column("gram"), "value": values})

    return dealt.applyInArrow(scores, "gram long, value double")


def _scorer(depth: int, ends: int, kind: pa.DataType):
    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        ids = chunk.column("doc_ids")[0].values
        texts = _texts(chunk.column("sizes")[0].as_py(), chunk.column("data")[0].as_py())
        of_grams = answers.filter(answers.column("gram").is_valid())
        of_words = answers.filter(answers.column("word").is_valid())
        grams = of_grams.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(grams)
        grams, values = grams[order], of_grams.column("value").to_numpy()[order]
        counts = of_words.column("value").to_numpy()
        logs = np.log10(np.abs(counts) + 0.5)
        word_log = dict(zip(of_words.column("word").to_pylist(), logs.tolist()))
        n_tokens, n_known, base = [], [], []
        for text in texts:
            words = _lower_words(text)
            each = np.fromiter(map(word_log.__getitem__, words), float, len(words))
            n_tokens.append(len(words) + 1)
            n_known.append(int((each > 0).sum()) + (ends > 0))  # log10(0.5) < 0 < log10(1.5)
            base.append(float(each.sum()) + math.log10(ends + 0.5))
        model = [np.empty(0)]
        for some in _slices(texts):
            keys, lengths = context_keys(some, depth)
            found = values[np.searchsorted(grams, keys)]
            model.append(np.add.reduceat(found, np.cumsum(lengths) - lengths))
        out = [held_out(x) for x in ids.to_pylist()]
        own = np.zeros(len(texts), np.int64)
        own[0] = np.count_nonzero(counts < 0)
        columns = [ids, out, n_tokens, n_known, own, base, np.concatenate(model)]
        return pa.table(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
            schema=schema,
        )

    schema = pa.schema(
        [
            ("doc_id", kind),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("own", pa.int64()),
            ("logs", pa.float64()),
            ("score", pa.float64()),
        ]
    )
    return score


def score_documents(documents: DataFrame, scratch: Scratch, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    Every text is read as bytes with an end. Each byte is eight binary decisions, each with a
    tree of contexts of up to ``depth`` bytes, whose nodes mix Krichevsky-Trofimov estimates of
    all depths by context-tree weighting. Documents are gathered in chunks of some megabytes; a
    chunk sends its distinct contexts and words with their counts, these are added up over the
    corpus, the model is built from whole subtrees in parallel, and every chunk gets back
    exactly what its documents look up. Nothing that grows with the corpus is broadcast.

    ``score`` is the model's log10 probability of the text, ``base_score`` that of a unigram
    model of lower-case words and one end. Needs doc_id and text; null texts count as empty. A
    null doc_id trains. Repeated rows are scored, and train, one by one.
    """
    chunks = scratch.save("chunks", _chunks(documents))
    per_chunk = scratch.save("grams", _gram_counts(chunks, depth))
    counted = scratch.save("model", per_chunk.groupBy("gram").agg(F.sum("n").alias("n")))
    scored = scratch.save("scored", _train(counted, depth))

    # The count of a word over the corpus, negative in the one chunk that counts it as distinct.
    by_word = Window.partitionBy("word")
    total, home = F.sum("n").over(by_word), F.min("chunk").over(by_word)
    value = F.when(F.col("chunk") == home, -total).otherwise(total).cast("double")
    none = F.lit(None)
    answers = (
        per_chunk.select("chunk", "gram")
        .join(scored, "gram")
        .select("chunk", none.cast("binary").alias("word"), "gram", "value")
        .unionByName(
            _word_counts(chunks).select(
                "chunk", "word", none.cast("long").alias("gram"), value.alias("value")
            )
        )
    )
    trains = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) != 1
    ends = documents.filter(trains).count()
    field = documents.select("doc_id").schema["doc_id"]
    parts = scratch.save(
        "parts",
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _scorer(depth, ends, to_arrow_type(field.dataType)),
            f"doc_id {field.dataType.simpleString()}, held_out boolean, n_tokens long, "
            "n_known long, own long, logs double, score double",
        ),
    )
    row = parts.agg(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.sum("own")).first()
    tokens, distinct = row[0] or 0, (row[1] or 0) + (ends > 0)
    below = math.log10(tokens + 0.5 * (distinct + 1))
    return parts.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * below).alias("base_score"),
        "score",
    )
