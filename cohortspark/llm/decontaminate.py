"""Benchmark passages inside documents, by a prefix-filtered set join."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.session import releasing
from cohortspark.sources.scratch import Scratch

WINDOW = 10  # words of a window
SHINGLE = 3  # words of a shingle; the rarest one of a window finds its candidates
PART_BYTES = 1 << 20  # of text that is cut into words at a time
MAX_BITS = 1 << 27  # of the filter that tasks hold, 16 MB however large the benchmark is
_BITS_PER_KEY = 16
# Fixed value: what stands between words, after A-Z became lower case.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_IN_WORD = np.array([re.match(_GAP, chr(c)) is None or c > 127 for c in range(256)])
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@dataclass
class Stretch:
    """Words of some texts in a row, or of one part of a long text."""

    data: np.ndarray  # the texts' bytes
    starts: np.ndarray  # of every word in the bytes
    ends: np.ndarray
    bounds: np.ndarray  # text i has words bounds[i] up to bounds[i + 1]
    first_row: int  # of the texts in their batch
    place: int = 0  # of the first word in its text
    own: tuple[int, int] = (0, 0)  # words whose shingles belong here; the rest is margin
    final: bool = True  # whether the texts end here

    @classmethod
    def cut(cls, data: np.ndarray, offsets: np.ndarray, first_row: int) -> Stretch:
        """Text i is ``data[offsets[i]:offsets[i + 1]]``."""
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _IN_WORD[data]
        borders = np.zeros(len(data) + 1, bool)
        borders[offsets] = True
        begins = inside[1:] & (~inside[:-1] | borders)
        stops = inside[:-1] & (~inside[1:] | borders)
        starts = np.flatnonzero(begins)
        bounds = np.searchsorted(starts, offsets)
        return cls(
            data, starts, np.flatnonzero(stops), bounds, first_row, own=(0, len(starts))
        )

    def hashes(self) -> np.ndarray:
        """64 bits of every word: a polynomial of its bytes, from running sums."""
        size = max(PART_BYTES, len(self.data)) + 1
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * _powers(_ODD, size)[: len(self.data)], out=sums[1:])
        return _mixed((sums[self.ends] - sums[self.starts]) * _powers(_INVERSE, size)[self.starts])

    def shingles(self, sizes: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, own words at which as many words of one text start, and the shingles' hashes."""
        each = self.hashes()
        text_end = np.repeat(self.bounds[1:], np.diff(self.bounds))
        for size in sizes:
            starts = max(0, len(each) - size + 1)
            total = np.full(starts, np.uint64(size))
            for k in range(size):
                total = _mixed(total * np.uint64(_ODD) + each[k : k + starts])
            at = np.arange(starts)
            at = at[(at + size <= text_end[:starts]) & (at >= self.own[0]) & (at < self.own[1])]
            yield size, at, total[at].view(np.int64)

    def text(self, first: int, stop: int) -> str:
        """Words ``first`` up to ``stop`` with what is between them."""
        return self.data[self.starts[first] : self.ends[stop - 1]].tobytes().decode()


def _parts(data: np.ndarray, row: int, window: int) -> Iterator[Stretch]:
    """The words of a long text. Parts overlap by less than two windows."""
    begin, end, place, done = 0, 0, 0, 0
    while end < len(data):
        end = min(end + PART_BYTES, len(data))
        while end < len(data) and _IN_WORD[data[end]]:
            gap = np.flatnonzero(~_IN_WORD[data[end : end + PART_BYTES]])
            end = end + int(gap[0]) if len(gap) else min(end + PART_BYTES, len(data))
        part = Stretch.cut(data[begin:end], np.asarray([0, end - begin]), row)
        part.place, part.final = place, end == len(data)
        words = len(part.starts)
        stop = words if part.final else max(done - place, words - window + 1)
        part.own = (done - place, stop)
        yield part
        done = place + stop
        margin = max(0, stop - window)
        if margin < words:
            begin += int(part.starts[margin])
        else:
            begin = end
        place += margin


def _stretches(texts: pa.Array, window: int) -> Iterator[Stretch]:
    """All words of a batch."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    data = np.frombuffer(lowered.buffers()[2] or b"", np.uint8)
    kind = np.int64 if pa.types.is_large_string(lowered.type) else np.int32
    offsets = np.frombuffer(lowered.buffers()[1], kind)[lowered.offset :][: len(lowered) + 1]
    row = 0
    while row < len(lowered):
        stop = int(np.searchsorted(offsets, int(offsets[row]) + PART_BYTES, "right")) - 1
        if stop <= row:
            yield from _parts(data[offsets[row] : offsets[row + 1]], row, window)
            row += 1
            continue
        group = offsets[row : stop + 1].astype(np.int64)
        yield Stretch.cut(data[group[0] : group[-1]], group - group[0], row)
        row = stop


class Membership:
    """A Bloom filter of 64-bit hashes: never denies one that is there."""

    def __init__(self, cells: np.ndarray):
        self.cells, self.bits = cells, 64 * len(cells)

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> Membership:
        """The bits are set by Spark; the driver gets at most ``MAX_BITS``, 64 a row."""
        bits = 1024
        while bits < min(MAX_BITS, _BITS_PER_KEY * keys.count()):
            bits *= 2
        key, last = F.col(column), F.lit(bits - 1)
        places = F.array(key.bitwiseAND(last), F.shiftrightunsigned(key, 32).bitwiseAND(last))
        rows = keys.select(F.explode(places).alias("bit")).groupBy(
            F.shiftright("bit", 6).cast("int").alias("cell")
        )
        set_bits = rows.agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("set"))
        table = set_bits.toArrow()
        cells = np.zeros(bits // 64, np.int64)
        cells[table.column("cell").to_numpy()] = table.column("set").to_numpy()
        return cls(cells)

    def has(self, keys: np.ndarray) -> np.ndarray:
        keys, found = keys.view(np.uint64), True
        for hashed in (keys, keys >> np.uint64(32)):
            bit = (hashed & np.uint64(self.bits - 1)).astype(np.int64)
            found = found & ((self.cells[bit >> 6] >> (bit & 63)) & 1 == 1)
        return found


def _sizes(window: int) -> range:
    return range(1, min(SHINGLE, window) + 1)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, window (its words joined by spaces), length and the hashes of all its shingles.
    An item of fewer words than a window, but some, is one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            rows, windows, lengths, hashes = [], [], [], []
            # Texts one by one: what a benchmark's text yields is many times its size.
            for row, text in enumerate(batch.column("text")):
                data = pc.ascii_lower(pa.scalar(text.as_py() or "")).as_py().encode()
                whole = Stretch.cut(np.frombuffer(data, np.uint8), np.asarray([0, len(data)]), 0)
                n = len(whole.starts)
                if not n:
                    continue
                length = min(window, n)
                ((size, _, keys),) = whole.shingles([min(SHINGLE, length)])
                words = [whole.text(i, i + 1) for i in range(n)]
                for at in range(n - length + 1):
                    rows.append(row)
                    windows.append(" ".join(words[at : at + length]))
                    lengths.append(length)
                    hashes.append(keys[at : at + length - size + 1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(pa.array(rows, pa.int64())),
                    pa.array(windows, pa.string()),
                    pa.array(lengths, pa.int32()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["item", "window", "length", "shingles"],
            )

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(cut, "item string, window string, length int, shingles array<long>")


def _shingle_counts(documents: DataFrame, known: Membership, window: int) -> DataFrame:
    """shingle and n, its places in all documents; about 2 % of the others come along."""
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            for stretch in _stretches(batch.column("text"), window):
                for _, _, keys in stretch.shingles(_sizes(window)):
                    some, n = np.unique(keys[shared.value.has(keys)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some), pa.array(n)], ["shingle", "n"]
                    )

    counts = documents.select("text").mapInArrow(tally, "shingle long, n long")
    return counts.groupBy("shingle").agg(F.sum("n").alias("n"))


def _candidates(documents: DataFrame, known: Membership, window: int) -> DataFrame:
    """A row per document (row, doc_id, n_words), and one with place, shingle and the words
    around, from place ``first`` on, wherever a document has a shingle of the filter."""
    shared = documents.sparkSession.sparkContext.broadcast(known)
    names = ["row", "doc_id", "n_words", "place", "shingle", "first", "context"]
    kind = documents.schema["doc_id"].dataType.simpleString()

    def around(stretch: Stretch, size: int, at: np.ndarray, keys: np.ndarray):
        """The text of each found place, and columns place, shingle, first and context."""
        found = shared.value.has(keys)
        at, keys = at[found], keys[found]
        text = np.searchsorted(stretch.bounds, at, "right") - 1
        low = np.maximum(stretch.bounds[text], at - (window - size))
        high = np.minimum(stretch.bounds[text + 1], at + window)
        base = stretch.place - stretch.bounds[text]
        context = [stretch.text(a, b) for a, b in zip(low.tolist(), high.tolist())]
        columns = [at + base, keys, low + base, pa.array(context, pa.string())]
        return stretch.first_row + text, [pa.array(c) for c in columns]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 40)
        for batch in releasing(batches):
            n = batch.num_rows
            row = np.asarray([next(numbers) for _ in range(n)], np.int64)
            n_words = np.zeros(n, np.int64)
            for stretch in _stretches(batch.column("text"), window):
                if stretch.final:
                    own = slice(stretch.first_row, stretch.first_row + len(stretch.bounds) - 1)
                    n_words[own] = stretch.place + np.diff(stretch.bounds)
                for size, at, keys in stretch.shingles(_sizes(window)):
                    rows, found = around(stretch, size, at, keys)
                    if len(rows):
                        ids = batch.column("doc_id").take(pa.array(rows))
                        fixed = [pa.array(row[rows]), ids, pa.nulls(len(rows), pa.int64())]
                        yield pa.RecordBatch.from_arrays([*fixed, *found], names)
            fixed = [pa.array(row), batch.column("doc_id"), pa.array(n_words)]
            empty = [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.string())]
            yield pa.RecordBatch.from_arrays([*fixed, *empty], names)

    return documents.select("doc_id", "text").mapInArrow(
        find,
        f"row long, doc_id {kind}, n_words long, place long, shingle long, first long, "
        "context string",
    )


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW
) -> DataFrame:
    """doc_id, n_words, spans and items of every document.

    Words are runs of digits, letters and all that is beyond ASCII, A-Z in lower case. An item's
    windows are its runs of ``window`` words; an item of fewer words, but some, is one window. A
    window must stand whole, so its prefix is one shingle (``SHINGLE`` consecutive words): the
    one that all documents together hold least often. Documents join on that shingle alone; a
    window whose rarest shingle is nowhere joins nothing. Candidates are bounded by position
    (the window has to begin and end inside the text) and verified word by word.

    ``spans`` are the stretches of words inside any window, as sorted structs (first, last) that
    do not touch; ``items`` the sorted ids, as text, of items with a window in the document.

    Two passes read the documents: shingle counts, then candidates. Tasks hold a filter of at
    most 16 MB, whatever the size of the benchmark; it only lets a few rows too many through.
    Only rows about candidates are shuffled. Texts beyond ``PART_CHARS`` characters are cut part
    by part.

    Needs doc_id and text, and item_id and text. Null or empty texts have no words. Every row is
    a document of its own, also one without doc_id or with that of another. Rows that share an
    item_id are one item; the windows of rows without one hit words and name no item.
    """
    windows = scratch.save("windows", item_windows(benchmark, window))
    distinct = windows.select("window", "length", "shingles").dropDuplicates(["window"])
    places = distinct.select("window", "length", F.posexplode("shingles").alias("offset", "shingle"))
    known = Membership.of(places.select("shingle").distinct(), "shingle")
    counts = _shingle_counts(documents, known, window)
    rarest = F.min(F.struct("n", "shingle", "offset", "length")).alias("rarest")
    seen = places.join(counts, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    prefix = scratch.save(
        "prefix",
        seen.groupBy("window")
        .agg(rarest)
        .filter("rarest.n > 0")
        .select("window", "rarest.shingle", "rarest.offset", "rarest.length"),
    )
    rare = Membership.of(prefix.select("shingle").distinct(), "shingle")
    found = scratch.save("found", _candidates(documents, rare, window))
    start = F.col("place") - F.col("offset")
    skipped = (start - F.col("first")).cast("int")
    hits = (
        found.filter("place IS NOT NULL")
        .join(prefix, "shingle")
        .withColumn("context", F.split("context", _GAP))
        .filter((skipped >= 0) & (skipped + F.col("length") <= F.size("context")))
        .filter(
            F.array_join(F.slice("context", skipped + 1, F.col("length")), " ") == F.col("window")
        )
    )
    hits = scratch.save(
        "hits",
        hits.select(
            "row", "window", start.alias("first"), (start + F.col("length") - 1).alias("last")
        ),
    )
    earlier = Window.partitionBy("row").orderBy("first", "last")
    before = F.max("last").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") > F.coalesce(before, F.lit(-2)) + 1, 1).otherwise(0)
    spans = (
        hits.groupBy("row", "first")
        .agg(F.max("last").alias("last"))
        .withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(earlier))
        .groupBy("row", "span")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))
    )
    named = windows.filter("item IS NOT NULL").select("window", "item").distinct()
    items = (
        hits.select("row", "window")
        .distinct()
        .join(named, "window")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    every = found.filter("place IS NULL").select("row", "doc_id", "n_words")
    return (
        every.join(spans, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.expr("coalesce(spans, array())").alias("spans"),
            F.expr("coalesce(items, array())").alias("items"),
        )
    )
