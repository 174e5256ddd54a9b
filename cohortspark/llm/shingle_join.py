"""Jaccard join of documents by their word shingles, with signature trees."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.components import components
from cohortspark.llm.session import hold_alone, releasing
from cohortspark.sources.scratch import Scratch

WORDS = 5  # of a shingle, unless the caller says otherwise
PERCENT = 80  # least similarity, in hundredths
BLOCK_SHINGLES = 3_000_000  # of a block of documents that are compared in one task
LEAF = 32  # documents of a leaf
FAN = 8  # children of an inner node
_COLUMNS = 4096  # tokens of two leaves that are looked at at once
_KNOWN_WORDS = 200_000  # hashes of words that a worker remembers
_SIGNATURE_BYTES = 32 << 20  # of a task's bitmaps, unless 256 bits a set take more


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of fewer words, of all of them."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total + each[i : i + len(total)])
    return np.unique(total)


def size_classes(percent: int, largest: int) -> np.ndarray:
    """Least sizes of classes such that linked sets are in the same class or in neighbours."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(100 * bounds[-1] // percent + 1)
    return np.asarray(bounds, np.int64)


def part_keys(tokens: np.ndarray, percent: int, bounds: np.ndarray) -> np.ndarray:
    """Keys of which two linked sets have at least one in common.

    Sets of classes k and k+1 that are linked differ in at most d tokens, d known from k. Tokens
    are dealt to d + 1 parts by hash, so at least one part is the same in both; its key is the
    hash of its tokens. Some more parts are made (four deviations above the number of empty ones
    to be expected), and as many empty ones left out, because what is empty says nothing.
    """
    if not len(tokens):
        return np.empty(0, np.int64)
    own = int(np.searchsorted(bounds, len(tokens), "right")) - 1
    keys = []
    for k in {own, max(own - 1, 0)}:
        differing = (100 - percent) * (int(bounds[k + 1]) - 1) // percent
        parts = differing + 1
        empty = parts * math.exp(-int(bounds[k]) / parts)
        spare = int(empty + 4 * math.sqrt(empty)) + 1 if differing else 0
        parts += spare
        part = (tokens >> np.uint64(16)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        number = part[order]
        starts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        sums = np.add.reduceat(_mixed(tokens[order]), starts)
        number = number[starts]
        if parts - len(number) > spare:
            missing = np.setdiff1d(np.arange(parts, dtype=np.uint64), number)
            number = np.concatenate((number, missing))
            sums = np.concatenate((sums, np.zeros(len(missing), np.uint64)))
        keys.append(_mixed(sums + _mixed(number + np.uint64((k + 1) << 32))))
    return np.concatenate(keys).view(np.int64)


class _Tree:
    """Signature tree over sets: OR and AND bitmaps and the range of sizes of every node."""

    def __init__(self, members: np.ndarray, signatures: np.ndarray, sizes: np.ndarray):
        self.members = members[np.lexsort((signatures[members, 0], sizes[members]))]
        spans = [(i, min(i + LEAF, len(members))) for i in range(0, len(members), LEAF)]
        self.levels = [[(*s, None) for s in spans]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(
                [
                    (below[i][0], below[min(i + FAN, len(below)) - 1][1], (i, i + FAN))
                    for i in range(0, len(below), FAN)
                ]
            )
        self.info = []
        for number, level in enumerate(self.levels):
            if number == 0:
                leaves = (self.members[i:j] for i, j, _ in level)
                self.info.append([self._bounds(signatures[m], sizes[m]) for m in leaves])
            else:
                self.info.append([self._joint(number - 1, below) for _, _, below in level])

    @staticmethod
    def _bounds(signatures: np.ndarray, sizes: np.ndarray) -> tuple:
        every, common = np.bitwise_or.reduce(signatures), np.bitwise_and.reduce(signatures)
        return every, common, int(sizes.min()), int(sizes.max())

    def _joint(self, level: int, children: tuple[int, int]) -> tuple:
        every, common, low, high = zip(*self.info[level][slice(*children)])
        return np.bitwise_or.reduce(every), np.bitwise_and.reduce(common), min(low), max(high)

    def children(self, level: int, node: int) -> range:
        first, last = self.levels[level][node][2]
        return range(first, min(last, len(self.levels[level - 1])))

    def at(self, level: int, node: int) -> np.ndarray:
        i, j, _ = self.levels[level][node]
        return self.members[i:j]


class SignatureJoin:
    """Links between sets, as a forest that connects the same sets.

    Trees are traversed in pairs of nodes. A pair is left out when sizes or bitmaps show that no
    two members can overlap enough (a bit that all sets of one node have and no set of the other
    is a token that differs). What remains is compared set by set, first by bitmaps, then exactly.

    With ``copies``, how many documents each set stands for, every link is found, and
    ``counts`` has for each set the documents behind the sets it is linked with. Without, links
    inside what is connected already are not sought.
    """

    def __init__(self, sets: list[np.ndarray], percent: int, copies: np.ndarray | None = None):
        self.sets, self.percent, self.copies = sets, percent, copies
        self.counts = np.zeros(len(sets), np.int64)
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        bits = 1 << int(np.clip(8 * self.sizes.max(initial=1) - 1, 255, 65535)).bit_length()
        # Shorter bitmaps only leave more pairs to the exact comparison.
        while bits > 256 and bits // 8 * len(sets) > _SIGNATURE_BYTES:
            bits //= 2
        self.signatures = np.zeros((len(sets), bits // 64), np.uint64)
        for row, tokens in zip(self.signatures, sets):
            bit = tokens & np.uint64(bits - 1)
            np.bitwise_or.at(row, bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63)))
        # An eighth as long: enough to tell most pairs apart.
        self.short = self.signatures
        if bits >= 1024:
            self.short = np.bitwise_or.reduce(self.signatures.reshape(len(sets), 8, -1), axis=1)
        self.ones = {
            id(x): np.bitwise_count(x).sum(-1, dtype=np.int64)
            for x in (self.signatures, self.short)
        }
        self.label = np.arange(len(sets))
        self.links: list[tuple[int, int]] = []

    def _possible(self, a: np.ndarray, b: np.ndarray, signatures: np.ndarray) -> np.ndarray:
        """Whether sizes, and the bits that only one side has, allow enough overlap."""
        p, size_a, size_b = self.percent, self.sizes[a], self.sizes[b]
        both = np.bitwise_count(signatures[a] & signatures[b]).sum(-1, dtype=np.int64)
        ones = self.ones[id(signatures)]
        only_a, only_b = ones[a] - both, ones[b] - both
        return (100 * (size_a - only_a) >= p * (size_b + only_a)) & (
            100 * (size_b - only_b) >= p * (size_a + only_b)
        )

    def _apart(self, a: tuple, b: tuple) -> bool:
        only_a = int(np.bitwise_count(a[1] & ~b[0]).sum())
        only_b = int(np.bitwise_count(b[1] & ~a[0]).sum())
        p = self.percent
        return 100 * (a[3] - only_a) < p * (b[2] + only_a) or 100 * (b[3] - only_b) < p * (
            a[2] + only_b
        )

    def _shared(self, x: int, y: int) -> int:
        return len(np.intersect1d(self.sets[x], self.sets[y], assume_unique=True))

    def _common(self, x_of: np.ndarray, y_of: np.ndarray) -> np.ndarray:
        """Number of tokens that both sets of every pair have."""
        left, i = np.unique(x_of, return_inverse=True)
        right, j = np.unique(y_of, return_inverse=True)
        members = np.concatenate((left, right))
        if len(x_of) <= len(members):
            pairs = zip(x_of.tolist(), y_of.tolist())
            return np.fromiter((self._shared(x, y) for x, y in pairs), np.int64, len(x_of))
        # Many pairs of few sets: products of 0/1 matrices, some thousand tokens at a time.
        tokens = np.concatenate([self.sets[k] for k in members.tolist()])
        owner = np.repeat(np.arange(len(members)), self.sizes[members])
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        column = np.cumsum(np.concatenate(([False], tokens[1:] != tokens[:-1])))
        both = np.zeros((len(left), len(right)), np.int64)
        edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + _COLUMNS, _COLUMNS))
        for number, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            has = np.zeros((len(members), column[b - 1] + 1 - number * _COLUMNS), np.float32)
            has[owner[a:b], column[a:b] - number * _COLUMNS] = 1
            both += (has[: len(left)] @ has[len(left) :].T).astype(np.int64)
        return both[i, j]

    def _compare(self, left: np.ndarray, right: np.ndarray, same: bool) -> None:
        maybe = self._possible(left[:, None], right[None, :], self.short)
        if same:
            maybe = np.triu(maybe, 1)
        i, j = np.nonzero(maybe)
        x_of, y_of = left[i], right[j]
        maybe = self._possible(x_of, y_of, self.signatures)
        x_of, y_of = x_of[maybe], y_of[maybe]
        if self.copies is not None and len(x_of):
            common = self._common(x_of, y_of)
            union = self.sizes[x_of] + self.sizes[y_of] - common
            linked = 100 * common >= self.percent * union
            x_of, y_of = x_of[linked], y_of[linked]
            np.add.at(self.counts, x_of, self.copies[y_of])
            np.add.at(self.counts, y_of, self.copies[x_of])
        for x, y in zip(x_of.tolist(), y_of.tolist()):
            if self.label[x] == self.label[y]:
                continue
            if self.copies is None:
                both = len(self.sets[x]) + len(self.sets[y])
                common = self._shared(x, y)
                if 100 * common < self.percent * (both - common):
                    continue
            self.links.append((x, y))
            self.label[self.label == self.label[y]] = self.label[x]

    def _descend(self, s: _Tree, t: _Tree, ls: int, a: int, lt: int, b: int) -> None:
        left, right = s.at(ls, a), t.at(lt, b)
        same = s is t and ls == lt and a == b
        label = self.label[left[0]]
        if self.copies is None and (self.label[left] == label).all():
            if (self.label[right] == label).all() and (len(left) > 1 or not same):
                return
        if not same and self._apart(s.info[ls][a], t.info[lt][b]):
            return
        if ls == 0 and lt == 0:
            self._compare(left, right, same)
        elif same:
            inner = list(s.children(ls, a))
            for c in inner:
                self._descend(s, s, ls - 1, c, ls - 1, c)
            for i, c in enumerate(inner):
                for d in inner[i + 1 :]:
                    self._descend(s, s, ls - 1, c, ls - 1, d)
        elif ls >= lt:
            for c in s.children(ls, a):
                self._descend(s, t, ls - 1, c, lt, b)
        else:
            for d in t.children(lt, b):
                self._descend(s, t, ls, a, lt - 1, d)

    def run(self, left: np.ndarray, right: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that connect ``left``, or ``left`` with ``right``."""
        s = _Tree(left, self.signatures, self.sizes)
        t = s if right is None else _Tree(right, self.signatures, self.sizes)
        self._descend(s, t, len(s.levels) - 1, 0, len(t.levels) - 1, 0)
        return self.links


def _described(documents: DataFrame, schema: str, describe) -> DataFrame:
    """Rows made of the texts of every batch by ``describe``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone("word hashes", _HASHES.clear)
        for batch in releasing(batches):
            texts = (text.as_py() or "" for text in batch.column("text"))
            yield describe(batch.column("doc_id"), texts)
        _HASHES.clear()

    rows = documents.select("doc_id", "text").filter("doc_id IS NOT NULL")
    return rows.mapInArrow(run, schema)


def document_sets(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles and a 128-bit digest of the set (d1, d2)."""

    def describe(doc_ids: pa.Array, texts: Iterator[str]) -> pa.RecordBatch:
        counts, digests = [], []
        for text in texts:
            tokens = shingle_set(text, words)
            counts.append(len(tokens))
            digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        columns = [doc_ids, pa.array(counts, pa.int64()), *map(pa.array, halves.T.copy())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "d1", "d2"])

    return _described(documents, "doc_id long, n_shingles long, d1 long, d2 long", describe)


def document_keys(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id and key, a row for every part key of every document."""
    bounds = size_classes(percent, 2**31)

    def describe(doc_ids: pa.Array, texts: Iterator[str]) -> pa.RecordBatch:
        keys = [part_keys(shingle_set(text, words), percent, bounds) for text in texts]
        rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat = np.concatenate([np.empty(0, np.int64), *keys])
        columns = [doc_ids.take(pa.array(rows, pa.int64())), pa.array(flat)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "key"])

    return _described(documents, "doc_id long, key long", describe)


def _block_joiner(words: int, percent: int, count: bool):
    def join(table: pa.Table) -> pa.Table:
        """Links that connect (n null) and, if asked for, numbers of links (b null) of one task:
        inside its clusters, or between two blocks of one cluster."""
        hold_alone("word hashes", _HASHES.clear)
        names = ("doc_id", "cluster", "block", "copies")
        columns = [table.column(c).to_numpy() for c in names]
        order = np.lexsort((columns[0], columns[1]))
        docs, cluster, block, copies = (c[order] for c in columns)
        texts = table.column("text")  # stay where they are: sorted, they would be there twice
        rows: list[tuple[int, int | None, int | None]] = []
        starts = np.flatnonzero(np.concatenate(([True], cluster[1:] != cluster[:-1])))
        for i, j in zip(starts, [*starts[1:], len(docs)]):
            sets: list[np.ndarray] = []
            own: list[int] = []
            for k in range(i, j):
                tokens = shingle_set(texts[order[k]].as_py() or "", words)
                if own and docs[own[-1]] == docs[k] and np.array_equal(sets[-1], tokens):
                    continue  # a repeated row is the same document
                sets.append(tokens)
                own.append(k)
            at, blocks = np.arange(len(own)), block[own]
            pieces = [at[blocks == b] for b in np.unique(blocks)]
            work = SignatureJoin(sets, percent, copies[own] if count else None)
            of = docs[own].tolist()
            rows += [(of[x], of[y], None) for x, y in work.run(*pieces)]
            rows += [(of[x], None, int(work.counts[x])) for x in np.flatnonzero(work.counts)]
        _HASHES.clear()
        columns = zip(*rows) if rows else ([], [], [])
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip("abn", columns)})

    return join


def jaccard_components(
    documents: DataFrame,
    scratch: Scratch,
    words: int = WORDS,
    percent: int = PERCENT,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document with a doc_id.

    For components links that connect are enough: what is connected already is not compared.
    ``jaccard_links`` counts all links.
    """
    joined = _joined(documents, scratch, words, percent, block_shingles, False)
    return joined.select("doc_id", "n_shingles", "component_id")


def jaccard_links(
    documents: DataFrame,
    scratch: Scratch,
    words: int = WORDS,
    percent: int = PERCENT,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """doc_id, n_shingles, n_links (other documents it is linked with) and component_id.

    Every pair of distinct sets that may be linked is compared, each in one task. Tasks return a
    number of links per set, never the pairs; equal sets count as often as there are documents.
    """
    return _joined(documents, scratch, words, percent, block_shingles, True)


def _joined(
    documents: DataFrame,
    scratch: Scratch,
    words: int,
    percent: int,
    block_shingles: int,
    count: bool,
) -> DataFrame:
    """doc_id, n_shingles, n_links (only with ``count``) and component_id.

    Linked are documents whose sets of shingles have 100 * intersection >= percent * union.

    1. Every set yields part keys, of which linked sets share at least one (``part_keys``).
       Documents with a key in common are joined to the smallest of them: candidate clusters.
       (Keys are made in a second pass over the texts; stored, they would be the largest table.)
    2. Equal sets are represented by the smallest doc_id.
    3. Clusters are joined by signature trees, several small ones to a task; a cluster of more
       than ``block_shingles`` is cut into blocks in order of size, and each pair of blocks
       with sizes that can be linked is a task of its own.
    4. The links found connect the documents.

    doc_id must be a long; rows that repeat a doc_id count as one document if their texts are
    equal. Null and empty texts and those without words have no shingles and no links.
    """
    sets = scratch.save("sets", document_sets(documents, words))
    together = Window.partitionBy("key")
    shared = (
        document_keys(documents, words, percent)
        .withColumns({"a": F.min("doc_id").over(together), "n": F.count("*").over(together)})
        .filter("n > 1 AND a <> doc_id")
    )
    stars = shared.select("a", F.col("doc_id").alias("b")).distinct()
    clusters = components(stars, scratch, "candidates").withColumnRenamed("component", "cluster")

    equal = Window.partitionBy("cluster", "d1", "d2")
    members = sets.select("doc_id", "n_shingles", "d1", "d2").join(
        clusters.withColumnRenamed("id", "doc_id"), "doc_id"
    )
    members = scratch.save(
        "members",
        members.distinct().withColumns(
            {"first": F.min("doc_id").over(equal), "copies": F.count("*").over(equal)}
        ),
    )
    copies = members.filter("first <> doc_id").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")
    )
    in_order = Window.partitionBy("cluster").orderBy("n_shingles", "doc_id")
    placed = scratch.save(
        "placed",
        members.filter("first = doc_id")
        .select("doc_id", "cluster", "n_shingles", "copies")
        .distinct()
        .withColumn("n_docs", F.count("*").over(Window.partitionBy("cluster")))
        .filter("n_docs > 1")
        .withColumn("before", F.sum("n_shingles").over(in_order) - F.col("n_shingles"))
        .withColumn("block", F.floor(F.col("before") / block_shingles))
        .withColumn("last", F.max("block").over(Window.partitionBy("cluster"))),
    )
    total = placed.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    bins = max(1, -(-total // (block_shingles // 8)))
    # Small clusters share tasks by hash; large ones have a task per pair of blocks.
    small = placed.filter("last = 0").select(
        "doc_id", "copies", "cluster", "block", F.pmod(F.xxhash64("cluster"), F.lit(bins)).alias("task"),
        F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"),
    )
    large = placed.filter("last > 0")
    ranges = large.groupBy("cluster", "block").agg(
        F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high")
    )
    lower = ranges.select("cluster", F.col("block").alias("i"), F.col("high").alias("high_i"))
    upper = ranges.select("cluster", F.col("block").alias("j"), F.col("low").alias("low_j"))
    tasks = lower.join(upper, "cluster").filter(f"i <= j AND 100 * high_i >= {percent} * low_j")
    either = F.explode(F.array_distinct(F.array("i", "j")))
    tasks = tasks.select("cluster", "i", "j", either.alias("block"))
    paired = large.join(tasks, ["cluster", "block"]).select(
        "doc_id", "copies", "cluster", "block", F.col("cluster").alias("task"), "i", "j"
    )
    dealt = small.unionByName(paired)
    texts = documents.select("doc_id", "text")
    links = scratch.save(
        "links",
        dealt.join(texts, "doc_id")
        .select("doc_id", "copies", "cluster", "block", "task", "i", "j", "text")
        .groupBy("task", "i", "j")
        .applyInArrow(_block_joiner(words, percent, count), "a long, b long, n long"),
    )
    edges = links.filter("b IS NOT NULL").select("a", "b")
    found = components(edges.unionByName(copies), scratch, "found")
    rows = sets.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    columns = ["doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")]
    if count:
        # Over all tasks that had the set, and its copies.
        others = links.filter("n IS NOT NULL").groupBy(F.col("a").alias("first")).agg(
            F.sum("n").alias("n")
        )
        numbers = members.join(others, "first", "left").select(
            "doc_id", "d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links")
        )
        rows = rows.join(numbers, ["doc_id", "d1", "d2"], "left")
        columns.insert(2, F.coalesce("links", F.lit(0)).alias("n_links"))
    return rows.select(*columns)


def keep_one_of_each(
    documents: DataFrame, scratch: Scratch, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of each component's smallest doc_id, all columns; rows without doc_id stay."""
    found = jaccard_components(documents, scratch, words, percent)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti")
