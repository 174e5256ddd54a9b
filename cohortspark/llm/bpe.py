"""Byte-level BPE over whole corpora: merges are replayed on distinct pieces, not on texts."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cohortspark.llm.session import hold_alone, releasing

# Letters, digits and white space up to U+017F, as Unicode has them. Texts beyond
# take the general pattern.
_L = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085 "
_BEYOND = re.compile("[^\u0000-ſ]")
_PIECES = re.compile(
    f" ?[{_L}]+| ?[{_N}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_WORDS = re.compile(f"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[{_N}]|[^{_S}{_L}{_N}]+|\n")
_LOWER_APART = re.compile("[^\u0000-\u001b -įı-ſ]")  # texts with others go to the library
_SPREAD = re.compile(f"[{_S}][{_S}]|\\A[{_S}]|[{_S}]\\Z|[\t\v\f\r\u0085\u00a0]")

BATCH_BYTES = 8 << 20  # of text whose distinct pieces are replayed together
CACHE_PIECES = 300_000  # pieces that each of a Python worker's caches remembers at most
GATHERED = 1 << 20  # runs of ids copied at a time
_NONE = np.int32(2**31 - 1)


class Merges:
    """Merges by rank, replayed over a list of words at once.

    An inverted index leads from each rank (a pair of tokens) to the places where the pair
    stands. Ranks are taken in order; every merge touches the pairs to its left and right, and
    only those are looked up again and enter the index under their new ranks.
    """

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], first, last):
        keys = np.fromiter(((a << 20) | b for a, b in pairs), np.int64, len(pairs))
        ranks = np.fromiter((r for r, _ in pairs.values()), np.int32, len(pairs))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        self.merged = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, np.int32)
        for rank, token in pairs.values():
            self.merged[rank] = token
        self.pairs = pairs
        self.first, self.last = np.asarray(first, np.int32), np.asarray(last, np.int32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << 20) | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def _alone(self, word: bytes) -> list[int]:
        """One word by the definition: the leftmost pair of least rank, again and again."""
        tokens = [int(self.first[b]) for b in word[:-1]] + [int(self.last[word[-1]])]
        while len(tokens) > 1:
            rank, at, token = min(
                (*self.pairs.get(p, (_NONE, 0))[:1], i, self.pairs.get(p, (0, 0))[1])
                for i, p in enumerate(zip(tokens, tokens[1:]))
            )
            if rank == _NONE:
                break
            tokens[at : at + 2] = [token]
        return tokens

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Token ids (32 bits each) of every word; no word may be empty."""
        if not words:
            return []
        ids, counts = self.replay_flat(words)
        packed, bounds = ids.tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
        return [packed[i:j] for i, j in zip(bounds, bounds[1:])]

    def replay_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after the other, and their number in every word. There has
        to be a word, and none may be empty."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        letters = np.frombuffer(b"".join(words), np.uint8)
        n = len(letters)
        token = self.first[letters]
        token[ends - 1] = self.last[letters[ends - 1]]
        after = np.arange(1, n + 1, dtype=np.int32)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[ends[:-1]] = -1
        rank = np.full(n, _NONE, np.int32)
        alive = np.ones(n, bool)
        odd: set[int] = set()

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(places: np.ndarray) -> None:
            found = rank[places]
            order = np.argsort(found, kind="stable")
            order = order[: np.searchsorted(found[order], _NONE)]
            if not len(order):
                return
            places, found = places[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for i, j in zip(starts, [*starts[1:], len(places)]):
                r, group = int(found[i]), places[i:j]
                if r in index:
                    index[r].append(group)
                else:
                    index[r] = [group]
                    heapq.heappush(heap, r)

        inner = np.flatnonzero(after >= 0).astype(np.int32)
        rank[inner] = self._rank(token[inner], token[inner + 1])
        enter(inner)
        while heap:
            r = heapq.heappop(heap)
            groups = index.pop(r)
            places = groups[0] if len(groups) == 1 else np.concatenate(groups)
            places = np.sort(places[rank[places] == r])
            if not len(places):
                continue
            if (again := places[1:] == places[:-1]).any():
                places = places[np.concatenate(([True], ~again))]
            right = after[places]
            if len(places) > 1 and (chained := right[:-1] == places[1:]).any():
                # Of overlapping pairs every second one is taken, from the left.
                at = np.arange(len(places))
                start = np.concatenate(([True], ~chained))
                run = np.maximum.accumulate(np.where(start, at, 0))
                even = (at - run) % 2 == 0
                places, right = places[even], right[even]
            token[places] = self.merged[r]
            alive[right] = False
            rank[right] = _NONE
            beyond = after[right]
            after[places] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = places[inside]
            rank[places] = _NONE
            touched = places[inside]
            left = before[places]
            left = left[left >= 0]
            touched = np.concatenate((touched, left))
            if len(touched):
                rank[touched] = self._rank(token[touched], token[after[touched]])
                if (lower := rank[touched] < r).any():
                    # A merge that makes a pair of lower rank: order inside the word matters.
                    odd.update(np.searchsorted(ends, touched[lower], "right").tolist())
                enter(touched)

        bounds = np.cumsum(alive)[ends - 1]
        ids, counts = token[alive], np.diff(bounds, prepend=0)
        if odd:
            parts, done = [], 0
            for w in sorted(odd):
                alone = np.asarray(self._alone(words[w]), np.int32)
                parts += [ids[done : bounds[w] - counts[w]], alone]
                done, counts[w] = bounds[w], len(alone)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, counts


class _Cache:
    """Bytes of the ids of pieces, remembered within a bound: the older half is dropped."""

    def __init__(self, times: int = 1) -> None:
        self.times = times
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def holding(self, wanted: set[str], make) -> dict[str, bytes]:
        """A dictionary with all of ``wanted``; ``make`` gives the bytes of a list of others."""
        if len(self.recent) > self.times * CACHE_PIECES // 2:
            self.recent, self.older = {}, self.recent
        new = wanted.difference(self.recent)
        for known in new.intersection(self.older):
            self.recent[known] = self.older[known]
        new = list(new.difference(self.older))
        self.recent.update(zip(new, make(new)))
        return self.recent


class ByteCodec:
    """Text to ids and back by the ranks of a ``.tiktoken`` file."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pairs = {}
        for whole, rank in ranks.items():
            for i in range(1, len(whole)):
                a, b = ranks.get(whole[:i]), ranks.get(whole[i:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank, rank)
        single = [ranks[bytes([b])] for b in range(256)]
        self.merges = Merges(pairs, single, single)
        self.bytes_of = {rank: whole for whole, rank in ranks.items()}
        self.general = regex.compile(pattern)
        self.line_end = np.int32(single[10]).tobytes()
        self.pieces, self.first, self.spaced = _Cache(), _Cache(), _Cache(2)

    def split(self, text: str) -> list[str]:
        return (self.general if _BEYOND.search(text) else _PIECES).findall(text)

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Bytes of the ids of every text, through its distinct pieces."""
        split = [self.split(t) for t in texts]
        known = self.pieces.holding(
            set().union(*split),
            lambda new: self.merges.replay([p.encode() for p in new]),
        )
        return [b"".join(map(known.__getitem__, s)) for s in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text.

        Where all white space is single spaces and line ends inside the text, no piece reaches
        across them but for the space ahead, and the parts between them are remembered.
        """
        plain = [bool(t) and not _SPREAD.search(t) for t in texts]
        lines = [[x.split(" ") for x in t.split("\n")] for t, p in zip(texts, plain) if p]
        first = self.first.holding({x[0] for t in lines for x in t}, self._by_pieces)
        spaced = self.spaced.holding(
            set().union(*(x[1:] for t in lines for x in t)),
            lambda new: self._by_pieces([" " + x for x in new]),
        )
        others = iter(self._by_pieces([t for t, p in zip(texts, plain) if not p]))
        done = iter(
            self.line_end.join(
                first[x[0]] + b"".join(map(spaced.__getitem__, x[1:])) for x in t
            )
            for t in lines
        )
        return [np.frombuffer(next(done if p else others), np.int32) for p in plain]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class WordCodec:
    """Ids as the ``tokenizers`` library gives them for a lower-casing BPE with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        model, vocabulary = plan["model"], plan["model"]["vocab"]
        end = model["end_of_word_suffix"]
        self.special = [t["content"] for t in plan["added_tokens"]]
        pairs = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault((vocabulary[a], vocabulary[b]), (rank, vocabulary[a + b]))
        shown = _byte_letters()
        self.merges = Merges(
            pairs, [vocabulary[c] for c in shown], [vocabulary[c + end] for c in shown]
        )
        self._forget()

    def _forget(self) -> None:
        self.rows: defaultdict[str, int] = defaultdict(count().__next__)  # in order of entry
        self.ids, self.starts = np.empty(0, np.int32), np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def _by_library(self, text: str) -> bool:
        return bool(_LOWER_APART.search(text)) or (
            "<|" in text and any(s in text for s in self.special)
        )

    def _learn(self, words: list[str]) -> None:
        """Add the ids of words, which hold no white space, behind those that are known.

        They are cut into pieces in one go, a line each, and the distinct pieces are replayed.
        """
        pieces: defaultdict[str, int] = defaultdict(count().__next__)
        line_end = pieces["\n"]
        cut = _WORDS.findall("\n".join(words) + "\n")
        at = np.fromiter(map(pieces.__getitem__, cut), np.int32, len(cut))
        ids, counts = self.merges.replay_flat(list(map(str.encode, pieces)))
        starts = np.cumsum(counts) - counts
        counts[line_end] = 0
        ends = np.cumsum(counts[at])[at == line_end]
        self.counts = np.concatenate((self.counts, np.diff(ends, prepend=0)))
        self.starts = np.concatenate((self.starts, len(self.ids) + ends - np.diff(ends, prepend=0)))
        self.ids = np.concatenate((self.ids, _gathered(ids, starts[at], counts[at])))

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.rows) > CACHE_PIECES:
            self._forget()
        known = len(self.rows)
        rows = [np.empty(0, np.int32)]
        try:
            for text in texts:
                words = text.lower().split()
                rows.append(np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words)))
            if len(self.rows) > known:
                self._learn(list(islice(self.rows, known, None)))
        except BaseException:
            self._forget()  # The worker may go on with words that have no ids yet.
            raise
        ends = np.cumsum([len(r) for r in rows[1:]], dtype=np.int64)
        of = np.concatenate(rows)
        counts = self.counts[of]
        ids = _gathered(self.ids, self.starts[of], counts)
        ends = np.concatenate(([0], np.cumsum(counts)))[ends].tolist()
        return [ids[i:j] for i, j in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without special tokens around it.

        No piece reaches across white space, so what stands between it is remembered. (The
        separators that only Python takes for white space also go to the library.) Texts are
        split once, into numbers of words: the words themselves take ten times the texts' memory.
        """
        slow = [self._by_library(t) for t in texts]
        others = iter(self._by_words([t for t, s in zip(texts, slow) if not s]))
        return [
            np.asarray(self.library.encode(t, add_special_tokens=False).ids, np.int32)
            if s
            else next(others)
            for t, s in zip(texts, slow)
        ]


def _gathered(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of values that start there and are so long, one after the other."""
    parts = []
    for i in range(0, len(starts), GATHERED):
        start, n = starts[i : i + GATHERED], counts[i : i + GATHERED]
        ends = np.cumsum(n)
        places = np.repeat(start - (ends - n), n)
        places += np.arange(len(places))
        parts.append(values[places])
    return np.concatenate(parts) if parts else values[:0]


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_byte_codec = lru_cache(maxsize=2)(ByteCodec)
_word_codec = lru_cache(maxsize=2)(WordCodec)


def byte_codec(path: str, pattern: str) -> ByteCodec:
    hold_alone("byte codec", _byte_codec.cache_clear)
    return _byte_codec(path, pattern)


def word_codec(path: str) -> WordCodec:
    hold_alone("word codec", _word_codec.cache_clear)
    return _word_codec(path)


def small_batches(
    batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES
) -> Iterator[tuple[pa.Array, list[str]]]:
    """doc_ids and texts (null: empty) in slices of about ``most`` bytes, or one longer text."""
    for batch in releasing(batches):
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(False)
        cut, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield _slice(batch, cut, i)
                cut, total = i, 0
            total += size
        if cut < batch.num_rows:
            yield _slice(batch, cut, batch.num_rows)


def _slice(batch: pa.RecordBatch, start: int, stop: int) -> tuple[pa.Array, list[str]]:
    part = batch.slice(start, stop - start)
    return part.column("doc_id"), [t or "" for t in part.column("text").to_pylist()]


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every text.

    Each task replays the merges over the distinct pieces of some megabytes of its texts at a
    time, so nothing is shuffled and memory is bounded whatever the corpus. Needs doc_id and
    text; a null text counts as empty and has no ids. Repeated rows are encoded one by one.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_codec(path, pattern)
        for doc_ids, texts in small_batches(batches):
            ids = pa.array(codec.encode(texts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "ids"])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that the ids stand for. Null ids give null bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_codec(path, pattern)
        for batch in batches:
            whole = [i if i is None else codec.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(whole, pa.binary())], ["doc_id", "bytes"]
            )

    rows = encoded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"doc_id {kind}, bytes binary")


def round_trip_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids again, and return the digests of both.

    One pass: ids go from the encoder to the decoder within the task.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_codec(path, pattern)
        for doc_ids, texts in small_batches(batches):
            counts, encoded, decoded = [], [], []
            for ids in codec.encode(texts):
                ids = ids.tolist()
                counts.append(len(ids))
                encoded.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(digests, schema)
