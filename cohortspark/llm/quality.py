"""Quality rules: text statistics, fixed rules, and an isolation forest over the statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortspark.llm.session import releasing
from cohortspark.sources.scratch import Scratch

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
TREES, TREE_ROWS = 100, 256
SAMPLE_ROWS = 8192  # labelled good documents the forest is grown from
MARGIN = 0.5  # standard deviations over all documents
MAX_GOOD_REJECTED = 0.002  # share of labelled good documents that the threshold may reject
DEFAULT_THRESHOLD = 0.60  # without labelled rows
BINS = 2000  # of scores, when the threshold is chosen
_SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\v\f\r"
_UPPER = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_KEPT = {**{c: "long" for c in COUNTS}, "n_upper": "long", "n_marks": "long"}


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a window of five words found at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        window = window * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
        window ^= window >> np.uint64(29)
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    ends = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(ends, at, 1)
    np.add.at(ends, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(ends)[:-1]))


def text_counts(text: str) -> tuple[int, ...]:
    """The values of ``_KEPT`` of one text."""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACE)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(data) - len(data.translate(None, _UPPER)),
        text.count("!") + text.count("?"),
    )


def _batch_counts(batch: pa.RecordBatch) -> np.ndarray:
    values = [text_counts(t.as_py() or "") for t in batch.column("text")]
    return np.asarray(values, np.int64).reshape(-1, len(_KEPT))


def features(counts: np.ndarray) -> np.ndarray:
    """Rates of a text that do not depend on its length, on scales that spread small rates."""
    words, chars, symbols, _, repeats, upper, marks = counts.T.astype(float)
    words, chars = np.maximum(words, 1), np.maximum(chars, 1)
    rates = [symbols / words, repeats / words, upper / chars, marks / words]
    return np.stack([*map(np.sqrt, rates), np.log(chars / words)], axis=1)


def feature_spread(counts: DataFrame) -> np.ndarray:
    """Standard deviation of every one of the ``features`` over all rows."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    rates = (("n_symbols", words), ("n_repeat_words", words), ("n_upper", chars), ("n_marks", words))
    columns = [F.sqrt(F.col(c) / per) for c, per in rates] + [F.log(chars / words)]
    row = counts.agg(*[F.stddev_pop(c) for c in columns]).first()
    # Sums of doubles depend on the order of tasks; the forest should not.
    return np.asarray([float(f"{x or 0.0:.9g}") for x in row])


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeats = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def _mean_path(n: int) -> float:
    """Mean depth at which a search among n rows ends without success."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Isolation trees as arrays: a node's feature, split, left child (right is next), path."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float

    @classmethod
    def grow(
        cls, rows: np.ndarray, margin: np.ndarray, seed: int = 7, drawn: list | None = None
    ) -> Forest:
        """Trees over random ``rows``, or each over rows ``drawn`` for it. A split falls anywhere between ``margin`` below a node's
        smallest value and as far above its largest, so that values the rows do not have at
        all (symbols, where good text has none) are set apart by empty nodes."""
        rng = np.random.default_rng(seed)
        size = min(TREE_ROWS, len(rows)) if drawn is None else max(map(len, drawn), default=0)
        limit = max(1, math.ceil(math.log2(max(2, size))))
        trees = []
        for tree in range(TREES):
            nodes: list[list[float]] = [[0, 0.0, -1, 0.0]]
            stack = []
            if drawn is not None:
                stack = [(0, drawn[tree], 0)]
            elif size:
                stack = [(0, rows[rng.choice(len(rows), size, replace=False)], 0)]
            while stack:
                at, part, depth = stack.pop()
                if depth >= limit or not len(part):
                    nodes[at][3] = depth + _mean_path(len(part))
                    continue
                f = int(rng.integers(part.shape[1]))
                low, high = part[:, f].min() - margin[f], part[:, f].max() + margin[f]
                split = float(rng.uniform(low, high))
                below = part[:, f] < split
                nodes[at][:3] = [f, split, len(nodes)]
                stack += [
                    (len(nodes), part[below], depth + 1),
                    (len(nodes) + 1, part[~below], depth + 1),
                ]
                nodes += [[0, 0.0, -1, depth + 1.0], [0, 0.0, -1, depth + 1.0]]
            trees.append(np.asarray(nodes))
        most = max(map(len, trees))
        flat = np.stack([np.pad(t, ((0, most - len(t)), (0, 0))) for t in trees])
        return cls(
            flat[..., 0].astype(np.int32),
            flat[..., 1],
            flat[..., 2].astype(np.int32),
            flat[..., 3],
            _mean_path(size) or 1.0,
        )

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """From near 0 (like most) to 1 (apart at once): 2 ** -(mean path / usual path)."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, left, path in zip(self.feature, self.split, self.left, self.path):
            node = np.zeros(len(rows), np.int32)
            while True:
                inner = left[node] > 0
                if not inner.any():
                    break
                right = rows[every, feature[node]] >= split[node]
                node = np.where(inner, left[node] + right, node)
            total += path[node]
        return 2.0 ** -(total / TREES / self.norm)


@dataclass
class QualityModel:
    forest: Forest
    threshold: float

    def rejects(self, counts: np.ndarray) -> np.ndarray:
        return base_failed(counts) | (self.forest.scores(features(counts)) > self.threshold)


def document_counts(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text; null counts as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            columns = [pa.array(c) for c in _batch_counts(batch).T]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *_KEPT])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{c} {t}" for c, t in _KEPT.items())
    return rows.mapInArrow(count, f"doc_id {kind}, {columns}")


def _scored(counts: DataFrame, forest: Forest) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            values = np.stack([batch.column(c).to_numpy() for c in _KEPT], 1)
            columns = [*batch.columns, pa.array(forest.scores(features(values)))]
            columns.append(pa.array(base_failed(values)))
            names = [*batch.schema.names, "anomaly", "base_failed"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema)
    return counts.mapInArrow(score, f"{kinds}, anomaly double, base_failed boolean")


def fit_quality(counts: DataFrame, labels: DataFrame | None, scratch: Scratch) -> QualityModel:
    """Grow the forest and choose the threshold.

    The forest grows from at most ``SAMPLE_ROWS`` documents, those of smallest hash among the
    ones labelled good that pass the fixed rules. Without such labels, each tree draws its rows
    by hash from all documents that pass the fixed rules, in one pass for all trees. How
    far splits may fall outside a node's values follows from all documents, also those that fail
    the fixed rules: what only one of them has still gets a margin.
    The threshold is the score above which most labelled bad documents lie while at most
    ``MAX_GOOD_REJECTED`` of all labelled good ones do; it is read from a histogram of every
    labelled row.
    """
    known = counts.limit(0).withColumn("quality", F.lit(0))
    if labels is not None:
        marks = labels.select("doc_id", "quality").filter("quality IS NOT NULL").distinct()
        known = scratch.save("labelled", counts.join(marks, "doc_id"))

    def sample(rows: DataFrame) -> np.ndarray:
        # By hash about twice the rows wanted, so that what tasks send stays as bounded.
        order, total = F.xxhash64("doc_id", *_KEPT), rows.count()
        share = 2 * (SAMPLE_ROWS + 100) / max(1, total)
        some = rows.filter(F.pmod(order, F.lit(1 << 30)) <= int(share * (1 << 30)))
        few = some.orderBy(order, *_KEPT).limit(SAMPLE_ROWS).select(*_KEPT)
        found = np.asarray([tuple(r) for r in few.collect()], np.int64).reshape(-1, len(_KEPT))
        return features(found[~base_failed(found)])

    def draw() -> list[np.ndarray]:
        passing = counts.filter(
            f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words"
        )
        # Somewhat more than a tree takes; the smallest hashes of each are its rows.
        share = min(1.0, 1.5 * (TREE_ROWS + 30) / max(1, passing.count()))
        most = int(share * (1 << 30))
        hashes = F.transform(
            F.sequence(F.lit(0), F.lit(TREES - 1)),
            lambda tree: F.struct(
                tree.alias("tree"), F.xxhash64(tree, "doc_id", *_KEPT).alias("h")
            ),
        )
        some = passing.select(
            *_KEPT, F.inline(F.filter(hashes, lambda x: F.pmod(x["h"], F.lit(1 << 30)) <= most))
        )
        order = Window.partitionBy("tree").orderBy("h", *_KEPT)
        few = some.withColumn("place", F.row_number().over(order)).filter(f"place <= {TREE_ROWS}")
        # TREES * TREE_ROWS rows of counts come to the driver.
        found = few.select("tree", "place", *_KEPT).orderBy("tree", "place").collect()
        drawn: list[list] = [[] for _ in range(TREES)]
        for tree, _, *values in found:
            drawn[tree].append(values)
        return [features(np.asarray(d, np.int64).reshape(-1, len(_KEPT))) for d in drawn]

    margin = MARGIN * feature_spread(counts)
    rows = sample(known.filter("quality = 1"))
    if len(rows):
        forest = Forest.grow(rows, margin)
    else:
        forest = Forest.grow(rows, margin, drawn=draw())
    binned = (
        _scored(known, forest)
        .filter("NOT base_failed")
        .groupBy(F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).alias("bin"), "quality")
        .agg(F.count("*").alias("n"))
    )
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in binned.collect():
        (good if r["quality"] == 1 else bad)[r["bin"]] += r["n"]
    if not bad.sum() or not good.sum():
        return QualityModel(forest, DEFAULT_THRESHOLD)
    # Share of either kind at or above each bin's lower edge.
    lost = np.append(good[::-1].cumsum()[::-1] / good.sum(), 0)
    caught = np.append(bad[::-1].cumsum()[::-1] / bad.sum(), 0)
    allowed = np.flatnonzero(lost <= MAX_GOOD_REJECTED)
    best = allowed[np.argmax(caught[allowed] - 4 * lost[allowed])]
    # Of equally good edges the one in the middle of the gap.
    equal = [b for b in allowed if caught[b] == caught[best] and lost[b] == lost[best]]
    return QualityModel(forest, float(np.mean(equal)) / BINS)


def judge_documents(
    documents: DataFrame, labels: DataFrame | None, scratch: Scratch
) -> DataFrame:
    """doc_id, the statistics, base_failed, the anomaly score and kept, of every document.

    Needs doc_id and text; labels needs doc_id and quality (0 bad, 1 good) and may be absent or
    empty. A null or empty text has no words and fails. Rows that repeat a doc_id are judged one
    by one, each by its own text.
    """
    counts = scratch.save("counts", document_counts(documents))
    model = fit_quality(counts, labels, scratch)
    keeps = ~F.col("base_failed") & (F.col("anomaly") <= model.threshold)
    return _scored(counts, model.forest).withColumn("kept", keeps)


def keep_good(documents: DataFrame, labels: DataFrame | None, scratch: Scratch) -> DataFrame:
    """The rows whose text passes, with all their columns. The text is read twice, not moved."""
    counts = scratch.save("counts", document_counts(documents))
    model = fit_quality(counts, labels, scratch)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches):
            yield batch.filter(pa.array(~model.rejects(_batch_counts(batch))))

    return documents.mapInArrow(keep, documents.schema)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("doc_id", "quality")
