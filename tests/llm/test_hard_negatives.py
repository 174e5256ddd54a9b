import math

import numpy as np
import pytest

from cohortspark.llm import hard_negatives as operator
from cohortspark.llm import registry
from cohortspark.llm.hard_negatives import Search, hard_negatives

SCHEMA = (
    "vec_id long, label int, embedding array<double>, asks boolean, node long, row string, "
    "size string, slab string"
)


def by_hand(rows, positives=5, negatives=3):
    """Every anchor against every row, in whole numbers of any size."""
    usable = []
    for number, (vec_id, label, v, asks) in enumerate(rows):
        if None in (vec_id, label, v) or any(x is None or not math.isfinite(x * 256) for x in v):
            continue
        usable.append((number, vec_id, label, [math.floor(x * 256) for x in v], asks))
    out = []
    for number, anchor, label, v, asks in usable:
        if not asks:
            continue
        scored = []
        for other, vec_id, its, w, _ in usable:
            if other != number and len(v) == len(w):
                score = sum(a * b for a, b in zip(v, w))
                scored.append((-max(1 - 2**63, min(2**63 - 1, score)), vec_id, its == label))
        scored.sort()
        for p, positive, same in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            for rank, (n, vec_id, _) in enumerate(inside[:negatives], 1):
                out.append((anchor, positive, rank, vec_id, -p, -n))
    return sorted(out)


def mined(spark, scratch, rows, parts=4, **options):
    frame = spark.createDataFrame([(*r, 7, "x", "x", "x") for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hard_negatives(frame, scratch, **options).collect())


def random_rows(n, size, labels, seed, every=5):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(labels, size)) / 4
    out = []
    for i in range(n):
        label = int(dice.integers(labels))
        vector = centres[(label + int(dice.integers(2))) % labels] + dice.normal(size=size) / 8
        out.append((i, label, vector.round(2).tolist(), i % every == 0))
    return out


@pytest.mark.parametrize("tile_values", [1, 300, 65_536])
def test_random_vectors(spark, scratch, tile_values):
    rows = random_rows(400, 6, 4, 1)
    expected = by_hand(rows)
    assert len(expected) > 100
    assert mined(spark, scratch, rows, tile_values=tile_values) == expected


def test_odd_rows(spark, scratch):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5], True), (0, 1, [1.0, 0.5], True), (0, 2, [1.0, 0.25], True),
        (1, 1, [1.0, 0.5], False), (2, 1, [1.0, 0.5], None), (3, 2, [0.7, 0.5], False),
        (4, 2, [0.7, 0.5], False), (5, 3, [0.7, 0.5], False), (6, 3, [0.7, 0.5], True),
        (7, None, [1.0, 1.0], True), (8, 1, None, True), (9, 1, [1.0, None], True),
        (10, 1, [nan, 1.0], True), (11, 2, [inf, 1.0], True), (None, 2, [0.7, 0.5], True),
        (12, 1, [0.0, 0.0], True), (13, 2, [0.0, 0.0], True), (14, 1, [-1.0, -0.5], True),
        (15, 1, [], True), (16, 1, [], False), (17, 2, [], True),
        (18, 1, [1.0], True), (19, 1, [2.0], False), (20, 2, [1.5], False),
        (21, 1, [1e307, 0.0], True), (22, 4, [0.001, -0.001], True), (23, 4, [0.7, 0.5], False),
    ]
    expected = by_hand(rows)
    assert expected
    assert mined(spark, scratch, rows) == expected


def test_scores_beyond_double_precision_and_64_bits(spark, scratch):
    dice = np.random.default_rng(3)
    rows = [
        (i, int(dice.integers(2)), [float(x) * 10.0 ** int(dice.integers(4, 9)) for x in dice.normal(size=4)], i % 3 == 0)
        for i in range(60)
    ]
    rows += [(100 + i, i % 2, [float(s) * 1e200, 1e200], True) for i, s in enumerate((1, 1, -1, 1, 1))]
    expected = by_hand(rows)
    assert expected and any(abs(r[4]) > 2**53 for r in expected)
    assert mined(spark, scratch, rows) == expected


def test_many_equal_vectors_and_a_hot_label(spark, scratch):
    rows = [(i, 1 if i % 3 else i % 7, [0.5, 0.25, -0.5], i % 40 == 0) for i in range(400)]
    rows += [(1000 + i, 9, [0.4, 0.3, -0.5], i % 40 == 0) for i in range(200)]
    assert mined(spark, scratch, rows, tile_values=60) == by_hand(rows)


def test_no_rows(spark, scratch):
    assert mined(spark, scratch, []) == []
    assert mined(spark, scratch, [(1, 1, [1.0], False), (2, 2, [1.0], False)]) == []
    assert mined(spark, scratch, [(1, 1, [1.0], True)]) == []


def test_the_query_over_the_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding")
    rows = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, v, i % 50 == 0) for i, label, v in given.collect()
    ]
    got = sorted(tuple(r) for r in registry.queries()["op12_hard_negatives"](spark, folder).collect())
    assert got == by_hand(rows)


@pytest.mark.parametrize("leaf, chunk", [(4, 3), (16, 200)])
def test_queue_finds_what_a_scan_finds(monkeypatch, leaf, chunk):
    monkeypatch.setattr(operator, "LEAF", leaf)
    monkeypatch.setattr(operator, "CHUNK", chunk)
    dice = np.random.default_rng(leaf)
    vectors = dice.integers(-9, 9, (500, 5)).astype(np.float64)
    ids, labels = dice.permutation(500), dice.integers(0, 3, 500)
    asked = np.arange(0, 500, 9)
    low = dice.integers(-50, 100, (len(asked), 2))
    anchors = {
        "vectors": vectors[asked], "labels": labels[asked], "rows": asked, "low": low,
        "high": low + dice.integers(-3, 60, low.shape), "floor": np.full(low.shape, operator._LEAST),
    }
    for same in (True, False):
        work = Search(vectors, ids, labels, np.arange(500))
        who, window, at, score = work.run(anchors, same, 4)
        got = sorted(zip(who.tolist(), window.tolist(), (-score).tolist(), work.ids[at].tolist()))
        expected = []
        for a, row in enumerate(asked):
            products = vectors @ vectors[row]
            for w in range(2):
                fits = (labels == labels[row]) == same
                fits &= (products >= low[a, w]) & (products <= anchors["high"][a, w])
                fits[row] = False
                best = sorted((-int(products[i]), int(ids[i])) for i in np.flatnonzero(fits))[:4]
                expected += [(a, w, *b) for b in best]
        assert got == sorted(expected)
