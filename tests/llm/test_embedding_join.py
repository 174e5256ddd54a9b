import math

import numpy as np
import pytest

from cohortspark.llm.embedding_join import embedding_components

SCHEMA = "vec_id long, embedding array<double>, rep string, i string"


def by_hand(rows, cosine):
    good = []
    for vec_id, v, *_ in rows:
        fine = vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v)
        good.append(np.asarray(v, float) if fine and any(v) else None)
    label = [r[0] for r in rows]
    links = [0] * len(rows)
    pairs = []
    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a is not None and b is not None and len(a) == len(b):
                a_, b_ = a / np.abs(a).max(), b / np.abs(b).max()
                if a_ @ b_ / math.sqrt((a_ @ a_) * (b_ @ b_)) >= cosine:
                    links[i] += 1
                    pairs.append((i, j))
    # Rows of one vec_id are in one component, whatever their vectors.
    pairs += [
        (i, j) for i in range(len(rows)) for j in range(len(rows))
        if good[i] is not None and good[j] is not None and label[i] == label[j]
    ]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if label[j] < label[i]:
                label[i], changed = label[j], True
    return sorted((str(r[0]), n, str(c), r[0] is not None and r[0] == c) for r, n, c in zip(rows, links, label))


def rows_of(rng, size):
    centers = rng.normal(size=(12, size))
    vectors = [centers[rng.integers(12)] + 0.2 * rng.normal(size=size) for _ in range(150)]
    vectors += [centers[0].copy()] * 9 + [3.5 * centers[0]] + [rng.normal(size=size) for _ in range(60)]
    return [v.tolist() for v in vectors]


@pytest.mark.parametrize("block", [16_384, 25])
@pytest.mark.parametrize("cosine", [0.95, 0.7])
def test_equals_all_pairs(spark, scratch, block, cosine):
    rng = np.random.default_rng(4)
    vectors = rows_of(rng, 8) + rows_of(rng, 2)[:40] + [
        None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [2.0], [5.0],
        [1e300, 1e300], [1e-300, 1e-300],
    ]
    rows = [(i, v, "x", "y") for i, v in enumerate(vectors)] + [(None, vectors[0], "x", "y")]
    got = embedding_components(spark.createDataFrame(rows, SCHEMA), scratch, cosine, block)
    ours = sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got.collect())
    assert ours == by_hand(rows, cosine)


def test_repeated_rows_are_copies(spark, scratch):
    frame = spark.createDataFrame([(5, [1.0, 2.0])] * 3 + [(2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, embedding_components(frame, scratch).collect())) == [
        (2, 3, 2, True), *[(5, 3, 2, False)] * 3,
    ]


def test_no_vectors(spark, scratch):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_components(frame, scratch).collect() == []


def test_one_vec_id_with_several_vectors(spark, scratch):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.2]
    near = lambda v: [x + 0.01 for x in v]
    rows = [
        (1, a), (1, b), (2, near(a)), (3, near(b)), (4, [0.0, 0.0, 1.0]), (5, b), (5, [0.0, -1.0, 0.0]),
        (6, [0.0, -1.0, 0.0]), (6, None), (7, [-1.0, 0.0, 0.0]), (7, [-1.0, 0.001, 0.0]), (8, [-1.0, -1.0, 0.0]),
        (9, [1e200, 1e200, 0.0]), (9, [-1e-170, 0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embedding_components(frame, scratch).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got) == by_hand(rows, 0.95)
    assert {r["vec_id"]: r["n_links"] for r in got}[3] == 2
