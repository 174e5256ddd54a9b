import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortspark.llm import quality

COLUMNS = quality.COUNTS


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(rows, "doc_id long, quality int")


def test_counts_and_fixed_rules(docs, corpus, labels, scratch):
    rows = corpus + [(None, "a b c d e f a b c d e g h"), (1, "é# | é# |\n é# |\né# |"), (2, "w " * 30000)]
    got = quality.judge_documents(docs(*rows), labels(), scratch).collect()
    ours = sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS), r["base_failed"]) for r in got)
    expected = []
    for i, text in rows:
        counts = by_hand(text)
        expected.append((str(i), *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]))
    assert ours == sorted(expected)
    assert not any(r["kept"] for r in got if r["base_failed"])


def synthetic(rng, bad):
    words = ["".join(rng.choice(list("abcdefg"), rng.integers(2, 9))) for _ in range(rng.integers(40, 300))]
    if bad:
        words = [w + "#%|"[rng.integers(3)] * 2 for w in words]
    return " ".join(words)


def test_anomalies_are_rejected_and_good_documents_kept(docs, labels, scratch):
    rng = np.random.default_rng(1)
    rows = [(i, synthetic(rng, i % 10 == 0)) for i in range(600)]
    marks = labels(*[(i, int(i % 10 != 0)) for i in range(0, 600, 2)], (3, None), (None, 1))
    got = {r["doc_id"]: r["kept"] for r in quality.judge_documents(docs(*rows), marks, scratch).collect()}
    bad = [i for i in got if i % 10 == 0]
    assert sum(not got[i] for i in bad) >= 0.95 * len(bad)
    assert sum(got[i] for i in got if i % 10) >= 0.98 * (600 - len(bad))


def test_filter_keeps_whole_rows(docs, labels, scratch):
    rng = np.random.default_rng(2)
    rows = [(i, synthetic(rng, False)) for i in range(80)] + [(80, None), (81, "few words"), (82, "")]
    frame = docs(*rows)
    kept = quality.keep_good(frame, labels(*[(i, 1) for i in range(80)]), scratch)
    assert kept.schema == frame.schema
    found = kept.collect()
    assert {r["doc_id"] for r in found}.isdisjoint({80, 81, 82}) and len(found) >= 78
    assert {(r["doc_id"], r["text"], r["key"]) for r in found} <= {(*r, "x") for r in rows}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "same words here " * 9)] * 5])
def test_little_or_nothing(docs, labels, scratch, rows):
    assert quality.judge_documents(docs(*rows), labels(), scratch).count() == len(rows)
    assert quality.judge_documents(docs(*rows), None, scratch).count() == len(rows)


def test_isolation_sets_far_points_apart():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(2000, 5))
    forest = quality.Forest.grow(rows, np.full(5, 0.5))
    assert forest.scores(np.full((1, 5), 9.0))[0] > forest.scores(rows).max()
    assert quality._mean_path(256) == pytest.approx(10.24, abs=0.1)


def test_margins_come_from_all_documents(spark, scratch):
    """One document with symbols in 60,000: no sample of good ones has any."""
    rng = np.random.default_rng(3)
    n = 60_000
    words = rng.integers(0, 400, n)
    columns = {c: np.zeros(n, np.int64) for c in quality._KEPT} | {
        "n_words": words,
        "word_chars": words * rng.integers(3, 9, n),
        "n_repeat_words": rng.integers(0, 1 + words // 8),
        "n_upper": rng.integers(0, 1 + words // 5),
        "n_marks": rng.integers(0, 1 + words // 20),
    }
    odd = n - 1
    columns["n_words"][odd], columns["n_symbols"][odd] = 200, 90
    table = pa.table({"doc_id": np.arange(n)} | columns)
    counts = scratch.save("given", spark.createDataFrame(table))
    rows = np.stack(list(columns.values()), 1)
    spread = quality.features(rows).std(0)
    assert quality.feature_spread(counts) == pytest.approx(spread, rel=1e-6)
    good = spark.range(0, odd, 7).selectExpr("id AS doc_id", "1 AS quality")
    forest = quality.fit_quality(counts, good, scratch).forest
    plain = rows[odd].copy()
    plain[2] = 0
    score, usual = forest.scores(quality.features(np.stack((rows[odd], plain))))
    assert score > usual + 0.05


def plain_score(forest, row):
    """The forest walked node by node."""
    total = 0.0
    for tree in range(quality.TREES):
        node = 0
        while forest.left[tree][node] > 0:
            right = row[forest.feature[tree][node]] >= forest.split[tree][node]
            node = int(forest.left[tree][node]) + int(right)
        total += forest.path[tree][node]
    return 2.0 ** -(total / quality.TREES / forest.norm)


@pytest.mark.parametrize("labelled", [True, False])
def test_kept_equals_a_plain_walk(docs, labels, scratch, labelled):
    rng = np.random.default_rng(5)
    rows = [(i, synthetic(rng, i % 9 == 0)) for i in range(150)] + [(200, None), (201, "a b")]
    marks = labels(*[(i, int(i % 9 != 0)) for i in range(0, 150, 3)]) if labelled else None
    judged = quality.judge_documents(docs(*rows), marks, scratch).collect()
    counts = scratch.save("again", quality.document_counts(docs(*rows)))
    model = quality.fit_quality(counts, marks, scratch)
    for r in judged:
        text = dict(rows)[r["doc_id"]] or ""
        values = np.asarray([quality.text_counts(text)])
        score = plain_score(model.forest, quality.features(values)[0])
        assert r["anomaly"] == pytest.approx(score)
        assert r["kept"] == (not r["base_failed"] and score <= model.threshold)


def test_unlabelled_trees_draw_from_all_documents(spark, scratch):
    """Beyond any fixed sample of documents; every tree has its own rows."""
    n = 30_000
    words = np.arange(n) + 10
    columns = {c: np.zeros(n, np.int64) for c in quality._KEPT} | {
        "n_words": words, "word_chars": words * 5, "n_upper": np.arange(n) % 97,
    }
    counts = scratch.save("all", spark.createDataFrame(pa.table({"doc_id": np.arange(n)} | columns)))
    drawn = []
    grow = quality.Forest.grow

    def watched(rows, margin, seed=7, drawn_rows=None, **named):
        drawn.extend(named["drawn"])
        return grow(rows, margin, seed, **named)

    quality.Forest.grow = watched
    try:
        quality.fit_quality(counts, None, scratch)
    finally:
        quality.Forest.grow = grow
    assert [len(d) for d in drawn] == [quality.TREE_ROWS] * quality.TREES
    distinct = {tuple(r) for d in drawn for r in d.tolist()}
    assert len(distinct) > 12_000
