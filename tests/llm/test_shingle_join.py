import re
from collections import defaultdict

import numpy as np
import pytest

from cohortspark.llm.components import components
from cohortspark.llm.shingle_join import (
    SignatureJoin,
    jaccard_components,
    jaccard_links,
    keep_one_of_each,
    part_keys,
    size_classes,
)


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def by_hand(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        starts = range(max(1, len(found) - words + 1))
        sets[doc_id] = {tuple(found[i : i + words]) for i in starts} if found else set()
    holders, groups = defaultdict(list), Union()
    for doc_id, tokens in sets.items():
        common = defaultdict(int)
        for t in tokens:
            for other in holders[t]:
                common[other] += 1
            holders[t].append(doc_id)
        for other, n in common.items():
            if 100 * n >= percent * (len(tokens) + len(sets[other]) - n):
                groups.link(doc_id, other)
    return sorted((d, len(s), groups.find(d)) for d, s in sets.items())


def near_copies(rng, base, count, changes):
    out = []
    for _ in range(count):
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(0, changes + 1)):
            words[at] = f"new{rng.integers(1000)}"
        out.append(" ".join(words))
    return out


@pytest.fixture
def rows(corpus):
    rng = np.random.default_rng(5)
    texts = []
    for size, changes in ((3, 1), (12, 2), (60, 3), (300, 14)):
        base = [f"w{rng.integers(10**6)}" for _ in range(size)]
        texts += near_copies(rng, base, 25, changes) + [" ".join(base).upper()] * 3
    passage = " ".join(f"p{i}" for i in range(80))
    texts += [passage + " " + " ".join(f"q{rng.integers(10**6)}" for _ in range(60)) for _ in range(20)]
    return corpus + [(50_000 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 50)])
@pytest.mark.parametrize("block", [3_000_000, 900])
def test_components_equal_brute_force(docs, rows, scratch, words, percent, block):
    got = jaccard_components(docs(*rows, (None, "no id")), scratch, words, percent, block)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, words, percent)


def links_by_hand(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        starts = range(max(1, len(found) - words + 1))
        sets[doc_id] = {tuple(found[i : i + words]) for i in starts} if found else set()
    holders, number = defaultdict(list), dict.fromkeys(sets, 0)
    for doc_id, tokens in sets.items():
        common = defaultdict(int)
        for t in tokens:
            for other in holders[t]:
                common[other] += 1
            holders[t].append(doc_id)
        for other, n in common.items():
            if 100 * n >= percent * (len(tokens) + len(sets[other]) - n):
                number[doc_id] += 1
                number[other] += 1
    return sorted(number.items())


@pytest.mark.parametrize("words, percent, block", [(3, 90, 3_000_000), (1, 50, 900)])
def test_all_links_are_counted(docs, rows, scratch, words, percent, block):
    given = docs(*rows, *rows[::40], (None, "no id"))  # repeated rows are the same document
    got = {tuple(r) for r in jaccard_links(given, scratch, words, percent, block).collect()}
    assert sorted((d, n) for d, _, n, _ in got) == links_by_hand(rows, words, percent)
    assert sorted((d, s, c) for d, s, _, c in got) == by_hand(rows, words, percent)


def test_one_of_each_group_stays(docs, scratch):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text), (1, text + " more"), (2, "other"), (4, None), (5, ""), (None, text)]
    frame = docs(*rows)
    kept = keep_one_of_each(frame, scratch)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "5", "None"]


def test_no_documents(docs, scratch):
    assert jaccard_components(docs(), scratch).collect() == []


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    bounds = size_classes(percent, 10_000)
    for size in [*range(1, 60), 200, 777]:
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        most = size * (100 - percent) // percent
        for extra in {0, most // 2, most}:
            b = np.concatenate((a, rng.integers(0, 2**64, extra, dtype=np.uint64)))
            assert 100 * size >= percent * len(b)
            keys = set(part_keys(np.unique(a), percent, bounds).tolist())
            assert keys & set(part_keys(np.unique(b), percent, bounds).tolist())


def test_signature_trees_lose_no_link():
    rng = np.random.default_rng(9)
    base = [np.unique(rng.integers(0, 10**6, n)) for n in (5, 80, 90, 400)]
    sets = []
    for _ in range(400):
        b = base[rng.integers(len(base))]
        keep = b[rng.random(len(b)) > 0.05]
        more = rng.integers(0, 10**6, rng.integers(0, 1 + len(b) // 20))
        sets.append(np.unique(np.concatenate((keep, more))).astype(np.uint64))
    expected = Union()
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                expected.link(i, j)
    half = np.arange(200)
    found = Union()
    for run in ((half,), (half + 200,), (half, half + 200)):
        for i, j in SignatureJoin(sets, 85).run(*run):
            found.link(i, j)
    assert [found.find(i) for i in range(400)] == [expected.find(i) for i in range(400)]


@pytest.mark.parametrize("size", [90, 9000])
def test_every_pair_of_near_copies_is_a_link(size):
    """More sets than a leaf, more tokens than one product of matrices takes."""
    common = np.arange(size, dtype=np.uint64)
    sets = [np.append(common, np.uint64(10**6 + i)) for i in range(70)]
    copies = np.arange(1, 71)
    work = SignatureJoin(sets, 90, copies)
    assert len(work.run(np.arange(70))) == 69
    assert work.counts.tolist() == (copies.sum() - copies).tolist()
    across = SignatureJoin(sets, 90, copies)
    across.run(np.arange(10), np.arange(10, 70))
    assert across.counts.tolist() == [copies[10:].sum()] * 10 + [copies[:10].sum()] * 60


def test_components_of_paths_stars_and_repeats(spark, scratch):
    edges = [(i, i + 1) for i in range(100, 164)] + [(7, i) for i in range(8, 40)] + [(9, 7), (7, 7)] * 3
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()))
    assert got == {**{i: 100 for i in range(100, 165)}, **{i: 7 for i in range(7, 40)}}
    assert components(spark.createDataFrame([], "a long, b long"), scratch, "none").collect() == []
