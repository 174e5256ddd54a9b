import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from cohortspark.llm import ctw


def tokens_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def base(rows):
    trained = [zlib.crc32(str("" if i is None else i).encode()) % 5 != 1 for i, _ in rows]
    counts = Counter(t for (_, text), yes in zip(rows, trained) if yes for t in tokens_of(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for (i, text), yes in zip(rows, trained):
        words = tokens_of(text)
        score = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        out.append((str(i), not yes, len(words), sum(counts[w] > 0 for w in words), total, score))
    return out


class Tree:
    """Context-tree weighting with exact fractions, node by node."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, Counter()
        for text in texts:
            for context, node, bit in self.decisions(text):
                for d in range(depth + 1):
                    self.counts[context[:d], node, bit] += 1
        self.children = {}
        for context, node, _ in self.counts:
            if context:
                self.children.setdefault((context[:-1], node), set()).add(context)
        self.known = {}

    def decisions(self, text):
        data = bytes([ctw.END]) * self.depth + text.encode() + bytes([ctw.END])
        for at in range(self.depth, len(data)):
            context = data[at - self.depth : at][::-1]
            for j in range(8):
                yield context, (1 << j) | (data[at] >> (8 - j)), (data[at] >> (7 - j)) & 1

    def estimate(self, context, node):
        p, seen = Fraction(1), [0, 0]
        for bit in (0, 1):
            for _ in range(self.counts[context, node, bit]):
                p *= Fraction(2 * seen[bit] + 1, 2 * (sum(seen) + 1))
                seen[bit] += 1
        return p

    def weighted(self, context, node):
        if (context, node) not in self.known:
            own = self.estimate(context, node)
            below = Fraction(1)
            for child in self.children.get((context, node), ()):
                below *= self.weighted(child, node)[0]
            if len(context) == self.depth:
                self.known[context, node] = own, Fraction(1)
            else:
                self.known[context, node] = (own + below) / 2, own / (own + below)
        return self.known[context, node]

    def log10(self, text):
        total = 0.0
        for context, node, bit in self.decisions(text):
            p = None
            for d in range(self.depth, -1, -1):
                n = [self.counts[context[:d], node, b] for b in (0, 1)]
                own = Fraction(2 * n[bit] + 1, 2 * (sum(n) + 1))
                share = Fraction(1) if p is None else self.weighted(context[:d], node)[1]
                p = own if p is None else share * own + (1 - share) * p
                if d and not sum(n):
                    p = None
            total += math.log10(p)
        return total


def check(docs, scratch, rows, depth=3):
    got = ctw.score_documents(docs(*rows), scratch, depth).collect()
    ours = sorted(((str(r[0]), *tuple(r)[1:]) for r in got), key=str)
    expected = sorted(base(rows), key=str)
    assert [r[:5] for r in ours] == [r[:5] for r in expected]
    assert [r[5] for r in ours] == pytest.approx([r[5] for r in expected])
    return ours


def test_scores_equal_exact_context_trees(docs, scratch):
    rows = [(i, "abra cadabra " * (i % 3) + "Abcé"[: i % 5]) for i in range(14)] + [(20, None), (21, "zz")]
    ours = {r[0]: r[6] for r in check(docs, scratch, rows)}
    tree = Tree([t or "" for i, t in rows if not ctw.held_out(i)], 3)
    for i, text in rows:
        assert ours[str(i)] == pytest.approx(tree.log10(text or ""), abs=1e-9)


def test_base_counts_over_odd_documents(docs, corpus, scratch):
    check(docs, scratch, corpus + [(None, "no id"), (3, "again"), (3, "again")])


def test_several_chunks_and_tasks_change_nothing(docs, corpus, scratch, monkeypatch):
    rows = corpus[:60]
    one = check(docs, scratch, rows)
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(ctw, "TASK_GRAMS", 2_000)
    from cohortspark.sources.scratch import Scratch

    with Scratch(scratch.spark) as other:
        many = check(docs, other, rows)
    assert [r[6] for r in one] == pytest.approx([r[6] for r in many])


def test_every_context_gives_a_distribution():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**24, 400)).astype(np.uint64)
    contexts = np.unique(keys >> np.uint64(8))
    every = ((contexts[:, None] << np.uint64(8)) | np.arange(256, dtype=np.uint64)).ravel()
    counts = np.where(np.isin(every, keys), 3, 0)
    level = ctw.lower_levels(every, counts, 2)[0][-1]
    shorter = (level.ids >> np.uint64(16) << np.uint64(8)) | (level.ids & np.uint64(255))
    ids, at = np.unique(shorter, return_inverse=True)
    sums = (np.bincount(at, weights=x) for x in (level.zeros, level.ones, level.log_weighted))
    scores = ctw.gram_scores(every, counts, 2, ctw.TopLevels(ids.astype(np.int64), *sums))
    assert (10**scores).reshape(-1, 256).sum(1) == pytest.approx(np.ones(len(contexts)))


def test_held_out_text_beats_uniform_bytes(docs, corpus, scratch):
    rows = corpus
    got = ctw.score_documents(docs(*rows), scratch).filter("held_out").collect()
    texts = dict(rows)
    size = sum(len((texts[r["doc_id"]] or "").encode()) + 1 for r in got)
    assert -sum(r["score"] for r in got) * math.log2(10) / size < 4.5


def test_no_documents(docs, scratch):
    assert ctw.score_documents(docs(), scratch).collect() == []
