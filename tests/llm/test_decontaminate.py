import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortspark.llm import decontaminate, registry
from cohortspark.llm.decontaminate import Membership, find_benchmark


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def by_hand(documents, items, size=10):
    """(doc_id, n_words, hit words, items), every window against every place."""
    holders = defaultdict(set)
    for item_id, text in items:
        words = words_of(text)
        length = min(size, len(words))
        for at in range(len(words) - length + 1):
            if length:
                holders[tuple(words[at : at + length])].add(item_id)
    lengths = sorted({len(w) for w in holders})
    out = []
    for doc_id, text in documents:
        words, hit, found = words_of(text), set(), set()
        for at in range(len(words)):
            for n in lengths:
                if at + n <= len(words) and (here := holders.get(tuple(words[at : at + n]))):
                    hit.update(range(at, at + n))
                    found |= here
        names = sorted(str(i) for i in found if i is not None)
        out.append((str(doc_id), len(words), sorted(hit), names))
    return sorted(out)


def found(frame, items, scratch, **options):
    rows = find_benchmark(frame, items, scratch, **options).collect()
    return sorted(
        (str(i), n, [w for a, b in spans for w in range(a, b + 1)], list(names))
        for i, n, spans, names in rows
    )


@pytest.fixture
def items(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(*r, "x", "x") for r in rows], "item_id long, text string, shingle string, n string"
        )

    return make


PASSAGE = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
ITEMS = [
    (1, PASSAGE),
    (2, "one two three four five"),
    (3, ""),
    (4, None),
    (5, "the"),
    (6, "ONE two"),
    (10, "alpha Beta gamma delta epsilon zeta eta theta iota kappa"),
    (10, "another text of the same item with more than ten words in it"),
    (None, "nobody owns this short one"),
    (7, "na " * 30),
    (8, "Ärger über  ßtraße x"),
    (9, "the"),
]
DOCS = [
    (1, f"before {PASSAGE.upper()} after"),
    (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (3, "beta gamma delta epsilon zeta eta theta iota kappa"),
    (4, "one two three four; one-two three four five one"),
    (5, None),
    (6, ""),
    (7, "..."),
    (8, "so nobody owns this short one, the end"),
    (9, "na " * 11 + "nu " + "na " * 9),
    (10, "ärger über ßtraße x Ärger"),
    (None, PASSAGE),
    (1, "the the"),
    (1, "the the"),
    (11, "another text of the same item with more than ten words in it, really"),
    (12, "one\ntwo"),
]


def test_documents_equal_a_plain_search(docs, items, scratch):
    assert found(docs(*DOCS), items(*ITEMS), scratch) == by_hand(DOCS, ITEMS)


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_other_windows(docs, items, scratch, window):
    got = found(docs(*DOCS), items(*ITEMS), scratch, window=window)
    assert got == by_hand(DOCS, ITEMS, window)


def test_many_documents_share_a_passage(spark, docs, items, scratch):
    rows = [(i, f"{i} {PASSAGE} " * (1 + i % 3)) for i in range(300)] + [(999, f"{PASSAGE} " * 3000)]
    pieces = [(i, " ".join(PASSAGE.split()[i % 5 : i % 5 + 10])) for i in range(50)]
    assert found(docs(*rows).repartition(7), items(*pieces), scratch) == by_hand(rows, pieces)


def test_the_query_over_the_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = registry.queries()["op11_decontamination"](spark, folder).collect()
    texts = [
        tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ]
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = [
        (i, n, len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
        for i, n, hit, names in by_hand(texts, given)
    ]
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in rows) == expected
    assert any(r["contaminated"] for r in rows) and not all(r["contaminated"] for r in rows)


def test_empty_tables(docs, items, scratch):
    assert found(docs(), items(*ITEMS), scratch) == []
    assert found(docs(*DOCS), items(), scratch) == by_hand(DOCS, [])


def shingles(texts, window):
    out = []
    for s in decontaminate._stretches(pa.array(texts), window):
        for size, at, keys in s.shingles(decontaminate._sizes(window)):
            text = np.searchsorted(s.bounds, at, "right") - 1
            where = at + s.place - s.bounds[text]
            out += zip((s.first_row + text).tolist(), [size] * len(at), where.tolist(), keys.tolist())
    return sorted(out)


@pytest.mark.parametrize("window", [1, 3, 10])
@pytest.mark.parametrize("part", [1, 7, 64])
def test_parts_of_long_texts_lose_nothing(monkeypatch, window, part):
    texts = [PASSAGE, None, "a b " * 50, "short", "no-gap" * 20, " , " * 30, "Ünï cödé " * 9, ""]
    whole = shingles(texts, window)
    words = [words_of(t) for t in texts]
    for size in decontaminate._sizes(window):
        places = [(r, p) for r, w in enumerate(words) for p in range(len(w) - size + 1)]
        assert [(r, p) for r, k, p, _ in whole if k == size] == places
        keys = {}
        for r, k, p, key in whole:
            assert k != size or keys.setdefault(tuple(words[r][p : p + k]), key) == key
        assert len(set(keys.values())) == len(keys)
    monkeypatch.setattr(decontaminate, "PART_BYTES", part)
    assert shingles(texts, window) == whole


def test_parts_hold_the_words_around(monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 5)
    text = " ".join(map(str, range(200)))
    for s in decontaminate._stretches(pa.array([text]), 10):
        listed = [s.text(i, i + 1) for i in range(len(s.starts))]
        assert listed == [str(s.place + i) for i in range(len(listed))]
        low, high = s.own
        if low < high:
            assert s.place == 0 or low >= 9
            assert s.final or high + 9 <= len(listed)


def test_filter_never_denies(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long")
    made = Membership.of(frame, "k")
    assert made.has(keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63, 20_000)
    assert made.has(others).mean() < 0.05
