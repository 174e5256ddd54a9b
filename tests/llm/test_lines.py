import re
from collections import defaultdict

import numpy as np
import pytest

from cohortspark.llm import lines
from cohortspark.llm.lines import MinimalHash, drop_repeated_lines


def key_of(line):
    line = line.strip(" \t\n\v\f\r")
    return re.sub("[A-Z]", lambda m: m.group().lower(), line)


def by_hand(rows, min_docs=5):
    holders = defaultdict(list)
    for doc_id, text in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= 40:
                holders[key].append(doc_id)
    keeper = {}
    for key, ids in holders.items():
        known = [i for i in ids if i is not None]
        if len(ids) >= min_docs and known:
            keeper[key] = max(known)
    out = []
    for doc_id, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if keeper.get(key_of(x), doc_id) == doc_id]
        out.append((str(doc_id), len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def report(frame, scratch):
    got = drop_repeated_lines(frame, scratch, report=True)
    return sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect())


LONG = "This line is long enough to count, and ends here."


@pytest.fixture
def rows(corpus):
    odd = [
        (10_000 + i, "\n".join(["short", " \t" + LONG.upper() if i % 2 else LONG, f"own {i}", LONG]))
        for i in range(9)
    ]
    at = [(20_000 + i, "É" * 39 + ("\n" + "é" * 40) * 2) for i in range(5)]
    four = [(30_000 + i, "z" * 60) for i in range(4)]
    return corpus + odd + at + four + [(None, LONG), (10_003, LONG + "\nx"), (40_000, (LONG + "\n") * 5000)]


def test_lines_equal_a_plain_count(docs, rows, scratch):
    assert report(docs(*rows), scratch) == by_hand(rows)


def test_hot_shards_are_split(docs, rows, scratch, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_LINES", 50)
    monkeypatch.setattr(lines, "TASK_PROBES", 3)
    assert report(docs(*rows), scratch) == by_hand(rows)


def test_rows_without_ids_keep_their_lines(docs, scratch):
    rows = [(None, LONG)] * 6
    assert report(docs(*rows), scratch) == by_hand(rows)


def test_all_columns_stay(spark, scratch):
    rows = [(i, f"{LONG}\n{i}", "en", len(LONG) + 2, "k") for i in range(6)] + [(9, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, gone_0 string")
    got = drop_repeated_lines(frame, scratch)
    assert got.schema == frame.schema
    found = {r["doc_id"]: r for r in got.collect()}
    assert found[5]["text"] == f"{LONG}\n5" and found[2]["text"] == "2"
    assert found[2]["n_chars"] == 1 and found[2]["gone_0"] == "k" and found[9]["text"] is None


def test_no_documents(docs, scratch):
    assert report(docs(), scratch) == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_minimal_hash_is_one_to_one(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    table = MinimalHash.from_bytes(MinimalHash.build(keys).to_bytes())
    assert sorted(table.index(keys).tolist()) == list(range(len(keys)))
