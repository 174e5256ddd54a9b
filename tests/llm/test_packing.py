import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortspark.llm.packing import best_fit, pack, pack_documents, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


def gapless(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(docs, corpus, scratch):
    rows = corpus + [(None, "no id"), (3, "again " * 5000)]
    library = Tokenizer.from_file(PATH)
    expected = []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.asarray(ids[at : at + 2048], "<u4")
            expected.append((str(i), piece, at, len(part), zlib.crc32(part.tobytes())))
    got = pack_documents(docs(*rows), PATH, scratch).collect()
    assert sorted((str(r[0]), *tuple(r)[1:5]) for r in got) == sorted(expected)
    total = sum(e[3] for e in expected)
    assert gapless(got, 2048) <= -(-total // 2048) * 1.05 + 1


def test_ids_on_request(docs):
    row = token_pieces(docs((1, "The cat")), PATH, with_ids=True).first()
    assert len(row["ids"]) == row["length"] and row["ids"][-1] == 0


def test_best_fit_takes_the_fullest_bin_with_room():
    bins, places = best_fit(np.asarray([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and places.tolist() == [0, 0, 6, 5, 8]


@pytest.mark.parametrize("task_items", [150, 10_000])
def test_rounds_merge_what_tasks_left(spark, scratch, task_items):
    rng = np.random.default_rng(3)
    rows = [(i, 0, int(n)) for i, n in enumerate(rng.integers(1, 120, 1500))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    got = pack(pieces, scratch, capacity=128, slack=1, task_items=task_items).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == rows
    assert gapless(got, 128) <= 1.05 * sum(r[2] for r in rows) / 128 + 1


def test_items_that_fit_with_none(spark, scratch):
    pieces = spark.createDataFrame([(i, 0, 70) for i in range(300)], "doc_id long, piece int, length long")
    got = pack(pieces, scratch, capacity=128, task_items=20).collect()
    assert len({r["sequence_id"] for r in got}) == 300


def test_no_documents(docs, scratch):
    assert pack_documents(docs(), PATH, scratch).collect() == []
