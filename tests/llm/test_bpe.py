import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortspark.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXT = st.text(st.sampled_from("aaabcde'stll  \n\t\r\x85\xa0\x1c.,!0²éßŁİſ中Σ\u0301😀"), max_size=60)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_ids_equal_the_reference(reference, texts):
    codec = bpe.byte_codec(PATH, PATTERN)
    assert [i.tolist() for i in codec.encode(texts)] == list(map(reference.encode_ordinary, texts))


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_words_equal_the_library(texts):
    codec = bpe.word_codec(public_tokenizers.path("word_bpe_49k.json"))
    plain = [codec.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in codec.encode(texts)] == plain


def test_special_tokens_in_texts():
    codec = bpe.word_codec(public_tokenizers.path("word_bpe_49k.json"))
    text = "a <|endoftext|> B<|startoftext|>"
    assert codec.encode([text])[0].tolist() == codec.library.encode(text, add_special_tokens=False).ids


def test_caches_stay_within_their_bound(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    codec = bpe.ByteCodec(PATH, PATTERN)
    for n in range(20):
        texts = [f"word{n} other{n * 7} again and again" for _ in range(3)]
        assert [i.tolist() for i in codec.encode(texts)] == list(
            map(reference.encode_ordinary, texts)
        )
    assert len(codec.pieces.recent) + len(codec.pieces.older) < 60


def test_pairs_of_lower_rank_appear_in_order():
    # Merging b+c makes a pair with a that ranks below b+c itself.
    pairs = {(0, 1): (9, 9), (1, 2): (5, 5), (0, 5): (3, 3), (2, 0): (4, 4)}
    merges = bpe.Merges(pairs, range(256), range(256))
    words = [b"\0\1\2", b"\0\1\2\0\1\2", b"\1\2\0", b"\0\0\1\2\2\0"]
    alone = [merges._alone(w) for w in words]
    assert [list(memoryview(i).cast("i")) for i in merges.replay(words)] == alone


def test_documents_round_trip(docs, corpus, reference):
    rows = corpus + corpus[:3] + [(None, "null id"), (7, "y" * 50_000)]
    frame = docs(*rows)
    texts = sorted((str(i), t or "") for i, t in rows)
    encoded = bpe.encode_documents(frame, PATH, PATTERN)
    decoded = bpe.decode_documents(encoded, PATH, PATTERN).collect()
    assert sorted((str(r[0]), bytes(r[1]).decode()) for r in decoded) == texts
    digests = {(str(r[0]), *tuple(r)[1:]) for r in bpe.round_trip_digests(frame, PATH, PATTERN).collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    assert digests == {
        (i, len(e), sha(" ".join(map(str, e)).encode()), sha(t.encode()))
        for i, t in texts
        for e in [reference.encode_ordinary(t)]
    }


def test_no_documents(docs):
    assert bpe.round_trip_digests(docs(), PATH, PATTERN).count() == 0


def test_a_worker_keeps_the_caches_of_one_operator():
    words = public_tokenizers.path("word_bpe_49k.json")
    first = bpe.byte_codec(PATH, PATTERN)
    assert bpe.byte_codec(PATH, PATTERN) is first
    bpe.word_codec(words)
    assert bpe._byte_codec.cache_info().currsize == 0
    assert bpe.byte_codec(PATH, PATTERN) is not first
    assert bpe._word_codec.cache_info().currsize == 0


def _word_ids(texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_split_into_words_once():
    lowered = []

    class Text(str):
        def lower(self):
            lowered.append(str(self))
            return str.lower(self)

    texts = ["The cat's hat, it's 42!", "", "a b", "Ωmega stays", "the THE café..."]
    found = bpe.WordCodec(public_tokenizers.path("word_bpe_49k.json")).encode(list(map(Text, texts)))
    assert [ids.tolist() for ids in found] == _word_ids(texts)
    # The one beyond Latin letters goes to the library.
    assert lowered == [t for t in texts if t != "Ωmega stays"]


def test_words_without_ids_do_not_outlast_a_failure(monkeypatch):
    codec = bpe.WordCodec(public_tokenizers.path("word_bpe_49k.json"))
    codec.encode(["some words"])
    with monkeypatch.context() as broken:
        broken.setattr(codec.merges, "replay_flat", lambda words: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            codec.encode(["other words"])
    texts = ["other words", "some more"]
    assert [ids.tolist() for ids in codec.encode(texts)] == _word_ids(texts)
