import re
import time

import pytest

from cohortspark.llm.licenses import BASE, Template, scan_licenses

COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def by_hand(text):
    found = words(text)
    places, labels = [], set()
    for phrase, label in BASE.items():
        k = len(phrase.split())
        at = [i for i in range(len(found)) if found[i : i + k] == phrase.split()]
        places += at
        if at:
            labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(found), len(places), *ends, ",".join(sorted(labels)))


def test_base_places_equal_a_search_word_by_word(docs, corpus, scratch):
    rows = corpus + [
        (900_001, "MIT-License, mit LICENSE; Apache\nLicense general public license mit"),
        (900_002, "license mit license general public public license MIT"),
        (900_003, "\u212amit license and m\u0130t license"),
        (900_003, "gnu lesser general public license v3 " * 3000),
    ]
    got = scan_licenses(docs(*rows), scratch)
    ours = sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got.collect())
    assert ours == sorted((i, *by_hand(t)) for i, t in rows)


def test_labels_of_the_method(docs, scratch):
    got = scan_licenses(
        docs(
            (1, "Permission is hereby granted, free of charge, to any person obtaining a copy"),
            (2, "hereby granted free " + "x " * 50 + "person obtaining"),
            (3, "Licensed under CC BY-NC 4.0."),
            (4, "GNU Affero General Public License"),
            (5, "nothing"),
            (6, None),
        ),
        scratch,
    )
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {i: r["labels"] for i, r in rows.items()} == {
        1: "mit", 2: "", 3: "cc", 4: "agpl,gpl", 5: "", 6: "",
    }
    assert rows[1]["score"] == rows[3]["score"] == 1 and rows[5]["score"] == 0
    assert 0 < rows[2]["score"] < 1


def test_every_word_of_a_phrase_counts(docs, scratch):
    texts = [
        "licensed under the apache", "licensed under banana apache", "licensed under apache",
        "released into the public domain", "released x y public domain", "into the public domain",
        "released into the the public domain", "the released into", "under the apache license",
    ]
    got = scan_licenses(docs(*enumerate(texts)), scratch).collect()
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels == {0: "apache", 1: "", 2: "", 3: "unlicense", 4: "", 5: "", 6: "", 7: "", 8: "apache"}


def test_phrases_of_common_words_are_refused(docs, scratch):
    odd = Template("odd", (("license of the and", 0),))
    with pytest.raises(ValueError, match="license of the and"):
        scan_licenses(docs((1, "x")), scratch, templates=(odd,))


def test_a_megabyte_of_license_words(docs, scratch):
    n = 90_000
    text = "mit license " * n + "source code must retain binary form must reproduce " * 5000
    started = time.monotonic()
    (row,) = scan_licenses(docs((1, text)), scratch).collect()
    assert time.monotonic() - started < 60
    assert (row["n_base"], row["first_word"], row["last_word"]) == (n, 0, 2 * n - 2)
    assert row["labels"] == "bsd,mit" and row["score"] == 1


def test_no_documents(docs, scratch):
    assert scan_licenses(docs(), scratch).collect() == []
