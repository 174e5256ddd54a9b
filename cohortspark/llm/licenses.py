"""License scans by a positional index of rare license words. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.sources.scratch import Scratch

# A word: digits, letters and whatever is not ASCII. The text keeps its case while it is split.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """One way in which a license shows: phrases that all have to stand near their offsets.

    ``phrases`` maps each mandatory phrase to the place of its first word in the template text.
    """

    label: str
    phrases: tuple[tuple[str, int], ...]


# The base phrases, then openings of well-known license texts and notices.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    *(Template(label, ((phrase, 0),)) for phrase, label in BASE.items()),
    Template("mit", (("hereby granted free", 2), ("person obtaining", 9))),
    Template("apache", (("licensed under the apache", 0),)),
    Template("gpl", (("gnu general public", 0),)),
    Template("agpl", (("affero general public license", 0),)),
    Template("lgpl", (("lesser general public license", 0),)),
    Template("bsd", (("source code must retain", 10), ("binary form must reproduce", 23))),
    Template("bsd", (("bsd license", 0),)),
    Template("cc", (("licensed under cc", 0),)),
    Template("cc", (("creative commons", 0),)),
    Template("isc", (("use copy modify", 2), ("without fee", 15))),
    Template("isc", (("isc license", 0),)),
    Template("mpl", (("mozilla public license", 0),)),
    Template("unlicense", (("released into the public domain", 5),)),
)
# Words of phrases that are too common to be looked up; stored only beside a word that is not.
SKIPPED = frozenset({"the", "of", "to", "into", "by", "and", "for", "in"})
SLACK = 12  # words by which two phrases of one template may have moved apart


def _kept(phrase: str) -> list[tuple[str, int]]:
    return [(w, i) for i, w in enumerate(phrase.split()) if w not in SKIPPED]


def license_hits(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n_words and the places of license words as ``hits`` (place -> word)."""
    # Lower-casing the Kelvin sign would make an ASCII letter of it.
    text = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("K"), F.lit("ⓚ")))
    words = documents.select(
        "doc_id", F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("words")
    )
    wanted = F.array(*[F.lit(w) for w in vocabulary])

    def beside(place: Column) -> Column:
        """Whether a word that is looked up stands next to a place."""
        around = [F.get("words", place + step).isin(vocabulary) for step in (-1, 1)]
        return F.coalesce(around[0], F.lit(False)) | F.coalesce(around[1], F.lit(False))

    placed = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("place"), w.alias("word"))),
        lambda x: x["word"].isin(vocabulary)
        | (x["word"].isin(sorted(SKIPPED)) & beside(x["place"])),
    )
    return words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.arrays_overlap("words", wanted), placed).alias("hits"),
    )


def _inverse_frequencies(hits: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of every license word over all documents; as many rows as the vocabulary has."""
    total = hits.count()
    each = hits.filter("hits IS NOT NULL").select(
        F.explode(F.array_distinct(F.transform("hits", lambda x: x["word"]))).alias("word")
    )
    seen = {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) + 1e-9 for w in vocabulary}


def _verifiable(phrase: str) -> bool:
    """Whether each skipped word of a phrase stands beside one that is looked up."""
    words = ["", *phrase.split(), ""]
    kept = [bool(w) and w not in SKIPPED for w in words]
    return any(kept) and all(
        kept[i] or kept[i - 1] or kept[i + 1] for i in range(1, len(words) - 1)
    )


def _places(phrase: str, idf: dict[str, float]) -> Column:
    """Starts of a phrase: its rarest word's places, intersected with those of all its words."""
    rarest, first = max(_kept(phrase), key=lambda x: (idf[x[0]], -x[1]))

    def starts(word: str, offset: int) -> Column:
        of_word = F.filter("hits", lambda x: x["word"] == F.lit(word))
        return F.transform(of_word, lambda x: x["place"] - offset)

    found = F.filter(starts(rarest, first), lambda s: s >= 0)
    for offset, word in enumerate(phrase.split()):
        if offset != first:
            found = F.array_intersect(found, starts(word, offset))
    return found


def _weighed(weight: float):
    return lambda s: F.struct(s.alias("s"), F.lit(weight).alias("w"))


def scan_licenses(
    documents: DataFrame,
    scratch: Scratch,
    base: dict[str, str] = BASE,
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """Where documents name licenses, and which.

    One scan stores each document's places of license words (a few hundred words at most, given
    by the templates). Their document frequencies over the whole corpus say which word of a
    phrase is the rarest; its places are looked up and intersected with the places of the other
    words by relative position. A template's label is given where all its phrases are found at
    their relative places, give or take ``SLACK`` words. Every word of a phrase is verified; common
    ones (``SKIPPED``) are stored beside license words only. No text is shuffled. The work of a
    document is linear in its license words, but for one sort of places.

    Needs doc_id and text; other columns are ignored. A null text counts as empty: no words,
    null first_word and last_word, empty labels, score 0. Repeated doc_ids give a row each.
    ``score`` is the largest share of a template's phrases, weighed by IDF, that is found.
    """
    phrases = list(dict.fromkeys([*base, *(p for t in templates for p, _ in t.phrases)]))
    if odd := [p for p in phrases if not _verifiable(p)]:
        raise ValueError(f"common words too far from any other: {', '.join(odd)}")
    vocabulary = sorted({w for p in phrases for w, _ in _kept(p)})
    hits = scratch.save("license_hits", license_hits(documents, vocabulary))
    idf = _inverse_frequencies(hits, vocabulary)

    empty = F.array().cast("array<int>")
    name = {p: f"p{i}" for i, p in enumerate(phrases)}
    found = hits.select(
        "doc_id",
        "n_words",
        *[
            F.when(F.col("hits").isNull(), empty).otherwise(_places(p, idf)).alias(name[p])
            for p in phrases
        ],
    )

    def share(t: Template) -> Column:
        """Share of the template's weight around the best place of any of its phrases."""
        weight = {p: sum(idf[w] for w, _ in _kept(p)) for p, _ in t.phrases}
        total = sum(weight.values())

        def near(p: str, o: int, q: str, k: int) -> Column:
            """Where the template would begin by p, if q is within the slack of its place."""
            begins = F.transform(name[p], lambda s: s - o)
            if q == p:
                return begins
            reach = F.flatten(
                F.transform(name[q], lambda s: F.sequence(s - k - SLACK, s - k + SLACK))
            )
            return F.array_intersect(begins, reach)

        def around(p: str, o: int) -> Column:
            parts = F.array_sort(
                F.concat(
                    *[
                        F.transform(near(p, o, q, k), _weighed(weight[q] / total))
                        for q, k in t.phrases
                    ]
                )
            )
            nothing = F.struct(
                F.lit(None).cast("int").alias("s"), F.lit(0.0).alias("w"), F.lit(0.0).alias("best")
            )

            def add(so_far: Column, part: Column) -> Column:
                same = part["s"].eqNullSafe(so_far["s"])
                w = F.when(same, so_far["w"] + part["w"]).otherwise(part["w"])
                return F.struct(
                    part["s"].alias("s"), w.alias("w"), F.greatest(so_far["best"], w).alias("best")
                )

            return F.aggregate(parts, nothing, add, lambda so_far: so_far["best"])

        if len(t.phrases) == 1:
            return F.when(F.size(name[t.phrases[0][0]]) > 0, 1.0).otherwise(0.0)
        return F.greatest(*[around(p, o) for p, o in t.phrases])

    shares = [share(t) for t in templates]
    all_base = F.concat(*[F.col(name[p]) for p in base])
    found = found.select(
        "doc_id",
        "n_words",
        all_base.alias("places"),
        F.array_compact(
            F.array(*[F.when(F.size(name[p]) > 0, F.lit(label)) for p, label in base.items()])
        ).alias("base_found"),
        F.array(*shares).alias("shares"),
    )
    whole = F.array_compact(
        F.array(
            *[
                F.when(F.element_at("shares", i + 1) > 1 - 1e-6, F.lit(t.label))
                for i, t in enumerate(templates)
            ]
        )
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_found")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_found", whole)), ",").alias("labels"),
        F.least(F.array_max("shares"), F.lit(1.0)).alias("score"),
    )
