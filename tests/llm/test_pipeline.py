import pytest

import corpus_pipeline
import __spark_entry__ as driver
from cohortspark.llm import registry

SF_DIR = "/root/testdata/sf0.001"


def test_stages_pass_documents_on(spark, scratch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = scratch.save(f"s{number}", stage(spark, docs, SF_DIR))
        assert docs.columns == columns
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left and left <= ids
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == ids
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in whole) == sorted(
        tuple(r[k] for k in key) for r in packed
    )


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=lambda s: s.__name__)
def test_stages_take_odd_tables(spark, scratch, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", None, "s", 3), (2, "", "en", "s", 0)]
    for given in (rows, []):
        out = stage(spark, spark.createDataFrame(given, schema), SF_DIR)
        assert stage is corpus_pipeline.best_fit_packing or out.columns == schema.replace(
            " long", "").replace(" string", "").split(", ")
        out.collect()


def test_all_operators_are_registered():
    names = registry.queries()
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(names) <= set(driver.queries()) and set(registry.oracle_sql()) <= set(driver.oracle_sql())


def _planted(spark):
    """The smallest table with copies, near copies and a passage that nine documents share."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [r.asDict() for r in table.orderBy("doc_id").collect()]
    long = [r for r in rows if r["text"] and len(r["text"].split()) > 200]
    passage = " ".join(long[0]["text"].split()[:60])
    more, at = [], max(r["doc_id"] for r in rows)
    for r in long[1:10]:
        words = r["text"].split(" ")
        words[50] = "changed"
        for text in (r["text"], " ".join(words), f"{r['text']}\n  {passage.upper()} \n"):
            at += 1
            more.append({**r, "doc_id": at, "text": text})
    return spark.createDataFrame([tuple(r.values()) for r in rows + more], table.schema)


def _texts(frame):
    return {r["doc_id"]: r["text"] or "" for r in frame.select("doc_id", "text").collect()}


def _ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _lines_dropped(texts):
    def keys(text):
        return [_ascii_lower(line.strip(" \t\n\v\f\r")) for line in text.split("\n")]

    owners = {}
    for doc_id, text in texts.items():
        for key in keys(text):
            owners.setdefault(key, set()).add(doc_id)
    return {
        d: "\n".join(
            line
            for line, key in zip(t.split("\n"), keys(t))
            if len(key) < 40 or len(owners[key]) < 5 or max(owners[key]) == d
        )
        for d, t in texts.items()
    }


def _smallest_of_groups(texts):
    def shingles(text):
        words = _ascii_lower(text).encode().split()
        width = min(5, len(words))
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()

    sets = {d: shingles(t) for d, t in texts.items()}
    group = {d: d for d in texts}
    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return {d for d, g in group.items() if d == g}


def test_middle_stages_against_brute_force(spark, scratch):
    docs = scratch.save("planted", _planted(spark))
    before = _texts(docs)
    deduped = scratch.save("lines", corpus_pipeline.line_dedup(spark, docs, SF_DIR))
    expected = _lines_dropped(before)
    assert expected != before and _texts(deduped) == expected
    kept = _texts(corpus_pipeline.jaccard_join(spark, deduped, SF_DIR))
    left = _smallest_of_groups(expected)
    assert len(left) < len(expected) and kept == {d: expected[d] for d in left}
