"""Physical plans and hot keys: what has to hold for the jobs to scale."""

import re
from datetime import date
from pathlib import Path

import pytest
from helpers import SCHEMAS, rows

import __spark_entry__ as driver
from cohortspark.operators import (
    cohort_spans,
    compare_tables,
    delivery_grain,
    differing_rows,
    latest_spans,
    span_bounds,
    span_index,
    spans_of,
    totals_in_spans,
)
from cohortspark.plans import coverage, events, linkage, people
from cohortspark.plans.events import SpanJoin
from cohortspark.plans.snapshot import ON_REQUEST, RESULTS, snapshot
from cohortspark.sources import Scratch, read_table
from testtables import DP, DP_MAX_DATE, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The seven tables as files, with a column too many in each."""
    root = tmp_path_factory.mktemp("tables")
    frames = {}
    for name, ddl in SCHEMAS.items():
        if name in ON_REQUEST:
            continue
        path = str(root / name)
        spark.createDataFrame([], f"{ddl}, extra string").write.parquet(path)
        frames[name] = read_table(spark, name, path)
    return frames


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame):
    text = re.sub(r"#\d+L?", "", plan(frame))
    return re.findall(r"Exchange (\w+\([^)]*\)|SinglePartition)", text)


OPTIONAL = driver.optional.queries() if driver.optional else {}
# Their results are read from what several jobs have written: the parts have tests below.
WRITTEN = ("compare_status", "compare_snapshots", "snapshot", "vit_pat_vitct_md", "written_order")


def is_native(text):
    return not any(
        part in text
        for part in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow")
    )


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(OPTIONAL) - set(WRITTEN)))
def test_no_query_pairs_all_rows(spark, name):
    assert is_native(plan(driver.queries()[name](spark, SF_DIR)))


@pytest.fixture
def saved_plans(monkeypatch):
    """Plans of everything that is stored on the way."""
    found, save = {}, Scratch.save

    save_bucketed = Scratch.save_bucketed

    def watched(self, name, frame, partition_by=None):
        found.setdefault(name, []).append(plan(frame))
        return save(self, name, frame, partition_by)

    def watched_buckets(self, name, frame, *how):
        found.setdefault(name, []).append(plan(frame))
        return save_bucketed(self, name, frame, *how)

    monkeypatch.setattr(Scratch, "save", watched)
    monkeypatch.setattr(Scratch, "save_bucketed", watched_buckets)
    return found


def test_tallies_of_the_snapshot_pair_no_rows(spark, saved_plans):
    domains = [*RESULTS, *ON_REQUEST]
    tables = {name: table(spark, SF_DIR, name) for name in domains}
    with Scratch(spark) as scratch:
        results = snapshot(tables, DP, scratch, DP_MAX_DATE, domains)
        assert all(is_native(plan(result)) for result in results.values())
    assert set(saved_plans) == {"spans", "delivery_grain"} | {
        f"{d}_tally" for d in domains if d != "enrollment"
    }
    assert all(is_native(text) for texts in saved_plans.values() for text in texts)


def test_comparisons_pair_no_rows(spark, saved_plans):
    ours = spark.range(100).selectExpr("id % 7 AS k", "CAST(id AS DOUBLE) AS v", "id AS n")
    theirs = ours.withColumn("v", ours.v + 0.5)
    assert compare_tables(ours, theirs, 0.5)["status"] == "numeric_tolerance_match"
    assert is_native(plan(differing_rows(ours, theirs)))
    assert set(saved_plans) == {"ours", "theirs"}
    assert all(is_native(text) for texts in saved_plans.values() for text in texts)


def test_files_of_stored_spans_follow_their_size(spark, stored):
    rows_of = spark.range(20_000).selectExpr(
        "id AS patid", "DATE '2020-01-01' AS enr_start", "DATE '2020-02-01' AS enr_end",
        "'y' AS drugcov", "'y' AS medcov",
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        with Scratch(spark) as scratch:
            scratch.save("spans", cohort_spans(rows_of), "cohort")
            files = list(Path(scratch.path).rglob("*.parquet"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert 3 <= len(files) <= 6


def test_flags_reach_the_scan(spark, stored):
    text = plan(cohort_spans(stored["enrollment"], ["md"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "In(medcov, [Y,y])" in pushed and "In(drugcov, [Y,y])" in pushed
    assert "IsNotNull(patid)" in pushed


def test_scans_read_only_what_they_need(spark, stored):
    spans = cohort_spans(stored["enrollment"], ["md"])
    deaths = people.death_counts(spans, stored["death"])
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(deaths))
    assert set(schemas) == {
        "patid:bigint,enr_start:date,enr_end:date,drugcov:string,medcov:string",
        "patid:bigint",
    }


def test_spans_take_two_shuffles_and_one_sort(spark, stored):
    spans = cohort_spans(stored["enrollment"])
    assert exchanges(spans) == [
        "hashpartitioning(patid, 4)",
        "hashpartitioning(patid, enr_start, 4)",
    ]
    assert plan(spans).count("Sort [") == 1
    assert "partial_max" in plan(spans)


def test_coverage_results_add_one_small_shuffle(spark, stored):
    spans = cohort_spans(stored["enrollment"], ["md"])
    for result, last in (
        (coverage.covered_days(spans, "x", "md"), "hashpartitioning(covered_days, 4)"),
        (coverage.span_counts(spans, "x", "md"), "hashpartitioning(span_id, 4)"),
        (coverage.patients(spans, "x", "md"), "SinglePartition"),
        (coverage.active_patients(spans, "x", "md", date(2020, 1, 1)), "SinglePartition"),
    ):
        assert exchanges(result)[0] == last
        assert len(exchanges(result)) == 3
        assert "partial_count" in plan(result)


def test_events_are_counted_ahead_of_both_shuffles(spark, stored):
    spans = cohort_spans(stored["enrollment"], ["md", "d"])
    totals = totals_in_spans(events.dispensing_days(stored["dispensing"]), spans, ["md", "d"])
    assert "Join" not in plan(totals)
    assert exchanges(totals)[0] == "hashpartitioning(patid, 4)"
    assert exchanges(totals)[-1] == "hashpartitioning(patid, day, 4)"
    assert plan(totals).count("FileScan") == 2


def test_linkage_needs_no_join(spark, stored):
    rates = linkage.linkage_rates(delivery_grain(stored["mil"]), stored["mil"], "x")
    assert "Join" not in plan(rates)
    assert "SortAggregate" not in plan(rates) and "collect" not in plan(rates)


def test_a_patient_with_a_third_of_all_events(spark):
    """The rows of a hot patient collapse to its calendar days before they meet in a task."""
    source = spark.range(300_000).selectExpr(
        "IF(id % 3 = 0, 0L, id) AS patid",
        "date_add(DATE '2015-01-01', CAST(id % 1000 AS INT)) AS rxdate",
    )
    spans = cohort_spans(
        source.selectExpr(
            "patid",
            "rxdate AS enr_start",
            "date_add(rxdate, CAST(patid % 30 AS INT)) AS enr_end",
            "'y' AS drugcov",
            "'y' AS medcov",
        ),
        ["md"],
    )
    days = events.dispensing_days(source)
    assert days.filter("patid = 0").count() == 1000
    assert rows(spans.filter("patid = 0"), "span_id", "span_start", "span_end") == [
        (1, "2015-01-01", "2017-09-26")
    ]
    assert days.count() == 201_000
    totals = totals_in_spans(days, spans, ["md"])
    assert rows(totals.filter("patid = 0")) == [(0, "md", 100_000)]
    assert totals.agg({"n": "sum"}).first()[0] == 300_000


def test_a_delivery_with_a_third_of_all_rows(spark):
    """A hot delivery and a hot infant collapse ahead of the shuffle."""
    mil = spark.range(90_000).selectExpr(
        "IF(id % 3 = 0, 1L, id) AS mpatid",
        "IF(id % 3 = 0, 1L, id) AS encounterid",
        "IF(id % 3 = 1, 7L, id) AS cpatid",
        "'IP' AS enctype",
        "1 AS birth_type",
        "30 AS age",
        "DATE '2020-01-01' AS adate",
    )
    rates = linkage.linkage_rates(delivery_grain(mil), mil, "x").filter("variable = 'overall'")
    assert [tuple(r)[3:6] for r in rates.collect()] == [(60_000, 60_000, 60_001)]


@pytest.fixture
def no_broadcast(spark):
    """Large tables: nothing is small enough for Spark to broadcast by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def index(spark):
    enrollment = table(spark, SF_DIR, "enrollment")
    with Scratch(spark) as scratch:
        spans = cohort_spans(enrollment, ["m", "md", "d"], partitions=4)
        made = span_index(spans, ["m", "md", "d"])
        assert exchanges(made) == exchanges(spans)
        yield scratch.save_bucketed("spans", made, "patid", 4)


def test_stored_spans_are_shuffled_by_no_domain(spark, index, no_broadcast):
    md = spans_of(index, ["md"])
    per_domain = [
        events.indexed_totals(table(spark, SF_DIR, "dispensing"), "rxdate", index, ["md", "d"]),
        events.indexed_totals(table(spark, SF_DIR, "encounter"), "adate", index, ["md"]),
        events.indexed_totals(table(spark, SF_DIR, "lab"), events.EVENT_DAYS["lab"], index, ["md"]),
        people.age_categories(md, table(spark, SF_DIR, "demographic"), "md"),
        latest_spans(spans_of(index, ["md", "m"])).join(
            table(spark, SF_DIR, "death").groupBy("patid").count(), "patid"
        ),
    ]
    for frame in per_domain:
        text = plan(frame)
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
        scan = next(line for line in text.splitlines() if "SelectedBucketsCount: 4 out of 4" in line)
        depth = len(scan) - len(scan.lstrip(" :+-*()0123456789"))
        above = []
        for line in text.splitlines()[: text.splitlines().index(scan)][::-1]:
            place = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if place < depth:
                depth = place
                above.append(line)
        assert any("Join" in line for line in above)
        assert not any(re.search(r"\bExchange\b", line) for line in above)


def test_a_broadcast_index_meets_events_where_they_are_read(spark, index, no_broadcast):
    rows_of = table(spark, SF_DIR, "encounter")
    totals = events.indexed_totals(rows_of, "adate", index, ["md"], SpanJoin("broadcast"))
    # One shuffle, of sums per patient; the other exchange is the broadcast.
    shuffles = [e for e in exchanges(totals) if "Broadcast" not in e]
    assert shuffles == ["hashpartitioning(patid, 4)"]
    text = plan(totals)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")
    never = events.indexed_totals(rows_of, "adate", index, ["md"], SpanJoin("shuffle"))
    assert "BroadcastHashJoin" not in plan(never)


def test_days_nobody_is_covered_on_are_not_read(spark, stored, index):
    bounds = span_bounds(index, ["m", "md", "d"])
    first, last = (d.isoformat() for d in bounds)
    totals = events.indexed_totals(stored["dispensing"], "rxdate", index, ["md"], bounds=bounds)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(totals))
    assert any(
        f"GreaterThanOrEqual(rxdate,{first})" in p and f"LessThanOrEqual(rxdate,{last})" in p
        for p in pushed
    )
    spark.conf.unset("spark.sql.maxMetadataStringLength")
