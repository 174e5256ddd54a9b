"""Cleaning and bridging of intervals."""

import random
from datetime import date, timedelta

from helpers import enrollment, rows, typed
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortspark.functions import COHORTS, cohort_rows
from cohortspark.operators import (
    GAP_DAYS,
    bridge_intervals,
    clean_intervals,
    cohort_spans,
    covered_years,
    latest_spans,
)

SPAN = ("patid", "span_id", "span_start", "span_end")


def bridged(spark, *intervals):
    return rows(bridge_intervals(enrollment(spark, *intervals)), *SPAN)


def test_nested_intervals_form_one_span(spark):
    assert bridged(
        spark,
        (1, "2011-11-20", "2013-04-02"),
        (1, "2012-02-29", "2012-03-01"),
        (1, "2012-12-31", "2013-01-01"),
    ) == [(1, 1, "2011-11-20", "2013-04-02")]


def test_long_interval_bridges_over_a_short_one(spark):
    """The end that counts is the latest so far, not that of the row before."""
    assert bridged(
        spark,
        (1, "2014-06-10", "2015-11-20"),
        (1, "2014-07-04", "2014-07-04"),
        (1, "2015-12-24", "2016-02-29"),
    ) == [(1, 1, "2014-06-10", "2016-02-29")]


def test_gap_of_46_days_is_closed(spark):
    # Across a leap day, and across the end of a year.
    assert bridged(
        spark,
        (1, "2016-01-10", "2016-02-20"),
        (1, "2016-04-06", "2016-04-30"),
        (2, "2018-11-01", "2018-12-05"),
        (2, "2019-01-20", "2019-01-21"),
    ) == [(1, 1, "2016-01-10", "2016-04-30"), (2, 1, "2018-11-01", "2019-01-21")]


def test_gap_of_47_days_splits(spark):
    assert bridged(
        spark,
        (1, "2016-01-10", "2016-02-20"),
        (1, "2016-04-07", "2016-04-30"),
        (2, "2018-11-01", "2018-12-05"),
        (2, "2019-01-21", "2019-01-21"),
    ) == [
        (1, 1, "2016-01-10", "2016-02-20"),
        (1, 2, "2016-04-07", "2016-04-30"),
        (2, 1, "2018-11-01", "2018-12-05"),
        (2, 2, "2019-01-21", "2019-01-21"),
    ]


def test_duplicates_and_broken_intervals_are_dropped(spark):
    frame = enrollment(
        spark,
        (1, "2020-01-01", "2020-01-31"),
        (1, "2020-01-01", "2020-01-31"),
        (1, "2020-05-31", "2020-05-01"),
        (1, None, "2020-06-30"),
        (1, "2020-06-01", None),
        (None, "2020-01-01", "2020-01-31"),
    )
    assert rows(clean_intervals(frame)) == [(1, "2020-01-01", "2020-01-31")]
    assert rows(bridge_intervals(frame), *SPAN) == [(1, 1, "2020-01-01", "2020-01-31")]


def test_order_of_rows_does_not_matter(spark):
    intervals = [
        (patid, f"202{year}-0{month}-01", f"202{year}-0{month}-20")
        for patid in (1, 2)
        for year in range(3)
        for month in (1, 2, 6)
    ]
    shuffled = random.Random(7).sample(intervals, len(intervals))
    assert bridged(spark, *intervals) == bridged(spark, *shuffled)


def test_running_columns(spark):
    spans = bridge_intervals(
        enrollment(
            spark,
            (1, "2020-01-01", "2020-01-01"),
            (1, "2020-06-01", "2020-06-10"),
            (2, "2019-01-01", "2019-12-31"),
        )
    )
    assert rows(spans, "patid", "span_id", "prior_end", "covered_days", "is_latest") == [
        (1, 1, None, 1, False),
        (1, 2, "2020-01-01", 11, True),
        (2, 1, None, 365, True),
    ]
    assert rows(latest_spans(spans), *SPAN) == [
        (1, 2, "2020-06-01", "2020-06-10"),
        (2, 1, "2019-01-01", "2019-12-31"),
    ]


def test_years_count_once_per_patient(spark):
    spans = bridge_intervals(
        enrollment(
            spark,
            (1, "2020-01-01", "2020-02-01"),
            (1, "2020-06-01", "2020-07-01"),
            (1, "2020-12-01", "2022-01-01"),
        )
    )
    assert rows(covered_years(spans)) == [(1, 2020), (1, 2021), (1, 2022)]


def test_other_keys_and_columns(spark):
    frame = typed(
        spark,
        "plan string, member long, since date, until date",
        ("a", 1, "2020-01-01", "2020-01-05"),
        ("a", 1, "2020-01-07", "2020-01-09"),
        ("b", 1, "2020-01-07", "2020-01-09"),
    )
    spans = bridge_intervals(frame, ["plan", "member"], "since", "until", gap_days=2)
    assert rows(spans, "plan", "member", "span_start", "span_end") == [
        ("a", 1, "2020-01-01", "2020-01-09"),
        ("b", 1, "2020-01-07", "2020-01-09"),
    ]


def test_flags_accept_either_case_only(spark):
    flags = typed(
        spark,
        "patid long, enr_start date, enr_end date, drugcov string, medcov string",
        (1, "2020-01-01", "2020-01-02", "Y", "y"),
        (2, "2020-01-01", "2020-01-02", "n", "Y"),
        (3, "2020-01-01", "2020-01-02", "y", None),
        (4, "2020-01-01", "2020-01-02", "yes", "N"),
    )
    members = {c: [r[0] for r in rows(cohort_rows(flags, c), "patid")] for c in COHORTS}
    assert members == {"m": [1, 2], "md": [1], "d": [1, 3]}


def reference_spans(intervals):
    """Spans day by day: the plainest possible statement of the rule."""
    spans = []
    for start, end in sorted(i for i in intervals if i[0] <= i[1]):
        if spans and (start - spans[-1][1]).days <= GAP_DAYS:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [tuple(span) for span in spans]


days = st.integers(0, 700).map(lambda n: date(2019, 6, 1) + timedelta(days=n))
interval = st.tuples(days, st.integers(-5, 120)).map(lambda i: (i[0], i[0] + timedelta(days=i[1])))
patients = st.lists(
    st.lists(st.tuples(interval, st.sampled_from("yYn"), st.sampled_from("yN")), max_size=12),
    min_size=1,
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(patients)
def test_spans_of_random_intervals(spark, patients):
    source = [
        (patid, start, end, drug, med)
        for patid, intervals in enumerate(patients)
        for (start, end), drug, med in intervals
    ]
    frame = spark.createDataFrame(
        source * 2, "patid long, enr_start date, enr_end date, drugcov string, medcov string"
    )
    expected = {
        (cohort, patid, *span)
        for cohort, flags in {"m": [4], "md": [3, 4], "d": [3]}.items()
        for patid in range(len(patients))
        for span in reference_spans(
            [r[1:3] for r in source if r[0] == patid and all(r[f] in "yY" for f in flags)]
        )
    }
    spans = cohort_spans(frame)
    columns = ["cohort", "patid", "span_start", "span_end"]
    found = [tuple(r) for r in spans.select(columns).collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected
    # Bridging spans changes nothing.
    again = bridge_intervals(spans, ["cohort", "patid"], "span_start", "span_end")
    assert {tuple(r) for r in again.select(columns).collect()} == expected
