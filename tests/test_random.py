"""Events and deliveries against brute force in plain Python."""

from collections import Counter
from datetime import date, timedelta

from helpers import SCHEMAS
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortspark.operators import cohort_spans, delivery_conflicts, delivery_grain, totals_in_spans
from cohortspark.plans import events
from cohortspark.plans.linkage import linkage_rates

quick = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
days = st.integers(0, 400).map(lambda n: date(2020, 1, 1) + timedelta(days=n))
patids = st.integers(1, 4)
coverage = st.lists(
    st.tuples(patids, days, st.integers(0, 60), st.sampled_from("yn"), st.sampled_from("yn")),
    max_size=25,
)


@quick
@given(coverage, st.lists(st.tuples(patids, st.none() | days), max_size=60))
def test_totals_in_spans(spark, coverage, happened):
    rows = [(p, start, start + timedelta(days=n), d, m) for p, start, n, d, m in coverage]
    spans = cohort_spans(spark.createDataFrame(rows, SCHEMAS["enrollment"]))
    daily = events.dispensing_days(spark.createDataFrame(happened * 2, SCHEMAS["dispensing"]))
    covered = spans.collect()
    expected = Counter(
        (patid, span.cohort)
        for patid, day in happened * 2
        for span in covered
        if day and span.patid == patid and span.span_start <= day <= span.span_end
    )
    cohorts = ["m", "md", "d"]
    totals = totals_in_spans(daily, spans, cohorts)
    assert {(r.patid, r.cohort): r.n for r in totals.collect()} == expected


attributes = st.tuples(
    st.sampled_from(["IP", "AV", None]),
    st.sampled_from([1, 2, None]),
    st.sampled_from([-1, 0, 17, 55, None]),
    st.sampled_from([date(2020, 1, 1), date(2021, 6, 1), None]),
)
key = st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from([10, 11, None]))
infants = st.lists(st.sampled_from([100, 101, 102, None]), min_size=1, max_size=5)
BANDS = {-1: "NEGATIVE", 0: "0-1 yrs", 17: "15-19 yrs", 55: "55+ yrs", None: "MISSING"}


@quick
@given(st.dictionaries(key, st.tuples(attributes, infants), max_size=10))
def test_linkage_rates(spark, deliveries):
    source = [(*k, c, *a) for k, (a, children) in deliveries.items() for c in children]
    mil = spark.createDataFrame(source, SCHEMAS["mil"])
    expected = {}
    for (mother, encounter), ((enctype, birth, age, day), children) in deliveries.items():
        if mother is None:
            continue
        known = {c for c in children if c is not None and encounter is not None}
        for pair in (
            ("overall", "overall"),
            ("age_category", BANDS[age]),
            ("enctype", enctype or "MISSING"),
            ("year", str(day.year) if day else "MISSING"),
            ("birth_type", str(birth) if birth else "MISSING"),
        ):
            count, linked, seen = expected.setdefault(pair, [0, 0, set()])
            expected[pair] = [count + 1, linked + bool(known), seen | known]
    rates = linkage_rates(delivery_grain(mil), mil, "x").collect()
    found = {(r.variable, r.value): r for r in rates}
    assert set(found) == set(expected)
    for pair, (count, linked, seen) in expected.items():
        row = found[pair]
        assert tuple(row)[3:6] == (count, linked, len(seen))
        assert abs(float(row.linkage_rate) - linked / count) <= 0.0000005


@quick
@given(st.lists(st.tuples(key, attributes), max_size=15))
def test_delivery_conflicts(spark, versions):
    source = [(*k, 100, *a) for k, a in versions]
    found = delivery_conflicts(delivery_grain(spark.createDataFrame(source, SCHEMAS["mil"])))
    expected = set()
    for mother, encounter in {k for k, _ in versions if k[0] is not None}:
        told = [a for k, a in versions if k == (mother, encounter)]
        differs = [len(set(values)) > 1 for values in zip(*told)]
        if any(differs):
            expected.add((mother, encounter, *differs))
    assert {tuple(r) for r in found.collect()} == expected
