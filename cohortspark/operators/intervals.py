"""Coverage intervals and the continuous spans they form.

A span table has one row per continuous span with these columns:

==============  ======  =====================================================
the keys                what the spans belong to, such as ``patid``, ``cohort``
span_id         long    1, 2, ... in calendar order
span_start      date    first covered day
span_end        date    last covered day
prior_end       date    end of the span before, null for the first
covered_days    long    days covered by this span and all before it
is_latest       bool    no later span exists
==============  ======  =====================================================

The running columns cost nothing extra while the rows are sorted, and they spare the
consumers every further grouping: the row marked ``is_latest`` already holds a patient's
number of spans, covered days and most recent span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import COHORTS, in_cohort, inclusive_days

# Fixed value: a gap of this many days still joins two intervals, a longer one separates them.
GAP_DAYS = 46


def _valid(keys: Sequence[str], start: str, end: str) -> str:
    present = " AND ".join(f"{column} IS NOT NULL" for column in (*keys, start, end))
    return f"{present} AND {end} >= {start}"


def clean_intervals(
    intervals: DataFrame,
    keys: Sequence[str] = ("patid",),
    start: str = "enr_start",
    end: str = "enr_end",
) -> DataFrame:
    """Distinct intervals without nulls and without an end before the start.

    Here and below, columns are given by plain names.
    """
    return intervals.filter(_valid(keys, start, end)).select(*keys, start, end).distinct()


def bridge_intervals(
    intervals: DataFrame,
    keys: Sequence[str] = ("patid",),
    start: str = "enr_start",
    end: str = "enr_end",
    gap_days: int = GAP_DAYS,
) -> DataFrame:
    """Merge the intervals of every key into spans, closing gaps of up to ``gap_days``.

    Of the intervals that start on one day only the longest matters. Taking that maximum
    first, with partial aggregation ahead of the shuffle, leaves a key at most one row per
    calendar day however many rows it came with, so sorting a key in one task is safe.
    """
    longest = (
        intervals.filter(_valid(keys, start, end))
        .groupBy(*keys, start)
        .agg(F.max(end).alias(end))
    )
    return _merge(longest, keys, start, end, gap_days)


def cohort_spans(
    enrollment: DataFrame,
    cohorts: Sequence[str] = tuple(COHORTS),
    gap_days: int = GAP_DAYS,
    partitions: int = 0,
) -> DataFrame:
    """Spans of several cohorts from one pass over enrollment, keyed ``patid, cohort``.

    The longest interval per patient and start day is found for all cohorts side by side;
    the rows fan out into one per cohort only behind the second shuffle. That one is on
    ``patid`` alone, which the per-patient joins and sums in the same plan can reuse; an
    exploded array keeps it, where an unpivot would not. Spans that are stored first lose it,
    unless they are stored in as many buckets as ``partitions`` asks the shuffle for.
    """
    members = " OR ".join(f"({in_cohort(c)})" for c in cohorts)
    fan_out = ", ".join(f"struct('{c}' AS cohort, {c} AS enr_end)" for c in cohorts)
    longest = (
        enrollment.filter(f"({members}) AND {_valid(['patid'], 'enr_start', 'enr_end')}")
        .groupBy("patid", "enr_start")
        .agg(*[F.expr(f"max(enr_end) FILTER (WHERE {in_cohort(c)}) AS {c}") for c in cohorts])
        .repartition(*([partitions] if partitions else []), "patid")
        .selectExpr("patid", "enr_start", f"inline(array({fan_out}))")
        .filter("enr_end IS NOT NULL")
    )
    return _merge(longest, ["patid", "cohort"], "enr_start", "enr_end", gap_days)


def _merge(
    longest: DataFrame, keys: Sequence[str], start: str, end: str, gap_days: int
) -> DataFrame:
    """Spans from intervals that are unique in (keys, start).

    Only the intervals that open a span are kept. The days covered before such an interval
    end where the previous span ends, so a span's own end is read from the next opening
    row, and for the last span from the whole group. All windows run on one sort.
    """
    calendar = f"PARTITION BY {', '.join(keys)} ORDER BY {start}"
    bounds = "UNBOUNDED PRECEDING AND"
    opening = longest.selectExpr(
        *keys,
        start,
        f"max({end}) OVER ({calendar} ROWS BETWEEN {bounds} 1 PRECEDING) AS prior_end",
        f"max({end}) OVER ({calendar} ROWS BETWEEN {bounds} UNBOUNDED FOLLOWING) AS final_end",
    ).filter(f"prior_end IS NULL OR datediff({start}, prior_end) > {gap_days}")
    spans = opening.selectExpr(
        *keys,
        f"row_number() OVER ({calendar}) AS place",
        start,
        "prior_end",
        f"lead(prior_end) OVER ({calendar}) AS known_end",
        "final_end",
    )
    days = inclusive_days(start, "coalesce(known_end, final_end)")
    return spans.selectExpr(
        *keys,
        "CAST(place AS LONG) AS span_id",
        f"{start} AS span_start",
        "coalesce(known_end, final_end) AS span_end",
        "prior_end",
        f"sum({days}) OVER ({calendar} ROWS BETWEEN {bounds} CURRENT ROW) AS covered_days",
        "known_end IS NULL AS is_latest",
    )


def latest_spans(spans: DataFrame) -> DataFrame:
    """The span that starts last of every key. Spans are disjoint, so it also ends last."""
    return spans.filter("is_latest")


def year_runs(spans: DataFrame) -> DataFrame:
    """Calendar years a span adds to those of the spans before it, as first and last year.

    The runs of one key are disjoint; a span that adds no year has no row.
    """
    return spans.selectExpr(
        "*",
        "greatest(year(span_start), year(prior_end) + 1) AS first_year",
        "year(span_end) AS last_year",
    ).filter("first_year <= last_year")


def covered_years(spans: DataFrame, keys: Sequence[str] = ("patid",)) -> DataFrame:
    """One row per key and calendar year with at least one covered day."""
    return year_runs(spans).selectExpr(
        *keys, "explode(sequence(first_year, last_year)) AS year"
    )
