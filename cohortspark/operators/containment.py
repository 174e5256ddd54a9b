"""Dated events inside continuous spans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(
    events: DataFrame, day: str, measures: Mapping[str, str] | None = None
) -> DataFrame:
    """Events per patient and day as ``patid, day, n``; rows without patient or day drop out.

    ``day`` is a column or SQL expression. Counting ahead of the shuffle leaves a patient at
    most one row per calendar day. ``measures`` replaces the count ``n`` by other additive
    aggregates, SQL by name.
    """
    measures = measures or {"n": "count(*)"}
    return (
        events.withColumn("day", F.expr(day))
        .filter("patid IS NOT NULL AND day IS NOT NULL")
        .groupBy("patid", "day")
        .agg(*[F.expr(f"{total} AS {name}") for name, total in measures.items()])
    )


def totals_in_spans(
    daily: DataFrame,
    spans: DataFrame,
    cohorts: Sequence[str],
    measures: Sequence[str] = ("n",),
) -> DataFrame:
    """Sum the daily counts that fall inside a span, as ``patid, cohort, *measures``.

    Patients without such an event have no row. ``spans`` holds ``patid, cohort,
    span_start, span_end`` with disjoint spans per patient and cohort.

    Spans and days are laid on one time line per patient. The latest end among the spans
    started so far tells whether a day is covered, so one sort serves all cohorts and no
    day is paired with any span but its own. Should spans overlap after all, a day inside
    several still counts once.
    """
    spans = spans.filter(F.col("cohort").isin(*cohorts))
    marks = spans.selectExpr(
        "patid",
        "span_start AS day",
        *[f"CASE WHEN cohort = '{c}' THEN span_end END AS {c}_end" for c in cohorts],
    )
    timeline = marks.unionByName(
        daily.select("patid", "day", *measures), allowMissingColumns=True
    )
    # A range frame takes in the spans that start on the very day.
    so_far = "PARTITION BY patid ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    reached = timeline.selectExpr(
        "patid", "day", *measures, *[f"max({c}_end) OVER ({so_far}) AS {c}_end" for c in cohorts]
    ).filter(f"{measures[0]} IS NOT NULL")
    per_patient = reached.groupBy("patid").agg(
        *[
            F.expr(f"CAST(sum({m}) FILTER (WHERE {c}_end >= day) AS LONG) AS {c}_{m}")
            for c in cohorts
            for m in measures
        ]
    )
    by_cohort = [
        f"struct('{c}' AS cohort, {', '.join(f'{c}_{m} AS {m}' for m in measures)})"
        for c in cohorts
    ]
    return per_patient.selectExpr("patid", f"inline(array({', '.join(by_cohort)}))").filter(
        f"{measures[0]} IS NOT NULL"
    )


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    """Number of rows for every combination of the SQL expressions ``by``, as ``count``."""
    return rows.groupBy(*[F.expr(b) for b in by]).agg(F.expr("count(*) AS count"))
