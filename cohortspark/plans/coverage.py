"""Results that need enrollment spans only.

All functions take the span table of ``cohort_spans`` and read it once without a further
shuffle of patients: each span row carries its patient's running figures.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.containment import histogram
from cohortspark.operators.intervals import latest_spans, year_runs


def labelled(rows: DataFrame, dp: str, *columns: str | Column) -> DataFrame:
    """Put the request id in front of the columns."""
    return rows.select(F.lit(dp).alias("dp"), *columns)


def of_cohort(spans: DataFrame, cohort: str) -> DataFrame:
    """Spans of one cohort."""
    return spans.filter(F.col("cohort") == cohort)


def covered_days(spans: DataFrame, dp: str, cohort: str) -> DataFrame:
    """How many patients have how many covered days in all."""
    totals = histogram(latest_spans(of_cohort(spans, cohort)), "covered_days AS total_length")
    return labelled(totals, dp, "total_length", "count")


def patients(spans: DataFrame, dp: str, cohort: str) -> DataFrame:
    """Number of patients with a span; no row if there is none."""
    return labelled(_total(latest_spans(of_cohort(spans, cohort))), dp, "count")


def active_patients(spans: DataFrame, dp: str, cohort: str, dp_max_date: date) -> DataFrame:
    """Number of patients with any span that ends on or after a day."""
    # The latest span ends last, so it decides for all of a patient's spans.
    active = latest_spans(of_cohort(spans, cohort)).filter(F.col("span_end") >= F.lit(dp_max_date))
    return labelled(_total(active), dp, "count")


def _total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.expr("count(*) AS count")).filter("count > 0")


def span_counts(spans: DataFrame, dp: str, cohort: str) -> DataFrame:
    """How many patients have how many spans."""
    counts = histogram(latest_spans(of_cohort(spans, cohort)), "span_id AS enr_count")
    return labelled(counts, dp, "enr_count", "count")


def patients_by_year(spans: DataFrame, dp: str, cohort: str) -> DataFrame:
    """Number of patients covered on at least one day of each calendar year.

    Counts the runs of years that begin and end instead of one row per patient and year, so
    coverage without an end (9999-12-31) costs no more than any other. Behind the first
    aggregation there is one row per year at most.
    """
    turns = year_runs(of_cohort(spans, cohort)).selectExpr(
        "inline(array(struct(first_year AS year, 1 AS change),"
        " struct(last_year + 1 AS year, -1 AS change)))"
    )
    levels = (
        turns.groupBy("year")
        .agg(F.sum("change").alias("change"))
        .selectExpr(
            "year",
            "lead(year) OVER (ORDER BY year) AS following",
            "sum(change) OVER (ORDER BY year) AS count",
        )
        .filter("count > 0")
    )
    years = levels.selectExpr("explode(sequence(year, following - 1)) AS year", "count")
    return labelled(years, dp, "year", "count")
