"""Results that join patients with spans to demographic and death rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import DEMOGRAPHIC_EDGES, age_band, completed_years
from cohortspark.operators.containment import histogram
from cohortspark.operators.intervals import latest_spans
from cohortspark.plans.coverage import labelled, of_cohort

# The demographic columns whose values are counted.
CATEGORIES = ("sex", "race", "hispanic")


def age_categories(
    spans: DataFrame, demographic: DataFrame, cohort: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Age band of every patient at the start of the latest span, with columns to ``keep``.

    ``demographic`` has one row per patient; ``duplicate_keys`` finds breaches of that.
    """
    aged = (
        latest_spans(of_cohort(spans, cohort))
        .select("patid", "span_start", "span_end")
        .join(demographic.select("patid", "birth_date", *keep), "patid")
        .selectExpr("*", f"{completed_years('birth_date', 'span_start')} AS age")
    )
    return aged.select(
        "patid",
        F.expr(age_band("age", DEMOGRAPHIC_EDGES)).alias("age_category"),
        "span_start",
        "span_end",
        "birth_date",
        *keep,
    )


def patient_tally(
    spans: DataFrame,
    demographic: DataFrame,
    cohort: str,
    dp_max_date: date,
    variables: Sequence[str] = ("age_category", *CATEGORIES),
) -> DataFrame:
    """Patients by ``variable, value`` and by ``active``: ends the latest span late enough?

    One join serves all variables; ahead of the only further shuffle the rows are down to
    one per value.
    """
    categories = [variable for variable in variables if variable in CATEGORIES]
    people = age_categories(spans, demographic, cohort, categories).withColumn(
        "active", F.col("span_end") >= F.lit(dp_max_date)
    )
    values = people.unpivot(["active"], list(variables), "variable", "value")
    return histogram(values, "variable", "value", "active")


def age_counts(tally: DataFrame, dp: str) -> DataFrame:
    """Patients of a ``patient_tally`` by age band at the start of the latest span."""
    ages = tally.filter("variable = 'age_category'").withColumnRenamed("value", "age_category")
    return labelled(_summed(ages, "age_category"), dp, "age_category", "count")


def active_age_counts(tally: DataFrame, dp: str) -> DataFrame:
    """As ``age_counts``, for the active patients."""
    return age_counts(tally.filter("active"), dp)


def category_counts(tally: DataFrame, dp: str) -> DataFrame:
    """Patients by value of each category; null values are left out."""
    values = tally.filter("variable <> 'age_category' AND value IS NOT NULL")
    return labelled(_summed(values, "variable", "value"), dp, "variable", "value", "count")


def _summed(counts: DataFrame, *by: str) -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("count").alias("count"))


def death_counts(spans: DataFrame, death: DataFrame) -> DataFrame:
    """Number of death rows of the patients of every cohort, as ``cohort, count``.

    All rows count, also several of one patient; they are added up before they meet the
    patients, so a patient with many rows weighs as little in the join as any other.
    """
    per_patient = histogram(death.filter("patid IS NOT NULL"), "patid")
    members = latest_spans(spans).select("patid", "cohort")
    return _summed(members.join(per_patient, "patid"), "cohort")


def deaths(counts: DataFrame, dp: str, cohort: str) -> DataFrame:
    """One cohort's row of ``death_counts``; no row if nobody died."""
    return labelled(of_cohort(counts, cohort), dp, "count")
