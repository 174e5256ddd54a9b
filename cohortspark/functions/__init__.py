"""Expressions shared by the operators and plans.

Most are SQL text: one expression string reaches Spark in one call, a tree of Column
objects in one call per node.
"""

from cohortspark.functions.bands import (
    DEMOGRAPHIC_EDGES,
    MATERNAL_EDGES,
    age_band,
    band_start,
)
from cohortspark.functions.cohorts import COHORTS, cohort_rows, in_cohort
from cohortspark.functions.dates import completed_years, first_date, inclusive_days

__all__ = [
    "COHORTS",
    "DEMOGRAPHIC_EDGES",
    "MATERNAL_EDGES",
    "age_band",
    "band_start",
    "cohort_rows",
    "completed_years",
    "first_date",
    "in_cohort",
    "inclusive_days",
]
