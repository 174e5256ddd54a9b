"""Which coverage rows belong to which cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The coverage flags every cohort asks for.
COHORTS = {
    "m": ("medcov",),
    "md": ("medcov", "drugcov"),
    "d": ("drugcov",),
}


def in_cohort(cohort: str) -> str:
    """SQL predicate on enrollment rows: every flag of the cohort is a yes in either case.

    ``IN ('y', 'Y')`` accepts what ``lower(flag) = 'y'`` does, and unlike it reaches the
    Parquet scan as a pushed filter.
    """
    try:
        flags = COHORTS[cohort]
    except KeyError:
        raise ValueError(f"no cohort {cohort!r}; known: {', '.join(COHORTS)}") from None
    return " AND ".join(f"{flag} IN ('y', 'Y')" for flag in flags)


def cohort_rows(enrollment: DataFrame, cohort: str) -> DataFrame:
    """The enrollment rows of one cohort."""
    return enrollment.filter(in_cohort(cohort))
