"""Deliveries of the mother-infant linkage table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIVERY_KEY = ["mpatid", "encounterid"]
DELIVERY_ATTRIBUTES = ["enctype", "birth_type", "age", "adate"]


def delivery_grain(mil: DataFrame) -> DataFrame:
    """One row per delivery with its attributes and ``linked``: is any infant known?

    The attributes take part in the grouping key, so all state is of fixed size, rows
    combine ahead of the shuffle, and a delivery whose rows disagree shows as several
    rows (see ``delivery_conflicts``). Rows without a mother are left out. A null encounter
    forms a delivery of its own that never counts as linked.
    """
    return (
        mil.filter("mpatid IS NOT NULL")
        .groupBy(*DELIVERY_KEY, *DELIVERY_ATTRIBUTES)
        .agg(F.expr("max(cpatid IS NOT NULL AND encounterid IS NOT NULL) AS linked"))
    )
