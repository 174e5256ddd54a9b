"""Data checks. Each returns its findings as rows; no finding, no row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.deliveries import DELIVERY_ATTRIBUTES, DELIVERY_KEY


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``. Null is a key too."""
    return rows.groupBy(*keys).agg(F.expr("count(*) AS n")).filter("n > 1")


def delivery_conflicts(grain: DataFrame) -> DataFrame:
    """Deliveries with more than one value, null included, in some attribute.

    Takes the result of ``delivery_grain``, where such a delivery has several rows, and
    tells which attributes disagree.
    """
    disagreeing = [
        f"coalesce(min({a}) <> max({a}), false) OR count({a}) NOT IN (0, count(*)) AS {a}_differs"
        for a in DELIVERY_ATTRIBUTES
    ]
    return (
        grain.groupBy(*DELIVERY_KEY)
        .agg(F.expr("count(*) AS versions"), *map(F.expr, disagreeing))
        .filter("versions > 1")
        .drop("versions")
    )
