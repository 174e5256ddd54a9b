"""How often deliveries can be linked to infants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import MATERNAL_EDGES, age_band, band_start

# What deliveries are broken down by, and the SQL for the label of a value.
DIMENSIONS = {
    "age_category": age_band("age_category", MATERNAL_EDGES),
    "enctype": "enctype",
    "year": "CAST(year AS STRING)",
    "birth_type": "CAST(birth_type AS STRING)",
}


def _by_dimension(rows: DataFrame, *measures: str) -> DataFrame:
    """Aggregate mil rows overall and by each dimension, as ``variable, value, *measures``.

    Grouping sets expand the rows into one copy per dimension inside the partial
    aggregation. The dimensions stay numbers there; labels are made of the few results.
    """
    prepared = rows.withColumns(
        {
            "age_category": F.expr(band_start("age", MATERNAL_EDGES)),
            # Null and the text MISSING are one value, also when infants are told apart.
            "enctype": F.expr("coalesce(enctype, 'MISSING')"),
            "year": F.expr("year(adate)"),
        }
    )
    names = list(DIMENSIONS)
    tallied = prepared.groupingSets(
        [[], *[[F.col(name)] for name in names]], *names
    ).agg(F.expr("grouping_id() AS grouped"), *[F.expr(m) for m in measures])
    # A bit of grouping_id is 1 for each dimension, first to last, that is summed over.
    every = 2 ** len(names) - 1
    variables = {every - 2 ** (len(names) - 1 - i): name for i, name in enumerate(names)}
    variable = " ".join(f"WHEN {bits} THEN '{name}'" for bits, name in variables.items())
    value = " ".join(f"WHEN {bits} THEN {DIMENSIONS[name]}" for bits, name in variables.items())
    dimensions = [*names, "grouped"]
    return tallied.selectExpr(
        f"CASE grouped WHEN {every} THEN 'overall' {variable} END AS variable",
        f"coalesce(CASE grouped WHEN {every} THEN 'overall' {value} END, 'MISSING') AS value",
        *[c for c in tallied.columns if c not in dimensions],
    )


def linkage_rates(grain: DataFrame, mil: DataFrame, dp: str) -> DataFrame:
    """Deliveries, linked deliveries, distinct infants and the share of linked deliveries.

    Overall and by age band, encounter type, year and birth type. ``grain`` is the
    ``delivery_grain`` of ``mil`` and free of conflicts, so an infant row carries the
    attributes of its delivery and is tallied without looking the delivery up. An infant
    counts once per value, over however many deliveries.
    """
    deliveries = _by_dimension(
        grain, "count(*) AS deliveries", "count_if(linked) AS linked_deliveries"
    )
    infants = _by_dimension(
        mil.filter("mpatid IS NOT NULL AND encounterid IS NOT NULL AND cpatid IS NOT NULL"),
        "count(DISTINCT cpatid) AS distinct_infants_linked",
    )
    # The two tallies have one row per value; adding them up spares a join.
    measures = ["deliveries", "linked_deliveries", "distinct_infants_linked"]
    return (
        deliveries.unionByName(infants, allowMissingColumns=True)
        .groupBy("variable", "value")
        .agg(*[F.expr(f"coalesce(sum({m}), 0L) AS {m}") for m in measures])
        .select(
            F.lit(dp).alias("dp"),
            "variable",
            "value",
            *measures,
            F.expr("CAST(linked_deliveries / deliveries AS DECIMAL(9, 6)) AS linkage_rate"),
        )
    )
