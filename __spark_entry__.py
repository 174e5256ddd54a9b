
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date
from functools import partial, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cohortspark.functions import first_date  # noqa: E402
from cohortspark.jobs import side_by_side  # noqa: E402
from cohortspark.operators import (  # noqa: E402
    bridge_intervals,
    clean_intervals,
    cohort_spans,
    compare_snapshots,
    compare_tables,
    covered_years,
    daily_counts,
    delivery_conflicts,
    delivery_grain,
    differing_rows,
    duplicate_keys,
    latest_spans,
    span_index,
    totals_in_spans,
)
from cohortspark.operators.compare import outcome_frame  # noqa: E402
from cohortspark.plans import coverage, events, linkage, people  # noqa: E402
from cohortspark.plans.events import SpanJoin  # noqa: E402
from cohortspark.plans.snapshot import RESULTS, result_names, snapshot, write_snapshot  # noqa: E402
from cohortspark.sources import Scratch, read_tables, write_table  # noqa: E402
from testtables import DP, DP_MAX_DATE, duckdb_with, table  # noqa: E402

try:  # An optional part: the library works without that folder.
    from cohortspark.llm import registry as optional  # noqa: E402
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("cohortspark.llm", "corpus_pipeline")):
        raise
    optional = None
except ImportError as missing:
    # The folder may be there without its modules, as an empty namespace.
    if missing.name != "cohortspark.llm":
        raise
    optional = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Patients by number of dispensings inside their medical-and-drug spans."""
    return queries()["dis_pat_rx_md"](spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- Spark queries


def _spans(spark: SparkSession, sf_dir: str, *cohorts: str) -> DataFrame:
    return cohort_spans(table(spark, sf_dir, "enrollment"), cohorts or ("md",))


def _from_spans(result: Callable[..., DataFrame], *args: object) -> Query:
    return lambda spark, d: result(_spans(spark, d), DP, "md", *args)


def _from_people(result: Callable[..., DataFrame], *variables: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        demographic = table(spark, d, "demographic")
        tally = people.patient_tally(_spans(spark, d), demographic, "md", DP_MAX_DATE, variables)
        return result(tally, DP)

    return query


def _from_events(name: str, days: Callable[[DataFrame], DataFrame], cohort: str, column: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        counts = events.event_histogram(
            days(table(spark, d, name)), _spans(spark, d, cohort), [cohort]
        )
        return events.event_counts(counts, DP, cohort, column)

    return query


def _deaths(cohort: str) -> Query:
    return lambda spark, d: people.deaths(
        people.death_counts(_spans(spark, d, cohort), table(spark, d, "death")), DP, cohort
    )


def _linkage_rates(spark: SparkSession, d: str) -> DataFrame:
    mil = table(spark, d, "mil")
    return linkage.linkage_rates(delivery_grain(mil), mil, DP)


def _bridge(cohort: str) -> Query:
    return lambda spark, d: _spans(spark, d, cohort).select(
        "patid", "span_id", "span_start", "span_end"
    )


def _lab_test_dt(spark: SparkSession, d: str) -> DataFrame:
    dated = table(spark, d, "lab").select(
        "patid", F.expr(first_date("lab_dt", "result_dt", "order_dt")).alias("test_dt")
    )
    return dated.groupBy("patid", "test_dt").agg(F.count("*").alias("n"))


def _delivery_grain(spark: SparkSession, d: str) -> DataFrame:
    # Numbers as text: clients differ in how they show an integer column with nulls.
    numbers = {c: F.col(c).cast("string") for c in ("birth_type", "age")}
    return delivery_grain(table(spark, d, "mil")).withColumns(numbers)


def _dispensing_in_window(spark: SparkSession, d: str) -> DataFrame:
    days = daily_counts(table(spark, d, "dispensing"), "rxdate")
    totals = totals_in_spans(days, _spans(spark, d), ["md"])
    return totals.select("patid", F.col("n").alias("total"))


def _dispensing_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """The same rows, from events that are probed where they are read."""
    index = Scratch(spark).save("index", span_index(_spans(spark, d), ["md"]))
    dispensing = table(spark, d, "dispensing")
    totals = events.indexed_totals(dispensing, "rxdate", index, ["md"], SpanJoin("broadcast"))
    return totals.select("patid", F.col("n").alias("total"))


def _written_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of every row in written results: by file, then by place in the file."""
    folder, spans = Scratch(spark).path, _spans(spark, d)
    dispensed = events.event_histogram(
        events.dispensing_days(table(spark, d, "dispensing")), spans, ["md"]
    )
    results = {
        "enr_pat_covlength_md": (coverage.covered_days(spans, DP, "md"), ["total_length"]),
        "dis_pat_rx_md": (events.event_counts(dispensed, DP, "md", "rx_count"), ["rx_count"]),
        "mil_linkage_rates": (_linkage_rates(spark, d), ["variable", "value"]),
    }
    found = []
    for name, (rows, keys) in results.items():
        path = write_table(rows, folder, name, partitions=3, order_by=keys)
        placed = spark.read.parquet(path).select(
            F.lit(name).alias("output"),
            F.concat_ws("|", *keys).alias("key"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )
        in_files = Window.partitionBy("output").orderBy("file", "row")
        found.append(placed.withColumn("place", F.row_number().over(in_files).cast("long")))
    return reduce(DataFrame.unionByName, found).select("output", "place", "key")


def _prices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def _compare_status(spark: SparkSession, d: str) -> DataFrame:
    prices = _prices(spark, d)

    def shifted(amount: str) -> DataFrame:
        return prices.withColumn("o_totalprice", F.expr(f"o_totalprice + {amount}"))

    others = {
        "same": (prices.repartition("o_totalprice"), 0.0),
        "near": (shifted("0.004"), 0.01),
        "near_exact": (shifted("0.004"), 0.0),
        "far": (shifted("CASE WHEN o_orderkey % 1000 = 0 THEN 5.0 ELSE 0.004 END"), 0.01),
        "repeated": (prices.union(prices.filter("o_orderkey % 100 = 0")), 0.01),
        "retyped": (prices.withColumn("o_totalprice", F.col("o_totalprice").cast("float")), 0.01),
    }
    comparisons = {
        name: partial(compare_tables, prices, other, tolerance)
        for name, (other, tolerance) in others.items()
    }
    # Two whole numbers of which the first by name varies, in either order of columns; rows of
    # one order all agree otherwise, so that only the right pairing shows the match.
    lines = table(spark, d, "lineitem").selectExpr("l_linenumber AS a", "l_orderkey AS b")
    moved = lines.selectExpr("a + 1L AS a", "b")
    kept = lines.selectExpr("CAST(a AS LONG) AS a", "b")
    comparisons |= {
        "first_varies": partial(compare_tables, kept, moved, 1.0),
        "first_varies_reordered": partial(compare_tables, kept.select("b", "a"), moved, 1.0),
        "first_varies_too_far": partial(compare_tables, kept, moved, 0.5),
    }
    # Two numbers vary, and sorted by either, rows meet others than those they came from.
    parts = table(spark, d, "lineitem").selectExpr(*_TWO_NUMBERS)
    comparisons |= {
        f"two_vary_{name}": partial(compare_tables, parts, parts.selectExpr(*moved), 2.0)
        for name, moved in _TWO_MOVED.items()
    }
    outcomes = side_by_side(spark, 4, comparisons)
    return outcome_frame(spark, outcomes).drop("details")


# Rows of one key and mode lie 100 apart in q or 10 in p; every other one moves in q, the rest in p.
_TWO_NUMBERS = (
    "l_orderkey % 50 AS k",
    "l_returnflag AS mode",
    "CAST(l_linenumber AS DOUBLE) * 10 AS p",
    "l_orderkey * 100 AS q",
)
_TWO_MOVED = {
    "near": ("k", "mode", "p + CASE WHEN q % 200 = 0 THEN 1.5 ELSE 0 END AS p",
             "q + CASE WHEN q % 200 = 0 THEN 0L ELSE 2L END AS q"),
    "far": ("k", "mode", "p + CASE WHEN q % 200 = 0 THEN 1.5 ELSE 0 END AS p",
            "q + CASE WHEN q % 7000 = 0 THEN 3L ELSE 2L END AS q"),
}


def _differing_rows(spark: SparkSession, d: str) -> DataFrame:
    prices = _prices(spark, d)
    other = prices.union(prices.filter("o_orderkey % 100 = 0")).filter("o_orderkey % 77 <> 0")
    return differing_rows(prices, other)


def _vitals(spark: SparkSession, d: str) -> DataFrame:
    """The domain that only runs on request."""
    tables = {name: table(spark, d, name) for name in ("enrollment", "vitals")}
    results = snapshot(tables, DP, Scratch(spark), DP_MAX_DATE, ["vitals"])
    return results["vit_pat_vitct_md"]


def _long(name: str, rows: DataFrame) -> DataFrame:
    """A result as rows of output, its leading columns in one text, its last column."""
    *keys, last = rows.columns
    return rows.select(
        F.lit(name).alias("output"),
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("keys"),
        F.col(last).cast("double").alias("measure"),
    )


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The whole job: read, check, build and write all results, then read them back, stacked."""
    folder = Scratch(spark).path
    stored = {name: write_table(table(spark, d, name), f"{folder}/in", name) for name in RESULTS}
    tables = read_tables(spark, RESULTS, stored)
    paths = write_snapshot(tables, f"{folder}/out", DP, DP_MAX_DATE, partitions=2)
    results = [_long(name, spark.read.parquet(path)) for name, path in paths.items()]
    return reduce(DataFrame.unionByName, results)


_LATER = date(2000, 9, 30)
_FIRST_RUN, _SECOND_RUN = ("enrollment", "mil"), ("enrollment", "death")


def _compare_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Two written runs: the second is for a later date, with deaths and without deliveries."""
    folder = Scratch(spark).path
    names = {*_FIRST_RUN, *_SECOND_RUN}
    tables = {name: table(spark, d, name) for name in names}
    write_snapshot(tables, f"{folder}/one", DP, DP_MAX_DATE, _FIRST_RUN)
    write_snapshot(tables, f"{folder}/two", DP, _LATER, _SECOND_RUN)
    names = result_names(names)
    return compare_snapshots(spark, f"{folder}/one", f"{folder}/two", names).drop("details")


def _bridge_all(spark: SparkSession, d: str) -> DataFrame:
    spans = bridge_intervals(table(spark, d, "enrollment"))
    return spans.select("patid", "span_id", "span_start", "span_end")


def queries() -> dict[str, Query]:
    """Every result table and operator as a query over the given tables."""
    return {
        "enr_pat_covlength_md": _from_spans(coverage.covered_days),
        "enr_patid_ct_md": _from_spans(coverage.patients),
        "enr_pat_covyears_md": _from_spans(coverage.patients_by_year),
        "enr_pat_enrcount_md": _from_spans(coverage.span_counts),
        "enr_active_patid_ct_md": _from_spans(coverage.active_patients, DP_MAX_DATE),
        "dem_pat_lstagecount_md": _from_people(people.age_counts, "age_category"),
        "dem_pat_actagect_md": _from_people(people.active_age_counts, "age_category"),
        "dem_catvars_md": _from_people(people.category_counts, *people.CATEGORIES),
        "dis_pat_rx_md": _from_events("dispensing", events.dispensing_days, "md", "rx_count"),
        "dis_pat_rx_d": _from_events("dispensing", events.dispensing_days, "d", "rx_count"),
        "enc_pat_enccount_md": _from_events("encounter", events.encounter_days, "md", "enc_count"),
        "lab_pat_testct_md": _from_events("lab", events.lab_days, "md", "lab_count"),
        "dth_dthct_md": _deaths("md"),
        "dth_dthct_m": _deaths("m"),
        "mil_linkage_rates": _linkage_rates,
        "vit_pat_vitct_md": _vitals,
        "snapshot": _snapshot,
        "clean_intervals": lambda spark, d: clean_intervals(table(spark, d, "enrollment")),
        "bridge_m": _bridge("m"),
        "bridge_md": _bridge("md"),
        "bridge_d": _bridge("d"),
        "cohort_spans": lambda spark, d: _spans(spark, d, "m", "md", "d"),
        "latest_span_md": lambda spark, d: latest_spans(_spans(spark, d)).select(
            "patid", "span_start", "span_end"
        ),
        "patient_years_md": lambda spark, d: covered_years(_spans(spark, d)),
        "age_category_md": lambda spark, d: people.age_categories(
            _spans(spark, d), table(spark, d, "demographic"), "md"
        ),
        "lab_test_dt": _lab_test_dt,
        "dispensing_in_window_md": _dispensing_in_window,
        "dispensing_in_window_broadcast": _dispensing_broadcast,
        "written_order": _written_order,
        "delivery_grain": _delivery_grain,
        "demographic_duplicates": lambda spark, d: duplicate_keys(
            table(spark, d, "demographic_dirty"), "patid"
        ),
        "delivery_conflicts": lambda spark, d: delivery_conflicts(
            delivery_grain(table(spark, d, "mil_dirty"))
        ),
        "differing_rows": _differing_rows,
        "compare_status": _compare_status,
        "compare_snapshots": _compare_snapshots,
        "bridge_intervals": _bridge_all,
        **(optional.queries() if optional else {}),
    }


# ------------------------------------------------------------- DuckDB counterparts

_COVERED = {
    "m": "lower(medcov) = 'y'",
    "md": "lower(medcov) = 'y' AND lower(drugcov) = 'y'",
    "d": "lower(drugcov) = 'y'",
    "all": "true",
}


def _spans_sql(cohort: str) -> str:
    """Spans by numbering the islands between long gaps."""
    return f"""
        SELECT patid, island AS span_id, min(enr_start) AS span_start, max(enr_end) AS span_end
        FROM (
            SELECT *, CAST(sum(opens) OVER (PARTITION BY patid ORDER BY enr_start, enr_end
                                            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island
            FROM (
                SELECT *, CASE WHEN enr_start <= max(enr_end) OVER (
                              PARTITION BY patid ORDER BY enr_start, enr_end
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 46
                          THEN 0 ELSE 1 END AS opens
                FROM (SELECT DISTINCT patid, enr_start, enr_end FROM enrollment
                      WHERE {_COVERED[cohort]} AND enr_end >= enr_start AND patid IS NOT NULL)))
        GROUP BY patid, island"""


_LATEST_SQL = """
    SELECT patid, span_start, span_end FROM (
        SELECT *, row_number() OVER (PARTITION BY patid
                                     ORDER BY span_start DESC, span_end DESC) AS place
        FROM spans) WHERE place = 1"""

_YEARS_SQL = """
    SELECT DISTINCT patid, CAST(y AS INTEGER) AS year
    FROM spans, LATERAL unnest(range(year(span_start), year(span_end) + 1)) AS t(y)"""


def _bands_sql(age: str, edges: list[int]) -> str:
    """Age bands by counting whole bands below the age."""
    whens = "".join(
        f" WHEN {age} BETWEEN {low} AND {high - 1} THEN '{low}-{high - 1} yrs'"
        for low, high in zip(edges, edges[1:])
    )
    return (
        f"CASE WHEN {age} IS NULL THEN 'MISSING' WHEN {age} < 0 THEN 'NEGATIVE'{whens}"
        f" ELSE '{edges[-1]}+ yrs' END"
    )


def _aged_sql(active_from: str | None = None) -> str:
    months = """(year(s) - year(b)) * 12 + month(s) - month(b)
        - CASE WHEN day(s) < day(b) AND NOT (s = last_day(s) AND b = last_day(b))
               THEN 1 ELSE 0 END"""
    bands = _bands_sql("age", [0, 2, *range(5, 81, 5)])
    active = f"WHERE span_end >= DATE '{active_from}'" if active_from else ""
    return f"""
        SELECT patid, {bands} AS age_category, s AS span_start, span_end, b AS birth_date
        FROM (SELECT patid, s, span_end, b, floor(({months}) / 12.0) AS age
              FROM (SELECT patid, span_start AS s, span_end, birth_date AS b
                    FROM latest JOIN demographic USING (patid) {active}))"""


def _counts_sql(rows: str, *by: str) -> str:
    groups = ", ".join(["dp", *by])
    return (
        f"SELECT {groups}, count(*) AS count"
        f" FROM (SELECT '{DP}' AS dp, * FROM ({rows})) GROUP BY {groups}"
    )


def _inside_sql(events_table: str, day: str) -> str:
    return f"""
        SELECT e.patid, count(*) AS total
        FROM (SELECT *, {day} AS happened FROM {events_table}) AS e
        JOIN spans AS s ON e.patid = s.patid AND happened BETWEEN span_start AND span_end
        GROUP BY e.patid"""


_LAB_DAY_SQL = (
    "coalesce(CAST(lab_dt AS DATE), CAST(result_dt AS DATE), try_cast(order_dt AS DATE))"
)

_GRAIN_SQL = """
    SELECT mpatid, encounterid, any_value(enctype) AS enctype, any_value(birth_type) AS birth_type,
           any_value(age) AS age, any_value(adate) AS adate,
           count(DISTINCT cpatid) FILTER (WHERE encounterid IS NOT NULL) > 0 AS linked
    FROM mil WHERE mpatid IS NOT NULL GROUP BY mpatid, encounterid"""


def _linkage_sql() -> str:
    dimensions = {
        "overall": "'overall'",
        "age_category": _bands_sql("age", [0, 2, *range(5, 56, 5)]),
        "enctype": "enctype",
        "year": "CAST(year(adate) AS VARCHAR)",
        "birth_type": "CAST(birth_type AS VARCHAR)",
    }
    dims = " UNION ALL ".join(
        f"SELECT '{name}' AS variable, coalesce({value}, 'MISSING') AS value,"
        " mpatid, encounterid, linked FROM grain"
        for name, value in dimensions.items()
    )
    return f"""
        SELECT '{DP}' AS dp, variable, value, deliveries, linked_deliveries,
               distinct_infants_linked,
               CAST(linked_deliveries / deliveries AS DECIMAL(9,6)) AS linkage_rate
        FROM (SELECT variable, value, count(*) AS deliveries,
                     count(*) FILTER (WHERE linked) AS linked_deliveries
              FROM ({dims}) GROUP BY variable, value)
        JOIN (SELECT variable, value, count(DISTINCT cpatid) AS distinct_infants_linked
              FROM ({dims}) LEFT JOIN mil USING (mpatid, encounterid)
              GROUP BY variable, value) USING (variable, value)"""


def _categories_sql() -> str:
    members = "FROM demographic WHERE patid IN (SELECT patid FROM spans)"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {c} AS value {members} AND {c} IS NOT NULL"
        for c in ("sex", "race", "hispanic")
    )


def _results_sql(dp_max_date: date = DP_MAX_DATE) -> dict[str, tuple[str, str, str]]:
    """Result name -> derived tables besides enrollment, cohort of the spans, SQL."""
    active = dp_max_date.isoformat()
    days = "SELECT patid, CAST(sum(span_end - span_start + 1) AS BIGINT) AS total_length"
    return {
        "enr_pat_covlength_md": (
            "", "md", _counts_sql(f"{days} FROM spans GROUP BY patid", "total_length"),
        ),
        "enr_patid_ct_md": ("", "md", _counts_sql("SELECT DISTINCT patid FROM spans")),
        "enr_pat_covyears_md": ("", "md", _counts_sql(_YEARS_SQL, "year")),
        "enr_pat_enrcount_md": (
            "", "md",
            _counts_sql("SELECT patid, count(*) AS enr_count FROM spans GROUP BY patid",
                        "enr_count"),
        ),
        "enr_active_patid_ct_md": (
            "", "md",
            _counts_sql(f"SELECT DISTINCT patid FROM spans WHERE span_end >= DATE '{active}'"),
        ),
        "dem_pat_lstagecount_md": (
            "demographic", "md", _counts_sql(_aged_sql(), "age_category"),
        ),
        "dem_pat_actagect_md": (
            "demographic", "md", _counts_sql(_aged_sql(active), "age_category"),
        ),
        "dem_catvars_md": (
            "demographic", "md", _counts_sql(_categories_sql(), "variable", "value"),
        ),
        "dis_pat_rx_md": (
            "dispensing", "md",
            _counts_sql(f"SELECT total AS rx_count FROM ({_inside_sql('dispensing', 'rxdate')})",
                        "rx_count"),
        ),
        "dis_pat_rx_d": (
            "dispensing", "d",
            _counts_sql(f"SELECT total AS rx_count FROM ({_inside_sql('dispensing', 'rxdate')})",
                        "rx_count"),
        ),
        "enc_pat_enccount_md": (
            "encounter", "md",
            _counts_sql(f"SELECT total AS enc_count FROM ({_inside_sql('encounter', 'adate')})",
                        "enc_count"),
        ),
        "lab_pat_testct_md": (
            "lab", "md",
            _counts_sql(f"SELECT total AS lab_count FROM ({_inside_sql('lab', _LAB_DAY_SQL)})",
                        "lab_count"),
        ),
        "dth_dthct_md": (
            "death", "md",
            _counts_sql("SELECT patid FROM death WHERE patid IN (SELECT patid FROM spans)"),
        ),
        "dth_dthct_m": (
            "death", "m",
            _counts_sql("SELECT patid FROM death WHERE patid IN (SELECT patid FROM spans)"),
        ),
        "mil_linkage_rates": ("mil", "", _linkage_sql()),
    }


def _with_spans(cohort: str, *tables: str) -> str:
    return duckdb_with("enrollment", *tables, spans=_spans_sql(cohort), latest=_LATEST_SQL)


def _result_sql(tables: str, cohort: str, body: str) -> str:
    if not cohort:
        return duckdb_with(tables, grain=_GRAIN_SQL) + body
    return _with_spans(cohort, *tables.split()) + body


# Leading columns of every result, in order; its last column is the measure.
_KEYS = {
    "enr_pat_covlength_md": "total_length",
    "enr_pat_covyears_md": "year",
    "enr_pat_enrcount_md": "enr_count",
    "dem_pat_lstagecount_md": "age_category",
    "dem_pat_actagect_md": "age_category",
    "dem_catvars_md": "variable, value",
    "dis_pat_rx_md": "rx_count",
    "dis_pat_rx_d": "rx_count",
    "enc_pat_enccount_md": "enc_count",
    "lab_pat_testct_md": "lab_count",
    "mil_linkage_rates": "variable, value, deliveries, linked_deliveries, distinct_infants_linked",
}


def _snapshot_sql() -> str:
    parts = []
    for name, (tables, cohort, body) in _results_sql().items():
        keys = ", ".join(filter(None, ["dp", _KEYS.get(name)]))
        measure = "linkage_rate" if name == "mil_linkage_rates" else "count"
        parts.append(
            f"SELECT '{name}' AS output, concat_ws('|', {keys}) AS keys,"
            f" CAST({measure} AS DOUBLE) AS measure"
            f" FROM ({_result_sql(tables, cohort, body)})"
        )
    return "\nUNION ALL\n".join(parts)


def _conflicts_sql() -> str:
    attributes = ("enctype", "birth_type", "age", "adate")
    differs = {a: f"count(DISTINCT struct_pack(x := {a})) > 1" for a in attributes}
    columns = ", ".join(f"{test} AS {a}_differs" for a, test in differs.items())
    return (
        f"SELECT mpatid, encounterid, {columns} FROM mil_dirty WHERE mpatid IS NOT NULL"
        f" GROUP BY mpatid, encounterid HAVING {' OR '.join(differs.values())}"
    )


_PRICES_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def _compare_sql() -> str:
    """Multiset differences by EXCEPT ALL, tolerance by pairing equal sorted positions."""
    near = "SELECT o_orderkey, o_orderstatus, o_totalprice + 0.004 AS o_totalprice FROM orders"
    far = near.replace("+ 0.004", "+ CASE WHEN o_orderkey % 1000 = 0 THEN 5.0 ELSE 0.004 END")
    repeated = f"{_PRICES_SQL} UNION ALL {_PRICES_SQL} WHERE o_orderkey % 100 = 0"
    cases = {
        "same": (_PRICES_SQL, "0.0"),
        "near": (near, "0.01"),
        "near_exact": (near, "0.0"),
        "far": (far, "0.01"),
        "repeated": (repeated, "0.01"),
    }
    ranked = "row_number() OVER (ORDER BY o_orderstatus, o_orderkey, o_totalprice) AS place"
    parts = []
    for name, (other, tolerance) in cases.items():
        parts.append(f"""
            SELECT '{name}' AS name,
                   CASE WHEN a = 0 AND b = 0 THEN 'exact_match'
                        WHEN {tolerance} > 0 AND unlike = 0 THEN 'numeric_tolerance_match'
                        ELSE 'value_difference' END AS status,
                   a AS only_actual, b AS only_reference
            FROM (SELECT
                (SELECT count(*) FROM (({_PRICES_SQL}) EXCEPT ALL ({other}))) AS a,
                (SELECT count(*) FROM (({other}) EXCEPT ALL ({_PRICES_SQL}))) AS b,
                (SELECT count(*) FROM (SELECT *, {ranked} FROM ({_PRICES_SQL})) AS p
                 FULL JOIN (SELECT *, {ranked} FROM ({other})) AS q USING (place)
                 WHERE (p.o_orderstatus = q.o_orderstatus
                        AND abs(p.o_orderkey - q.o_orderkey) <= {tolerance}
                        AND abs(p.o_totalprice - q.o_totalprice) <= CAST({tolerance} AS DOUBLE))
                       IS NOT TRUE) AS unlike)""")
    parts.append("""
        SELECT 'retyped', 'schema_difference', CAST(0 AS BIGINT), CAST(0 AS BIGINT)""")
    # All lines of an order agree in b, so shifted lines match if sorted ones do within b.
    parts.append("""
        SELECT name,
               CASE WHEN unlike = 0 THEN 'numeric_tolerance_match' ELSE 'value_difference' END,
               surplus, surplus
        FROM (VALUES ('first_varies', 1.0), ('first_varies_reordered', 1.0),
                     ('first_varies_too_far', 0.5)) AS t(name, tolerance),
             LATERAL (SELECT
                (SELECT count(*) FROM (
                    SELECT l_linenumber, l_orderkey FROM lineitem
                    EXCEPT ALL SELECT l_linenumber + 1, l_orderkey FROM lineitem)) AS surplus,
                (SELECT count(*) FROM (
                    SELECT l_orderkey, l_linenumber AS a,
                           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
                    FROM lineitem) AS p JOIN (
                    SELECT l_orderkey, l_linenumber + 1 AS a,
                           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
                    FROM lineitem) AS q USING (l_orderkey, place)
                 WHERE abs(p.a - q.a) > tolerance) AS unlike)""")
    # Moved rows are 2 apart at most, all others 10 or more in p or 100 in q, so a row matches
    # if it has as many neighbours in the other table as equals in its own.
    for name, moved in _TWO_MOVED.items():
        rows = "(SELECT " + ", ".join(_TWO_NUMBERS) + " FROM lineitem)"
        theirs = f"(SELECT {', '.join(m.replace('L ', ' ') for m in moved)} FROM {rows})"
        parts.append(f"""
            SELECT 'two_vary_{name}',
                   CASE WHEN unlike = 0 THEN 'numeric_tolerance_match' ELSE 'value_difference' END,
                   (SELECT count(*) FROM (FROM {rows} EXCEPT ALL FROM {theirs})),
                   (SELECT count(*) FROM (FROM {theirs} EXCEPT ALL FROM {rows}))
            FROM (SELECT count(*) AS unlike FROM (
                SELECT k, mode, p, q, count(*) AS n FROM {rows} GROUP BY ALL) AS a
                LEFT JOIN (SELECT k, mode, p, q, count(*) AS n FROM {theirs} GROUP BY ALL) AS b
                ON a.k = b.k AND a.mode = b.mode AND abs(a.p - b.p) <= 2 AND abs(a.q - b.q) <= 2
                WHERE a.n IS DISTINCT FROM b.n)""")
    return " UNION ALL ".join(parts)


def _differing_sql() -> str:
    other = (
        f"SELECT * FROM ({_PRICES_SQL} UNION ALL {_PRICES_SQL} WHERE o_orderkey % 100 = 0)"
        " WHERE o_orderkey % 77 <> 0"
    )
    columns = "o_orderkey, o_orderstatus, o_totalprice"
    return f"""
        SELECT {columns}, CAST(coalesce(p.n, 0) - coalesce(q.n, 0) AS BIGINT) AS surplus
        FROM (SELECT {columns}, count(*) AS n FROM ({_PRICES_SQL}) GROUP BY ALL) AS p
        FULL JOIN (SELECT {columns}, count(*) AS n FROM ({other}) GROUP BY ALL) AS q
             USING ({columns})
        WHERE coalesce(p.n, 0) <> coalesce(q.n, 0)"""


def _cohort_spans_sql() -> str:
    parts = [
        f"""
        SELECT patid, '{c}' AS cohort, span_id, span_start, span_end,
               lag(span_end) OVER by_date AS prior_end,
               CAST(sum(span_end - span_start + 1) OVER by_date AS BIGINT) AS covered_days,
               span_id = max(span_id) OVER (PARTITION BY patid) AS is_latest
        FROM ({_spans_sql(c)}) WINDOW by_date AS (PARTITION BY patid ORDER BY span_start)"""
        for c in ("m", "md", "d")
    ]
    return duckdb_with("enrollment") + " UNION ALL ".join(parts)


def _compare_snapshots_sql() -> str:
    """The results of both runs, computed and held against each other row by row."""
    one = {name: _results_sql()[name] for name in result_names(_FIRST_RUN)}
    two = {name: _results_sql(_LATER)[name] for name in result_names(_SECOND_RUN)}
    parts = []
    for name in result_names({*_FIRST_RUN, *_SECOND_RUN}):
        if name in one and name in two:
            ours, theirs = f"({_result_sql(*one[name])})", f"({_result_sql(*two[name])})"
            status = "CASE WHEN a = 0 AND b = 0 THEN 'exact_match' ELSE 'value_difference' END"
            surplus = (
                f"(SELECT (SELECT count(*) FROM ({ours} EXCEPT ALL {theirs})) AS a,"
                f" (SELECT count(*) FROM ({theirs} EXCEPT ALL {ours})) AS b)"
            )
        else:
            status = "'missing_reference'" if name in one else "'missing_actual'"
            surplus = "(SELECT CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b)"
        parts.append(
            f"SELECT '{name}' AS name, {status} AS status, a AS only_actual, b AS only_reference"
            f" FROM {surplus}"
        )
    return "\nUNION ALL\n".join(parts)


def _written_order_sql() -> str:
    """Positions in the order of the key columns."""
    keys = {
        "enr_pat_covlength_md": ["total_length"],
        "dis_pat_rx_md": ["rx_count"],
        "mil_linkage_rates": ["variable", "value"],
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS output, row_number() OVER (ORDER BY {', '.join(by)}) AS place,"
        f" concat_ws('|', {', '.join(by)}) AS key FROM ({_result_sql(*_results_sql()[name])})"
        for name, by in keys.items()
    )


def _vitals_sql() -> str:
    signs = {"HGT": "ht", "WGT": "wt", "DIA": "diastolic", "SYS": "systolic"}
    long = " UNION ALL ".join(
        f"SELECT patid, measure_date, '{s}' AS vs_type FROM vitals WHERE {c} IS NOT NULL"
        for s, c in signs.items()
    )
    inside = f"""
        SELECT vs_type FROM ({long}) AS v
        JOIN spans AS s ON v.patid = s.patid AND measure_date BETWEEN span_start AND span_end"""
    return _with_spans("md", "vitals") + _counts_sql(inside, "vs_type")


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query."""
    spans = "SELECT patid, span_id, span_start, span_end FROM spans"
    return {
        **{name: _result_sql(*parts) for name, parts in _results_sql().items()},
        "vit_pat_vitct_md": _vitals_sql(),
        "snapshot": _snapshot_sql(),
        "clean_intervals": duckdb_with("enrollment")
        + """SELECT DISTINCT patid, enr_start, enr_end FROM enrollment
             WHERE patid IS NOT NULL AND enr_start <= enr_end""",
        **{f"bridge_{c}": _with_spans(c) + spans for c in ("m", "md", "d")},
        "bridge_intervals": _with_spans("all") + spans,
        "cohort_spans": _cohort_spans_sql(),
        "latest_span_md": _with_spans("md") + "SELECT patid, span_start, span_end FROM latest",
        "patient_years_md": _with_spans("md") + _YEARS_SQL,
        "age_category_md": _with_spans("md", "demographic") + _aged_sql(),
        "lab_test_dt": duckdb_with("lab")
        + f"""SELECT patid, test_dt, count(*) AS n
              FROM (SELECT patid, {_LAB_DAY_SQL} AS test_dt FROM lab) GROUP BY patid, test_dt""",
        "dispensing_in_window_md": _with_spans("md", "dispensing")
        + _inside_sql("dispensing", "rxdate"),
        "dispensing_in_window_broadcast": _with_spans("md", "dispensing")
        + _inside_sql("dispensing", "rxdate"),
        "written_order": _written_order_sql(),
        "delivery_grain": duckdb_with("mil", grain=_GRAIN_SQL)
        + """SELECT mpatid, encounterid, enctype, CAST(birth_type AS VARCHAR) AS birth_type,
                    CAST(age AS VARCHAR) AS age, adate, linked FROM grain""",
        "demographic_duplicates": duckdb_with("demographic_dirty")
        + "SELECT patid, count(*) AS n FROM demographic_dirty GROUP BY patid HAVING count(*) > 1",
        "delivery_conflicts": duckdb_with("mil_dirty") + _conflicts_sql(),
        "differing_rows": _differing_sql(),
        "compare_status": _compare_sql(),
        "compare_snapshots": _compare_snapshots_sql(),
        **(optional.oracle_sql() if optional else {}),
    }
