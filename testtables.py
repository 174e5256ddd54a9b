"""Health-plan tables derived from the driver's test tables, for queries, bench and tests.

Every definition is one SQL text for both engines. ``{add(day, n)}``-style helpers cover the
only difference, which is date arithmetic and the name of the text type.
"""

from __future__ import annotations

from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DP = "DEMO"
DP_MAX_DATE = date(2000, 6, 30)


def _spark_add(day: str, days: str) -> str:
    return f"date_add({day}, CAST({days} AS INT))"


def _duckdb_add(day: str, days: str) -> str:
    return f"CAST({day} + CAST({days} AS INTEGER) AS DATE)"


def _definitions(add, text: str, stamp: str) -> dict[str, str]:
    ordered = "CAST(o_orderdate AS DATE)"
    epoch = "DATE '1996-01-01'"
    return {
        # A few intervals end before they start, some lack the patient or a date.
        "enrollment": f"""
            SELECT CASE WHEN o_orderkey % 61 <> 0 THEN o_custkey END AS patid,
                   CASE WHEN o_orderkey % 67 <> 0 THEN {ordered} END AS enr_start,
                   CASE WHEN o_orderkey % 71 <> 0
                        THEN {add(ordered, "o_orderkey % 400 - 5")} END AS enr_end,
                   CASE WHEN o_orderstatus = 'P' THEN 'n'
                        WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'y' END AS medcov,
                   CASE WHEN o_orderkey % 5 = 0 THEN 'N' ELSE 'y' END AS drugcov
            FROM orders""",
        "demographic": f"""
            SELECT c_custkey AS patid,
                   CASE WHEN c_custkey % 23 = 0 THEN NULL
                        ELSE {add("DATE '1912-03-01'", "(c_custkey * 7919) % 33000")}
                   END AS birth_date,
                   CASE WHEN c_custkey % 37 = 0 THEN NULL
                        WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
                   substr(c_mktsegment, 1, 1) AS race,
                   CASE c_nationkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'U' END AS hispanic
            FROM customer""",
        "dispensing": """
            SELECT o_custkey AS patid,
                   CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS rxdate
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "encounter": f"""
            SELECT user_id AS patid, {add(epoch, "(event_id * 37) % 2000")} AS adate
            FROM events""",
        # A date, a timestamp (without zone, where there is such a type) and a text column.
        "lab": f"""
            SELECT user_id AS patid,
                   CASE WHEN event_id % 4 = 0
                        THEN {add(epoch, "(event_id * 41) % 2000")} END AS lab_dt,
                   CASE WHEN event_id % 3 = 0
                        THEN CAST({add(epoch, "(event_id * 43) % 2000")} AS {stamp})
                   END AS result_dt,
                   CASE WHEN event_id % 11 = 0 THEN 'bad' WHEN event_id % 7 = 0 THEN NULL
                        ELSE CAST({add(epoch, "(event_id * 47) % 2000")} AS {text})
                   END AS order_dt
            FROM events""",
        # Some patients twice: rows are counted, not patients.
        "death": f"""
            SELECT c_custkey AS patid, {add("DATE '2000-01-01'", "c_custkey % 500")} AS deathdt
            FROM customer WHERE c_custkey % 11 = 0
            UNION ALL
            SELECT c_custkey, {add("DATE '2000-01-01'", "c_custkey % 500")}
            FROM customer WHERE c_custkey % 55 = 0""",
        # Some rows lack the mother; each mother has one delivery without an encounter at most.
        "mil": f"""
            SELECT CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey END AS mpatid,
                   o_orderkey AS encounterid,
                   CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_partkey END AS cpatid,
                   o_orderstatus AS enctype,
                   CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 3 END AS INTEGER)
                       AS birth_type,
                   CAST(CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey % 70 - 2 END
                        AS INTEGER) AS age,
                   {ordered} AS adate
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            UNION ALL
            SELECT c_custkey, CAST(NULL AS BIGINT),
                   CASE WHEN c_custkey % 26 <> 0 THEN c_custkey * 3 END, 'IP', 1, 30,
                   DATE '1997-05-05'
            FROM customer WHERE c_custkey % 13 = 0""",
        "vitals": f"""
            SELECT user_id AS patid, {add(epoch, "(event_id * 53) % 2000")} AS measure_date,
                   CASE WHEN event_id % 5 <> 0 THEN 150 + event_id % 50 END AS ht,
                   CASE WHEN event_id % 3 <> 0 THEN 40 + event_id % 90 END AS wt,
                   CASE WHEN event_id % 2 = 0 THEN 60 + event_id % 40 END AS diastolic,
                   CASE WHEN event_id % 2 = 0 THEN 100 + event_id % 60 END AS systolic
            FROM events""",
        # What the checks have to find.
        "demographic_dirty": """
            SELECT * FROM demographic UNION ALL SELECT * FROM demographic WHERE patid % 100 = 0""",
        "mil_dirty": """
            SELECT * FROM mil
            UNION ALL
            SELECT mpatid, encounterid, cpatid, 'X', birth_type, age, adate
            FROM mil WHERE encounterid % 97 = 0
            UNION ALL
            SELECT mpatid, encounterid, cpatid, enctype, birth_type, CAST(NULL AS INTEGER), adate
            FROM mil WHERE encounterid % 89 = 0""",
    }


SPARK_SQL = _definitions(_spark_add, "string", "timestamp_ntz")
DUCKDB_SQL = _definitions(_duckdb_add, "varchar", "timestamp")
SOURCES = {
    "enrollment": ("orders",),
    "demographic": ("customer",),
    "dispensing": ("lineitem", "orders"),
    "encounter": ("events",),
    "lab": ("events",),
    "death": ("customer",),
    "mil": ("lineitem", "orders", "customer"),
    "vitals": ("events",),
    "demographic_dirty": ("demographic",),
    "mil_dirty": ("mil",),
}


@lru_cache(maxsize=64)
def _scan(application: str, spark: SparkSession, path: str) -> DataFrame:
    # Reading a Parquet footer for the schema is a Spark job: once per file will do.
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a lazy plan over the Parquet files of ``sf_dir``."""
    if name not in SOURCES:
        return _scan(spark.sparkContext.applicationId, spark, f"{sf_dir}/{name}.parquet")
    sources = {source: table(spark, sf_dir, source) for source in SOURCES[name]}
    text = SPARK_SQL[name]
    # Bind the sources by name without registering views in the caller's session.
    for source in sources:
        text = text.replace(f"FROM {source}", f"FROM {{{source}}}")
        text = text.replace(f"JOIN {source}", f"JOIN {{{source}}}")
    return spark.sql(text, **sources)


def duckdb_with(*names: str, **queries: str) -> str:
    """WITH clause that defines the named derived tables, then ``queries``, for DuckDB."""
    wanted: dict[str, str] = {}
    for name in names:
        for source in SOURCES[name]:
            if source in SOURCES:
                wanted[source] = DUCKDB_SQL[source]
        wanted[name] = DUCKDB_SQL[name]
    wanted.update(queries)
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in wanted.items()) + "\n"
