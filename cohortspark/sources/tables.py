"""Parquet tables in and out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortspark.sources.contracts import CONTRACTS, require_schema
from cohortspark.sources.publish import Publication
from cohortspark.sources.scratch import path_exists

WRITE_MODES = ("errorifexists", "overwrite", "ignore")


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Scan one input table: footer read, schema check, contract columns only."""
    rows = spark.read.parquet(path)
    require_schema(table, rows.schema)
    return rows.select(*CONTRACTS[table])


def read_tables(
    spark: SparkSession, tables: Iterable[str], paths: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Scan every named table once. Paths of tables that are not named may be absent."""
    tables = list(tables)
    absent = [table for table in tables if not paths.get(table)]
    if absent:
        raise ValueError(f"no path for table {', '.join(absent)}")
    return {table: read_table(spark, table, paths[table]) for table in tables}


def write_table(
    rows: DataFrame,
    root: str,
    name: str,
    mode: str = "errorifexists",
    partitions: int = 0,
    order_by: Sequence[str] = (),
    staged: bool = True,
) -> str:
    """Write ``<root>/<name>/`` as Parquet and return that path.

    The files are written beside the target and moved there when all are complete, so a failed
    write leaves what was there before, also with ``overwrite``. ``staged=False`` writes in
    place, for folders that are staged as a whole.

    The table keeps the partitioning Spark gives it unless ``partitions`` asks for a number.
    With ``order_by`` the files in turn hold the rows in that order.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"write mode {mode!r}; known: {', '.join(WRITE_MODES)}")
    if partitions < 0:
        raise ValueError("partitions must not be negative (0 leaves them to Spark)")
    path = f"{root.rstrip('/')}/{name}"
    if partitions and order_by:
        rows = rows.repartitionByRange(partitions, *order_by).sortWithinPartitions(*order_by)
    elif partitions:
        rows = rows.repartition(partitions)
    elif order_by:
        rows = rows.orderBy(*order_by)
    # What is there already is Spark's to refuse or to leave.
    if not staged or (mode != "overwrite" and path_exists(rows.sparkSession, path)):
        rows.write.mode(mode).parquet(path)
        return path
    with Publication(rows.sparkSession, root) as staging:
        rows.write.parquet(f"{staging.path}/{name}")
        staging.publish([name], mode)
    return path
