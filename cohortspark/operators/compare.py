"""Comparing tables as unordered multisets, without bringing rows to the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FractionalType, IntegralType, NumericType

from cohortspark.jobs import side_by_side
from cohortspark.operators.matching import MATCH_ROWS, matched
from cohortspark.sources.scratch import Scratch

# The outcomes of a comparison.
EXACT = "exact_match"
WITHIN_TOLERANCE = "numeric_tolerance_match"
SCHEMA_DIFFERS = "schema_difference"
VALUES_DIFFER = "value_difference"
NO_ACTUAL = "missing_actual"
NO_REFERENCE = "missing_reference"
STATUSES = (EXACT, WITHIN_TOLERANCE, SCHEMA_DIFFERS, VALUES_DIFFER, NO_REFERENCE, NO_ACTUAL)

# One task lines up 2**17 rows of each table at a time.
TILE_BITS = 17


def schema_differences(actual: DataFrame, reference: DataFrame) -> list[str]:
    """Columns of only one table or of another type; precision and scale count as type."""
    ours = {field.name: field.dataType for field in actual.schema}
    theirs = {field.name: field.dataType for field in reference.schema}
    findings = []
    for column in sorted(ours.keys() | theirs.keys()):
        if column not in theirs:
            findings.append(f"{column} only in actual")
        elif column not in ours:
            findings.append(f"{column} only in reference")
        elif ours[column] != theirs[column]:
            findings.append(
                f"{column} is {ours[column].simpleString()}, "
                f"reference has {theirs[column].simpleString()}"
            )
    return findings


def differing_rows(actual: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct rows that occur more often in one table, with ``surplus``.

    Positive: extra copies in ``actual``; negative: in ``reference``. Equal multisets have
    no such row. Copies add up ahead of the single shuffle.
    """
    columns = actual.columns
    signed = actual.withColumn("surplus", F.lit(1)).unionByName(
        reference.withColumn("surplus", F.lit(-1))
    )
    return (
        signed.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter("surplus != 0")
    )


def compare_tables(
    actual: DataFrame,
    reference: DataFrame,
    tolerance: float = 0.0,
    tile_bits: int = TILE_BITS,
    match_rows: int = MATCH_ROWS,
) -> dict[str, object]:
    """Status of one pair of tables, the number of surplus rows of either side and details.

    With a tolerance, numbers may be up to ``tolerance`` apart, everything else has to be
    equal, and the tables match if all rows can be paired so. If some numeric column seems to be
    all that varies (without it, sums over row hashes are equal), rows are first paired in the
    order of that column among rows that agree otherwise. If that does not work out, or several
    columns vary, ``matching.matched`` finds a pairing whenever there is one, but for
    blocks of more than ``match_rows`` distinct rows whose numbers run into each other in
    several columns: those are paired by order, and the details say so if no pairing was found.
    The order of the columns never matters.
    """
    findings = schema_differences(actual, reference)
    if findings:
        return _outcome(SCHEMA_DIFFERS, details="; ".join(findings))

    surplus = F.col("surplus")
    ours, theirs = (
        differing_rows(actual, reference)
        .agg(
            F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)),
            F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)),
        )
        .first()
    )
    if ours == theirs == 0:
        return _outcome(EXACT)
    # Unequal surpluses mean unequal row counts, which no tolerance can make good.
    if tolerance > 0 and ours == theirs:
        with Scratch(actual.sparkSession) as scratch:

            def by_order(left: DataFrame, right: DataFrame, order: list[str]) -> bool:
                return _within(left, right, order, tolerance, tile_bits, scratch)

            for column in _varying_alone(actual, reference):
                order = [c for c in _general_order(actual) if c != column] + [column]
                if by_order(actual, reference, order):
                    return _outcome(WITHIN_TOLERANCE, ours, theirs)

            def near(left: Column, right: Column, kind: DataType) -> Column:
                return _close(left, right, kind, tolerance)

            found = matched(actual, reference, near, tolerance, scratch, by_order, match_rows)
            if found:
                return _outcome(WITHIN_TOLERANCE, ours, theirs)
            counts = _outcome(VALUES_DIFFER, ours, theirs)["details"]
            doubt = "; undecided: large blocks of close rows were paired by order only"
            return _outcome(
                VALUES_DIFFER, ours, theirs, counts + (doubt if found is None else "")
            )
    return _outcome(VALUES_DIFFER, ours, theirs)


def _general_order(table: DataFrame) -> list[str]:
    """Column names, those that are not numeric first, fractions last."""

    def place(f):
        kind = f.dataType
        return isinstance(kind, FractionalType), isinstance(kind, NumericType), f.name

    return [f.name for f in sorted(table.schema, key=place)]


def _varying_alone(actual: DataFrame, reference: DataFrame) -> list[str]:
    """Numeric columns without which the tables seem equal, by sums over hashes of their rows.

    One pass over both tables serves all columns. Equal sums prove nothing, so the caller pairs.
    """
    columns = actual.columns
    numeric = [c for c in _general_order(actual) if isinstance(actual.schema[c].dataType, NumericType)]
    signed = actual.withColumn("sign", F.lit(1)).unionByName(
        reference.withColumn("sign", F.lit(-1))
    )
    sums = []
    for i, column in enumerate(numeric):
        rest = F.xxhash64(*[c for c in columns if c != column], F.lit(0))
        for bits in (40, 16):
            part = F.shiftright(F.shiftleft(rest, 40 - bits), 40)
            sums.append(F.sum(F.col("sign") * part).alias(f"s{i}_{bits}"))
    if not sums:
        return []
    found = signed.agg(*sums).first()
    return [c for i, c in enumerate(numeric) if found[f"s{i}_40"] == found[f"s{i}_16"] == 0]


def _outcome(status: str, ours: int = 0, theirs: int = 0, details: str = "") -> dict[str, object]:
    return {
        "status": status,
        "only_actual": ours,
        "only_reference": theirs,
        "details": details or f"{ours} rows only in actual, {theirs} only in reference",
    }


def _close(left: Column, right: Column, kind: DataType, tolerance: float) -> Column:
    """Cells are equal (null to null, NaN to NaN) or numbers within the tolerance."""
    if not isinstance(kind, NumericType):
        return left.eqNullSafe(right)
    if isinstance(kind, IntegralType):
        # Long differences could overflow, and doubles would round large numbers.
        left, right = left.cast("decimal(20,0)"), right.cast("decimal(20,0)")
    # Decimals too far apart for a decimal have no difference, and are not close.
    near = F.abs(F.try_subtract(left, right)) <= tolerance
    return left.eqNullSafe(right) | F.coalesce(near, F.lit(False))


def _within(
    actual: DataFrame,
    reference: DataFrame,
    order: list[str],
    tolerance: float,
    tile_bits: int,
    scratch: Scratch,
) -> bool:
    """Do two tables of the same length agree at every position, sorted by ``order``?"""
    fields = [actual.schema[column] for column in order]
    row = F.struct(*[F.col(f.name).alias(f"c{i}") for i, f in enumerate(fields)])
    sides = [
        _tiles(table.select(row.alias(name)), name, tile_bits, scratch)
        for name, table in (("ours", actual), ("theirs", reference))
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    # Within a tile, a row holds from its own position up to the next one of its table.
    so_far = (
        Window.partitionBy("tile")
        .orderBy("position")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    aligned = both.select(
        F.last("ours", ignorenulls=True).over(so_far).alias("ours"),
        F.last("theirs", ignorenulls=True).over(so_far).alias("theirs"),
    )
    agree = F.lit(True)
    for i, f in enumerate(fields):
        ours, theirs = F.col(f"ours.c{i}"), F.col(f"theirs.c{i}")
        agree = agree & _close(ours, theirs, f.dataType, tolerance)
    return aligned.filter(~agree).isEmpty()


def _tiles(rows: DataFrame, column: str, tile_bits: int, scratch: Scratch) -> DataFrame:
    """The sorted table cut into tiles of ``2**tile_bits`` positions: ``tile, position, row``.

    Equal rows are one row with a count throughout, so neither a slice of the sort nor a
    tile grows with the copies of a row. A row that reaches into a tile starts there anew.
    """
    spark = rows.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Stored, because a second run of the sort might draw its slices differently.
    sliced = scratch.save(
        column,
        rows.groupBy(column)
        .agg(F.count("*").alias("copies"))
        .repartitionByRange(slices, column)
        .withColumn("slice", F.spark_partition_id()),
    )
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: the broadcast and the unpartitioned window are as small as that.
    offsets = (
        sliced.groupBy("slice")
        .agg(F.sum("copies").alias("rows"))
        .select("slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    )
    within = (
        Window.partitionBy("slice")
        .orderBy(column)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        sliced.withColumn("up_to", F.sum("copies").over(within))
        .join(F.broadcast(offsets), "slice")
        .select(
            column,
            (F.col("offset") + F.col("up_to") - F.col("copies")).alias("first"),
            (F.col("offset") + F.col("up_to") - 1).alias("last"),
        )
    )
    tiles = F.sequence(F.shiftright("first", tile_bits), F.shiftright("last", tile_bits))
    return placed.withColumn("tile", F.explode(tiles)).select(
        "tile", F.greatest("first", F.shiftleft("tile", tile_bits)).alias("position"), column
    )


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def compare_snapshots(
    spark: SparkSession,
    actual_root: str,
    reference_root: str,
    names: Iterable[str] | None = None,
    tolerance: float = 0.0,
    threads: int = 4,
) -> DataFrame:
    """Compare tables below two folders: one row per name with its status.

    Without names, all results that a snapshot writes by default.
    """
    if names is None:
        from cohortspark.plans.snapshot import result_names  # which imports the operators

        names = result_names()

    def outcome(name: str) -> dict[str, object]:
        actual = _stored(spark, f"{actual_root}/{name}")
        reference = _stored(spark, f"{reference_root}/{name}")
        if actual is None:
            return _outcome(NO_ACTUAL, details=f"nothing at {actual_root}/{name}")
        if reference is None:
            return _outcome(NO_REFERENCE, details=f"nothing at {reference_root}/{name}")
        return compare_tables(actual, reference, tolerance)

    outcomes = side_by_side(spark, threads, {name: partial(outcome, name) for name in names})
    return outcome_frame(spark, outcomes)


def outcome_frame(spark: SparkSession, outcomes: Mapping[str, dict[str, object]]) -> DataFrame:
    """Outcomes of ``compare_tables`` by name as a table of one row each."""
    return spark.createDataFrame(
        [{"name": name, **outcome} for name, outcome in outcomes.items()],
        "name string, status string, only_actual long, only_reference long, details string",
    )


def summarize(outcomes: DataFrame) -> DataFrame:
    """Number of tables per status and ``equivalent``: all equal or within tolerance."""
    by_status = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    good = F.count_if(F.col("status").isin(EXACT, WITHIN_TOLERANCE))
    return outcomes.agg(
        *by_status, ((good == F.count("*")) & (good > 0)).alias("equivalent")
    )
