"""Results that count dated events inside spans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import first_date
from cohortspark.operators.containment import daily_counts, histogram, totals_in_spans
from cohortspark.operators.span_index import BROADCAST_LIMIT, broadcast_index, packed, totals_in_index
from cohortspark.plans.coverage import labelled, of_cohort

# Label of every vital sign and the column that holds it, in report order.
VITAL_SIGNS = {"HGT": "ht", "WGT": "wt", "DIA": "diastolic", "SYS": "systolic"}
VITAL_COUNTS = {label: f"count({column})" for label, column in VITAL_SIGNS.items()}


#: The day of an event, as a column or SQL expression, by domain.
EVENT_DAYS = {
    "dispensing": "rxdate",
    "encounter": "adate",
    "lab": first_date("lab_dt", "result_dt", "order_dt"),
    "vitals": "measure_date",
}
SPAN_JOINS = ("auto", "broadcast", "shuffle")


@dataclass(frozen=True)
class SpanJoin:
    """How events meet a stored span index. The caller chooses; sizes never do.

    ``broadcast`` probes the index where events are scanned and shuffles no event, and raises
    ``IndexTooLarge`` for an index beyond ``limit`` bytes. ``shuffle`` brings the events, added up
    by patient and day, to the index and never broadcasts. ``auto`` does so too, but leaves Spark
    its own threshold for small sides.
    """

    kind: str = "auto"
    limit: int = BROADCAST_LIMIT

    def __post_init__(self):
        if self.kind not in SPAN_JOINS:
            raise ValueError(f"span join {self.kind!r}; known: {', '.join(SPAN_JOINS)}")


def dispensing_days(dispensing: DataFrame) -> DataFrame:
    """Dispensings per patient and day."""
    return daily_counts(dispensing, EVENT_DAYS["dispensing"])


def encounter_days(encounter: DataFrame) -> DataFrame:
    """Encounters per patient and day."""
    return daily_counts(encounter, EVENT_DAYS["encounter"])


def lab_days(lab: DataFrame) -> DataFrame:
    """Lab tests per patient and day, dated by test, else result, else order."""
    return daily_counts(lab, EVENT_DAYS["lab"])


def indexed_totals(
    rows: DataFrame,
    day: str,
    index: DataFrame,
    cohorts: Sequence[str],
    join: SpanJoin = SpanJoin(),
    bounds: tuple[date | None, date | None] | None = None,
    measures: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregates of the events inside spans, as ``patid, cohort, *measures``.

    ``index`` is a stored ``span_index``. With ``bounds``, the first and last covered day of
    all patients, other days are left out where the events are read; a plain date column makes
    that a filter of the file scan. ``measures`` as in ``daily_counts``.
    """
    measures = measures or {"n": "count(*)"}
    if bounds and None not in bounds:
        first, last = (f"DATE '{d.isoformat()}'" for d in bounds)
        rows = rows.filter(f"{day} >= {first} AND {day} <= {last}")
    if join.kind == "broadcast":
        probed = broadcast_index(index, cohorts, join.limit)
        dated = rows.withColumn("day", F.expr(day)).filter("patid IS NOT NULL AND day IS NOT NULL")
        return totals_in_index(dated, probed, cohorts, measures)
    daily = daily_counts(rows, day, measures)
    if join.kind == "shuffle":
        daily = daily.hint("merge")
    sums = {name: f"sum({name})" for name in measures}
    return totals_in_index(daily, packed(index, cohorts), cohorts, sums)


def event_histogram(daily: DataFrame, spans: DataFrame, cohorts: Sequence[str]) -> DataFrame:
    """How many patients have how many events inside their spans, per cohort.

    Returns ``cohort, n, count``. One pass over the events serves all cohorts; patients
    without an event inside a span are not counted.
    """
    return histogram(totals_in_spans(daily, spans, cohorts), "cohort", "n")


def event_counts(counts: DataFrame, dp: str, cohort: str, column: str) -> DataFrame:
    """One cohort's rows of ``event_histogram`` with the number of events named ``column``."""
    return labelled(of_cohort(counts, cohort), dp, F.col("n").alias(column), "count")


def vital_sign_counts(vitals: DataFrame, spans: DataFrame, dp: str, cohort: str) -> DataFrame:
    """Measurements inside spans per vital sign, in report order.

    The four signs are counted side by side and turned into rows at the very end.
    """
    daily = daily_counts(vitals, EVENT_DAYS["vitals"], VITAL_COUNTS)
    return vital_sign_rows(totals_in_spans(daily, spans, [cohort], list(VITAL_SIGNS)), dp)


def vital_sign_rows(inside: DataFrame, dp: str) -> DataFrame:
    """The report rows of patients' numbers of measurements by vital sign."""
    counts = inside.agg(*[F.sum(sign).alias(sign) for sign in VITAL_SIGNS])
    rows = ", ".join(
        f"struct({i} AS place, '{sign}' AS vs_type, {sign} AS count)"
        for i, sign in enumerate(VITAL_SIGNS)
    )
    by_sign = counts.selectExpr(f"inline(array({rows}))").filter("count > 0").orderBy("place")
    return labelled(by_sign, dp, "vs_type", "count")
