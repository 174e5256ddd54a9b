"""Spans with one row per patient, for joins that shuffle no span and, on request, no event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An index that is larger than this is not broadcast unless the caller raises the limit.
BROADCAST_LIMIT = 512 << 20

# Order matters: arrays of these structs sort by the first day.
_SPAN = ("span_start", "span_end", "span_id", "prior_end", "covered_days", "is_latest")


class IndexTooLarge(ValueError):
    """A span index is larger than the caller allows a broadcast to be."""


def span_index(spans: DataFrame, cohorts: Sequence[str]) -> DataFrame:
    """One row per patient: ``patid`` and, named after each cohort, its spans in calendar order.

    Spans of one patient and cohort are at least ``GAP_DAYS`` apart, so the arrays are short:
    eight spans a year at most. The spans of ``cohort_spans`` lie by patient already, and are
    not shuffled again.
    """
    fields = ", ".join(_SPAN)
    return spans.groupBy("patid").agg(
        *[
            F.expr(
                f"array_sort(collect_list(struct({fields})) FILTER (WHERE cohort = '{c}')) AS {c}"
            )
            for c in cohorts
        ]
    )


def spans_of(index: DataFrame, cohorts: Sequence[str]) -> DataFrame:
    """The span rows of an index, for the named cohorts. They lie as the index does."""
    fields = ", ".join(f"s.{name} AS {name}" for name in _SPAN)
    listed = [f"transform({c}, s -> struct('{c}' AS cohort, {fields}))" for c in cohorts]
    return index.selectExpr("patid", f"inline(concat({', '.join(listed)}))")


def span_bounds(index: DataFrame, cohorts: Sequence[str]) -> tuple:
    """First and last covered day of all patients; two nulls if there is no span."""
    starts = ", ".join(f"array_min({c}.span_start)" for c in cohorts)
    ends = ", ".join(f"array_max({c}.span_end)" for c in cohorts)
    row = index.selectExpr(
        f"min(array_min(array({starts}))) AS first", f"max(array_max(array({ends}))) AS last"
    ).first()
    return row["first"], row["last"]


def packed(index: DataFrame, cohorts: Sequence[str]) -> DataFrame:
    """What a probe needs: ``patid`` and per cohort the sorted first and last days."""
    days = [f"{c}.span_{end} AS {c}_{end}s" for c in cohorts for end in ("start", "end")]
    return index.selectExpr("patid", *days)


def index_bytes(index: DataFrame, cohorts: Sequence[str]) -> int:
    """Bytes of the packed index in memory, rows and hash table, rounded up."""
    spans = " + ".join(f"8L * size({c})" for c in cohorts)
    row = 64 + 64 * len(cohorts)
    return index.selectExpr(f"coalesce(sum({row}L + {spans}), 0L)").first()[0]


def broadcast_index(
    index: DataFrame, cohorts: Sequence[str], limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """The packed index, marked for broadcast whatever its size, but never beyond ``limit`` bytes.

    ``index`` should be stored, as it is measured first. A larger one raises ``IndexTooLarge``.
    """
    size = index_bytes(index, cohorts)
    if size > limit:
        raise IndexTooLarge(f"the span index takes {size} bytes, {limit} are allowed")
    return F.broadcast(packed(index, cohorts))


def totals_in_index(
    events: DataFrame,
    index: DataFrame,
    cohorts: Sequence[str],
    measures: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregates of the events that fall inside a span, as ``patid, cohort, *measures``.

    The same rows as ``totals_in_spans``. ``events`` holds ``patid, day`` and what the
    ``measures`` (SQL aggregates by name, the number of rows by default) ask for; ``index`` is a
    packed one. A day's span is found by position: the last one that starts by then.

    How the two meet is the caller's choice. A broadcast index (``broadcast_index``) is probed
    where events are scanned, and only sums per patient are shuffled. An index stored by
    patient in buckets keeps its place, and events come to it.
    """
    measures = measures or {"n": "count(*)"}
    # A null array has no last start, a day ahead of all spans none either.
    covered = {
        c: f"coalesce(get({c}_ends, size(filter({c}_starts, s -> s <= day)) - 1) >= day, false)"
        for c in cohorts
    }
    inside = events.join(index, "patid").selectExpr(
        *events.columns, *[f"{found} AS in_{c}" for c, found in covered.items()]
    )
    per_patient = inside.groupBy("patid").agg(
        *[F.expr(f"count_if(in_{c}) AS {c}_rows") for c in cohorts],
        *[
            F.expr(f"{total} FILTER (WHERE in_{c}) AS {c}_{m}")
            for c in cohorts
            for m, total in measures.items()
        ],
    )
    by_cohort = ", ".join(
        f"struct('{c}' AS cohort, {c}_rows AS rows, "
        + ", ".join(f"{c}_{m} AS {m}" for m in measures)
        + ")"
        for c in cohorts
    )
    return (
        per_patient.selectExpr("patid", f"inline(array({by_cohort}))")
        .filter("rows > 0")
        .drop("rows")
    )
