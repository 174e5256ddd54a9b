"""DataFrame-to-DataFrame operators."""

from cohortspark.operators.checks import delivery_conflicts, duplicate_keys
from cohortspark.operators.compare import (
    compare_snapshots,
    compare_tables,
    differing_rows,
    summarize,
)
from cohortspark.operators.containment import daily_counts, histogram, totals_in_spans
from cohortspark.operators.deliveries import delivery_grain
from cohortspark.operators.intervals import (
    GAP_DAYS,
    bridge_intervals,
    clean_intervals,
    cohort_spans,
    covered_years,
    latest_spans,
)
from cohortspark.operators.span_index import (
    IndexTooLarge,
    broadcast_index,
    packed,
    span_bounds,
    span_index,
    spans_of,
    totals_in_index,
)

__all__ = [
    "GAP_DAYS",
    "IndexTooLarge",
    "bridge_intervals",
    "broadcast_index",
    "clean_intervals",
    "cohort_spans",
    "compare_snapshots",
    "compare_tables",
    "covered_years",
    "daily_counts",
    "delivery_conflicts",
    "delivery_grain",
    "differing_rows",
    "duplicate_keys",
    "histogram",
    "latest_spans",
    "packed",
    "span_bounds",
    "span_index",
    "spans_of",
    "summarize",
    "totals_in_index",
    "totals_in_spans",
]
