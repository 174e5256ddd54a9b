"""The snapshot job: all result tables of the chosen domains from shared intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame

from cohortspark.jobs import side_by_side
from cohortspark.operators.checks import delivery_conflicts, duplicate_keys
from cohortspark.operators.containment import histogram
from cohortspark.operators.deliveries import delivery_grain
from cohortspark.operators.intervals import cohort_spans
from cohortspark.operators.span_index import span_bounds, span_index, spans_of
from cohortspark.plans import coverage, events, linkage, people
from cohortspark.plans.events import EVENT_DAYS, SpanJoin
from cohortspark.sources.publish import Publication
from cohortspark.sources.scratch import Scratch, path_exists
from cohortspark.sources.tables import WRITE_MODES, write_table

DP_MAX_DATE = date(2023, 6, 30)

# Domain -> its result tables, and the cohorts a domain needs spans of.
RESULTS = {
    "enrollment": (
        "enr_pat_covlength_md",
        "enr_patid_ct_md",
        "enr_pat_covyears_md",
        "enr_pat_enrcount_md",
        "enr_active_patid_ct_md",
    ),
    "demographic": ("dem_pat_lstagecount_md", "dem_pat_actagect_md", "dem_catvars_md"),
    "dispensing": ("dis_pat_rx_md", "dis_pat_rx_d"),
    "encounter": ("enc_pat_enccount_md",),
    "lab": ("lab_pat_testct_md",),
    "death": ("dth_dthct_md", "dth_dthct_m"),
    "mil": ("mil_linkage_rates",),
}
# Only run when named.
ON_REQUEST = {"vitals": ("vit_pat_vitct_md",)}
COHORTS_OF = {
    "enrollment": ("md",),
    "demographic": ("md",),
    "dispensing": ("md", "d"),
    "encounter": ("md",),
    "lab": ("md",),
    "death": ("md", "m"),
    "mil": (),
    "vitals": ("md",),
}


class DataError(ValueError):
    """Input rows break a rule the results rely on."""


def needed_domains(domains: Iterable[str] | None = None) -> list[str]:
    """The domains to run, in a fixed order: all but mil also need enrollment.

    Without a choice, all of ``RESULTS``; those ``ON_REQUEST`` have to be named.
    """
    if domains is None:
        return list(RESULTS)
    domains, known = list(domains), [*RESULTS, *ON_REQUEST]
    unknown = sorted(set(domains) - set(known))
    if unknown:
        raise ValueError(f"no domain {', '.join(unknown)}; known: {', '.join(known)}")
    if len(set(domains)) < len(domains):
        raise ValueError("a domain is named twice")
    if not domains:
        raise ValueError("no domain is selected")
    wanted = set(domains)
    if wanted - {"mil"}:
        wanted.add("enrollment")
    return [domain for domain in known if domain in wanted]


def result_names(domains: Iterable[str] | None = None) -> list[str]:
    """Names of the result tables of the domains, in the order they are built."""
    every = RESULTS | ON_REQUEST
    return [name for domain in needed_domains(domains) for name in every[domain]]


def check_patients(demographic: DataFrame) -> None:
    """Raise ``DataError`` if a patient has several demographic rows."""
    repeated = duplicate_keys(demographic, "patid").count()
    if repeated:
        raise DataError(f"{repeated} patients have several demographic rows")


def check_deliveries(grain: DataFrame) -> None:
    """Raise ``DataError`` if the rows of a delivery disagree about its attributes."""
    conflicting = delivery_conflicts(grain).count()
    if conflicting:
        raise DataError(f"{conflicting} deliveries have conflicting attributes")


def snapshot(
    tables: Mapping[str, DataFrame],
    dp: str,
    scratch: Scratch,
    dp_max_date: date = DP_MAX_DATE,
    domains: Iterable[str] | None = None,
    threads: int = 8,
    span_join: SpanJoin = SpanJoin(),
) -> dict[str, DataFrame]:
    """Check the inputs and build the result tables of the domains.

    Runs in two rounds of jobs. The first checks the inputs and stores the spans of all
    cohorts and the delivery grain in ``scratch``. Spans are stored one row per patient, in
    buckets by patient, as many as a shuffle has partitions: no later join shuffles them again.
    The second round reads every other table, events only of days that anybody is covered on, and
    stores one small tally per domain, which serves all results of that domain. The
    returned plans only read what is stored, so they are cheap to use more than once, but
    have to be used before ``scratch`` is dropped. When one job of a round fails, the others
    are cancelled.
    """
    if not dp.strip():
        raise ValueError("dp must not be empty")
    selected = needed_domains(domains)
    absent = [table for table in selected if table not in tables]
    if absent:
        raise ValueError(f"no table {', '.join(absent)}")
    cohorts = sorted({c for domain in selected for c in COHORTS_OF[domain]})

    def store_grain() -> DataFrame:
        grain = scratch.save("delivery_grain", delivery_grain(tables["mil"]))
        check_deliveries(grain)
        return grain

    def store_spans() -> DataFrame:
        buckets = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
        spans = cohort_spans(tables["enrollment"], cohorts, partitions=buckets)
        return scratch.save_bucketed("spans", span_index(spans, cohorts), "patid", buckets)

    first: dict[str, Callable[[], DataFrame | None]] = {}
    if "enrollment" in selected:
        first["spans"] = store_spans
    if "mil" in selected:
        first["grain"] = store_grain
    if "demographic" in selected:
        first["patients"] = lambda: check_patients(tables["demographic"])
    stored = side_by_side(scratch.spark, threads, first)
    index = stored.get("spans")
    # Of all cohorts, as one filter serves them all.
    bounds = span_bounds(index, cohorts) if set(selected) & set(EVENT_DAYS) else None

    def spans(*cohorts: str) -> DataFrame:
        return spans_of(index, cohorts)

    def counted(domain: str, rows: DataFrame, *cohorts: str) -> DataFrame:
        day = EVENT_DAYS[domain]
        totals = events.indexed_totals(rows, day, index, cohorts, span_join, bounds)
        return histogram(totals, "cohort", "n")

    def tally_of(domain: str) -> DataFrame:
        rows = tables[domain]
        match domain:
            case "demographic":
                return people.patient_tally(spans("md"), rows, "md", dp_max_date)
            case "dispensing":
                return counted(domain, rows, "md", "d")
            case "encounter" | "lab":
                return counted(domain, rows, "md")
            case "death":
                return people.death_counts(spans("md", "m"), rows)
            case "mil":
                return linkage.linkage_rates(stored["grain"], rows, dp)
            case "vitals":
                inside = events.indexed_totals(
                    rows, EVENT_DAYS[domain], index, ["md"], span_join, bounds, events.VITAL_COUNTS
                )
                return events.vital_sign_rows(inside, dp)

    def store_tally(domain: str) -> DataFrame:
        return scratch.save(f"{domain}_tally", tally_of(domain))

    second = {d: partial(store_tally, d) for d in selected if d != "enrollment"}
    tallies = side_by_side(scratch.spark, threads, second)

    results: dict[str, DataFrame] = {}
    if "enrollment" in selected:
        md = spans("md")
        results["enr_pat_covlength_md"] = coverage.covered_days(md, dp, "md")
        results["enr_patid_ct_md"] = coverage.patients(md, dp, "md")
        results["enr_pat_covyears_md"] = coverage.patients_by_year(md, dp, "md")
        results["enr_pat_enrcount_md"] = coverage.span_counts(md, dp, "md")
        results["enr_active_patid_ct_md"] = coverage.active_patients(md, dp, "md", dp_max_date)
    if "demographic" in selected:
        tally = tallies["demographic"]
        results["dem_pat_lstagecount_md"] = people.age_counts(tally, dp)
        results["dem_pat_actagect_md"] = people.active_age_counts(tally, dp)
        results["dem_catvars_md"] = people.category_counts(tally, dp)
    if "dispensing" in selected:
        tally = tallies["dispensing"]
        results["dis_pat_rx_md"] = events.event_counts(tally, dp, "md", "rx_count")
        results["dis_pat_rx_d"] = events.event_counts(tally, dp, "d", "rx_count")
    if "encounter" in selected:
        tally = tallies["encounter"]
        results["enc_pat_enccount_md"] = events.event_counts(tally, dp, "md", "enc_count")
    if "lab" in selected:
        tally = tallies["lab"]
        results["lab_pat_testct_md"] = events.event_counts(tally, dp, "md", "lab_count")
    if "death" in selected:
        tally = tallies["death"]
        results["dth_dthct_md"] = people.deaths(tally, dp, "md")
        results["dth_dthct_m"] = people.deaths(tally, dp, "m")
    if "mil" in selected:
        results["mil_linkage_rates"] = tallies["mil"]
    if "vitals" in selected:
        results["vit_pat_vitct_md"] = tallies["vitals"]
    return results


def write_snapshot(
    tables: Mapping[str, DataFrame],
    root: str,
    dp: str,
    dp_max_date: date = DP_MAX_DATE,
    domains: Iterable[str] | None = None,
    mode: str = "errorifexists",
    partitions: int = 0,
    threads: int = 8,
    span_join: SpanJoin = SpanJoin(),
) -> dict[str, str]:
    """Write every result table to ``<root>/<name>/`` and return the paths by name.

    No result is written before all checks have passed. Rows are ordered by the key columns
    of their table. Up to ``threads`` results are written side by side.

    Results are written to a staging folder and published together (``sources.publish``), in
    every mode all or none: until then, ``overwrite`` leaves the former ones as they are. With
    ``errorifexists`` no job starts if one of the folders is there; one that another run puts
    there meanwhile is kept, and nothing of this run appears. ``ignore`` keeps the results that
    are there.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"write mode {mode!r}; known: {', '.join(WRITE_MODES)}")
    spark = next(iter(tables.values())).sparkSession
    targets = {name: f"{root.rstrip('/')}/{name}" for name in result_names(domains)}
    if mode == "errorifexists":
        taken = [path for path in targets.values() if path_exists(spark, path)]
        if taken:
            raise FileExistsError(f"exists already: {', '.join(taken)}")
    with Scratch(spark) as scratch, Publication(spark, root) as staging:
        results = snapshot(
            tables, dp, scratch, dp_max_date, domains, threads, span_join=span_join
        )

        def writer(name: str) -> Callable[[], str]:
            rows = results[name]
            keys = [column for column in rows.columns if column in SORT_COLUMNS]
            return lambda: write_table(
                rows, staging.path, name, "errorifexists", partitions, keys, staged=False
            )

        side_by_side(spark, threads, {name: writer(name) for name in results})
        staging.publish(results, mode)
    return targets


# The columns results are ordered by, those of each in its column order.
SORT_COLUMNS = {
    "total_length", "year", "enr_count", "age_category", "variable", "value",
    "rx_count", "enc_count", "lab_count",
}
