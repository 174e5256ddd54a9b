"""The whole job on seven small tables."""

import os
import time
from datetime import date
from decimal import Decimal

import pytest
from helpers import enrollment, make, rows, stored_scratch

from cohortspark.jobs import side_by_side
from cohortspark.operators import IndexTooLarge
from cohortspark.plans import snapshot as job
from cohortspark.plans.events import SpanJoin
from cohortspark.plans.snapshot import (
    RESULTS,
    DataError,
    needed_domains,
    result_names,
    snapshot,
    write_snapshot,
)
from cohortspark.sources import Scratch, read_manifest

DP = "DP1"
MAX = date(2020, 6, 30)


@pytest.fixture(scope="module")
def tables(spark):
    both = enrollment(
        spark,
        (1, "2020-01-01", "2020-12-31"),
        (1, "2022-01-01", "2022-03-31"),
        (2, "2019-01-01", "2019-12-31"),
    )
    medical = enrollment(spark, (3, "2020-01-01", "2020-12-31"), drugcov="N")
    drug = enrollment(spark, (4, "2020-01-01", "2020-12-31"), medcov="n")
    return {
        "enrollment": both.union(medical).union(drug),
        "demographic": make(
            spark,
            "demographic",
            (1, "1980-01-01", "F", "1", "N"),
            (2, None, "M", "2", None),
            (3, "1990-01-01", "F", "1", "N"),
        ),
        "dispensing": make(
            spark,
            "dispensing",
            (1, "2020-05-01"),
            (1, "2020-05-01"),
            (1, "2021-05-01"),
            (4, "2020-05-01"),
        ),
        "encounter": make(
            spark, "encounter", (1, "2020-05-01"), (2, "2019-12-31"), (3, "2020-05-01")
        ),
        "lab": make(spark, "lab", (1, None, None, "2020-05-01"), (2, None, None, None)),
        "death": make(spark, "death", (1, "2022-04-01"), (3, "2021-01-01"), (3, "2021-01-01")),
        "mil": make(
            spark,
            "mil",
            (1, 10, 100, "IP", 1, 40, "2020-05-01"),
            (2, 20, None, "IP", 1, 12, "2019-05-01"),
        ),
    }


EXPECTED = {
    "enr_pat_covlength_md": [(DP, 365, 1), (DP, 456, 1)],
    "enr_patid_ct_md": [(DP, 2)],
    "enr_pat_covyears_md": [(DP, 2019, 1), (DP, 2020, 1), (DP, 2022, 1)],
    "enr_pat_enrcount_md": [(DP, 1, 1), (DP, 2, 1)],
    "enr_active_patid_ct_md": [(DP, 1)],
    "dem_pat_lstagecount_md": [(DP, "40-44 yrs", 1), (DP, "MISSING", 1)],
    "dem_pat_actagect_md": [(DP, "40-44 yrs", 1)],
    "dem_catvars_md": [
        (DP, "hispanic", "N", 1),
        (DP, "race", "1", 1),
        (DP, "race", "2", 1),
        (DP, "sex", "F", 1),
        (DP, "sex", "M", 1),
    ],
    "dis_pat_rx_md": [(DP, 2, 1)],
    "dis_pat_rx_d": [(DP, 1, 1), (DP, 2, 1)],
    "enc_pat_enccount_md": [(DP, 1, 2)],
    "lab_pat_testct_md": [(DP, 1, 1)],
    "dth_dthct_md": [(DP, 1)],
    "dth_dthct_m": [(DP, 3)],
    "mil_linkage_rates": [
        (DP, "age_category", "10-14 yrs", 1, 0, 0, Decimal("0.000000")),
        (DP, "age_category", "40-44 yrs", 1, 1, 1, Decimal("1.000000")),
        (DP, "birth_type", "1", 2, 1, 1, Decimal("0.500000")),
        (DP, "enctype", "IP", 2, 1, 1, Decimal("0.500000")),
        (DP, "overall", "overall", 2, 1, 1, Decimal("0.500000")),
        (DP, "year", "2019", 1, 0, 0, Decimal("0.000000")),
        (DP, "year", "2020", 1, 1, 1, Decimal("1.000000")),
    ],
}

TYPES = {
    "enr_pat_covlength_md": "dp string, total_length bigint, count bigint",
    "enr_patid_ct_md": "dp string, count bigint",
    "enr_pat_covyears_md": "dp string, year int, count bigint",
    "enr_pat_enrcount_md": "dp string, enr_count bigint, count bigint",
    "enr_active_patid_ct_md": "dp string, count bigint",
    "dem_pat_lstagecount_md": "dp string, age_category string, count bigint",
    "dem_pat_actagect_md": "dp string, age_category string, count bigint",
    "dem_catvars_md": "dp string, variable string, value string, count bigint",
    "dis_pat_rx_md": "dp string, rx_count bigint, count bigint",
    "dis_pat_rx_d": "dp string, rx_count bigint, count bigint",
    "enc_pat_enccount_md": "dp string, enc_count bigint, count bigint",
    "lab_pat_testct_md": "dp string, lab_count bigint, count bigint",
    "dth_dthct_md": "dp string, count bigint",
    "dth_dthct_m": "dp string, count bigint",
    "mil_linkage_rates": "dp string, variable string, value string, deliveries bigint, "
    "linked_deliveries bigint, distinct_infants_linked bigint, linkage_rate decimal(9,6)",
}


def test_all_results(spark, tables, tmp_path):
    before = stored_scratch(spark)
    paths = write_snapshot(tables, str(tmp_path), DP, MAX)
    assert list(paths) == list(EXPECTED) == result_names()
    for name, path in paths.items():
        written = spark.read.parquet(path)
        assert sorted(rows(written)) == sorted(EXPECTED[name])
        types = [f"{f.name} {f.dataType.simpleString()}" for f in written.schema]
        assert ", ".join(types) == TYPES[name]
    assert sorted(f for f in os.listdir(tmp_path) if not f.startswith((".", "_"))) == sorted(EXPECTED)
    manifest = read_manifest(spark, str(tmp_path))
    assert manifest["results"] == list(EXPECTED) and manifest["mode"] == "errorifexists"
    assert not [f for f in os.listdir(tmp_path) if f.startswith(".staging")]
    assert stored_scratch(spark) == before
    lengths = spark.read.parquet(paths["enr_pat_covlength_md"]).collect()
    assert [r["total_length"] for r in lengths] == [365, 456]


def test_vitals_run_only_when_named(spark, tables, tmp_path):
    vitals = make(
        spark,
        "vitals",
        (1, "2020-05-01", 170, None, 80, 120),
        (1, "2021-05-01", 170, 70.5, 80, 120),
        (2, "2019-01-01", None, 60.0, None, 110),
        (9, "2020-05-01", 1, 1.0, 1, 1),
    )
    given = {"enrollment": tables["enrollment"], "vitals": vitals}
    paths = write_snapshot(given, str(tmp_path), DP, MAX, ["vitals"])
    assert list(paths) == [*RESULTS["enrollment"], "vit_pat_vitct_md"]
    written = spark.read.parquet(paths["vit_pat_vitct_md"]).collect()
    assert [tuple(r) for r in written] == [
        (DP, "HGT", 1), (DP, "WGT", 1), (DP, "DIA", 1), (DP, "SYS", 2),
    ]


def test_nothing_is_written_where_one_target_exists(spark, tables, tmp_path, monkeypatch):
    (tmp_path / "enr_patid_ct_md").mkdir()
    monkeypatch.setattr(job, "snapshot", lambda *a: pytest.fail("started"))
    with pytest.raises(FileExistsError, match="enr_patid_ct_md"):
        write_snapshot(tables, str(tmp_path), DP, MAX, ["enrollment"])
    assert os.listdir(tmp_path) == ["enr_patid_ct_md"]


def test_a_failed_write_leaves_nothing(tables, tmp_path, monkeypatch):
    write = job.write_table

    def failing(rows, root, name, *more, **options):
        if name == "enr_pat_enrcount_md":
            raise OSError("disk full")
        return write(rows, root, name, *more, **options)

    monkeypatch.setattr(job, "write_table", failing)
    with pytest.raises(OSError, match="disk full"):
        write_snapshot(tables, str(tmp_path), DP, MAX, ["enrollment"])
    assert os.listdir(tmp_path) == []


def test_a_failing_job_stops_the_others(spark):
    """The slow job would take minutes; its tasks sleep in the JVM."""
    slow = spark.range(0, 400, 1, 4).selectExpr("java_method('java.lang.Thread', 'sleep', 500L)")

    def fail():
        time.sleep(2)
        raise DataError("duplicate")

    begun = time.monotonic()
    with pytest.raises(DataError, match="duplicate"):
        side_by_side(spark, 2, {"slow": lambda: slow.write.format("noop").mode("overwrite").save(),
                                "fails": fail})
    assert time.monotonic() - begun < 20


def test_empty_tables_give_empty_results(spark, tmp_path):
    nothing = {name: make(spark, name) for name in RESULTS}
    for name, path in write_snapshot(nothing, str(tmp_path), DP, MAX).items():
        written = spark.read.parquet(path)
        assert written.count() == 0
        types = [f"{f.name} {f.dataType.simpleString()}" for f in written.schema]
        assert ", ".join(types) == TYPES[name]


def test_linkage_alone_needs_no_other_table(tables, tmp_path):
    paths = write_snapshot({"mil": tables["mil"]}, str(tmp_path), DP, MAX, ["mil"])
    assert list(paths) == ["mil_linkage_rates"]


def test_dependent_domain_brings_enrollment(spark, tables):
    some = {name: tables[name] for name in ("enrollment", "death")}
    with Scratch(spark) as scratch:
        results = snapshot(some, DP, scratch, MAX, ["death"])
        assert list(results) == [*RESULTS["enrollment"], *RESULTS["death"]]
        assert rows(results["dth_dthct_m"]) == EXPECTED["dth_dthct_m"]


def test_domains():
    assert needed_domains() == list(RESULTS)
    assert needed_domains(["lab"]) == ["enrollment", "lab"]
    assert needed_domains(["mil"]) == ["mil"]
    assert len(result_names()) == 15
    assert needed_domains(["vitals"]) == ["enrollment", "vitals"]
    for wrong in (["labs"], ["lab", "lab"], []):
        with pytest.raises(ValueError):
            needed_domains(wrong)


@pytest.mark.parametrize(
    ("broken", "row", "message"),
    [
        ("demographic", (1, "1980-01-01", "F", "1", "N"), "1 patients"),
        ("mil", (1, 10, 101, "AV", 1, 40, "2020-05-01"), "1 deliveries"),
    ],
)
def test_nothing_is_written_when_a_check_fails(spark, tables, tmp_path, broken, row, message):
    before = stored_scratch(spark)
    dirty = {**tables, broken: tables[broken].union(make(spark, broken, row))}
    with pytest.raises(DataError, match=message):
        write_snapshot(dirty, str(tmp_path), DP, MAX)
    assert os.listdir(tmp_path) == []
    assert stored_scratch(spark) == before


def test_arguments_are_checked(spark, tables):
    with Scratch(spark) as scratch:
        with pytest.raises(ValueError, match="dp"):
            snapshot(tables, " ", scratch)
        with pytest.raises(ValueError, match="no table lab"):
            snapshot({"enrollment": tables["enrollment"]}, DP, scratch, domains=["lab"])


def test_overwrite_and_partitions(spark, tables, tmp_path):
    root = str(tmp_path)
    write_snapshot(tables, root, DP, MAX, ["mil"])
    with pytest.raises(Exception, match="(?i)exists"):
        write_snapshot(tables, root, DP, MAX, ["mil"])
    paths = write_snapshot(tables, root, "DP2", MAX, ["mil"], mode="overwrite", partitions=2)
    written = spark.read.parquet(paths["mil_linkage_rates"])
    assert {r["dp"] for r in written.collect()} == {"DP2"}
    assert written.count() == len(EXPECTED["mil_linkage_rates"])


def test_span_joins_give_the_same_results(spark, tables, tmp_path):
    for kind in ("auto", "broadcast", "shuffle"):
        paths = write_snapshot(
            tables, f"{tmp_path}/{kind}", DP, MAX, ["dispensing", "encounter", "lab"],
            span_join=SpanJoin(kind),
        )
        for name, path in paths.items():
            assert sorted(rows(spark.read.parquet(path))) == sorted(EXPECTED[name])
    with pytest.raises(ValueError, match="hash"):
        SpanJoin("hash")


def test_too_large_an_index_stops_the_job(tables, tmp_path):
    with pytest.raises(IndexTooLarge, match="100 are allowed"):
        write_snapshot(
            tables, str(tmp_path), DP, MAX, ["lab"], span_join=SpanJoin("broadcast", 100)
        )
    assert os.listdir(tmp_path) == []


def test_a_failed_overwrite_leaves_the_former_results(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_snapshot(tables, root, DP, MAX, ["enrollment"])
    write = job.write_table

    def failing(rows, folder, name, *more, **options):
        if name == "enr_pat_enrcount_md":
            raise OSError("disk full")
        return write(rows, folder, name, *more, **options)

    monkeypatch.setattr(job, "write_table", failing)
    with pytest.raises(OSError, match="disk full"):
        write_snapshot(tables, root, "DP2", MAX, ["enrollment"], mode="overwrite")
    for name in RESULTS["enrollment"]:
        assert {r["dp"] for r in spark.read.parquet(f"{root}/{name}").collect()} == {DP}


def test_a_result_that_comes_up_meanwhile_is_kept(spark, tables, tmp_path, monkeypatch):
    root, build = str(tmp_path), job.snapshot

    def slow(*given, **options):
        spark.range(3).write.parquet(f"{root}/enr_pat_enrcount_md")
        return build(*given, **options)

    monkeypatch.setattr(job, "snapshot", slow)
    with pytest.raises(FileExistsError, match="enr_pat_enrcount_md"):
        write_snapshot(tables, root, DP, MAX, ["enrollment"])
    assert [f for f in os.listdir(root) if not f.startswith("_")] == ["enr_pat_enrcount_md"]
    assert spark.read.parquet(f"{root}/enr_pat_enrcount_md").count() == 3


def test_ignore_keeps_what_is_there(spark, tables, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/enr_patid_ct_md")
    write_snapshot(tables, root, DP, MAX, ["enrollment"], mode="ignore")
    assert spark.read.parquet(f"{root}/enr_patid_ct_md").count() == 3
    assert rows(spark.read.parquet(f"{root}/enr_pat_enrcount_md")) == EXPECTED["enr_pat_enrcount_md"]
    assert "enr_patid_ct_md" not in read_manifest(spark, root)["results"]
    with pytest.raises(ValueError, match="append"):
        write_snapshot(tables, root, DP, MAX, ["enrollment"], mode="append")
