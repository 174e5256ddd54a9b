"""Deliveries and their infants."""

from decimal import Decimal

import pytest
from helpers import make, rows

from cohortspark.operators import delivery_conflicts, delivery_grain, duplicate_keys
from cohortspark.plans.linkage import linkage_rates

DP = "DP1"
DATED = ("IP", 1, 30, "2020-05-01")


def rates(spark, *mil_rows):
    mil = make(spark, "mil", *mil_rows)
    result = linkage_rates(delivery_grain(mil), mil, DP)
    return {(r["variable"], r["value"]): tuple(r)[3:] for r in result.collect()}


def test_repeated_infant_counts_once(spark):
    found = rates(spark, (1, 10, 100, *DATED), (1, 10, 100, *DATED))
    one = (1, 1, 1, Decimal("1.000000"))
    assert found == {
        ("overall", "overall"): one,
        ("age_category", "30-34 yrs"): one,
        ("enctype", "IP"): one,
        ("year", "2020"): one,
        ("birth_type", "1"): one,
    }


def test_twins_and_unlinked_deliveries(spark):
    found = rates(
        spark,
        (1, 10, 100, *DATED),
        (1, 10, 101, *DATED),
        (2, 20, None, *DATED),
        (3, 30, None, *DATED),
        (None, 40, 102, *DATED),
    )
    assert found["overall", "overall"] == (3, 1, 2, Decimal("0.333333"))


def test_infant_of_two_deliveries(spark):
    found = rates(spark, (1, 10, 100, *DATED), (1, 11, 100, "AV", 2, 31, "2021-05-01"))
    assert found["overall", "overall"] == (2, 2, 1, Decimal("1.000000"))
    assert found["age_category", "30-34 yrs"] == (2, 2, 1, Decimal("1.000000"))
    assert found["year", "2020"] == found["year", "2021"] == (1, 1, 1, Decimal("1.000000"))


def test_null_encounter_is_a_delivery_without_link(spark):
    found = rates(spark, (1, None, 100, *DATED), (1, None, 101, *DATED), (2, 20, 102, *DATED))
    assert found["overall", "overall"] == (2, 1, 1, Decimal("0.500000"))


def test_null_attributes_are_labelled(spark):
    found = rates(spark, (1, 10, 100, None, None, None, None))
    assert set(found) == {
        ("overall", "overall"),
        ("age_category", "MISSING"),
        ("enctype", "MISSING"),
        ("year", "MISSING"),
        ("birth_type", "MISSING"),
    }


def test_null_attribute_and_its_label_as_text_fall_together(spark):
    found = rates(spark, (1, 10, 100, "MISSING", 1, 30, None), (2, 20, None, None, 1, 30, None))
    assert found["enctype", "MISSING"] == (2, 1, 1, Decimal("0.500000"))
    found = rates(spark, (1, 10, 100, "MISSING", 1, 30, None), (2, 20, 100, None, 1, 30, None))
    assert found["enctype", "MISSING"] == (2, 2, 1, Decimal("1.000000"))


@pytest.mark.parametrize(
    ("age", "band"),
    [(-1, "NEGATIVE"), (0, "0-1 yrs"), (9, "5-9 yrs"), (54, "50-54 yrs"), (55, "55+ yrs")],
)
def test_maternal_bands(spark, age, band):
    assert ("age_category", band) in rates(spark, (1, 10, 100, "IP", 1, age, "2020-05-01"))


def test_schema_and_empty_input(spark):
    mil = make(spark, "mil")
    result = linkage_rates(delivery_grain(mil), mil, DP)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in result.schema] == [
        "dp string",
        "variable string",
        "value string",
        "deliveries bigint",
        "linked_deliveries bigint",
        "distinct_infants_linked bigint",
        "linkage_rate decimal(9,6)",
    ]
    assert rows(result) == []


def conflicts(spark, *mil_rows):
    return rows(delivery_conflicts(delivery_grain(make(spark, "mil", *mil_rows))))


def test_conflicting_values(spark):
    assert conflicts(
        spark,
        (1, 10, 100, *DATED),
        (1, 10, 101, "AV", 1, 30, "2020-05-02"),
        (2, 20, 102, *DATED),
        (2, 20, 103, *DATED),
    ) == [(1, 10, True, False, False, True)]


def test_null_against_a_value_is_a_conflict(spark):
    assert conflicts(spark, (1, 10, 100, *DATED), (1, 10, 100, "IP", 1, None, "2020-05-01")) == [
        (1, 10, False, False, True, False)
    ]


def test_no_conflict(spark):
    empty = (None, None, None, None)
    assert conflicts(spark, (1, 10, 100, *empty), (1, 10, 101, *empty)) == []
    assert conflicts(spark, (None, 10, 100, *DATED), (None, 10, 100, *empty)) == []


def test_conflict_of_a_null_encounter(spark):
    assert conflicts(spark, (1, None, 1, *DATED), (1, None, 2, "IP", 2, 30, "2020-05-01")) == [
        (1, None, False, True, False, False)
    ]


def test_duplicate_patients(spark):
    person = ("1980-01-01", "F", "1", "N")
    patids = [1, 2, 2, None, None]
    frame = make(spark, "demographic", *[(patid, *person) for patid in patids])
    assert rows(duplicate_keys(frame, "patid")) == [(None, 2), (2, 2)]
