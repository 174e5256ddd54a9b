"""Comparison of tables and of snapshots."""

import math
from decimal import Decimal

import numpy as np
import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortspark.operators import compare_snapshots, compare_tables, differing_rows, summarize
from cohortspark.operators.matching import assignable
from cohortspark.sources import write_table

COUNTS = "dp string, count long"
RATES = "name string, rate double"


def status(spark, ours, theirs, schema=COUNTS, tolerance=0.0, **how):
    pair = [spark.createDataFrame(side, schema) for side in (ours, theirs)]
    return compare_tables(*pair, tolerance, **how)["status"]


def test_order_does_not_matter_but_copies_do(spark):
    assert status(spark, [("a", 1), ("b", 2)], [("b", 2), ("a", 1)]) == "exact_match"
    assert status(spark, [("a", 1), ("a", 1)], [("a", 1)]) == "value_difference"
    assert status(spark, [("a", 1), ("a", 1), ("b", 1)], [("a", 1), ("b", 1), ("b", 1)]) == (
        "value_difference"
    )


def test_empty_tables_and_nulls_are_equal(spark):
    assert status(spark, [], []) == "exact_match"
    assert status(spark, [(None, None)], [(None, None)]) == "exact_match"
    assert status(spark, [(None, None)], [(None, 0)], tolerance=1.0) == "value_difference"


def test_tolerance(spark):
    ours, theirs = [("a", 100), ("b", 7)], [("b", 7), ("a", 101)]
    assert status(spark, ours, theirs) == "value_difference"
    assert status(spark, ours, theirs, tolerance=1.0) == "numeric_tolerance_match"
    assert status(spark, ours, theirs, tolerance=0.5) == "value_difference"
    assert status(spark, [("a", 1)], [("b", 1)], tolerance=5.0) == "value_difference"


def test_tolerance_pairs_rows_in_order(spark):
    """Equal rows of both tables may still have to pair with others."""
    ours, theirs = [("a", 1.0), ("a", 2.0)], [("a", 2.0), ("a", 3.0)]
    assert status(spark, ours, theirs, RATES, 1.0) == "numeric_tolerance_match"
    assert status(spark, ours, theirs, RATES, 0.9) == "value_difference"


def test_not_a_number_equals_itself_only(spark):
    assert status(spark, [("a", math.nan)], [("a", math.nan)], RATES) == "exact_match"
    assert status(spark, [("a", math.nan)], [("a", 1.0)], RATES, 9.0) == "value_difference"
    ours, theirs = [("a", math.nan), ("b", 1.0)], [("a", math.nan), ("b", 1.5)]
    assert status(spark, ours, theirs, RATES, 1.0) == "numeric_tolerance_match"


def test_decimals_have_tolerance_and_a_scale(spark):
    ours, theirs = [("a", Decimal("0.5"))], [("a", Decimal("0.500001"))]
    schema = "n string, r decimal(9,6)"
    assert status(spark, ours, theirs, schema, 0.000001) == "numeric_tolerance_match"
    assert status(spark, ours, theirs, schema, 0.0000005) == "value_difference"
    narrow = spark.createDataFrame(ours, "n string, r decimal(8,6)")
    wide = spark.createDataFrame(ours, schema)
    outcome = compare_tables(narrow, wide)
    assert outcome["status"] == "schema_difference"
    assert outcome["details"] == "r is decimal(8,6), reference has decimal(9,6)"


def test_large_numbers_keep_their_last_digit(spark):
    ours, theirs = [("a", 2**60), ("b", 2**63 - 1)], [("a", 2**60 + 3), ("b", 2**63 - 1)]
    assert status(spark, ours, theirs, tolerance=2.0) == "value_difference"
    assert status(spark, ours, theirs, tolerance=3.0) == "numeric_tolerance_match"
    ours, theirs = [("a", 2**63 - 1)], [("a", -(2**63))]
    assert status(spark, ours, theirs, tolerance=3.0) == "value_difference"


def test_schema_differences(spark):
    ours = spark.createDataFrame([("a", 1)], "dp string, count long")
    theirs = spark.createDataFrame([("a", 1)], "dp string, total long")
    outcome = compare_tables(ours, theirs)
    assert outcome["status"] == "schema_difference"
    assert outcome["details"] == "count only in actual; total only in reference"


def test_column_order_does_not_matter(spark):
    ours = spark.createDataFrame([("a", 1)], "dp string, count long")
    assert compare_tables(ours, ours.select("count", "dp"))["status"] == "exact_match"


def test_surplus_rows(spark):
    ours = spark.createDataFrame([("a", 1)] * 3 + [("b", 2)], COUNTS)
    theirs = spark.createDataFrame([("a", 1), ("c", 3)], COUNTS)
    assert rows(differing_rows(ours, theirs)) == [("a", 1, 2), ("b", 2, 1), ("c", 3, -1)]


def sorted_pairs_agree(ours, theirs, tolerance):
    pairs = zip(sorted(ours), sorted(theirs))
    return len(ours) == len(theirs) and all(
        a[0] == b[0] and abs(a[1] - b[1]) <= tolerance for a, b in pairs
    )


cells = st.tuples(st.sampled_from("ab"), st.integers(0, 6))
pairs = st.lists(st.tuples(cells, st.sampled_from([-1, 0, 0, 1])), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, st.booleans())
def test_tiles_agree_with_sorting_everything(spark, pairs, spoil):
    ours = [cell for cell, _ in pairs]
    theirs = [(name, n + shift) for (name, n), shift in pairs]
    if spoil and theirs:
        theirs[0] = (theirs[0][0], theirs[0][1] + 2)
    found = status(spark, ours, theirs, tolerance=1.0, tile_bits=2)
    if sorted(ours) == sorted(theirs):
        assert found == "exact_match"
    elif sorted_pairs_agree(ours, theirs, 1):
        assert found == "numeric_tolerance_match"
    else:
        assert found == "value_difference"


@pytest.mark.parametrize("columns", [("a", "b"), ("b", "a")])
def test_one_varying_number_is_found_in_any_column(spark, columns):
    ours, theirs = [(1.00, 5.0), (1.01, 3.0)], [(1.005, 3.0), (1.006, 5.0)]
    for schema, pair in (("a double, b double", (ours, theirs)), ("b double, a double", (
        [r[::-1] for r in ours], [r[::-1] for r in theirs]))):
        sides = [spark.createDataFrame(side, schema).select(*columns) for side in pair]
        assert compare_tables(*sides, 0.01)["status"] == "numeric_tolerance_match"
        assert compare_tables(*sides, 0.004)["status"] == "value_difference"
    counts = [(10, 1), (11, 2)], [(11, 1), (10, 2)]
    sides = [spark.createDataFrame(s, "rx_count long, count long").select("rx_count", "count")
             for s in counts]
    assert compare_tables(*sides, 1.0)["status"] == "numeric_tolerance_match"


def test_several_varying_numbers_are_matched(spark):
    schema = "k string, x double, y double"
    sides = [spark.createDataFrame(s, schema) for s in ([("a", 1.0, 2.0)], [("a", 1.1, 2.1)])]
    outcome = compare_tables(*sides, 0.2)
    assert outcome["status"] == "numeric_tolerance_match"
    assert "undecided" not in outcome["details"]
    # Sorted by either number, the first rows of both tables do not fit each other.
    ours, theirs = [("a", 0.0, 3.0), ("a", 0.5, 0.0)], [("a", 0.4, 0.1), ("a", 0.6, 3.1)]
    assert status(spark, ours, theirs, schema, 0.7) == "numeric_tolerance_match"
    assert status(spark, ours, theirs, schema, 0.5) == "value_difference"


def test_rows_that_vary_in_a_number_of_another_group(spark):
    """Without x the tables are equal, yet rows pair only across values of y."""
    ours, theirs = [(0, 0), (10, 1)], [(10, 0), (0, 1)]
    assert status(spark, ours, theirs, "x long, y long", 1.0) == "numeric_tolerance_match"


def brute_force(ours, theirs, tolerance):
    """Augmenting paths over single rows."""
    taken = {}

    def near(a, b):
        return all(x == y or (x is not None and y is not None and abs(x - y) <= tolerance)
                   if not isinstance(x, str) else x == y for x, y in zip(a, b))

    def place(i, seen):
        for j, b in enumerate(theirs):
            if j not in seen and near(ours[i], b):
                seen.add(j)
                if j not in taken or place(taken[j], seen):
                    taken[j] = i
                    return True
        return False

    return len(ours) == len(theirs) and all(place(i, set()) for i in range(len(ours)))


small = st.one_of(st.none(), st.integers(0, 4))
shift = st.sampled_from([-1, 0, 0, 1, 1, 2])


@pytest.mark.parametrize("kind", ["long", "double", "decimal(9,2)"])
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("ab"), small, small, small, shift, shift, shift), max_size=14),
    st.integers(2, 3),
    st.randoms(use_true_random=False),
)
def test_matching_agrees_with_brute_force(spark, kind, cases, varying, dice):
    make = {"long": int, "double": float, "decimal(9,2)": Decimal}[kind]
    ours = [(k, *[None if v is None else make(v) for v in (x, y, z)]) for k, x, y, z, *_ in cases]
    theirs = [
        (row[0], *[v if v is None or i >= varying else v + s for i, (v, s) in enumerate(zip(row[1:], case[4:]))])
        for row, case in zip(ours, cases)
    ]
    dice.shuffle(theirs)
    schema = f"k string, x {kind}, y {kind}, z {kind}"
    expected = "numeric_tolerance_match" if brute_force(ours, theirs, 1) else "value_difference"
    if sorted(map(str, ours)) == sorted(map(str, theirs)):
        expected = "exact_match"
    assert status(spark, ours, theirs, schema, 1.0) == expected


def test_large_blocks_are_paired_by_order_or_left_open(spark):
    ours = [(i, i, "k") for i in range(40)]
    theirs = [(i + 1, i + 1, "k") for i in range(40)]
    schema = "x long, y long, k string"
    theirs[7] = (8, 11, "k")
    pair = [spark.createDataFrame(side, schema) for side in (ours, theirs)]
    outcome = compare_tables(*pair, 1.0, match_rows=3)
    assert outcome["status"] == "value_difference" and "undecided" in outcome["details"]
    assert "undecided" not in compare_tables(*pair, 1.0)["details"]


def test_numbers_without_end_match_their_like(spark):
    inf, nan = math.inf, math.nan
    schema = "x double, y float"
    ours = [(inf, 1.0), (-inf, 1.5), (nan, 2.0), (1.0, nan), (None, 3.0)]
    theirs = [(nan, 2.1), (inf, 1.1), (None, 3.1), (-inf, 1.6), (1.2, nan)]
    assert status(spark, ours, theirs, schema, 0.25) == "numeric_tolerance_match"
    theirs[1] = (-inf, 1.1)
    assert status(spark, ours, theirs, schema, 0.25) == "value_difference"


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.randoms(use_true_random=False))
def test_assignment_with_copies(n, m, dice):
    near = np.array([[dice.random() < 0.5 for _ in range(m)] for _ in range(n)])
    supply = np.array([dice.randint(1, 4) for _ in range(n)])
    demand = np.zeros(m, np.int64)
    for _ in range(supply.sum()):
        demand[dice.randrange(m)] += 1
    ours = [i for i in range(n) for _ in range(supply[i])]
    theirs = [j for j in range(m) for _ in range(demand[j])]
    taken = {}

    def place(a, seen):
        for b, j in enumerate(theirs):
            if b not in seen and near[ours[a], j]:
                seen.add(b)
                if b not in taken or place(taken[b], seen):
                    taken[b] = a
                    return True
        return False

    assert assignable(near, supply, demand) == all(place(a, set()) for a in range(len(ours)))


def test_decimals_whose_difference_overflows_are_not_close(spark):
    sides = ([("a", Decimal("9" * 38))], [("a", Decimal("-" + "9" * 38))])
    assert status(spark, *sides, "n string, r decimal(38,0)", 1.0) == "value_difference"


numbers = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=12
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(numbers, st.lists(st.tuples(*[st.sampled_from([0, 0, 1])] * 3), min_size=12, max_size=12))
def test_order_of_columns_never_changes_the_status(spark, rows, shifts):
    moved = [tuple(x + s for x, s in zip(r, shift)) for r, shift in zip(rows, shifts)]
    schema = "p long, q long, r long"
    ours, theirs = (spark.createDataFrame(side, schema) for side in (rows, moved))
    found = {
        compare_tables(ours.select(*order), theirs, 1.0)["status"]
        for order in (("p", "q", "r"), ("r", "p", "q"), ("q", "r", "p"))
    }
    assert len(found) == 1


def test_many_copies_of_one_row_spread_over_tiles(spark):
    ours = [("a", 1)] * 500 + [("b", i) for i in range(50)]
    theirs = [("a", 1)] * 499 + [("a", 2)] + [("b", i) for i in range(50)]
    assert status(spark, ours, theirs, tolerance=1.0, tile_bits=3) == "numeric_tolerance_match"
    theirs[499] = ("a", 3)
    assert status(spark, ours, theirs, tolerance=1.0, tile_bits=3) == "value_difference"


def test_snapshots(spark, tmp_path):
    ours, theirs = str(tmp_path / "ours"), str(tmp_path / "theirs")
    tables = {
        "same": ([("a", 1)], [("a", 1)]),
        "near": ([("a", 10)], [("a", 11)]),
        "far": ([("a", 10)], [("a", 19)]),
        "mine": ([("a", 1)], None),
        "yours": (None, [("a", 1)]),
    }
    for name, sides in tables.items():
        for root, side in zip((ours, theirs), sides):
            if side:
                write_table(spark.createDataFrame(side, COUNTS), root, name)
    outcomes = compare_snapshots(spark, ours, theirs, tables, tolerance=1.0)
    assert {r["name"]: r["status"] for r in outcomes.collect()} == {
        "same": "exact_match",
        "near": "numeric_tolerance_match",
        "far": "value_difference",
        "mine": "missing_reference",
        "yours": "missing_actual",
    }
    totals = summarize(outcomes).first().asDict()
    assert totals.pop("schema_difference") == 0
    assert totals.pop("equivalent") is False
    assert set(totals.values()) == {1}
    every = compare_snapshots(spark, ours, theirs)
    assert {r["status"] for r in every.collect()} == {"missing_actual"} and every.count() == 15
    good = compare_snapshots(spark, ours, theirs, ["same", "near"], tolerance=1.0)
    assert summarize(good).first()["equivalent"] is True


def test_unreadable_table_is_an_error(spark, tmp_path):
    for side in ("ours", "theirs"):
        (tmp_path / side / "t").mkdir(parents=True)
        (tmp_path / side / "t" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        compare_snapshots(spark, str(tmp_path / "ours"), str(tmp_path / "theirs"), ["t"])
