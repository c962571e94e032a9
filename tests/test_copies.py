import random
from collections import Counter

import pytest
from frames import at, day, movements, rows, table

from stockrecon.operators import copies

T = "2025-01-01 07:00:00"


def numbers(df):
    return rows(df, "movement_id", "duplicate_number")


def test_triple_copy(spark):
    moved = movements(spark, *[(1, 1, T, "DELIVERY", 5, "SUP-1")] * 3)
    assert numbers(copies.duplicate_movements(moved)) == [(2, 2), (3, 3)]


def test_no_reference_equals_no_reference_and_empty(spark):
    moved = movements(spark, (1, 1, T, "WASTE", 5, None), (1, 1, T, "WASTE", 5, None), (1, 1, T, "WASTE", 5, ""))
    found = copies.duplicate_movements(moved)
    assert rows(found, "movement_id", "reference_id", "duplicate_number") == [(2, None, 2), (3, "", 3)]


@pytest.mark.parametrize(
    "other",
    [
        (1, 1, "2025-01-01 07:00:01", "DELIVERY", 5, "SUP-1"),
        (1, 1, T, "DELIVERY", 5, "SUP-2"),
        (1, 1, T, "DELIVERY", 6, "SUP-1"),
        (1, 1, T, "SALE", 5, "SUP-1"),
        (2, 1, T, "DELIVERY", 5, "SUP-1"),
        (1, 2, T, "DELIVERY", 5, "SUP-1"),
    ],
)
def test_any_difference_is_no_copy(spark, other):
    moved = movements(spark, (1, 1, T, "DELIVERY", 5, "SUP-1"), other)
    assert numbers(copies.duplicate_movements(moved)) == []
    assert numbers(copies.number_duplicates(moved)) == [(1, 1), (2, 1)]


def test_nulls_compare_equal(spark):
    moved = movements(spark, (None, 1, None, "SALE", None, None), (None, 1, None, "SALE", None, None))
    assert numbers(copies.duplicate_movements(moved)) == [(2, 2)]


def test_duplicate_days(spark):
    moved = movements(
        spark,
        *[(1, 1, T, "DELIVERY", 5, "SUP-1")] * 3,
        *[(1, 1, "2025-01-01 09:00:00", "DELIVERY", 5, "SUP-2")] * 2,
        (1, 1, "2025-01-02 09:00:00", "DELIVERY", 5, "SUP-3"),
    )
    assert rows(copies.duplicate_days(moved)) == [(1, 1, day("2025-01-01"), 3)]


@pytest.mark.parametrize("slice_bits", [1, 3, 6, 21])
def test_large_group_in_slices(spark, slice_bits):
    """A third of all rows are copies of one movement; slices must number them like one window."""
    draw = random.Random(7)
    ids = draw.sample(range(-500, 4000), 600)
    kinds = [("SALE", 1)] * 200 + [("SALE", draw.randint(2, 60)) for _ in range(400)]
    draw.shuffle(kinds)
    moved = table(spark, "movements", [(i, 1, 1, at(T), k, q, None) for i, (k, q) in zip(ids, kinds)])
    seen, expected = Counter(), []
    for i, kind in sorted(zip(ids, kinds)):
        seen[kind] += 1
        expected.append((i, seen[kind]))
    assert sorted(numbers(copies.number_duplicates(moved, slice_bits))) == sorted(expected, key=lambda r: (r[0], r[1]))
    surplus = [pair for pair in expected if pair[1] > 1]
    assert sorted(numbers(copies.duplicate_movements(moved, slice_bits))) == sorted(surplus)


def test_sparse_ids_far_apart(spark):
    ids = [-(2**62), -5, 0, 3, 2**40, 2**62]
    moved = table(spark, "movements", [(i, 1, 1, at(T), "SALE", 1, "x") for i in ids])
    found = {i: n for i, n in numbers(copies.number_duplicates(moved, 1))}
    assert found == {i: n for n, i in enumerate(ids, 1)}
