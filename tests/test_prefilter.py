"""Filters by hash lose no partner, and what they let through is compared exactly."""

import random
from collections import Counter

import pytest
from frames import table
from pyspark.sql import functions as F

from stockrecon.operators import integrity
from stockrecon.operators import prefilter as P


def ids(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}")


@pytest.mark.parametrize("kind,low,high", [("long", -(2**63), 2**63 - 1), ("int", -(2**31), 2**31 - 1), ("long", -200, 200)])
def test_number_set_holds_its_numbers_only(spark, kind, low, high):
    draw = random.Random(3)
    values = [draw.randint(low, high) for _ in range(300)] + [low, high]
    others = [draw.randint(low, high) for _ in range(300)]
    words = P.number_set(ids(spark, values, kind), F.col("id")).withColumnRenamed("word", "w")
    asked = ids(spark, values + others, kind)
    found = asked.join(words, P.word_of(F.col("id")) == F.col("w"), "left").where(P.contains(F.col("mask"), F.col("id")))
    held = set(values)
    assert Counter(r["id"] for r in found.collect()) == Counter(v for v in values + others if v in held)


@pytest.mark.parametrize("bits", [6, 12, 24])
def test_hash_set_is_bounded_and_loses_nothing(spark, bits):
    members, rows = ids(spark, range(0, 4000, 2)), ids(spark, range(4000))
    hashed = F.xxhash64("id")
    small = P.hash_set(members.select(hashed.alias("h")), F.col("h"), bits)
    assert small.count() <= 2**bits / 64
    passed = {r["id"] for r in P.may_be_in(rows, small, hashed, bits).collect()}
    left = {r["id"] for r in P.may_be_in(rows, small, hashed, bits, "left_anti").collect()}
    assert passed >= set(range(0, 4000, 2)) and passed | left == set(range(4000)) and not passed & left
    if bits == 24:
        assert len(passed) < 2020


@pytest.mark.parametrize("bits", [6, 24])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_with_repeated_keys_stay(spark, bits, kind):
    draw = random.Random(5)
    values = [draw.randint(-10_000, 10_000) for _ in range(400)] + [None, None]
    rows = ids(spark, values).select(F.col("id").cast(kind))
    passed = Counter(r["id"] for r in P.may_repeat(rows, ["id"], bits).collect())
    counts = Counter(r["id"] for r in rows.collect())
    for value, n in counts.items():
        assert passed[value] == n or (value is not None and n == 1 and passed[value] == 0)


def test_hot_key_and_mixed_keys(spark):
    rows = spark.createDataFrame([(1, "a")] * 500 + [(i, "b") for i in range(500)] + [(None, "c"), (2, None)], "x int, y string")
    for prefilter in (True, False):
        found = integrity.unique_violations(rows, ["x", "y"], "t", prefilter=prefilter)
        assert [tuple(r) for r in found.collect()] == [("Q2", "t", "1, a", "x, y: 500 rows")]
    listed = sorted(r["record_id"] for r in integrity.pk_violations(rows, ["x", "y"], "t").collect())
    assert listed == ["1, a", "2, NULL", "NULL, c"]


def test_days_within_series(spark):
    days = [("2024-01-01", 1), ("2024-01-01", 2), ("1969-12-31", 1), ("2024-03-01", 1), ("2024-01-01", 1), (None, 1)]
    rows = spark.createDataFrame(days, "d string, x int").select("x", F.col("d").cast("date").alias("d"))
    assert [r["record_id"] for r in integrity.unique_violations(rows, ["x", "d"], "t").collect()] == ["1, 2024-01-01"]
    passed = P.may_repeat(rows.dropna(), ["x", "d"]).count()
    assert passed == 2


def test_density(spark):
    assert P.dense(spark.range(100), "id") and not P.dense(spark.range(0, 10_000, 100), "id")
    assert not P.dense(ids(spark, []), "id") and not P.dense(ids(spark, ["a"], "string"), "id")
    assert not P.dense(ids(spark, [-(2**63), 2**63 - 1]), "id")


def test_empty_table(spark):
    assert P.may_repeat(ids(spark, []), ["id"]).isEmpty()
    assert integrity.pk_violations(ids(spark, []), "id").isEmpty()


def test_only_references_of_orders_count_as_booked(spark):
    orders = table(spark, "supplier_orders", [(n, 1, 1, 1, None, None, None, 1, 1) for n in (-3, 0, 5, 63, 64, 2**40, 7, 8, 9)])
    references = ["SUP--3", "SUP-0", "SUP-05", "SUP-64", "SUP-1099511627776", "SUP-7\n", "sup-8", "SUP-9 ", None, "", "SUP-",
                  "SUP-99999999999999999999", "SUP-9999999999999999999"]
    moved = [(i, 1, 1, None, "DELIVERY", 1, r) for i, r in enumerate(references)] + [(50, 1, 1, None, "SALE", 1, "SUP-5")]
    left = integrity.orders_without_movement(orders, table(spark, "movements", moved))
    assert sorted(r["supplier_order_id"] for r in left.collect()) == [5, 7, 8, 9, 63]
