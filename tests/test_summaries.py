"""Sums over stored sets."""

from checks.summaries import summaries


def numbers(spark, rows, schema="id long, day date"):
    return summaries({"set": spark.createDataFrame(rows, schema)}).collect()[0]


def test_sums_beyond_64_bits_keep_their_lowest_bits(spark):
    large = (1 << 62) + 3
    for copies in (1, 2, 3, 4, 9):
        for sign in (1, -1):
            total = sign * copies * large
            expected = (total + (1 << 63)) % (1 << 64) - (1 << 63)
            found = numbers(spark, [(sign * large, None)] * copies)
            assert (found.rows, found.numbers, found.days, found.empty) == (copies, expected, 0, copies)


def test_two_columns_together_pass_64_bits(spark):
    found = numbers(spark, [((1 << 63) - 1, 5)], "a long, b int")
    assert found.numbers == (1 << 63) + 4 - (1 << 64)


def test_small_sums_are_plain_and_the_types_stay(spark):
    df = spark.createDataFrame([(7, 12.25, "abc"), (-9, None, None)], "id long, rate double, name string")
    sums = summaries({"set": df})
    assert dict(sums.dtypes)["numbers"] == "bigint"
    assert [tuple(r) for r in sums.collect()] == [("set", 2, 1223, 3, 0, 0, 2)]
    assert [tuple(r) for r in summaries({"set": df.limit(0)}).collect()] == [("set", 0, 0, 0, 0, 0, 0)]


def test_numbers_are_added_up_as_longs(spark):
    """Decimals as wide as the sum of ids are slow to add, so they come in once at the end."""
    sums = summaries({"set": spark.createDataFrame([(1, 2)], "id long, n int")})
    text = sums._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(shiftright" in text and "partial_sum(cast(id" not in text
