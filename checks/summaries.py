"""One line per stored set that both engines can compute: rows and sums over all columns.

``numbers`` adds up all numbers (money in cents, rates in hundredths), ``text`` the lengths of
all texts, ``days`` the days of all dates and times since 1970, ``moments`` the milliseconds of
all times of day, ``empty`` the missing values. Spark adds up numbers in three parts of at most 22
bits, put together in wide decimals, so no sum of a large set can overflow; one beyond 64 bits (ids
of some hundred million rows) is given by its lowest 64 bits, as a signed number.
"""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBERS = (T.LongType, T.IntegerType)
_HUNDREDTHS = (T.DecimalType, T.DoubleType)
_TIMES = (T.TimestampNTZType, T.TimestampType)
MEASURES = ("numbers", "text", "days", "moments")


def _spark(field: T.StructField) -> dict[str, str]:
    name, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, _NUMBERS):
        return {"numbers": name}
    if isinstance(kind, _HUNDREDTHS):
        return {"numbers": f"CAST(round(CAST({name} AS DECIMAL(38,6)) * 100) AS BIGINT)"}
    if isinstance(kind, T.StringType):
        return {"text": f"char_length({name})"}
    days = {"days": f"datediff(CAST({name} AS DATE), DATE'1970-01-01')"}
    if isinstance(kind, _TIMES):
        days["moments"] = f"CAST(extract(HOUR FROM {name}) * 3600000 + extract(MINUTE FROM {name}) * 60000 + extract(SECOND FROM {name}) * 1000 AS BIGINT)"
    return days


def _duck(field: T.StructField) -> dict[str, str]:
    name, kind = f'"{field.name}"', field.dataType
    if isinstance(kind, _NUMBERS):
        return {"numbers": name}
    if isinstance(kind, _HUNDREDTHS):
        return {"numbers": f"round({name}::DECIMAL(38,6) * 100)::BIGINT"}
    if isinstance(kind, T.StringType):
        return {"text": f"length({name})"}
    days = {"days": f"date_diff('day', DATE '1970-01-01', {name}::DATE)"}
    if isinstance(kind, _TIMES):
        days["moments"] = f"(extract('hour' FROM {name}) * 3600000 + extract('minute' FROM {name}) * 60000 + extract('millisecond' FROM {name}))"
    return days


def _sums(schema: T.StructType, of, names: str, number: str = "sum({})", low: str = "{}") -> list[str]:
    """SQL of the sums, one for each measure, and of the missing values.

    ``number`` adds up a term of ``numbers``, ``low`` is the part of a sum that is kept.
    """
    terms: dict[str, list[str]] = {measure: [] for measure in MEASURES}
    for field in schema:
        for measure, term in of(field).items():
            terms[measure].append(f"coalesce({(number if measure == 'numbers' else 'sum({})').format(term)}, 0)")
    empty = " + ".join(f"count(*) - count({names}{field.name}{names})" for field in schema)
    made = [f"CAST({low.format(' + '.join(t) or '0')} AS BIGINT) AS {measure}" for measure, t in terms.items()]
    return [*made, f"CAST({empty} AS BIGINT) AS empty"]


_PART = 22
#: The sum of 64-bit numbers, of 2**41 of them without overflow: sums of longs cost little a row, those of decimals a lot.
_NUMBER_SUM = " + ".join(
    f"CAST(sum({part}) AS DECIMAL(20,0)) * {1 << shift}BD"
    for shift, part in (
        (2 * _PART, f"shiftright(CAST({{0}} AS BIGINT), {2 * _PART})"),
        (_PART, f"shiftright(CAST({{0}} AS BIGINT), {_PART}) & {(1 << _PART) - 1}"),
        (0, f"CAST({{0}} AS BIGINT) & {(1 << _PART) - 1}"),
    )
)
#: Moved by 2**63, taken modulo 2**64 and moved back.
_LOW = f"pmod({{}} + {1 << 63}BD, {1 << 64}BD) - {1 << 63}BD"


def summaries(sets: Mapping[str, DataFrame]) -> DataFrame:
    """``name, rows, numbers, text, days, moments, empty`` of every set."""
    lines = [
        df.selectExpr("count(*) AS rows", *_sums(df.schema, _spark, "`", _NUMBER_SUM, _LOW)).select(F.lit(name).alias("name"), "*")
        for name, df in sets.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def summaries_sql(sets: Mapping[str, tuple[str, T.StructType]]) -> str:
    """The same in SQL; each set is given by a query and its schema."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows, {', '.join(_sums(schema, _duck, chr(34)))} FROM ({query})"
        for name, (query, schema) in sets.items()
    )
