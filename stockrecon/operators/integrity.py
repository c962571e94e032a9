"""Data-quality jobs: rows that break a key, a NOT NULL, a CHECK or a reference.

Every job returns ``rule_id, table_name, record_id, detail``. As in SQL, a CHECK passes
when its expression is NULL, and a NULL reference points nowhere and breaks nothing.
"""

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon import labels as L
from stockrecon.functions import expressions as X
from stockrecon.operators.prefilter import contains, dense, may_repeat, number_set, word_of
from stockrecon.schemas import RESULTS, TABLES

# Primary key of each table.
PRIMARY_KEYS = {
    "branches": "branch_id",
    "suppliers": "supplier_id",
    "products": "product_id",
    "sales": "sale_id",
    "supplier_orders": "supplier_order_id",
    "movements": "movement_id",
    "snapshots": "snapshot_id",
    "cancellations": "cancellation_id",
}

# Tables with one row per event, whose keys are checked behind a filter.
FACTS = {"sales", "supplier_orders", "movements", "snapshots", "cancellations"}

# Other unique columns.
UNIQUE_COLUMNS = [
    ("branches", ["branch_name"]),
    ("suppliers", ["supplier_name"]),
    ("products", ["sku"]),
    ("snapshots", ["branch_id", "product_id", "snapshot_date"]),
]

# The only column that may be empty.
NULLABLE = {("movements", "reference_id")}

# Allowed values, ranges and comparisons, as SQL conditions.
ENUM_CHECKS = [
    ("movements", "movement_type IN ({})".format(", ".join(f"'{v}'" for v in L.MOVEMENT_TYPES))),
    ("cancellations", "reason IN ({})".format(", ".join(f"'{v}'" for v in L.CANCELLATION_REASONS))),
]
RANGE_CHECKS = [
    ("products", "unit_cost >= 0"),
    ("products", "reorder_point >= 0"),
    ("sales", "quantity > 0"),
    ("sales", "revenue >= 0"),
    ("supplier_orders", "ordered_quantity > 0"),
    ("supplier_orders", "received_quantity > 0"),
    ("movements", "quantity > 0"),
    ("cancellations", "requested_quantity > 0"),
]
CROSS_CHECKS = [
    ("products", "selling_price >= unit_cost"),
    ("products", "target_stock >= reorder_point"),
]

# References (child, parent, key of both).
REFERENCES = [
    ("products", "suppliers", "supplier_id"),
    ("sales", "branches", "branch_id"),
    ("sales", "products", "product_id"),
    ("supplier_orders", "branches", "branch_id"),
    ("supplier_orders", "products", "product_id"),
    ("supplier_orders", "suppliers", "supplier_id"),
    ("movements", "branches", "branch_id"),
    ("movements", "products", "product_id"),
    ("snapshots", "branches", "branch_id"),
    ("snapshots", "products", "product_id"),
    ("cancellations", "branches", "branch_id"),
    ("cancellations", "products", "product_id"),
]


@dataclass(frozen=True)
class RowRule:
    """A condition every row must meet; ``holds`` may be NULL, which passes."""

    rule_id: str
    detail: str
    holds: Column


def _text(columns: list[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


# ---- single jobs --------------------------------------------------------------------


def pk_violations(
    df: DataFrame, key: str | list[str], table: str = "", rule_id: str = "Q1", prefilter: bool = True
) -> DataFrame:
    """Keys that occur more than once or are NULL, one row per key."""
    keys = [key] if isinstance(key, str) else key
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return _repeated(df, keys, missing, table, rule_id, prefilter)


def unique_violations(
    df: DataFrame, cols: str | list[str], table: str = "", rule_id: str = "Q2", prefilter: bool = True
) -> DataFrame:
    """Values that occur more than once; rows with a NULL among them are not compared."""
    keys = [cols] if isinstance(cols, str) else cols
    return _repeated(df.dropna(subset=keys), keys, F.lit(False), table, rule_id, prefilter)


def _repeated(
    df: DataFrame, keys: list[str], missing: Column, table: str, rule_id: str, prefilter: bool
) -> DataFrame:
    """``prefilter`` reads a table twice to shuffle only keys that may be repeated, see ``may_repeat``."""
    keyed = df.select(*keys)
    return (
        (may_repeat(keyed, keys) if prefilter else keyed)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) | missing)
        .select(
            F.lit(rule_id).alias("rule_id"),
            F.lit(table).alias("table_name"),
            _text(keys).alias("record_id"),
            F.concat(F.lit(f"{', '.join(keys)}: "), F.col("copies").cast("string"), F.lit(" rows")).alias("detail"),
        )
    )


def row_violations(df: DataFrame, rules: list[RowRule], record: str, table: str = "") -> DataFrame:
    """All row-level rules of a table in one scan, one output row per broken rule.

    Rows are filtered by their broken rules before anything is built from them, so that the
    scan can skip row groups in which every rule holds.
    """
    broken = [~rule.holds for rule in rules]
    named = [
        F.when(fails, F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.detail).alias("detail")))
        for rule, fails in zip(rules, broken)
    ]
    found = F.explode(F.array_compact(F.array(*named)))
    rows = df.where(reduce(lambda a, b: a | b, broken))
    return _listed(rows.select(F.col(record).cast("string").alias("record_id"), found.alias("found")), table)


def _listed(found: DataFrame, table: str) -> DataFrame:
    return found.select(
        F.col("found.rule_id").alias("rule_id"),
        F.lit(table).alias("table_name"),
        "record_id",
        F.col("found.detail").alias("detail"),
    )


def null_violations(df: DataFrame, cols: list[str], record: str, table: str = "") -> DataFrame:
    rules = [RowRule("Q3", f"{name} is null", F.col(name).isNotNull()) for name in cols]
    return row_violations(df, rules, record, table)


def check_violations(
    df: DataFrame, checks: str | list[str], record: str, table: str = "", rule_id: str = "Q5"
) -> DataFrame:
    checks = [checks] if isinstance(checks, str) else checks
    rules = [RowRule(rule_id, check, F.expr(check)) for check in checks]
    return row_violations(df, rules, record, table)


@dataclass(frozen=True)
class Reference:
    """A column of the child that points at a key of ``parent``, whose table is ``target``."""

    column: str
    parent: DataFrame
    parent_column: str
    target: str


def reference_violations(child: DataFrame, references: list[Reference], record: str, table: str = "") -> DataFrame:
    """Keys of the child that are set but unknown to their parent, all references in one pass.

    Parents are reduced to distinct keys, so a key that a broken parent repeats does not
    multiply the child.
    """
    columns = dict.fromkeys(reference.column for reference in references)
    rows = child.select(F.col(record).cast("string").alias("record_id"), *columns)
    lost = []
    for number, reference in enumerate(references):
        key, mark = f"_key{number}", f"_known{number}"
        known = reference.parent.select(F.col(reference.parent_column).alias(key)).distinct().withColumn(mark, F.lit(True))
        rows = rows.join(known, F.col(reference.column) == F.col(key), "left")
        lost.append(F.col(reference.column).isNotNull() & F.col(mark).isNull())
    named = [
        F.when(
            missing,
            F.struct(
                F.lit("Q7").alias("rule_id"),
                F.concat(
                    F.lit(f"{reference.column} "),
                    F.col(reference.column).cast("string"),
                    F.lit(f" not in {reference.target}"),
                ).alias("detail"),
            ),
        )
        for reference, missing in zip(references, lost)
    ]
    found = F.explode(F.array_compact(F.array(*named)))
    return _listed(rows.where(reduce(lambda a, b: a | b, lost)).select("record_id", found.alias("found")), table)


def fk_violations(
    child: DataFrame, cols: str, parent: DataFrame, parent_cols: str, record: str, table: str = "", target: str = ""
) -> DataFrame:
    """Child rows whose key is set but unknown to the parent."""
    return reference_violations(child, [Reference(cols, parent, parent_cols, target)], record, table)


# ---- the rules of the eight tables --------------------------------------------------


def table_rules(table: str, families: set[str]) -> list[RowRule]:
    """Row-level rules of one table for the wanted families Q3 to Q6."""
    rules = []
    if "Q3" in families:
        rules += [
            RowRule("Q3", f"{name} is null", F.col(name).isNotNull())
            for name in TABLES[table].names
            if name != PRIMARY_KEYS[table] and (table, name) not in NULLABLE
        ]
    for family, checks in (("Q4", ENUM_CHECKS), ("Q5", RANGE_CHECKS), ("Q6", CROSS_CHECKS)):
        if family in families:
            rules += [RowRule(family, check, F.expr(check)) for owner, check in checks if owner == table]
    return rules


def violations(dfs: Mapping[str, DataFrame], *families: str) -> DataFrame:
    """Violations of the model's own rules, for the given families (all by default)."""
    wanted = set(families or ("Q1", "Q2", "Q3", "Q4", "Q5", "Q6", "Q7"))
    parts: list[DataFrame] = []
    if "Q1" in wanted:
        for table, key in PRIMARY_KEYS.items():
            close = table in FACTS and dense(dfs[table], key)
            parts.append(pk_violations(dfs[table], key, table, prefilter=close))
    if "Q2" in wanted:
        parts += [unique_violations(dfs[table], cols, table, prefilter=table in FACTS) for table, cols in UNIQUE_COLUMNS]
    for table, key in PRIMARY_KEYS.items():
        rules = table_rules(table, wanted)
        if rules:
            parts.append(row_violations(dfs[table], rules, key, table))
    if "Q7" in wanted:
        for table, record in PRIMARY_KEYS.items():
            references = [
                Reference(key, dfs[parent], key, parent) for child, parent, key in REFERENCES if child == table
            ]
            if references:
                parts.append(reference_violations(dfs[table], references, record, table))
    return reduce(DataFrame.unionByName, parts)


class IntegrityError(RuntimeError):
    """Raised with the first offending rows."""


def first_offenders(found: DataFrame, limit: int = 10) -> DataFrame:
    """The first violations by rule, table, record and detail.

    The order makes the choice definite, and lets every partition keep its own first ones in a
    single pass instead of searching partitions in turn.
    """
    return found.orderBy("rule_id", "table_name", "record_id", "detail").limit(limit)


def refuse(found: DataFrame, limit: int = 10) -> None:
    """Fail with the first violations, if there are any."""
    offenders = first_offenders(found, limit).collect()
    if offenders:
        raise IntegrityError([tuple(row) for row in offenders])


def assert_integrity(dfs: Mapping[str, DataFrame], limit: int = 10, *families: str) -> None:
    """Fail with the first offenders if a rule of the given families (all by default) is broken."""
    refuse(violations(dfs, *families), limit)


# ---- booking mistakes ---------------------------------------------------------------


def orders_without_movement(orders: DataFrame, movements: DataFrame) -> DataFrame:
    """Delivered orders whose reference was never booked as a delivery.

    References in the form that ``supplier_reference`` gives are read as numbers and gathered 64
    to a word with partial sums, so movements are shuffled neither by text nor row by row, and a
    reference that was booked very often is one bit. Other references match no order. Orders look
    their word up; a word belongs to 64 orders at most.
    """
    form = f"^{L.SUPPLIER_REFERENCE_PREFIX}(-?[0-9]{{1,19}})$"
    number = F.regexp_extract("reference_id", form, 1).try_cast("bigint")
    booked = movements.where(F.col("movement_type") == L.DELIVERY).select(number.alias("number"), "reference_id")
    booked = booked.where(X.supplier_reference(F.col("number")) == F.col("reference_id"))
    words = number_set(booked, F.col("number")).select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))
    order = F.col("supplier_order_id")
    return orders.join(words, (word_of(order) == F.col("_word")) & contains(F.col("_mask"), order), "left_anti")


def data_quality_issues(duplicates: DataFrame, unbooked: DataFrame) -> DataFrame:
    """Surplus movements and orders without a movement, in one list."""
    columns = RESULTS["data_quality_issues"].names
    surplus = duplicates.select(
        F.lit(L.DUPLICATE_MOVEMENT).alias("issue_type"),
        F.col("movement_id").alias("record_id"),
        "branch_id",
        "product_id",
        X.day_of(F.col("movement_time")).alias("issue_date"),
    )
    missing = unbooked.select(
        F.lit(L.ORDER_WITHOUT_MOVEMENT).alias("issue_type"),
        F.col("supplier_order_id").alias("record_id"),
        "branch_id",
        "product_id",
        F.col("actual_delivery_date").alias("issue_date"),
    )
    return surplus.select(*columns).unionByName(missing.select(*columns))
