"""Data-quality checks. Each returns `(check_name, severity, failures)` rows.

Checks ignore nulls, except `not_null` itself. The matching `*_violations`
functions return what failed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir.functions import columns as c
from orderweir.session import stored


def _summary(name: str, failures: Column, severity: str = "error") -> list[Column]:
    return [F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), failures.alias("failures")]


def _one_per_row(totals: DataFrame, names: list[str], severity: str = "error") -> DataFrame:
    """A one-row frame of counters to one row per counter."""
    entries = F.array(*[F.struct(*_summary(name, F.col(f"`{name}`"), severity)) for name in names])
    return totals.select(F.explode(entries).alias("row")).select("row.*")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """All columns are counted in one pass."""
    names = [f"not_null_{name}" for name in columns]
    totals = df.agg(*[F.count_if(F.col(name).isNull()).alias(f"not_null_{name}") for name in columns])
    return _one_per_row(totals, names)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that lack one of the columns."""
    return df.filter(reduce(Column.__or__, [F.col(name).isNull() for name in columns]))


def relationship_violations(child: DataFrame, column: str, parent: DataFrame, field: str, where: Column | None = None) -> DataFrame:
    """Child values without a parent, with the number of rows that hold each.

    Rows are counted per value first: the join sees distinct values only, so a
    value that fills a third of the table is one row.
    """
    rows = child.filter(F.col(column).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    values = rows.groupBy(column).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(field).alias("_known"))
    return values.join(known, F.col(column) == F.col("_known"), "left_anti")


def relationship(
    name: str, child: DataFrame, column: str, parent: DataFrame, field: str, severity: str = "error", where: Column | None = None
) -> DataFrame:
    found = relationship_violations(child, column, parent, field, where)
    failures = F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint")
    return found.agg(failures.alias("n")).select(*_summary(name, F.col("n"), severity))


def accepted_values(df: DataFrame, accepted: dict[str, list]) -> DataFrame:
    names = [f"accepted_values_{name}" for name in accepted]
    totals = df.agg(
        *[F.count_if(~F.col(name).isin(*values)).alias(f"accepted_values_{name}") for name, values in accepted.items()]
    )
    return _one_per_row(totals, names)


def accepted_values_violations(df: DataFrame, accepted: dict[str, list]) -> DataFrame:
    """`(column_name, value, row_count)` of every value that is not accepted."""
    checked = F.explode(
        F.array(
            *[
                F.when(
                    ~F.col(name).isin(*values),
                    F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")),
                )
                for name, values in accepted.items()
            ]
        )
    )
    found = df.select(checked.alias("bad")).filter("bad is not null").select("bad.*")
    return found.groupBy("column_name", "value").agg(F.count("*").alias("row_count"))


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """`(table_name, has_rows)`; looks at one row per table."""
    found = [
        df.limit(1).agg((F.count("*") > 0).alias("has_rows")).select(F.lit(name).alias("table_name"), "has_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def unique(name: str, df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
    return counts.agg(F.count("*").alias("n")).select(*_summary(name, F.col("n")))


def fact_checks(fact: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Every check declared on the sales fact."""
    return reduce(
        DataFrame.unionByName,
        [
            not_null(fact, ["order_id", "line_item_id", "customer_id", "product_id", "currency"]),
            accepted_values(fact, {"currency": ["USD"], "is_weekend": [True, False]}),
            relationship(
                "relationship_customer", fact, "customer_id", customers, "customer_id",
                severity="warn", where=F.col("customer_id").like("CUST-%"),
            ),
            relationship("relationship_product", fact, "product_id", products, "product_id"),
            relationship("relationship_date", fact, "date_key", dates, "date_key"),
        ],
    )


def order_total_mismatches(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose header total is not the sum of their lines."""
    sums = lines.groupBy("order_id").agg(F.sum("line_total").cast(c.MONEY).alias("line_item_total"))
    return (
        orders.join(sums, "order_id")
        .filter(F.col("order_total") != F.col("line_item_total"))
        .select(
            "order_id", "order_total", "line_item_total",
            (F.col("order_total") - F.col("line_item_total")).cast(c.MONEY).alias("difference"),
        )
    )


def quarantine(records: DataFrame, amount: str, target: str, corrupt: Column | None = None) -> DataFrame:
    """Split good from bad without failing: adds the typed amount and a `reason` (null when good).

    A missing amount is allowed; text that is no amount is not.
    """
    typed = c.money(F.col(amount))
    reason = F.when(F.col(amount).isNotNull() & typed.isNull(), F.lit(f"bad amount in {amount}"))
    if corrupt is not None:
        reason = F.coalesce(F.when(corrupt, F.lit("unreadable record")), reason)
    return records.withColumn(target, typed).withColumn("reason", reason)


def key_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that occur more often on one side: both `except all` directions in one shuffle."""
    sides = left.select(F.col(key), F.lit(1).alias("side")).unionByName(
        right.select(F.col(key), F.lit(-1).alias("side"))
    )
    return sides.groupBy(key).agg(F.sum("side").alias("surplus")).filter("surplus <> 0")


def parity(name: str, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row counts of two copies of a table and how many rows one side has that the other lacks."""
    sides = left.select(F.col(key), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))), F.lit(0)).alias("only_right"),
    ).select(F.lit(name).alias("table_name"), "left_rows", "right_rows", "only_left", "only_right")


def _checksums(rows: DataFrame, key: str, columns: list[str], buckets: int, side: str) -> DataFrame:
    """Rows and order-free checksums per hash bucket of the key; a doubled row counts twice in both sums."""
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]
    return rows.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")).agg(
        F.count("*").alias(f"n_{side}"),
        F.struct(F.count("*"), *[F.sum(h.cast("decimal(38,0)")) for h in hashes]).alias(f"sum_{side}"),
    )


def row_differences(left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None, buckets: int = 4096) -> DataFrame:
    """Rows that one copy of a table has more often than the other: the columns and `surplus`, negative for the right.

    Checksums of hash buckets of the key are compared first; rows are compared only in buckets whose
    checksums differ, so two equal copies cost one aggregation each and no row is moved.
    """
    columns = columns or left.columns
    left, right = left.select(columns), right.select(columns)
    return _differences(left, right, key, columns, buckets, _compared(left, right, key, columns, buckets))


def _compared(left: DataFrame, right: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    sums = _checksums(left, key, columns, buckets, "left").join(
        _checksums(right, key, columns, buckets, "right"), "_bucket", "full"
    )
    return stored(sums, "parity-sums")


def _differences(left: DataFrame, right: DataFrame, key: str, columns: list[str], buckets: int, sums: DataFrame) -> DataFrame:
    differ = sums.where(~F.col("sum_left").eqNullSafe(F.col("sum_right"))).select("_bucket")
    if differ.isEmpty():  # equal copies are not computed once more for a join with nothing
        return left.select(*columns, F.lit(0).cast("bigint").alias("surplus")).limit(0)
    inside = lambda rows, sign: (
        rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        .join(differ, "_bucket", "left_semi")
        .select(*columns, F.lit(sign).alias("_side"))
    )
    both = inside(left, 1).unionByName(inside(right, -1))
    return both.groupBy(*columns).agg(F.sum("_side").alias("surplus")).where("surplus <> 0")


def row_parity(
    name: str, left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None, buckets: int = 4096
) -> DataFrame:
    """Whole rows of two copies of a table compared: row counts, buckets that differ, and rows by kind of difference.

    changed: rows of one key that stand in both copies with other values; only_left, only_right: rows that
    the other copy lacks, doubled ones included. `columns` name what is compared, by default all of the left copy.
    """
    columns = columns or left.columns
    left, right = left.select(columns), right.select(columns)
    sums = _compared(left, right, key, columns, buckets)
    rows = _differences(left, right, key, columns, buckets, sums)
    per_key = rows.groupBy(key).agg(
        F.sum(F.greatest("surplus", F.lit(0))).alias("l"), F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("r")
    )
    both = F.least("l", "r")
    kinds = per_key.agg(
        *[F.coalesce(F.sum(x), F.lit(0)).alias(kind) for kind, x in
          {"changed": both, "only_left": F.col("l") - both, "only_right": F.col("r") - both}.items()]
    )
    totals = sums.agg(
        F.coalesce(F.sum("n_left"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("n_right"), F.lit(0)).alias("right_rows"),
    )
    return totals.join(kinds).select(F.lit(name).alias("table_name"), "left_rows", "right_rows", "changed", "only_left", "only_right")
