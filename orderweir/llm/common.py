"""Helpers that several operators share: reading, words, seeded order, running counts, components."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderweir.session import release, stored

#: Rows that one window task ranks; hot strata are cut into cells of about this size.
CELL_ROWS = 16_384
#: Cells that one window task sums up.
BLOCK_CELLS = 1_024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def utf8(text: str | Column = "text") -> Column:
    """The text's bytes; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b""))


def neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """The frame with columns in0_, in1_, ..., the new name of each column, and the columns that restore it.

    Columns that an operator adds meanwhile cannot clash with the frame's own.
    """
    names = {name: f"in{i}_" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names, [F.col(new).alias(old) for old, new in names.items()]


def tie_break(docs: DataFrame, name: str) -> Column:
    """Orders rows of equal id: a number as it is, a text by its CRC-32, where null counts as empty."""
    if dict(docs.dtypes)[name] != "string":
        return F.col(name)
    return F.crc32(F.coalesce(name, F.lit("")).cast("binary"))


def seeded(seed: str, key: Column, tie: Column) -> Column:
    """A number of 60 bits that depends on the seed, the key and the tie only: rows of one key are spread by their ties."""
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (key, tie)]
    digest = F.md5(F.concat(F.lit(seed + "|"), parts[0], F.lit("|"), parts[1]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def stratum_key(column: Column) -> Column:
    """Text that is never null: '' for null, '=value' for a value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def cell_bits(rows: int) -> int:
    """Bits of the seeded number so that a cell holds about CELL_ROWS rows."""
    return max(0, math.ceil(math.log2(max(rows, 1) / CELL_ROWS)))


def running_starts(counts: DataFrame, keys: list[str], cell: str, n: str, start: str) -> DataFrame:
    """Adds to each row of `counts` (one per keys and cell) how many rows lie in earlier cells.

    Sums in two levels, so no task sees more than BLOCK_CELLS cells or as many blocks as there
    are cells / BLOCK_CELLS.
    """
    blocked = counts.withColumn("_block", F.floor(F.col(cell) / BLOCK_CELLS))
    earlier = lambda part, order: (
        Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        blocked.groupBy(*keys, "_block")
        .agg(F.sum(n).alias("_rows"))
        .select(*keys, "_block", F.coalesce(F.sum("_rows").over(earlier(keys, "_block")), F.lit(0)).alias("_before"))
    )
    within = F.coalesce(F.sum(n).over(earlier([*keys, "_block"], cell)), F.lit(0))
    return (
        blocked.withColumn("_within", within)
        .join(blocks, [*keys, "_block"])
        .select(*keys, cell, n, (F.col("_before") + F.col("_within")).alias(start))
    )


def celled(docs: DataFrame, rows: int, seed: str, id_col: str, stratum: str, tie: Column) -> tuple[DataFrame, DataFrame]:
    """The rows with `_s` (stratum key), `_h` (seeded number) and `_cell`; and per stratum and cell (`_n`, `_start`).

    A cell is a range of the seeded number; `_start` counts the stratum's rows in the cells before.
    """
    bits = cell_bits(rows)
    cell = F.shiftright("_h", 60 - bits) if bits else F.lit(0).cast("long")
    keyed = (
        docs.withColumn("_s", stratum_key(F.col(stratum)))
        .withColumn("_h", seeded(seed, F.col(id_col), tie))
        .withColumn("_cell", cell)
    )
    counts = keyed.groupBy("_s", "_cell").agg(F.count("*").alias("_n"))
    return keyed, running_starts(counts, ["_s"], "_cell", "_n", "_start")


def rank_in_cell(keyed: DataFrame, starts: DataFrame, id_col: str, tie: Column) -> DataFrame:
    """Adds `_rank` (from 1, by `_h`, id and tie within the stratum) and the columns of `starts`, joined where the rows lie."""
    order = Window.partitionBy("_s", "_cell").orderBy("_h", id_col, tie)
    return (
        keyed.withColumn("_row", F.row_number().over(order))
        .join(starts, ["_s", "_cell"])
        .withColumn("_rank", F.col("_start") + F.col("_row"))
    )


def ranked(docs: DataFrame, rows: int, seed: str, id_col: str, stratum: str, tie: Column) -> DataFrame:
    """Adds `_s`, `_h` and `_rank`: the place of each row in the seeded order of its stratum."""
    keyed, starts = celled(docs, rows, seed, id_col, stratum, tie)
    return rank_in_cell(keyed, starts.drop("_n"), id_col, tie).drop("_cell", "_start", "_row")


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Smallest id reachable over links: (id, comp) for every id that has one.

    edges: (a, b) longs without nulls. Large-star and small-star steps on written tables; every
    step groups by id with a map-side minimum, so a hub with very many links is no single task. A round
    and its test are as few shuffles and broadcasts as can be, each of which costs the driver threads and plans.
    """
    link = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    link = stored(link, purpose)
    while True:
        both = link.unionByName(link.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # A row per link at most, some of them repeated until the round's end.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (
            small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        link = stored(small, purpose)
        # Stars only: no root is itself a child, and no child has two roots.
        ends = link.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
            link.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("root"))
        )
        ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
        if ends.where("up > 1 or (up = 1 and root = 1)").isEmpty():
            break
        release(link.sparkSession)
    release(link.sparkSession)
    members = link.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return members.unionByName(members.select(F.col("comp").alias("id"), "comp").distinct())
