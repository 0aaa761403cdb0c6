"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderweir.llm.common import cell_bits, neutral, ranked, running_starts, stratum_key, tie_break
from orderweir.session import stored

#: Blocks of a given order that one window task sorts, per shard.
ORDER_BLOCKS = 256


def interleave(
    docs: DataFrame,
    shards: int = 24,
    seed: str = "shards",
    id_col: str = "doc_id",
    stratum: str = "source",
    tie: str = "text",
    order: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Adds `shard` and `slot`: every shard has the mixture of all rows.

    Rows are ranked in seeded order within their source. Row r of n gets the fraction (r - u) / n,
    where u in (0, 1) is drawn per source by the seed; all rows are sorted by fraction and cut
    into `shards` runs whose lengths differ by one at most. In each shard a source has its share,
    give or take one row at either end. The draw u spreads sources of a few rows over all shards.

    `order` names three columns of an order of all rows: rank within the source (from 1), block, row in
    the block (`mixing.mix` makes them). Then a source's rows are dealt over the shards by that rank, so every
    shard has an even sample of the whole order, and the slots of a shard follow it. The three columns go.

    Ranks and positions come from counts per cell and row numbers within cells, so a source or
    a shard of any size is the work of many tasks.

    * null id: seeded like an empty one; null source: a source of its own; null or empty text: no
      matter; repeated rows: each is placed, equal ones in any order (ties go by id, then by the CRC-32 of
      `tie`, or by `tie` itself if it is a number).
    * empty table: empty result. Existing columns `shard` and `slot` are replaced.
    """
    docs, names, restored = neutral(docs)
    restored = [c for c, name in zip(restored, names) if name not in ("shard", "slot", *(order or ()))]
    id_col, stratum, tie = names[id_col], names[stratum], tie_break(docs, names[tie])
    rows = docs.count()
    bits = cell_bits(rows)
    sizes = docs.groupBy(stratum_key(F.col(stratum)).alias("_s")).agg(F.count("*").alias("_total"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.col("_s"))), 1, 13), 16, 10).cast("long")
    sizes = sizes.withColumn("_u", (draw + 0.5) / float(2**52))
    if order is None:
        own, rank, ties = ranked(docs, rows, seed, id_col, stratum, tie), F.col("_rank"), ["_h", id_col, tie]
    else:
        place, block, row = (names[c] for c in order)
        own, ties = docs.withColumn("_s", stratum_key(F.col(stratum))).withColumn("_rank", F.col(place) - 1), []
        # Places 0, shards, 2 * shards, ... come first, then 1, shards + 1, ...: each run is spread over the order.
        rank = F.expr(
            f"(_rank % {shards}) * (_total div {shards}) + least(_rank % {shards}, _total % {shards}) + _rank div {shards} + 1"
        )
    spread = (
        own.join(sizes, "_s")
        .withColumn("_f", (rank - F.col("_u")) / F.col("_total"))
        .withColumn("_cell", F.floor(F.col("_f") * float(2**bits)))
        .drop("_rank", "_total", "_u")
    )
    counts = spread.groupBy("_cell").agg(F.count("*").alias("_n"))
    starts = running_starts(counts.withColumn("_all", F.lit(0)), ["_all"], "_cell", "_n", "_start").drop("_all", "_n")
    if order is not None:
        starts = stored(starts, "shard-starts")  # the rows up to here are needed twice, their counts once
    by_fraction = Window.partitionBy("_cell").orderBy("_f", "_s", *ties)
    cut = (
        spread.join(starts, "_cell")
        .withColumn("_at", F.col("_start") + F.row_number().over(by_fraction) - 1)
        .withColumn("shard", F.expr(f"cast((_at * {shards}) div {max(rows, 1)} as int)"))
    )
    if order is None:
        slotted = cut.withColumn("slot", F.expr(f"_at - (shard * {rows}L + {shards - 1}) div {shards}"))
    else:
        cut = cut.drop("_cell", "_start", "_f").withColumn("_cell", F.expr(f"{block} div {ORDER_BLOCKS * shards}"))
        counts = cut.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
        starts = stored(running_starts(counts, ["shard"], "_cell", "_n", "_start").drop("_n"), "shard-starts")
        by_order = Window.partitionBy("shard", "_cell").orderBy(block, row)
        slotted = cut.join(starts, ["shard", "_cell"]).withColumn(
            "slot", F.col("_start") + F.row_number().over(by_order) - 1
        )
    return slotted.select(*restored, "shard", "slot")


def measured(docs: DataFrame) -> DataFrame:
    """Adds `size` (UTF-8 bytes plus 8, null text: 8) and `text_crc32` (null text as empty)."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("size", F.octet_length(text).cast("long") + 8).withColumn(
        "text_crc32", F.crc32(text.cast("binary"))
    )
