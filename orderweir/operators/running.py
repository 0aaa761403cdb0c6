"""Running and final totals per key, with attributes taken from the newest event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweir.operators.hotkeys import SLICE, in_several, slice_by_rows


def newest(event_time: str, arrival: str, latest: list[str]) -> Column:
    """A struct whose maximum is the newest event: latest time, then latest arrival.

    A missing time sorts below every time, so it never replaces a dated event.
    """
    return F.struct(F.col(event_time), F.col(arrival).alias("_arrival"), *[F.col(name) for name in latest])


def running_totals(
    events: DataFrame,
    key: str,
    arrival: str,
    event_time: str,
    sums: list[str],
    latest: list[str],
    max_rows: int | None = None,
) -> DataFrame:
    """One row per event: sums so far by arrival, attributes of the newest event so far.

    Late events add to the sums but do not replace newer attributes; on equal
    times the later arrival wins. `arrival` is a unique whole number per key.
    Columns that are neither summed nor latest keep the event's own value.
    """
    rows = slice_by_rows(events, key, [arrival], max_rows).withColumn("_newest", newest(event_time, arrival, latest))
    so_far = W.partitionBy(key, SLICE).orderBy(arrival).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.select(
        *[F.col(name) for name in events.columns if name not in {*sums, *latest, event_time}],
        SLICE,
        *[F.sum(name).over(so_far).alias(name) for name in sums],
        F.max("_newest").over(so_far).alias("_newest"),
    )
    carried = _carry(rows, key, sums)
    joined = local.join(
        carried,
        local[key].eqNullSafe(carried["_key"]) & (local[SLICE] == carried["_from"]),
        "left",
    )
    top = F.greatest(F.col("_newest"), F.col("_newest_before"))
    return (
        joined.withColumn("_top", top)
        .select(
            *[F.col(name) for name in local.columns if name not in {*sums, SLICE, "_newest"}],
            *[
                F.when(F.col(f"_before_{name}").isNull(), F.col(name))
                .otherwise(F.coalesce(F.col(name), F.lit(0)) + F.col(f"_before_{name}"))
                .alias(name)
                for name in sums
            ],
            F.col(f"_top.{event_time}").alias(event_time),
            *[F.col(f"_top.{name}").alias(name) for name in latest],
        )
    )


def _carry(rows: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """What each slice of a key inherits from the slices before it; keys of one slice inherit nothing."""
    per_slice = rows.groupBy(F.col(key).alias("_key"), F.col(SLICE).alias("_from")).agg(
        *[F.sum(name).alias(name) for name in sums], F.max("_newest").alias("_newest")
    )
    before = W.partitionBy("_key").orderBy("_from").rowsBetween(W.unboundedPreceding, -1)
    return in_several(per_slice, "_key").select(
        "_key",
        "_from",
        *[F.sum(name).over(before).alias(f"_before_{name}") for name in sums],
        F.max("_newest").over(before).alias("_newest_before"),
    )


def latest_totals(
    events: DataFrame, key: str, arrival: str, event_time: str, sums: list[str], latest: list[str]
) -> DataFrame:
    """The last row of `running_totals` per key, as a plain aggregate.

    Sums and the newest struct combine before the shuffle, so a hot key costs no
    more than any other. Usable on a stream in update or complete mode.
    """
    totals = events.groupBy(key).agg(
        *[F.sum(name).alias(name) for name in sums],
        F.max(newest(event_time, arrival, latest)).alias("_newest"),
    )
    return totals.select(key, *sums, F.col(f"_newest.{event_time}").alias(event_time),
                         *[F.col(f"_newest.{name}").alias(name) for name in latest])
