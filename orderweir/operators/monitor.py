"""Alert rules, probe panels and freshness over metric samples.

Samples are rows of (time, labels, value). What a time range before each sample holds is put
together from pieces: the rest of the range's first second, whole seconds, and the sample's own second so
far. Samples of one millisecond, then of one second, are combined before anything is ordered, so a
task orders at most the milliseconds of a second or a few times the seconds of a range, however busy a series is.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweir.functions import columns as c
from orderweir.operators.hotkeys import SLICE, in_several, slice_by_rows


def _of_series(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the key columns; those of the right side start with r_."""
    return reduce(Column.__and__, [left[key].eqNullSafe(right[f"r_{key}"]) for key in keys])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({key: f"r_{key}" for key in keys})


def _best_in_range(points: DataFrame, series: list[str], seconds: int, best) -> DataFrame:
    """Of every point (series, `_ms`, `_v`) the best `_v` between `seconds` earlier and itself, as `_best`.

    best: F.max or F.min. Seconds wholly inside a range are covered by two overlapping runs, one to the end of
    a block of as many seconds and one from the start of the next.
    """
    kind = points.schema["_v"].dataType
    second = lambda ms: F.floor(F.col(ms) / 1000)
    nothing = F.lit(None).cast(kind).alias("_v")

    def runs(rows: DataFrame, part: str, at: str) -> DataFrame:
        """Best value up to (`_upto`) and from (`_onward`) each place within its part."""
        within = W.partitionBy(*series, part)
        # Both frames grow row by row; a frame that shrinks would be computed anew for every row.
        return rows.select(
            "*",
            best("_v").over(within.orderBy(at).rangeBetween(W.unboundedPreceding, W.currentRow)).alias("_upto"),
            best("_v").over(within.orderBy(F.desc(at)).rangeBetween(W.unboundedPreceding, W.currentRow)).alias("_onward"),
        )

    own = points.select(*series, F.col("_ms").alias("_at"), "_v", F.col("_ms").alias("_for"), F.lit(False).alias("_early"))
    early = points.select(*series, (F.col("_ms") - seconds * 1000).alias("_at"), nothing, F.col("_ms").alias("_for"), F.lit(True).alias("_early"))
    ends = runs(own.unionByName(early).withColumn("_part", second("_at")), "_part", "_at")
    ends = ends.groupBy(*series, "_for").agg(best(F.when(F.col("_early"), F.col("_onward")).otherwise(F.col("_upto"))).alias("_ends"))
    ends = ends.withColumn("_second", second("_for"))
    if seconds < 2:
        return ends.select(*series, F.col("_for").alias("_ms"), F.col("_ends").alias("_best"))

    whole = seconds - 1
    per = points.groupBy(*series, second("_ms").alias("_at")).agg(best("_v").alias("_v"))
    asked = lambda shift, onward: per.select(
        *series, (F.col("_at") + shift).alias("_at"), nothing, F.col("_at").alias("_for"), F.lit(onward).alias("_side")
    )
    places = per.select(*series, "_at", "_v", F.col("_at").alias("_for"), F.lit(0).alias("_side"))
    places = places.unionByName(asked(-whole, 1)).unionByName(asked(-1, 2)).withColumn("_part", F.floor(F.col("_at") / whole))
    middle = runs(places, "_part", "_at").where("_side > 0")
    middle = middle.groupBy(*series, F.col("_for").alias("_second")).agg(
        best(F.when(F.col("_side") == 1, F.col("_onward")).otherwise(F.col("_upto"))).alias("_middle")
    )
    keys = [*series, "_second"]
    middle = _renamed(middle, keys)
    either = F.greatest if best is F.max else F.least
    return ends.join(middle, _of_series(ends, middle, keys), "left").select(
        *[ends[key] for key in series], F.col("_for").alias("_ms"), either("_ends", "_middle").alias("_best")
    )


def max_over_time(samples: DataFrame, series: list[str], time: str, value: str, seconds: int) -> DataFrame:
    """Highest value of the series in the last `seconds` before each sample, as `max_value`."""
    timed = samples.withColumn("_ms", c.epoch_ms(F.col(time)))
    points = timed.groupBy(*series, "_ms").agg(F.max(value).alias("_v"))
    found = _renamed(_best_in_range(points, series, seconds, F.max), [*series, "_ms"])
    return timed.join(found, _of_series(timed, found, [*series, "_ms"]), "left").select(
        *samples.columns, F.col("_best").alias("max_value")
    )


def _counted(samples: DataFrame, series: list[str], time: str, value: str, tie: str) -> DataFrame:
    """(series, `_ms`, `_time`, `_tie`, `_grown`): growth of each series up to and including each sample.

    Rows are cut into slices along each series; a slice starts from the last value and the growth before it.
    """
    rows = samples.select(
        F.struct(*series).alias("_s"), F.col(time).alias("_time"), F.col(tie).alias("_tie"), F.col(value).alias("_value")
    )
    rows = slice_by_rows(rows, "_s", ["_time", "_tie"])
    place = F.struct("_time", "_tie", "_value")
    step = lambda now, before: F.when(before.isNotNull(), F.when(now >= before, now - before).otherwise(now))
    in_order = W.partitionBy("_s", SLICE).orderBy("_time", "_tie")
    local = rows.withColumn("_step", step(F.col("_value"), F.lag("_value").over(in_order)))
    per = local.groupBy("_s", SLICE).agg(
        F.min(place).alias("_first"), F.max(place).alias("_last"), F.coalesce(F.sum("_step"), F.lit(0)).alias("_inside")
    )
    slices = W.partitionBy("_s").orderBy(SLICE)
    per = in_several(per, "_s").withColumn("_entry", F.coalesce(step(F.col("_first._value"), F.lag("_last._value").over(slices)), F.lit(0)))
    before = F.sum(F.col("_inside") + F.col("_entry")).over(slices.rowsBetween(W.unboundedPreceding, -1))
    carried = per.select(
        F.col("_s").alias("_key"), F.col(SLICE).alias("_from"), (F.coalesce(before, F.lit(0)) + F.col("_entry")).alias("_carried")
    )
    so_far = F.sum(F.coalesce("_step", F.lit(0))).over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))
    grown = local.withColumn("_so_far", so_far)
    return grown.join(carried, grown["_s"].eqNullSafe(carried["_key"]) & (grown[SLICE] == carried["_from"]), "left").select(
        "_s.*", "_time", "_tie", c.epoch_ms(F.col("_time")).alias("_ms"),
        (F.col("_so_far") + F.coalesce("_carried", F.lit(0))).alias("_grown"),
    )


def increase(samples: DataFrame, series: list[str], time: str, value: str, seconds: int, tie: str) -> DataFrame:
    """Growth of a counter over the last `seconds` before each sample, as `increase`.

    Only steps between samples inside the range count. A drop is a restart: the
    counter grew from zero to its new value. There is no extrapolation to the
    edges of the range. Samples of one time go by `tie`, a unique column; all of them see the
    growth up to the last. It is the growth up to a sample less that up to the first sample in range.
    """
    place = F.struct("_time", "_tie")
    points = (
        _counted(samples, series, time, value, tie)
        .groupBy(*series, "_ms")
        .agg(F.max_by("_grown", place).alias("_upto"), F.min_by("_grown", place).alias("_first"))
    )
    keys = [*series, "_ms"]
    early = _renamed(_best_in_range(points.withColumn("_v", F.struct("_ms", "_first")), series, seconds, F.min), keys)
    found = points.join(early, _of_series(points, early, keys)).select(
        *[points[key] for key in keys], (F.col("_upto") - F.col("_best._first")).alias("increase")
    )
    timed = samples.withColumn("_ms", c.epoch_ms(F.col(time)))
    found = _renamed(found, keys)
    return timed.join(found, _of_series(timed, found, keys), "left").select(*samples.columns, "increase")


def probe_health(probes: DataFrame, series: list[str], time: str, value: str, tie: str) -> DataFrame:
    """Instances up and down at their latest sample; samples of one time go by `tie`, a unique column."""
    last = probes.groupBy(*series).agg(F.max_by(value, F.struct(time, tie)).alias("up"))
    return last.agg(F.count_if(F.col("up") == 1).alias("healthy"), F.count_if(F.col("up") == 0).alias("unhealthy"))


def probe_duration(probes: DataFrame, series: list[str], time: str, value: str, every: str = "hour") -> DataFrame:
    """Average and longest duration per instance and period."""
    per_period = probes.groupBy(*series, F.date_trunc(every, F.col(time)).cast("timestamp_ntz").alias("period")).agg(
        F.sum(value).alias("total"), F.count(value).alias("samples"), F.max(value).alias("max_duration")
    )
    return per_period.select(
        *series, "period", "samples", "max_duration",
        (F.col("total").cast("double") / F.col("samples")).alias("avg_duration"),
    )


def freshness(tables: dict[str, tuple[DataFrame, str]], now: Column) -> DataFrame:
    """Age in seconds of the newest row of each table at a given time."""
    ages = [
        df.agg(F.max(time).alias("newest")).select(F.lit(name).alias("table_name"), "newest")
        for name, (df, time) in tables.items()
    ]
    age = ((c.epoch_ms(now) - c.epoch_ms(F.col("newest"))) / 1000).cast("bigint")
    return reduce(DataFrame.unionByName, ages).select("table_name", "newest", age.alias("age_seconds"))


def delay_quantile(df: DataFrame, group: list[str], delay: str, quantile: float, cell: int = 4096) -> DataFrame:
    """The exact discrete quantile of a whole-number delay per group, as `delay_quantile`.

    Rows are counted once per value, before any shuffle too; both steps work on these counts. The first sums them
    per cell of `cell` neighbouring values, the second orders the values of the one cell that holds the quantile.
    """
    share = F.lit(Decimal(str(quantile)))
    counts = df.filter(F.col(delay).isNotNull()).groupBy(*group, delay).agg(F.count("*").alias("n"))
    counts = counts.withColumn("_cell", F.floor(F.col(delay) / cell))
    cells = counts.groupBy(*group, "_cell").agg(F.sum("n").alias("n"))
    upto = W.partitionBy(*group).orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    cells = (
        cells.withColumn("upto", F.sum("n").over(upto))
        .withColumn("events", F.sum("n").over(W.partitionBy(*group)))
        .filter((F.col("upto") >= F.col("events") * share) & (F.col("upto") - F.col("n") < F.col("events") * share))
        .select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_cell").alias("_in"), "events", (F.col("upto") - F.col("n")).alias("before"))
    )
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], F.col("_cell") == F.col("_in"))
    within = W.partitionBy(*group).orderBy(delay).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        counts.join(cells, same)
        .withColumn("upto", F.col("before") + F.sum(counts["n"]).over(within))
        .filter(F.col("upto") >= F.col("events") * share)
        .groupBy(*group)
        .agg(F.min(delay).alias("delay_quantile"), F.max("events").alias("events"))
    )


def delay_sketches(df: DataFrame, group: list[str], time: str, delay: str, every: str = "hour", k: int = 800) -> DataFrame:
    """One mergeable quantile sketch of a whole-number delay per group and period: (group, period, sketch, events).

    Stored once per period, any longer period is answered from the sketches without the rows. A
    sketch has a few KB however many rows it saw; with k = 800 its rank error is about 0.4 %.
    """
    period = F.date_trunc(every, F.col(time)).cast("timestamp_ntz").alias("period")
    known = df.where(F.col(delay).isNotNull())
    return known.groupBy(*group, period).agg(
        F.kll_sketch_agg_bigint(F.col(delay), F.lit(k)).alias("sketch"), F.count("*").alias("events")
    )


def sketched_quantile(sketches: DataFrame, group: list[str], quantile: float) -> DataFrame:
    """The quantile of each group over all periods given, from merged sketches: (group, delay_quantile, events)."""
    merged = sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("events").alias("events"))
    return merged.select(*group, F.kll_sketch_get_quantile_bigint("sketch", F.lit(quantile)).alias("delay_quantile"), "events")


def rank_error(df: DataFrame, group: list[str], delay: str, found: DataFrame, quantile: float) -> DataFrame:
    """How far the rank of a found quantile lies from the wanted one: (group, delay_quantile, events, rank_error).

    A value stands for all ranks of its equals; the error is 0 if the wanted rank is among them.
    """
    answers = _renamed(found.select(*group, "delay_quantile"), group)
    rows = df.where(F.col(delay).isNotNull())
    ranks = rows.join(answers, _of_series(rows, answers, group)).groupBy(*group, "delay_quantile").agg(
        F.count("*").alias("events"),
        (F.count_if(F.col(delay) < F.col("delay_quantile")) / F.count("*")).alias("_low"),
        (F.count_if(F.col(delay) <= F.col("delay_quantile")) / F.count("*")).alias("_high"),
    )
    error = F.greatest(F.col("_low") - quantile, F.lit(quantile) - F.col("_high"), F.lit(0.0))
    return ranks.select(*group, "delay_quantile", "events", error.alias("rank_error"))
