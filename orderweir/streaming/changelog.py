"""The customer changelog of a stream: one snapshot out per event in, from keyed state.

Every customer's totals are one value in the state store. A micro-batch reads and
writes the values of its own customers and emits its own snapshots; nothing
stored earlier is read or rewritten.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from orderweir.functions.columns import MONEY, has_key
from orderweir.operators.projections import CUSTOMER_LATEST, CUSTOMER_SUMS
from orderweir.streaming.sinks import append_batch

SNAPSHOT = (
    "customerId string, customerName string, customerEmail string, customerSegment string, "
    "orderCount bigint, totalSpent decimal(18,2), lastOrderId string, updatedAt timestamp_ntz, currency string"
)
FIELDS = [field.split()[0] for field in SNAPSHOT.split(", ")]
# Times travel as microseconds: state and events then compare as whole numbers.
STATE = SNAPSHOT.replace("updatedAt timestamp_ntz", "updatedAt bigint") + ", lastArrival bigint"
SNAPSHOT_ROW = Row(*FIELDS)
# Places in a state and in an event, which has its own arrival in place of the last one.
TIME, ARRIVAL = FIELDS.index("updatedAt"), len(FIELDS)
SUMS = [FIELDS.index(name) for name in CUSTOMER_SUMS]
NEWEST = [TIME, ARRIVAL, *(FIELDS.index(name) for name in CUSTOMER_LATEST)]


class RunningTotals(StatefulProcessor):
    """Totals so far and the attributes of the newest event so far, per customer.

    Events of one micro-batch are taken by arrival. A late event adds to the totals and
    leaves newer attributes alone; on equal times the later arrival wins, and an event
    without a time never replaces one that has a time. With `keep_for` the totals of a customer without
    events for so long are dropped by the store, and start anew.
    """

    def __init__(self, keep_for: datetime.timedelta | None = None):
        self.keep_for = keep_for

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = int(self.keep_for.total_seconds() * 1000) if self.keep_for else None
        self.totals = handle.getValueState("totals", STATE, ttlDurationMs=ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # One call to the store tells whether there are totals and which; rows and state have the columns of STATE in order.
        known = self.totals.get()
        now = list(known) if known else None
        for event in sorted(rows, key=itemgetter(ARRIVAL)):
            if now is None:
                now = list(event)
                for i in SUMS:
                    now[i] = now[i] or 0
            else:
                for i in SUMS:
                    now[i] += event[i] or 0
                at, before = event[TIME], now[TIME]
                if (at is not None, at or 0, event[ARRIVAL]) >= (before is not None, before or 0, now[ARRIVAL]):
                    for i in NEWEST:
                        now[i] = event[i]
            yield SNAPSHOT_ROW(*now[:ARRIVAL])
        if now:
            self.totals.update(tuple(now))

    def close(self) -> None:
        pass


def snapshots(contributions: DataFrame, arrival: str, keep_for: datetime.timedelta | None = None) -> DataFrame:
    """One snapshot per customer contribution of a stream, for append mode; contributions without a customer are left out.

    `arrival` is a unique whole number per customer that rises with the order of delivery. All events of a customer in one
    micro-batch are one task's work, so the source's bound on a micro-batch bounds it too. State is
    one row per customer. With `keep_for` run the query on an interval: a clock drives its expiry, so
    a query over what is available would not end.
    """
    shaped = {"totalSpent": F.col("totalSpent").cast(MONEY), "updatedAt": F.expr("unix_micros(cast(updatedAt as timestamp))")}
    events = contributions.filter(has_key(F.col("customerId"))).select(
        *[shaped.get(name, F.col(name)).alias(name) for name in FIELDS],
        F.col(arrival).cast("bigint").alias("arrival"),
    )
    emitted = events.groupBy("customerId").transformWithState(
        RunningTotals(keep_for),
        outputStructType=STATE.removesuffix(", lastArrival bigint"),
        outputMode="Append",
        timeMode="ProcessingTime" if keep_for else "None",
    )
    return emitted.withColumn("updatedAt", F.expr("cast(timestamp_micros(updatedAt) as timestamp_ntz)")).select(FIELDS)


def log_snapshots(stream: DataFrame, path: str):
    """A writer that appends the snapshots of each micro-batch to a log; a repeated batch replaces its own rows."""
    return stream.writeStream.outputMode("append").foreachBatch(lambda batch, i: append_batch(batch, i, path))
