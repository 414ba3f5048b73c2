"""As-of join: every event with the attributes that were valid at its time.

``versions`` has one row per change of a key's attributes and the time from
which it holds. The join is not a join of events with versions at all:

1. Time is cut into slots of ``slot_seconds``. A narrow pass over the events
   and the versions gives the cells (key, slot) that hold events and the last
   version of each cell (aggregates, combined map-side).
2. A window per key over its cells carries the last version forward into each
   later cell: at most span / slot rows per key, however many events it has.
3. Events, versions and carried versions are ordered within one cell only, and
   each event takes the last version before it.

So a key with a third of all events is split over its slots; the largest window
partition holds one key's events within one slot. Events are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import time_bucket

SLOT_SECONDS = 3600
UNPLACED_SLOTS = 4096


def latest_versions(versions: DataFrame, key: str, valid_from: str, attributes: list[str]) -> DataFrame:
    """One version per key and time: of several the greatest by ``attributes``
    in their order. Versions without key or time are left out."""
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    return (known.groupBy(F.col(key).alias("_key"), F.col(valid_from).alias("_at"))
            .agg(F.max(F.struct(*attributes)).alias("_attributes")))


def asof_join(events: DataFrame, versions: DataFrame, key: str, ts: str, attributes: list[str],
              valid_from: str = "valid_from", slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """All events with ``valid_from`` and ``attributes`` of the latest version
    of their key that is not later than the event.

    A version holds from its very time on, so an event at the same time has
    it. Of versions of one key and time the greatest by ``attributes`` (in
    their order) holds. Events before their key's first version, of keys
    without versions, or without key or time keep NULLs; no event is lost or
    doubled. The new columns must not stand in ``events``.
    """
    clash = {valid_from, *attributes} & set(events.columns)
    if clash:
        raise ValueError(f"events have columns of the same name: {sorted(clash)}")
    changes = latest_versions(versions, key, valid_from, attributes)
    changes = changes.select("_key", time_bucket("_at", slot_seconds).alias("_slot"), "_at",
                             F.struct("_at", "_attributes").alias("_version"))
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()

    cells = (events.where(placed).select(F.col(key).alias("_key"), time_bucket(ts, slot_seconds).alias("_slot"))
             .distinct().withColumn("_version", F.lit(None).cast(changes.schema["_version"].dataType)))
    cells = (cells.withColumn("_events", F.lit(True))
             .unionByName(changes.drop("_at").withColumn("_events", F.lit(False)))
             .groupBy("_key", "_slot").agg(F.max("_version").alias("_version"), F.max("_events").alias("_events")))
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (cells.withColumn("_version", F.last("_version", ignorenulls=True).over(earlier))
               .where(F.col("_events") & F.col("_version").isNotNull())
               .select("_key", "_slot", F.col("_version._at").alias("_at"), "_version"))

    # rows without key or time have no version: dealt over slots of their own
    unplaced = F.lit(-1) - F.pmod(F.xxhash64(*events.columns), F.lit(UNPLACED_SLOTS))
    rows = events.select("*", F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(True).alias("_event"),
                         F.when(placed, time_bucket(ts, slot_seconds)).otherwise(unplaced).alias("_slot"))
    both = rows.unionByName(carried.unionByName(changes).withColumn("_event", F.lit(False)), allowMissingColumns=True)
    upto = (Window.partitionBy("_key", "_slot").orderBy("_at", "_event")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = both.withColumn("_held", F.last("_version", ignorenulls=True).over(upto)).where("_event")
    return joined.select(*events.columns, F.col("_held._at").alias(valid_from),
                         *[F.col("_held._attributes")[a].alias(a) for a in attributes])
