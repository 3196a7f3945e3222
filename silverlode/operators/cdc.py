"""Change feeds to current state (type 1) or history (type 2).

A feed row carries key columns, a payload, an operation and a sequence number.
Order is decided by the sequence alone, never by arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clean import row_print
from .ordering import order_cuts, range_bucket


def latest_events(feed: DataFrame, keys: Sequence[str], seq: str, delete_when: Column) -> DataFrame:
    """One row per key: the event with the greatest sequence, deletes included.

    An associative maximum, so it combines on the map side, tolerates any arrival
    order, and applying it to its own output plus new events gives the same answer
    as applying it to all events. Equal sequences: a delete wins.
    """
    payload = [c for c in feed.columns if c not in keys]
    dead = F.coalesce(delete_when, F.lit(False))
    # equal sequences of one kind: decided by a print of the payload, which may hold maps
    order = F.struct(F.col(seq), dead, row_print(feed, [c for c in payload if c != seq]))
    picked = feed.groupBy(*keys).agg(F.max_by(F.struct(*payload), order).alias("_e"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_e.{c}").alias(c) for c in feed.columns])


def scd1(
    feed: DataFrame, keys: Sequence[str], seq: str, delete_when: Column, drop: Sequence[str] = ()
) -> DataFrame:
    """Current state: the latest event per key, keys whose latest event is a delete removed."""
    current = latest_events(feed, keys, seq, delete_when)
    return current.where(~F.coalesce(delete_when, F.lit(False))).drop(*drop)


def merge_scd1(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str, delete_when: Column
) -> DataFrame:
    """State (with its tombstones) after a batch; late events lose to newer ones already applied."""
    return latest_events(state.unionByName(batch), keys, seq, delete_when)


def distinct_events(feed: DataFrame, keys: Sequence[str], seq: str, delete_when: Column) -> DataFrame:
    """One event per key and sequence. Equal sequences: a delete wins."""
    return latest_events(feed, [*keys, seq], seq, delete_when)


def scd2(
    feed: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: Column,
    drop: Sequence[str] = (),
    parts: int | None = None,
    collapse: bool = False,
    unique_sequence: bool = False,
    ranged: DataFrame | None = None,
) -> DataFrame:
    """History: a version per non-delete event with ``__START_AT`` and ``__END_AT``.

    A version ends where the key's next event starts; a delete closes without opening.
    ``collapse`` merges consecutive events with the same payload. ``unique_sequence``
    states that a key never repeats a sequence number, which saves one shuffle.

    A single key may own a large share of the feed, so a key's events are not sorted
    in one task. The sequence axis is cut into ``parts`` ranges of near-equal size;
    events find their successor inside (key, range), and only the last event of a
    range looks up where the key's next non-empty range begins. Any (key, range)
    group holds at most about ``1/parts`` of the feed, whatever the key distribution.
    The cuts come from a scan of its own, of ``ranged`` where the same events are cheaper
    to read than the feed is to compute again.
    """
    parts = parts or int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = order_cuts(feed if ranged is None else ranged, seq, parts)
    events = feed if unique_sequence else distinct_events(feed, keys, seq, delete_when)
    events = events.withColumn("_range", range_bucket(F.col(seq), cuts))
    shown = [c for c in feed.columns if c not in (*keys, seq, *drop)]

    def history(some: DataFrame, by: Sequence[str]) -> DataFrame:
        if collapse:
            some = _without_repeats(some, by, seq, delete_when, shown)
        ended = _neighbour(some, by, seq, F.lead, F.min_by, "__END_AT", F.col(seq))
        return ended.where(~F.coalesce(delete_when, F.lit(False))).select(
            *[F.col(c) for c in feed.columns if c not in drop],
            F.col(seq).alias("__START_AT"),
            "__END_AT",
        )

    # one struct for the key: its NULL members compare as equal, in windows and in the join
    return history(events.withColumn("_key", F.struct(*keys)), ["_key"])


def _neighbour(
    events: DataFrame, by: Sequence[str], seq: str, step, edge, out: str, value: Column
) -> DataFrame:
    """Value of the next (``lead``, ``min_by``) or previous (``lag``, ``max_by``) event of the key."""
    inside = Window.partitionBy(*by, "_range").orderBy(seq)
    across = Window.partitionBy(*by).orderBy("_range")
    local = events.withColumn("_local", step(value).over(inside))
    # grouped like the window above, so the edges reuse its shuffle
    edges = local.groupBy(*by, "_range").agg(edge(value, F.col(seq)).alias("_edge"))
    hops = edges.select(*by, "_range", step("_edge").over(across).alias("_hop"))
    joined = local.join(hops, [*by, "_range"], "left")
    return joined.withColumn(out, F.coalesce("_local", "_hop")).drop("_local", "_hop")


def _without_repeats(
    events: DataFrame, by: Sequence[str], seq: str, delete_when: Column, shown: Sequence[str]
) -> DataFrame:
    """Drop events whose payload and liveness equal those of the event before."""
    print_ = F.struct(F.coalesce(delete_when, F.lit(False)).alias("_dead"), *shown)
    marked = _neighbour(events, by, seq, F.lag, F.max_by, "_prev", print_)
    return marked.where(~F.coalesce(F.col("_prev") == print_, F.lit(False))).drop("_prev")
