"""Incremental change-data-capture into a stored target.

Type 1. The target holds the latest event of each key, deletes included, in key buckets
that split as it grows. A micro-batch is reduced to one event per key, merged with what the
touched buckets hold, and those buckets are written anew.

Type 2. Open versions and closed ones lie apart. The open ones (each key's latest event) are
a bucket table as above. A closed version is appended once, in the batch that closed it,
spread over ranges of the sequence, so a hot key has many writers; what a batch rewrites
does not depend on the history behind it. Only events older than their key's open one read
closed versions, those of their own keys: what they change is appended again and the rows
they replace are listed as withdrawn. Deletes are kept as versions that are not shown.

A batch that is retried reads what was there before it and replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.clean import has_map, row_print
from ..operators.materialize import folder, hadoop_path
from ..session import stage
from ..sources.buckets import MOST, BucketTable


@dataclass(frozen=True)
class Flow:
    """What an automatic CDC flow needs to know about its feed."""

    keys: Sequence[str]
    sequence_by: str
    delete_when: Column
    scd_type: int = 1
    drop: Sequence[str] = field(default_factory=tuple)

    def latest(self, events: DataFrame) -> DataFrame:
        return cdc.latest_events(events, self.keys, self.sequence_by, self.delete_when)

    def distinct(self, events: DataFrame) -> DataFrame:
        return cdc.distinct_events(events, self.keys, self.sequence_by, self.delete_when)

    def chain(self, events: DataFrame, unique: bool) -> DataFrame:
        """Every event with where it starts and ends, deletes too; one event per key and sequence.

        ``events`` are read twice, so written ones are asked for: first for the ranges of
        the sequence, then, without repeats unless they are ``unique``, for the chain.
        """
        once = events if unique else self.distinct(events)
        return cdc.scd2(once, self.keys, self.sequence_by, F.lit(False), unique_sequence=True, ranged=events)

    def shown(self, versions: DataFrame) -> DataFrame:
        return versions.where(~F.coalesce(self.delete_when, F.lit(False))).drop(*self.drop)


def run_cdc(stream: DataFrame, flow: Flow, target: str, checkpoint: str, most: int = MOST) -> None:
    """Apply everything that arrived since the last run, then stop."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, flow, target, most)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def apply_batch(batch: DataFrame, batch_id: int, flow: Flow, target: str, most: int = MOST) -> None:
    """Merge a batch into the target; a bucket holds ``most`` rows on average at most."""
    table = BucketTable(batch.sparkSession, f"{target}/open", flow.keys, most)
    if flow.scd_type == 1:
        table.apply(batch_id, flow.latest(batch), flow.latest)
    else:
        _apply_history(batch, batch_id, flow, target, table)


def read_target(spark: SparkSession, flow: Flow, target: str) -> DataFrame:
    """The current table for type 1, the history for type 2."""
    stored = BucketTable(spark, f"{target}/open", flow.keys).read()
    if flow.scd_type == 1:
        return flow.shown(stored)
    seq = F.col(flow.sequence_by)
    versions = stored.withColumns({"__START_AT": seq, "__END_AT": F.lit(None).cast(stored.schema[flow.sequence_by].dataType)})
    closed = _closed(spark, target)
    return flow.shown(versions if closed is None else closed.unionByName(versions))


def _apply_history(batch: DataFrame, batch_id: int, flow: Flow, target: str, table: BucketTable) -> None:
    spark, seq = batch.sparkSession, flow.sequence_by
    events = stage(flow.distinct(batch), "events")
    if events.isEmpty():
        return
    before = table.lookup(events, batch_id)
    known, late = events, None
    if before is not None:
        before = stage(before, "open-before")
        known = events.unionByName(before)
        late = _of_keys(events, before, flow.keys, F.col(seq) < F.col("_seq"), seq)
        late = stage(late.select(*flow.keys).distinct(), "late-keys")
        past = _closed(spark, target, batch_id)
        late = None if past is None or late.isEmpty() else stage(_of_keys(past, late, flow.keys), "past")
    if late is not None:  # the whole chain of keys with late events, put together again
        known = known.unionByName(late.drop("__START_AT", "__END_AT"))
    chain = stage(flow.chain(known, unique=before is None), "chain")
    closed = chain.where(F.col("__END_AT").isNotNull())
    gone = None
    if late is not None:
        closed, gone = _only(closed, late, flow)
    # batches of both kinds are complete before the open versions name the batch as applied
    closed.write.mode("overwrite").parquet(f"{target}/closed/v={batch_id:010d}")
    if gone is not None:
        gone.write.mode("overwrite").parquet(f"{target}/gone/v={batch_id:010d}")
    table.apply(batch_id, chain.where(F.col("__END_AT").isNull()).drop("__START_AT", "__END_AT"), flow.latest, replaced=True)


def _of_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str], when: Column | None = None, seq: str | None = None) -> DataFrame:
    """Rows whose key ``others`` has; NULL is a key. ``when`` may compare with the other row's ``_seq``."""
    right = others.select(F.struct(*keys).alias("_key"), *([F.col(seq).alias("_seq")] if seq else []))
    same = F.struct(*[rows[k] for k in keys]) == F.col("_key")
    return rows.join(right, same if when is None else same & when, "left_semi")


def _only(rows: DataFrame, others: DataFrame, flow: Flow) -> tuple[DataFrame, DataFrame]:
    """Versions of ``rows`` that ``others`` has not, and the reverse, by key, window and print."""
    cols = [c for c in rows.columns if c not in (*flow.keys, "__START_AT", "__END_AT")]

    def side(df: DataFrame, s: str) -> DataFrame:
        name = F.struct(*[F.col(k) for k in flow.keys], F.col("__START_AT"), F.col("__END_AT"), row_print(df, cols).alias("_print"))
        return df.select(name.alias(f"_name{s}"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias(f"_row{s}"))

    both = side(rows, "0").join(side(others, "1"), F.col("_name0") == F.col("_name1"), "full").where("_name0 IS NULL OR _name1 IS NULL")
    both = stage(both.select("_row0", "_row1"), "one-sided")
    return both.where("_row0 IS NOT NULL").select("_row0.*"), both.where("_row1 IS NOT NULL").select("_row1.*")


def _closed(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """Closed versions that later batches have not withdrawn; None without any."""
    rows, gone = (_batches(spark, f"{target}/{kind}", before) for kind in ("closed", "gone"))
    if rows is None or gone is None:
        return rows
    names = [F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in _maps(rows)], row_print(df, rows.columns).alias("_print")) for df in (rows, gone)]
    # a withdrawn version never comes back: later events only split windows further
    return rows.withColumn("_name", names[0]).join(gone.select(names[1].alias("_other")).distinct(), F.col("_name") == F.col("_other"), "left_anti").drop("_name")


def _maps(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if has_map(f.dataType)]


def _batches(spark: SparkSession, path: str, before: int | None) -> DataFrame | None:
    files, home = folder(spark, path), hadoop_path(spark, path)
    if not files.exists(home):
        return None
    found = sorted(s.getPath().toString() for s in files.listStatus(home) if files.exists(hadoop_path(spark, f"{s.getPath()}/_SUCCESS")))
    found = [p for p in found if before is None or int(p.rsplit("v=", 1)[1]) < before]
    return spark.read.parquet(*found) if found else None
