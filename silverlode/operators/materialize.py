"""Views and refreshable snapshots.

A live view stores only the query text. A snapshot is a folder of Parquet files
under a new version path plus a catalog view that points to it; replacing that
view is the single step that makes a refresh visible, so readers never see half
of one, and a failed refresh leaves the old version in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def live_view(df: DataFrame, name: str, scope: str = "session") -> DataFrame:
    """Register a temporary view for this session or for every session of the application."""
    if scope == "session":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if scope == "global":
        df.createOrReplaceGlobalTempView(name)
        return df.sparkSession.table(f"global_temp.{name}")
    raise ValueError("scope is 'session' or 'global'")


def persistent_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Catalog view recomputed on every read."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def refresh_snapshot(
    spark: SparkSession, name: str, build: Callable[[SparkSession], DataFrame], root: str | None = None
) -> DataFrame:
    """Recompute ``build`` into a new version folder below ``root`` and point ``name`` at it.

    ``build`` receives the session and must read persistent inputs itself; that is what
    lets another session, or a later run, refresh the same snapshot. ``root`` is a durable
    folder of the snapshot's own; it outlives the job, and a session without the view
    takes the newest version from :func:`current_snapshot`. The version before the newest
    stays for readers that have already planned on it; older ones are removed. Without
    ``root`` the snapshot lives in the scratch area, as long as that does.
    """
    home = (root or scratch_path(spark, f"snapshot/{name}")).rstrip("/")
    known = _versions(spark, home)
    path = f"{home}/v={(known[-1] if known else 0) + 1:010d}"
    build(spark).write.mode("overwrite").parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    files = folder(spark, home)
    for version in known[:-1]:
        files.delete(hadoop_path(spark, f"{home}/v={version:010d}"), True)
    return spark.table(name)


def current_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Newest complete version below ``root``, without any catalog."""
    known = _versions(spark, root.rstrip("/"))
    if not known:
        raise FileNotFoundError(f"no complete snapshot below {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v={known[-1]:010d}")


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def folder(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, home: str) -> list[int]:
    """Numbers of the versions that were written to the end, ascending."""
    files = folder(spark, home)
    if not files.exists(hadoop_path(spark, home)):
        return []
    found = [s.getPath() for s in files.listStatus(hadoop_path(spark, home)) if s.getPath().getName().startswith("v=")]
    return sorted(int(p.getName()[2:]) for p in found if files.exists(hadoop_path(spark, f"{p}/_SUCCESS")))
