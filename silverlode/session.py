"""Session defaults and the shared scratch area used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_root: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "silverlode", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark. A cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # laptop-sized inputs: keep every core busy although partitions are tiny
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _own_root[app] = tempfile.mkdtemp(prefix="silverlode-")
        atexit.register(shutil.rmtree, _own_root[app], ignore_errors=True)
    return _own_root[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder, grouped by application for clean-up."""
    return f"{scratch_root(spark)}/silverlode/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and continue from the files.

    Later passes read only the columns they need, a lost executor re-reads files
    instead of recomputing the lineage, and values that depend on the physical
    layout (row positions) are frozen.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
