"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = "*", app_name: str = "colweave", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine only.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="colweave-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/colweave-{app}/{name}-{uuid.uuid4().hex}"


SPREAD_PARTITIONS = 64


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Give a small input as many tasks as there are cores.

    A file of one row group is one task, however many cores wait. Inputs of 64
    partitions or more are left alone, so no large table is ever shuffled here;
    filters and column pruning still reach the scan. ``columns`` should be
    nearly unique together: their hash spreads rows evenly, gives a lost task
    the same rows again, and spares the sort that plain repartitioning needs.
    """
    cores = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_PARTITIONS)
    return df.repartition(cores, *columns) if df.rdd.getNumPartitions() < cores else df


def discard(*settled: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for df in settled:
        context = df.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage so that a lost executor costs a re-read and not a re-run,
    and freezes values that depend on the physical layout of the rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
