"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


_LOCAL_DIRS: dict[str, str] = {}
_WRITTEN: list[str] = []


def build_session(app: str = "dockcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans expect; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster every
    executor has to reach the folder, so an unset value is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.master.startswith("local") and configured.startswith(("/", "file:")):
            warnings.warn(f"{configured} has to be a mount that all executors share", stacklevel=2)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="dockcast-")
        spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Deletes the tables this process wrote to the shared folder, and only those.

    For the end of a run: results that are still wanted have to be saved before.
    """
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = hadoop.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage like a checkpoint does, keeps the columns in Parquet so later
    readers prune them, and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
