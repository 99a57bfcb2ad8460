"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_local_root: dict[str, str] = {}


def build_session(app_name: str = "ladderline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for; ANSI mode stays on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster, executors could not
    read each other's files there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if "root" not in _local_root:
        _local_root["root"] = tempfile.mkdtemp(prefix="ladderline-")
        atexit.register(shutil.rmtree, _local_root["root"], ignore_errors=True)
    return _local_root["root"]


def stage(
    df: DataFrame,
    label: str = "stage",
    partition_by: list[str] | None = None,
    reader: SparkSession | None = None,
) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Used where a plan reads one intermediate result several times: the lineage ends at the table, so a
    lost executor never re-runs the scan behind it, and positions assigned during the scan are fixed.
    ``reader`` is the session that reads it back (micro-batches come with a session of their own).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    read = (reader or spark).read.schema(_readable(df, partition_by)).parquet(path)
    read._staged_at = path
    return read


def unstage(df: DataFrame) -> None:
    """Remove the table behind ``df``, the very frame that ``stage`` returned, once nothing will read it again."""
    path = getattr(df, "_staged_at", None)
    if path:
        jvm = df.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _readable(df: DataFrame, partition_by: list[str] | None):
    """The schema of the written table: partition columns come last."""
    schema = df.schema
    if not partition_by:
        return schema
    fields = [f for f in schema if f.name not in partition_by] + [schema[name] for name in partition_by]
    return type(schema)(fields)
