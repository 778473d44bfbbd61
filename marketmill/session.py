"""Session defaults and the shared scratch area."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold at every data size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

PARTITION_BYTES = 256 * 1024**2
TERABYTE = 1024**4


def cluster_conf(shuffle_bytes: int) -> dict[str, str]:
    """Read splits, shuffle partitions and written files of about 256 MB.

    `shuffle_bytes` is what the largest shuffle is expected to move. AQE merges
    partitions that turn out smaller, up to that size and not just to keep all cores
    busy, so that tables are not written as many small files.
    """
    width = str(max(200, math.ceil(shuffle_bytes / PARTITION_BYTES)))
    return {
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.shuffle.partitions": width,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": width,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    }


def build_session(
    app: str = "marketmill",
    master: str | None = None,
    shuffle_bytes: int = 5 * TERABYTE,
    **conf: str,
) -> SparkSession:
    """A session with the base settings, and those for a local run or for a cluster.

    `shuffle_bytes` sizes the shuffles of a cluster: reading 100 TB of wide raw tables,
    the marts move a few columns of them, merged per task. Keyword settings use `__`
    for the dots, e.g. `spark__driver__memory="8g"`.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(BASE_CONF)
    if master is not None:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    settings.update(LOCAL_CONF if local else cluster_conf(shuffle_bytes))
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may do without the setting: driver and executors are then
    one process, so a temporary folder is as good as a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = spark.conf.get("spark.marketmill.localFolder", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="marketmill-")
        spark.conf.set("spark.marketmill.localFolder", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/marketmill/{name}-{uuid.uuid4().hex[:12]}"
