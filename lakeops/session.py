"""SparkSession construction and shared-folder helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are unset, so a cluster's own choices always win.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on. Applied only when unset.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "lakeops",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster sets it; ``DataFrame.checkpoint`` uses it too. Only a session on a
    local master without the setting gets a fresh scratch folder; elsewhere that
    is an error.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf)
        return conf
    d = sc.getCheckpointDir()
    if d:
        return d
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder "
                           "that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="lakeops-ckpt-")
    sc.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables that cut
    lineage and for streaming checkpoints)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts]])


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
