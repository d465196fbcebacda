"""Session helpers.

The library never creates its own cluster settings beyond sane local
defaults: on a cluster the caller's session is used as-is.  Intermediate
files go under ``spark.checkpoint.dir`` (a shared folder named by the
cluster); a default is only set when the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wattlake") -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("WATTLAKE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a local one is set only if unset and Spark runs in one process."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = os.path.join("/tmp", "wattlake-checkpoints")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once (they may not have it on their path)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="wattlake-package-"), "wattlake.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/wattlake-{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows, written once to the shared folder as columns and read back: what follows reads only the columns it
    takes, and with ``by`` only the directories that its filters on those columns leave."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
