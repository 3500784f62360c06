"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # page and payload parsing is heavy per byte: do not merge small shuffle blocks into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # split a hot key even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # keep the map-side row limit for per-key samples larger than the default 1000
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # a recursive query over nested values ends when nothing is left, however many nodes and levels there are
    "spark.sql.cteRecursionLevelLimit": "-1",
    "spark.sql.cteRecursionRowLimit": "-1",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows go to Python by bytes, not by the count alone: pages and texts are of any length
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "shelfgrain", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Put the SQL settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local-mode session without that setting gets a temporary folder of its own,
    which goes when the process ends. In a shared folder `discard` removes what is done with.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="shelfgrain-")
            atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
        shared = _LOCAL_FOLDERS[app]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder whose rows are no longer needed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
