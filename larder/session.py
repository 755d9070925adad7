"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make the plans in this package hold at scale. AQE splits skewed join
# partitions and turns sort-merge joins into broadcast joins only after it has *measured*
# the small side, so no operator needs a broadcast hint.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "larder", master: str | None = None, **settings: str) -> SparkSession:
    """A session with :data:`SCALE_SETTINGS`; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets one folder of its own for the session; on a cluster the
    executors would each write to their own disk, so an unset folder is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="larder-")
        root = _LOCAL_FOLDERS[context.applicationId]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder of a store holds; nothing if it is not there."""
    store, target = _located(spark, path)
    return [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, which must not be there."""
    store, target = _located(spark, path)
    store.create(target, False).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the store that ``path`` is in, if it is there."""
    store, target = _located(spark, path)
    store.delete(target, True)
