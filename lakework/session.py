"""Sessions with the settings that the operators rely on."""

from __future__ import annotations

import atexit
import tempfile

from pyspark.sql import SparkSession

#: Spark's own setting for a folder that driver and executors share.
CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Later keys win in ``map_concat`` (edits over originals), skew joins are split, times are UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "lakework", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    On a cluster it is the session's ``spark.checkpoint.dir``.  Only where that is
    unset and Spark runs in one process (local tests) a temporary folder is made,
    and removed at exit.
    """
    context = spark.sparkContext
    found = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if not found and context._jsc.sc().getCheckpointDir().isDefined():
        found = context._jsc.sc().getCheckpointDir().get()
    if not found:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
        holder = tempfile.TemporaryDirectory(prefix="lakework-")
        atexit.register(holder.cleanup)
        found = f"file://{holder.name}"
        context.setCheckpointDir(found)
    return found.rstrip("/")
