"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Wall-clock UTC throughout; adaptive execution sizes and splits shuffle partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "delaycast", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the cluster's shared checkpoint folder.

    Written intermediates must outlive any executor, so they go where ``spark.checkpoint.dir``
    points. Only a local session that names no such folder (unit tests) gets a local one; on a
    cluster that is an error, since other machines could not read it.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="delaycast-")
        root = _local_root
    return f"{root.rstrip('/')}/delaycast/{name}-{uuid.uuid4().hex}"
