"""Session helpers. Library code never sets a master, memory or partition count."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str = "meterlake", cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A UTC session on this machine, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; also sets it for ``checkpoint()``.

    Only a local session may go without the setting: it gets a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getCheckpointDir() or context.getConf().get(_CHECKPOINT_DIR) or spark.conf.get(_CHECKPOINT_DIR, None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="meterlake-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
