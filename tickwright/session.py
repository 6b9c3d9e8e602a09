"""Session settings and the shared folder for checkpoints and state."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app: str = "tickwright", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution; cluster settings win over these."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Levels meet their day's prices by hash, without being sorted, where each part is small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """One folder for this process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="tickwright-", ignore_cleanup_errors=True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Where that is not set, a session within this one process gets a temporary folder; a cluster gets an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder().name
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
