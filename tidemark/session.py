"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# forceOptimizeSkewedJoin lets AQE split a hot key even when the split costs
# another shuffle above the join. Scan tasks read at most 16 MB: they decode their rows into
# text and sort or group them before the shuffle, which takes memory many times that size.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "16MB",
}


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on to a session made elsewhere."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may leave it unset (tests): its one machine is the whole
    cluster, so a local folder is shared. Anywhere else that is an error, as each
    executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
