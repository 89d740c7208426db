"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Meter timestamps carry no zone; truncating them goes through the session
# zone, so any zone with clock changes would move readings between buckets.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "wattspan", master: str | None = None, **conf) -> SparkSession:
    """A session with the pinned settings; the cluster's own settings otherwise."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**PINNED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the pinned settings to a session somebody else built."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


# The folder of a local session that names none; made once.
_OWN: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    A folder of this machine is used only on a local master without the setting, which stays
    as it is.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="wattspan-"))
        base = _OWN[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_dir`` once its rows are stored elsewhere."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(folder, True)
