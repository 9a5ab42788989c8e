"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Capturing the Python call site of every column expression makes wide plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "terrace", **settings: str) -> SparkSession:
    """A session with the settings the library relies on; ``settings`` override."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Fail early when wall-clock casts would shift values.

    Casting an instant to TIMESTAMP_NTZ uses the session time zone, so any zone
    but UTC would silently move the hours that a source published.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in {"UTC", "ETC/UTC", "Z", "+00:00", "GMT"}:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="terrace-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
