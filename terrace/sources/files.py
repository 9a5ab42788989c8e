"""File-system metadata through the cluster's own Hadoop file systems.

Only names and small pointer files pass through the driver, never table rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _open(spark, path)
    return system.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; empty when it does not exist."""
    target, system = _open(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def read_small(spark: SparkSession, path: str) -> str:
    target, system = _open(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all, and never replaces another."""
    target, system = _open(spark, path)
    partial, _ = _open(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    system.mkdirs(target.getParent())
    stream = system.create(partial, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(partial, target):
        system.delete(partial, False)
        raise FileExistsError(path)
