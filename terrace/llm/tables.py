"""Reading the given tables, and tables written on the way."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write below spark.checkpoint.dir and read again: cuts lineage, computes once, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(df: DataFrame, rows: int) -> int:
    """How many parts of about ``rows`` rows a table makes; the parts grow in number, not in size."""
    return max(1, -(-df.count() // rows))


def remainder(name: str, divisor: int):
    """crc32 of an id's decimal text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % divisor


#: Rows and bytes that go to a Python worker at once: a worker and its executor hold a few megabytes of text, or one longer text.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors' Python, once per application; lower the session's Arrow batches to ``BATCH``."""
    for name, most in BATCH.items():
        given = spark.conf.get(name, None)
        if given is None or not given.isdigit() or not 0 < int(given) <= most:
            spark.conf.set(name, str(most))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="terrace-code-")) / "terrace-code.zip"  # the driver serves this file
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "terrace").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
