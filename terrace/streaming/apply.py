"""Clean tables kept up to date by micro-batches.

The state of a table is cut into parts, by the month of the key and a bucket of the key's
hash. A part holds one row per key and instant with its place on the key's timeline, so
the current rows and the history are filters over it. Every micro-batch
is written once, split into accepted and rejected rows and by part. The parts it touches,
and only those, are then rebuilt from their stored rows and the new ones: copies of an
instant collapse, and each row gets its version anew, so rows may arrive in any order. The
cost of a batch follows the parts it touches, not the rows ever accepted.

One small manifest names the folder in force for each part, so a batch becomes visible at once or
not at all and a repeated batch changes nothing. It grows with parts, never with batches
or rows: rejected rows and rule counts are found by their batch numbers.

Nothing is kept only in executor memory: each step reads files that the step
before it wrote, so a lost executor costs a retry and never a wrong count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import history, quality
from terrace.operators import timeline as tl
from terrace.plans.spec import (
    HISTORY_COLUMNS,
    SEQUENCE,
    VERSION_COLUMNS,
    VIOLATED,
    VIOLATED_COLUMN,
    CleanTable,
    Column,
    check_schema,
    names_of,
    struct_of,
)
from terrace.session import require_utc
from terrace.sources.files import list_names, path_exists, publish_small, read_small

ACCEPTED, PART, NUMBER, RUN_ENDS, BATCH = "accepted", "state_part", "version_number", "version_ends", "batch"
COUNT_COLUMNS = tuple(
    Column(n, t) for n, t in (
        ("table", "string"), ("rule", "string"), ("kind", "string"), ("passed", "bigint"), ("failed", "bigint"),
    )
)


@dataclass
class Manifest:
    """Which folders are in force. Grows with the parts of the state, never with batches or rows."""

    last_batch: int = -1
    buckets: int = 0
    parts: dict[str, int] = field(default_factory=dict)


def _month_of(part: str) -> str:
    return part.split("=", 1)[1].rsplit(".", 1)[0]


class CheckpointLost(Exception):
    """The state is ahead of a checkpoint that no longer exists."""


class IncrementalTable:
    """State of one clean table below ``root`` (a folder that all executors reach)."""

    def __init__(self, table: CleanTable, root: str, buckets: int | None = None):
        self.table = table
        self.root = root.rstrip("/")
        self.buckets = table.state_buckets if buckets is None else buckets

    # -- generations ---------------------------------------------------------------

    def _generation(self, spark: SparkSession) -> str:
        published = [n for n in list_names(spark, f"{self.root}/_generations") if not n.endswith(".tmp")]
        name = read_small(spark, f"{self.root}/_generations/{published[-1]}") if published else f"generation={0:06d}"
        return f"{self.root}/{name}"

    def _manifest(self, spark: SparkSession, base: str) -> Manifest:
        names = [n for n in list_names(spark, f"{base}/_manifest") if not n.endswith(".tmp")]
        if not names:
            return Manifest()
        return Manifest(**json.loads(read_small(spark, f"{base}/_manifest/{names[-1]}")))

    # -- readers -------------------------------------------------------------------

    def _read(self, spark: SparkSession, paths: Sequence[str], cols: Sequence[Column]) -> DataFrame:
        schema = struct_of(cols)
        if not paths:
            return spark.createDataFrame([], schema)
        # The folders are already chosen by name, so no partition columns are inferred.
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def months(self, spark: SparkSession) -> dict[str, str]:
        """Each month of the key, with a mark that changes whenever a row of the month may have."""
        base, out = self._generation(spark), {}
        for part, batch in sorted(self._manifest(spark, base).parts.items()):
            month, bucket = _month_of(part), part.rsplit(".", 1)[1]
            out[month] = f"{out.get(month, base.rsplit('/', 1)[1])} {bucket}:{batch}"
        return out

    def _state(self, spark: SparkSession, months: Collection[str] | None = None) -> DataFrame:
        base = self._generation(spark)
        live = self._manifest(spark, base).parts
        paths = [f"{base}/state/batch={b}/{p}" for p, b in live.items() if months is None or _month_of(p) in months]
        cols = (*self.table.stored, *HISTORY_COLUMNS, Column(NUMBER, "int"), Column(RUN_ENDS, "boolean"))
        return self._read(spark, paths, cols)

    def current(self, spark: SparkSession, months: Collection[str] | None = None) -> DataFrame:
        """Row in force per key (the last one of its timeline, which no other ends), of some months or of all."""
        return self._state(spark, months).filter(F.col(history.END_AT).isNull() & F.col(RUN_ENDS)).select(*names_of(self.table.stored))

    def _numbered_history(self, spark: SparkSession) -> DataFrame:
        versions = self._state(spark).filter(RUN_ENDS).drop(RUN_ENDS)
        return versions if self.table.versioned else versions.limit(0)

    def history(self, spark: SparkSession) -> DataFrame:
        """All versions with their technical columns."""
        return self._numbered_history(spark).drop(NUMBER)

    def versions(self, spark: SparkSession) -> DataFrame:
        """All versions with business names; numbers were stored with the history."""
        return history.with_business_names(self._numbered_history(spark), NUMBER, SEQUENCE, VERSION_COLUMNS)

    def _by_batch(self, spark: SparkSession, folder: str, cols: Sequence[Column], *folders: Column) -> DataFrame:
        """Rows of all batches that count, with the columns that folders below the batch stand for."""
        base = self._generation(spark)
        schema = struct_of((*cols, Column(BATCH, "bigint"), *folders))
        if not path_exists(spark, f"{base}/{folder}"):
            return spark.createDataFrame([], schema)
        # A batch that did not end has a number above the last one.
        return spark.read.schema(schema).parquet(f"{base}/{folder}").filter(F.col(BATCH) <= self._manifest(spark, base).last_batch)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        cols = (*self.table.stored, VIOLATED_COLUMN)
        staged = self._by_batch(spark, "staged", cols, Column(ACCEPTED, "boolean"), Column(PART, "string"))
        return staged.filter(~F.col(ACCEPTED)).select(*names_of(cols))

    def rule_counts(self, spark: SparkSession) -> DataFrame:
        """Passed and failed rows per rule, one row per batch and rule."""
        return self._by_batch(spark, "rule_counts", COUNT_COLUMNS).select(*names_of(COUNT_COLUMNS))

    # -- writer --------------------------------------------------------------------

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Bring one batch of standardized rows into the tables (``foreachBatch`` target)."""
        self._apply(batch, batch_id, self._generation(batch.sparkSession))

    def _apply(self, batch: DataFrame, batch_id: int, base: str) -> None:
        spark, table = batch.sparkSession, self.table
        require_utc(spark)
        check_schema(batch, table.stored, table.name)
        manifest = self._manifest(spark, base)
        if batch_id <= manifest.last_batch:
            return
        if manifest.buckets not in (0, self.buckets):
            raise ValueError(f"{base} has {manifest.buckets} buckets a month, not {self.buckets}; use full_refresh to change them")

        staged = f"{base}/staged/batch={batch_id}"
        self._stage(batch, staged)
        parts = list_names(spark, f"{staged}/{ACCEPTED}=true")
        sides = [n for n in list_names(spark, staged) if n.startswith(f"{ACCEPTED}=")]

        if sides:
            written = self._read(
                spark, [f"{staged}/{side}" for side in sides], (*table.stored, VIOLATED_COLUMN)
            )
            counts = quality.rule_counts(written, table.drop_rules, table.warn_rules, table.name)
            counts.write.mode("overwrite").parquet(f"{base}/rule_counts/batch={batch_id}")
        if parts:
            paths = [f"{staged}/{ACCEPTED}=true/{p}" for p in parts]
            paths += [f"{base}/state/batch={manifest.parts[p]}/{p}" for p in parts if p in manifest.parts]
            self._rebuild(self._read(spark, paths, table.stored), f"{base}/state/batch={batch_id}")
            manifest.parts.update({p: batch_id for p in parts})

        manifest.last_batch, manifest.buckets = batch_id, self.buckets
        publish_small(spark, f"{base}/_manifest/{batch_id:012d}", json.dumps(vars(manifest)))

    def _part(self):
        """Month of the key and bucket of its hash, as a name."""
        column = self.table.month_column
        month = F.lit("all") if column is None else F.coalesce(F.trunc(F.col(column), "month").cast("string"), F.lit("none"))
        bucket = F.pmod(F.xxhash64(*self.table.key), F.lit(self.buckets))
        return F.concat_ws(".", month, bucket.cast("string"))

    def _stage(self, batch: DataFrame, path: str) -> None:
        """The only pass over the source: rules are evaluated here and stored with the row."""
        marked = quality.mark_violations(batch, self.table.drop_rules, VIOLATED)
        accepted = F.size(VIOLATED) == 0
        parts = marked.withColumn(ACCEPTED, accepted).withColumn(PART, F.when(accepted, self._part()))
        parts.hint("rebalance", ACCEPTED, PART).write.mode("overwrite").partitionBy(ACCEPTED, PART).parquet(path)

    def _rebuild(self, rows: DataFrame, path: str) -> None:
        """Write the parts that ``rows`` (stored and new ones) belong to, one row per key and instant."""
        table = self.table
        if table.versioned:
            placed = tl.timeline(rows, table.key, SEQUENCE, table.versioned).select(
                *names_of(table.stored),
                F.col(tl.RUN_START).alias(history.START_AT),
                F.col(tl.NEXT_AT).alias(history.END_AT),
                F.col(tl.RUN).cast("int").alias(NUMBER),
                F.col(tl.RUN_ENDS).alias(RUN_ENDS),
            )
        else:
            placed = history.latest_per_key(rows, table.key, SEQUENCE).withColumns(
                {history.START_AT: F.col(SEQUENCE), history.END_AT: F.lit(None).cast("timestamp"), NUMBER: F.lit(1), RUN_ENDS: F.lit(True)}
            )
        # Rebalancing gives each part files of even size, splits a part that is far larger
        # than the others, and avoids a file per task and part.
        placed.withColumn(PART, self._part()).hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(path)

    # -- runs ----------------------------------------------------------------------

    def run_available(self, spark: SparkSession, *streams: DataFrame) -> None:
        """Process everything that arrived since the last run, then stop."""
        self._run(spark, self._generation(spark), streams)

    def _run(self, spark: SparkSession, base: str, streams: Sequence[DataFrame]) -> None:
        applied = self._manifest(spark, base).last_batch
        if applied >= 0 and not list_names(spark, f"{base}/_checkpoint/offsets"):
            # A new checkpoint would number its batches from 0 and each would look like a repeat.
            raise CheckpointLost(f"{base} holds batch {applied} but its checkpoint is gone; use full_refresh")
        standardized = self.table.standardize(*streams).select(*names_of(self.table.stored))
        query = (
            standardized.writeStream.queryName(f"{self.table.name}-upkeep")
            .foreachBatch(lambda batch, batch_id: self._apply(batch, batch_id, base))
            .option("checkpointLocation", f"{base}/_checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def full_refresh(self, spark: SparkSession, *streams: DataFrame) -> None:
        """Rebuild from the raw tables next to the live state and switch over when done."""
        number = int(self._generation(spark).rsplit("=", 1)[1].split("-")[0]) + 1
        # A name of its own for each refresh: one that died is never continued, not even under the same rules.
        name = f"generation={number:06d}-{uuid.uuid4().hex[:12]}"
        self._run(spark, f"{self.root}/{name}", streams)
        publish_small(spark, f"{self.root}/_generations/{number:06d}", name)
