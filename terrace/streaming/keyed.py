"""Revision history kept row by row in keyed state, for streams that must not wait for a rebuild.

Each key's state is its open version and its instants with their rows. Rows that arrive in order only
touch the open version. A late row reads the key's instants, since it can split a version
or take a version's end away. What changed is emitted, one row per version that is new,
different or gone, with the revision in which it changed; ``versions_of`` reads the emitted
rows back as the history.

The result is that of ``operators.history.change_history``. The stateful operator is Spark's
own, with state in RocksDB, but its logic runs in Python: rows go to a worker and back, row by row,
and each state access is a round trip to the JVM. ``streaming.apply`` has no such cost;
this one is for few rows at a time and an answer per trigger. A key's rows meet in one task, as keyed
state must.

Defined results: equal instants of a key keep the greatest row by the other columns in their
order, null lowest; null is a value; a null key is a key. Rows without an instant are an
error of the declared schema check, not dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.history import END_AT, START_AT

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AT, END, SINCE, REVISION, GONE = "_at", "_end", "_since", "_revision", "_gone"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside have the state store that the operator needs; the session's own setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _micros(df: DataFrame, sequence: str) -> DataFrame:
    instant = F.unix_micros(F.col(sequence).cast("timestamp"))
    return df.withColumn(AT, F.coalesce(instant, F.raise_error(F.lit(f"{sequence} is null")).cast("long"))).drop(sequence)


def version_changes(stream: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str]) -> DataFrame:
    """Changes of versions: key, other columns, begin, end (null while in force), last instant, revision, and whether it is gone."""
    keys, tracked = list(keys), list(tracked)
    rows = _micros(stream.select(*keys, sequence, *[c for c in stream.columns if c not in (*keys, sequence)]), sequence)
    kinds = {f.name: f.dataType for f in rows.schema}
    rest = [c for c in rows.columns if c not in (*keys, AT)]
    places = [rest.index(c) for c in tracked]
    data = T.StructType([T.StructField(c, kinds[c], True) for c in rest])
    key_of = T.StructType([T.StructField(AT, T.LongType(), False)])
    opened = T.StructType([T.StructField(SINCE, T.LongType()), T.StructField(AT, T.LongType()), T.StructField(REVISION, T.LongType()), *data.fields])
    more = [T.StructField(n, T.LongType(), True) for n in (SINCE, END, AT, REVISION)]
    out = T.StructType([*[T.StructField(k, kinds[k], True) for k in keys], *data.fields, *more, T.StructField(GONE, T.BooleanType(), True)])

    named = Row(*out.names)

    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Versions(StatefulProcessor):  # defined here so that it travels with the job
        def init(self, handle) -> None:
            self.open = handle.getValueState("open", opened)
            self.instants = handle.getMapState("instants", key_of, data)

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            rank = lambda row: tuple((x is not None, x) for x in row)
            value = lambda row: tuple(row[i] for i in places)
            shown = lambda since, end, at, row, gone=False: named(*key, *row, since, end, at, revision, gone)
            new: dict[int, tuple] = {}
            for r in rows:
                row = tuple(r[c] for c in rest)
                if r[AT] not in new or rank(row) > rank(new[r[AT]]):
                    new[r[AT]] = row
            now = self.open.get() if self.open.exists() else None
            revision = (now[2] if now else 0) + 1

            def islands(steps: list[tuple[int, tuple]]) -> list[list]:
                """[since, end, last instant, row] of each run of equal tracked values."""
                found: list[list] = []
                for at, row in steps:
                    if found and value(found[-1][3]) == value(row):
                        found[-1][2:] = [at, row]
                    else:
                        if found:
                            found[-1][1] = at
                        found.append([at, None, at, row])
                return found

            if now is None or min(new) > now[1]:
                before = [[now[0], None, now[1], tuple(now[3:])]] if now else []
                steps = sorted(new.items())
                after = islands([(now[1], tuple(now[3:])), *steps] if now else steps)
                if now:
                    after[0][0] = now[0]
            else:
                held = {k[0]: tuple(v) for k, v in self.instants.iterator()}
                before = islands(sorted(held.items()))
                for at in list(new):
                    if at in held and rank(held[at]) >= rank(new[at]):
                        del new[at]
                after = islands(sorted({**held, **new}.items()))
            for at, row in new.items():
                self.instants.updateValue((at,), row)
            since, _, last, row = after[-1]
            self.open.update((since, last, revision, *row))
            known = {x[0]: x for x in before}
            for x in after:
                if known.pop(x[0], None) != x:
                    yield shown(*x)
            for x in known.values():
                yield shown(*x, gone=True)

        def close(self) -> None:
            pass

    return rows.groupBy(*keys).transformWithState(Versions(), outputStructType=out, outputMode="Update", timeMode="None")


def run_keyed(changes: DataFrame, path: str, checkpoint: str) -> None:
    """Append what changes to the folder ``path``, each batch once, until the stream's input is used up."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = changes.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with keyed_state(changes.sparkSession):
        query = writer.start()
        query.awaitTermination()


def versions_of(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The history that the emitted changes leave: the last word on each version, unless it is gone."""
    by_version = changes.groupBy(*keys, SINCE).agg(F.max_by(F.struct(*[c for c in changes.columns if c not in (*keys, SINCE, "batch")]), REVISION).alias("_x"))
    data = [c for c in changes.columns if c not in (*keys, SINCE, END, AT, REVISION, GONE, "batch")]
    instant = lambda c: F.timestamp_micros(c)
    return by_version.filter(~F.col(f"_x.{GONE}")).select(
        *keys, instant(F.col(f"_x.{AT}")).alias(sequence), *[F.col(f"_x.{c}").alias(c) for c in data],
        instant(F.col(SINCE)).alias(START_AT), instant(F.col(f"_x.{END}")).alias(END_AT),
    )
