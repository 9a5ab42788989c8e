"""Keyed state gives the batch history for any order and split of the rows."""

import random

import pytest

from terrace.operators import history
from terrace.sources.scans import read_stream
from terrace.streaming import keyed
from tests.conftest import frame

SCHEMA = "k string, at timestamp, v double, note string"


@pytest.mark.parametrize("seed, ordered", [(1, False), (2, True)])
def test_shuffled_batches_equal_the_batch_history(spark, tmp_path, seed, ordered):
    dice = random.Random(seed)
    rows = [
        (dice.choice(["a", "b", None]), f"2026-01-01 00:{dice.randrange(40):02d}:00", dice.choice([1.0, 1.0, 2.0, None]), dice.choice(["x", "y", None]))
        for _ in range(90)
    ]
    if ordered:
        rows.sort(key=lambda r: r[1])
    for start in range(0, 90, 30):
        frame(spark, SCHEMA, *rows[start : start + 30]).coalesce(1).write.mode("append").parquet(str(tmp_path / "raw"))
    stream = read_stream(spark, str(tmp_path / "raw"), spark.read.parquet(str(tmp_path / "raw")).schema, maxFilesPerTrigger="1")
    keyed.run_keyed(keyed.version_changes(stream, ["k"], "at", ["v"]), str(tmp_path / "out"), str(tmp_path / "check"))
    changes = spark.read.parquet(str(tmp_path / "out"))
    made = keyed.versions_of(changes, ["k"], "at")
    want = history.change_history(frame(spark, SCHEMA, *rows), ["k"], "at", ["v"]).select(*made.columns)
    assert made.exceptAll(want).count() == 0 and want.exceptAll(made).count() == 0
    assert changes.select("batch").distinct().count() == 3
    assert changes.count() < 3 * 90
