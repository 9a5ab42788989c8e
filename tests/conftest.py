import datetime as dt
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from terrace.plans.energy.values import RAW_LAYOUTS as RAW
from terrace.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "terrace-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def instant(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def raw_rows(spark, table, rows):
    """Raw rows from dicts; absent columns are null, text instants are UTC."""
    schema = RAW[table]
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = dict(part.split() for part in schema.split(", "))
    data = [
        tuple(
            instant(row[n]) if kinds[n] == "timestamp" and isinstance(row.get(n), str) else row.get(n)
            for n in names
        )
        for row in rows
    ]
    return spark.createDataFrame(data, schema)


def frame(spark, schema, *rows):
    """DataFrame from plain values; texts are cast to the column's type."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    strings = ", ".join(f"{n} string" for n, _ in fields)
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    df = spark.createDataFrame(text, strings)
    return df.select(*[F.col(n).cast(kind).alias(n) for n, kind in fields])


def weather_json(first_day, hours, suffix="", base=0.0):
    """A response like the weather service's: each variable holds its catalog index."""
    from terrace.plans.energy.values import WEATHER_VARIABLES

    start = dt.datetime.fromisoformat(first_day)
    stamps = [start + dt.timedelta(hours=h) for h in range(hours)]
    series = {"time": [f"{s:%Y-%m-%dT%H:%M}" for s in stamps]}
    for index, (api, *_rest) in enumerate(WEATHER_VARIABLES):
        series[api + suffix] = (
            [1.0 if 6 <= s.hour < 18 else 0.0 for s in stamps] if api == "is_day" else [base + index] * hours
        )
    return json.dumps(
        {"latitude": -11.6, "longitude": -41.7, "timezone": "America/Fortaleza", "hourly": series}
    )
