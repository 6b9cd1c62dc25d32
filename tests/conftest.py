import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from widefold.model import wide_schema  # noqa: E402

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def wide(spark):
    """Builds a wide fact from partial rows; what a row leaves out is 0, '' or an empty map."""
    schema = wide_schema()
    defaults = {}
    for field in schema.fields:
        kind = field.dataType.simpleString()
        if kind.startswith("map"):
            defaults[field.name] = {}
        elif kind == "string":
            defaults[field.name] = ""
        elif kind == "timestamp_ntz":
            defaults[field.name] = DAY
        elif kind == "date":
            defaults[field.name] = DAY.date()
        else:
            defaults[field.name] = 0

    def build(rows):
        return spark.createDataFrame([tuple({**defaults, **r}[f.name] for f in schema.fields) for r in rows], schema)

    return build


def at(minutes=0, seconds=0, ms=0, days=0):
    return DAY + dt.timedelta(days=days, minutes=minutes, seconds=seconds, milliseconds=ms)
