import json
import os

import pytest
from pyspark.sql import SparkSession

from lectern.schemas import RAW, TOPICS
from lectern.session import SETTINGS
from lectern.sources.events import decode_topic

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ["TZ"] = "UTC"
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def put(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def raw(spark):
    """Raw records of a topic from dicts or JSON texts."""

    def build(topic, values, broker_time=None):
        rows = [
            (
                v.get("user_id") if isinstance(v, dict) else None,
                json.dumps(v) if isinstance(v, dict) else v,
                TOPICS[topic],
                broker_time,
            )
            for v in values
        ]
        return spark.createDataFrame(rows, RAW)

    return build


@pytest.fixture
def typed(raw):
    return lambda topic, values: decode_topic(raw(topic, values), topic)


@pytest.fixture
def rows():
    """A frame as a sorted list of dicts."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((r.asDict() for r in picked.collect()), key=lambda r: str(r))

    return collect
