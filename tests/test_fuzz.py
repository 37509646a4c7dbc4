"""All batch views against their SQL twins on random events full of NULLs and hot keys."""

import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest

from check import rows_of
from lectern.plans import oracle
from lectern.plans.registry import VIEWS, build_view
from lectern.schemas import EVENT
from lectern.sources.typed import typed_schema
from lectern.sources.sample import EVENT_TYPES
from lectern.functions.columns import as_ntz
from pyspark.sql import types as T


def random_events(rng, topic, n):
    kinds = EVENT_TYPES[topic]

    def value(field):
        name = field.name
        if rng.random() < 0.12:
            return None
        if name == "event_type":
            return rng.choice(kinds)
        if name == "role":
            return rng.choice(["student", "student", "teacher"])
        if name in ("user_id", "student_id"):
            return f"u{0 if rng.random() < 0.35 else rng.randrange(6)}"
        if isinstance(field.dataType, T.IntegerType):
            return rng.choice([0, 30, 59, 60, 61, 179, 180, 300])
        return f"{name[0]}{0 if rng.random() < 0.35 else rng.randrange(5)}"

    rows = []
    for _ in range(n):
        row = {f.name: value(f) for f in EVENT[topic].fields}
        moment = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(4 * 86400))
        row["timestamp_parsed"] = None if rng.random() < 0.1 else moment
        rows.append(row)
    return rows


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(7)
    connection = duckdb.connect()
    frames = {}
    arrow = {T.IntegerType: pa.int32(), T.StringType: pa.string()}
    for topic in EVENT:
        schema = typed_schema(topic)
        rows = random_events(rng, topic, 300)
        frames[topic] = spark.createDataFrame(
            [tuple(r[c] for c in schema.names) for r in rows], schema
        ).cache()
        columns = pa.schema(
            [(f.name, arrow[type(f.dataType)]) for f in EVENT[topic].fields]
            + [("timestamp_parsed", pa.timestamp("us"))]
        )
        table = pa.Table.from_pylist(rows, columns)
        connection.register(f"{topic}_rows", table)
        connection.execute(
            f"CREATE TABLE {topic} AS SELECT *, timestamp_parsed AS tp,"
            f" strftime(timestamp_parsed, '%Y-%m-%d') AS date FROM {topic}_rows"
        )
        if "role" in EVENT[topic].names:
            connection.execute(
                f"CREATE VIEW s_{topic} AS SELECT * FROM {topic} WHERE role = 'student'"
            )
    return frames, connection


@pytest.mark.parametrize("name", list(VIEWS))
def test_view_equals_sql(world, name):
    frames, connection = world
    ours = as_ntz(build_view(name, frames.__getitem__, ordered=False))
    result = connection.execute(oracle._VIEW[name])
    names = [d[0] for d in result.description]
    assert sorted(ours.columns) == sorted(names)
    left = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    right = rows_of(names, result.fetchall())
    assert left == right
    assert left
