"""Progress of streaming queries as rows."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lectern.schemas import ddl
from lectern.sources import versions

SCHEMA = ddl(
    "query STRING, batch_id BIGINT, input_rows BIGINT, state_rows BIGINT, watermark STRING,"
    " sources STRING"
)

ENDED = ddl("id STRING, error STRING")


def _row(progress) -> tuple:
    return (
        progress.name,
        progress.batchId,
        progress.numInputRows,
        sum(s.numRowsTotal for s in progress.stateOperators),
        (progress.eventTime or {}).get("watermark"),
        ", ".join(s.description for s in progress.sources),
    )


def is_running(query: StreamingQuery) -> tuple[bool, str]:
    return query.isActive, query.status["message"]


class ProgressListener(StreamingQueryListener):
    """Logs a row per micro-batch of every query of the session, and each query's end.

    Rows go to JSON files below `root`, one file for `every` rows of a kind; `frame` and
    `ended` read all of them. `report` is called with each row as it arrives. What is
    not yet written when the driver dies, `every` rows at most, is lost with it.
    """

    def __init__(
        self, spark: SparkSession, root: str, every: int = 1, report: Callable[[tuple], None] | None = None
    ):
        self.spark, self.root, self.every, self.report = spark, root.rstrip("/"), every, report
        self.waiting: dict[str, list[dict]] = {"progress": [], "ended": []}

    def _add(self, kind: str, row: dict) -> None:
        self.waiting[kind].append(row)
        if len(self.waiting[kind]) >= self.every:
            self.flush()

    def flush(self) -> None:
        for kind, rows in self.waiting.items():
            if rows:
                text = "".join(json.dumps(r) + "\n" for r in rows)
                path = self.spark._jvm.org.apache.hadoop.fs.Path(
                    f"{self.root}/{kind}/{time.time_ns()}-{uuid.uuid4().hex[:8]}.json"
                )
                files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
                out = files.create(path)
                out.write(bytearray(text.encode()))
                out.close()
                self.waiting[kind] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = _row(event.progress)
        self._add("progress", dict(zip(SCHEMA.names, row)))
        if self.report:
            self.report(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._add("ended", {"id": str(event.id), "error": event.exception})
        self.flush()

    def frame(self) -> DataFrame:
        """All rows logged below the root."""
        return self._read("progress", SCHEMA)

    def ended(self) -> DataFrame:
        """The queries that have ended, each with its error or NULL."""
        return self._read("ended", ENDED)

    def _read(self, kind: str, schema) -> DataFrame:
        self.flush()
        path = f"{self.root}/{kind}"
        if not versions.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(path)
