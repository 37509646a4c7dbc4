"""Run a streaming job against a broker.

    python -m lectern.streaming ingest BOOTSTRAP_SERVERS MASTER_ROOT CHECKPOINT_ROOT
    python -m lectern.streaming speed  BOOTSTRAP_SERVERS SPEED_ROOT  CHECKPOINT_ROOT
    python -m lectern.streaming rollups BOOTSTRAP_SERVERS STREAM_ROOT CHECKPOINT_ROOT
    python -m lectern.streaming compact DAYS_KEPT MASTER_ROOT CHECKPOINT_ROOT

`compact` puts the batches of the days before the last DAYS_KEPT together. The others need Spark's public Kafka connector, for example by
`spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2`.
"""

from __future__ import annotations

import sys
import time

from lectern.session import session
from lectern.sources.streams import compact_master, kafka_options, master_sink, read_kafka
from lectern.streaming import rollups
from lectern.streaming.progress import ProgressListener
from lectern.streaming.speed import Settings, run


def main(arguments: list[str]) -> int:
    if len(arguments) != 4 or arguments[0] not in ("ingest", "speed", "rollups", "compact"):
        print(__doc__)
        return 2
    job, servers, root, checkpoints = arguments
    if job == "compact":
        before = int(time.time()) // 86400 - int(servers)
        print(compact_master(session("lectern compact"), root, f"{checkpoints.rstrip('/')}/ingest", before))
        return 0
    spark = session(f"lectern {job}", streaming=True)
    log = f"{checkpoints.rstrip('/')}/progress-{job}"
    spark.streams.addListener(ProgressListener(spark, log, report=print))
    if job == "ingest":
        raw = read_kafka(spark, kafka_options(servers, starting_offsets="earliest"))
        master_sink(raw, root, f"{checkpoints.rstrip('/')}/ingest").start().awaitTermination()
    elif job == "rollups":
        raw = read_kafka(spark, kafka_options(servers, starting_offsets="earliest"))
        rollups.start(raw, root, f"{checkpoints.rstrip('/')}/rollups").awaitTermination()
    else:
        raw = read_kafka(spark, kafka_options(servers))
        run(spark, raw, Settings(root=root, checkpoints=checkpoints))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
