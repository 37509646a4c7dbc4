"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Nothing here fixes parallelism: AQE sizes shuffles from measured bytes, and an
# initial partition count belongs to the cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

# For long-running streams: state on local disk with changelog checkpoints
# instead of on the executor heap.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session(app: str, streaming: bool = False, time_zone: str = "UTC", **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    settings = {**SETTINGS, **(STREAM_SETTINGS if streaming else {}), **extra}
    settings["spark.sql.session.timeZone"] = time_zone
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
