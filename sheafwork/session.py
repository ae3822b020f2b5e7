"""Session construction and the settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold for every deployment. Sizes (partitions, memory) are left
# to the cluster's own configuration.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A count of all state rows costs a lookup for every row that is written or removed.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Streams merge the rows of one session on the map side first, so a busy
    # key does not ship every row to one reducer.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "sheafwork", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the common settings plus ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**COMMON_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Put the common settings on a session somebody else created.

    A local session also gets one shuffle partition per core: stateful
    streaming cannot coalesce partitions, and 200 of them on one machine only
    cost time. A cluster keeps its own partition count.
    """
    for key, value in COMMON_CONF.items():
        spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark
