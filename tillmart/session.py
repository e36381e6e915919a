"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these can be set on a running session. Sizing (executor memory, shuffle
# partitions, split size) belongs to the cluster and is left alone.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the aggregate above it then needs a shuffle
    # of its own: one device may own a third of all transactions.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(64 * 1024 * 1024),
    # Where no task's share of the smaller side exceeds this, as measured in the shuffle,
    # hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    # Catalyst broadcasts a join side only below this estimated size. Estimates are file sizes, shared
    # out by the widths of the columns; ids in sequence and repeated dates take up to a hundred times
    # that in memory (900,000 stores: 0.4 MB of file, 41 MB). Every broadcast goes through the driver,
    # so tables that grow with the input must stay out of them.
    "spark.sql.autoBroadcastJoinThreshold": str(512 * 1024),
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # A third less to read than with the default, at no cost in time.
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "tillmart", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
