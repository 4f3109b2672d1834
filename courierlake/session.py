"""Session settings the library relies on.

Hot keys are met by three things only: map-side partial aggregation, adaptive
splitting of skewed join partitions, and the rebalance hint before partitioned
writes. `tune` turns the adaptive part on for any session it is given, so a
caller's own session behaves the same as one made by `build_session`.
"""

from pyspark.sql import SparkSession

# Runtime settings only: each may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed partition is split even where that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of a reduce task, of a piece of a split hot partition, and of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # No cross product may appear unasked in a plan.
    "spark.sql.crossJoin.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "courierlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


# One reduce task per this much input, before adaptive execution merges small ones.
BYTES_PER_REDUCER = 256 * 1024**2


def size_shuffles(spark: SparkSession, *paths: str, most: int | None = None) -> int:
    """Start shuffles with as many partitions as the input asks for.

    The default of 200 would make reducers of hundreds of gigabytes out of a
    hundred terabytes. Adaptive execution merges partitions that turn out small,
    so too many cost little; the number is never set below the session's own, nor
    above `most` where the caller gives a bound (reducers then grow beyond 256 MB).
    """
    hadoop = spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        total += where.getFileSystem(hadoop).getContentSummary(where).getLength()
    wanted = total // BYTES_PER_REDUCER
    start = max(wanted if most is None else min(wanted, most), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return start


def checkpoint_root(spark: SparkSession, shared: str) -> str:
    """The folder the cluster names for checkpoints, or one below `shared` where it names none."""
    return (spark.conf.get("spark.checkpoint.dir", None) or f"{shared}/checkpoints").rstrip("/")
