"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Adaptive execution only merges shuffle partitions, so a cluster starts with many.
INITIAL_PARTITIONS = 4096


def build_session(
    app_name: str = "feedloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with adaptive execution on and a UTC clock.

    A cluster normally brings its own master, memory and
    ``spark.checkpoint.dir``; nothing here overrides them unless asked to.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Plans are built inside the library; recording a Python call site for
        # every column expression only slows that down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config(_INITIAL_PARTITIONS, str(INITIAL_PARTITIONS))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
