"""Session settings the operators are designed for.

Every operator also runs on a session it did not build. A setting made here wins over ``--conf`` of whoever submits the
job, so only what the results need is set, and the number of shuffle partitions only for a given volume.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int = 1) -> int:
    """Initial shuffle partitions so that one holds about 128 MB; AQE coalesces what turns out smaller."""
    by_size = -(-shuffled_bytes // TARGET_PARTITION_BYTES)
    return max(by_size, cores)


def builder(app_name: str = "shelfcast", *, shuffled_bytes: int | None = None, cores: int = 1) -> SparkSession.Builder:
    """A session builder; with ``shuffled_bytes`` the shuffle partitions are sized for that volume."""
    built = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        # Column call sites are looked up through the gateway, once per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if shuffled_bytes is not None:
        built = built.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes, cores)))
    return built
