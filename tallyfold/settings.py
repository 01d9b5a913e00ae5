"""Session settings for large runs.

These are the settings a 100 TB run of this library is sized for.  They are
applied by whoever builds the session (the bench, a job launcher); the
operators never change session state themselves.
"""

from __future__ import annotations

# Adaptive execution re-plans from real shuffle sizes: it coalesces small
# partitions, splits skewed join partitions and can turn a join into a
# broadcast join when a side proves small at runtime.
CLUSTER_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Start with many shuffle partitions and let AQE coalesce them: a 100 TB
    # shuffle at ~256 MB per partition needs on the order of 10^5 partitions.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Broadcast by statistics only for genuinely small sides.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # min/max/count of plain columns from parquet footers (as-of periods).
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def local_settings(cpus: int) -> dict[str, str]:
    """The same settings scaled to one machine with ``cpus`` threads."""
    s = dict(CLUSTER_SETTINGS)
    s.update(
        {
            "spark.sql.shuffle.partitions": str(cpus * 2),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
            "spark.sql.autoBroadcastJoinThreshold": "10m",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    return s
