"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wall-clock columns are TIMESTAMP_NTZ holding UTC, so results do not depend on the session zone;
# the zone is still pinned because date_format and current_timestamp read it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` (dots written as `__`) wins over them.

    Shuffle partitions are left to the cluster's own configuration: AQE coalesces small ones, and a
    100 TB run needs thousands.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = SETTINGS | {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
