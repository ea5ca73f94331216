"""SparkSession for tests and the benchmark.

On a cluster the session comes from the launcher (spark-submit or a
notebook) and this module is not used; the queries only take a session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings results can depend on, set on every session this module builds.
FIXED_CONF = {
    # Results with timestamps must not depend on the machine's time zone.
    "spark.sql.session.timeZone": "UTC",
    # Decimal and integer overflow must raise, never wrap or turn into null.
    "spark.sql.ansi.enabled": "true",
}

# Performance settings. AQE re-plans each stage from the real size of the
# shuffle output: it turns a sort-merge join into a broadcast join only when
# the side it measured is under the threshold, splits skewed join
# partitions and merges small ones. Broadcasts chosen before execution from
# file-size estimates are off, since compressed files can expand far beyond
# their estimate.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "keelson",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cpus]`` session with the UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**FIXED_CONF, **SCALE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
