"""Session settings shared by every job, fixed in one place."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are UTC by convention; hive
# partition values such as buoy "0041" or year "unknown" must stay text.
SESSION_SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not JIT-compile methods over 8,000 bytes of bytecode; a
    # whole-stage-codegen method above that runs interpreted and is slower
    # than Spark's per-operator code. At this limit Spark falls back for
    # exactly those stages (the value Spark's docs suggest on HotSpot).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "tidewater",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for scripts, tests and the bench. No UI, no servers."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
