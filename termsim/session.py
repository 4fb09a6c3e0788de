"""Session helpers.

On a cluster the session comes from the caller (``spark-submit``); these
helpers only fill in settings that are unset, as tests and the local bench
need them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the engine relies on: adaptive execution (runtime coalescing, skew
# join splitting, broadcast decisions from real sizes) and no web UI.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "termsim",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
    checkpoint: str | None = None,
) -> SparkSession:
    """A local session for tests and the bench. ``checkpoint`` is used where the
    session names no ``spark.checkpoint.dir``; no folder is made up here."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None and checkpoint is not None:
        spark.sparkContext.setCheckpointDir(checkpoint)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or None
