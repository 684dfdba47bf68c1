"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the reduce side from what was really shuffled, splits hot join partitions and
# turns joins into broadcast joins only after it has measured the small side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def builder(app: str = "tellerflow") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local(cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session inside this process, for tests and the bench."""
    b = (
        builder()
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in conf.items():
        b = b.config(key, value)
    return b.getOrCreate()
