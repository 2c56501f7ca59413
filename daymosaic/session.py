"""Local session for tests, checks and the benchmark. A cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = 8, shuffle_partitions: int | None = None, checkpoint_dir: str | None = None
) -> SparkSession:
    cores = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("daymosaic")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
