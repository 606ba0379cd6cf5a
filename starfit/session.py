"""Sessions for tests and benchmarks, and the staging folder of local ones; a cluster brings its own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cores = cores or os.cpu_count() or 1
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starfit")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        # Small data on few cores: keep every shuffle as wide as the machine.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return with_local_folder(spark)


def with_local_folder(spark: SparkSession) -> SparkSession:
    """Give a local session without ``spark.checkpoint.dir`` a temporary staging folder.

    A cluster's session is left as it is: a machine's own folder is of no use to it.
    """
    context = spark.sparkContext
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir())
    if unset and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starfit-"))
    return spark
