"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "12g", app: str = "gleaner") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="gleaner-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/gleaner-{uuid.uuid4().hex}"
