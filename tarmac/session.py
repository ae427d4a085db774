"""Session settings shared by tests, bench and the registered queries."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS


def local_session(cores: int = 8, app: str = "tarmac") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """All message times are naive UTC, so calendar columns need a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for stream checkpoints and written intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``. A private
    folder is made only in local mode, where every task sees the same disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        return tempfile.mkdtemp(prefix="tarmac-")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    unique = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    return hadoop_path(root, f"tarmac-{unique}").toString()
