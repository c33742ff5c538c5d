"""Session construction and table loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution on, UTC clock and the web page off.

    Cluster settings (master, memory, shuffle partitions) come from spark-submit;
    `master` and `conf` exist for tests and benchmarks.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class Tables:
    """Attribute access to the parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")
