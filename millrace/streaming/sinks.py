"""Run a stream over what is available and return its latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.lineage import new_path


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream over a parquet file or folder, with the schema of what lies there."""
    folder, name = path.rsplit("/", 1)
    # a pattern is accepted for a single file, a plain path only for a folder
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{folder}/{{{name}}}")


def run_available(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process everything available into a parquet table tagged with the batch number.

    A batch rewrites only its own folder, so a batch repeated after a failure
    replaces its rows instead of doubling them.
    """
    spark = stream.sparkSession
    base = new_path(spark, "stream")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/rows/batch={number}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()
    return spark.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows")


def latest(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Last written value per key of an update-mode table."""
    return rows.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))
