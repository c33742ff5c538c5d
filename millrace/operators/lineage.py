"""Materialise an expensive intermediate once, in storage that outlives executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(SETTING, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that nothing uses yet."""
    return f"{work_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, spread: bool = False) -> DataFrame:
    """Write `df` once and read it back.

    Unlike a cache the copy survives lost executors, and unlike an RDD checkpoint it
    is computed once and stays columnar, so later passes still prune and push down.
    `spread` is for compute-heavy users: a copy that is read in fewer partitions than
    there are cores is small, and is dealt out over all of them.
    """
    copy = _stored(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if spread and copy.rdd.getNumPartitions() < cores:
        return _stored(copy.repartition(cores))
    return copy


def _stored(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, "millrace")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
