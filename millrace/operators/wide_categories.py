"""One-hot encoding of columns with any number of levels: a stored dictionary and sparse vectors.

The levels stay a table. Rows meet their level by join and carry its position as a
number, so neither the plan nor the driver grows with the levels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.lineage import materialize
from millrace.operators.sizing import broadcast_if_small


def level_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, position): the distinct values of each column as text, numbered from 0 in order; nulls have none.

    Levels are sorted over all tasks; each numbers its own, and how many lie in the tasks
    before it is added from a table with a row per task and column.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    levels = df.select(F.explode(cells).alias("cell")).select("cell.*").filter("level is not null").distinct()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            local = []
            for column in batch.column(0).to_pylist():
                local.append(seen.get(column, 0))
                seen[column] = local[-1] + 1
            tasks = pa.array(np.full(batch.num_rows, task, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, tasks, pa.array(local, pa.int64())], ["column", "level", "task", "local"])

    sorted_ = materialize(levels.orderBy("column", "level").mapInArrow(number, "column string, level string, task int, local long"))
    before = Window.partitionBy("column").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sorted_.groupBy("column", "task").count()
    offsets = sizes.select("column", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    joined = sorted_.join(broadcast_if_small(offsets), ["column", "task"])
    return joined.select("column", "level", (F.col("local") + F.col("offset")).alias("position"))


@dataclass
class WidePreparation:
    """Scaling and encoding learned from the training rows; `dictionary` is a stored table."""

    numeric: list[str]
    categories: list[str]
    dictionary: DataFrame
    sizes: dict[str, int]
    means: dict[str, float]
    deviations: dict[str, float]
    drop_first: bool = False

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(max(n - self.drop_first, 0) for n in self.sizes.values())

    def names(self) -> DataFrame:
        """(i, name): what each position of the vector stands for; `<col>_<level>` for a level."""
        spark = self.dictionary.sparkSession
        first = spark.createDataFrame([(i, c) for i, c in enumerate(self.numeric)], "i long, name string")
        kept = self.dictionary.filter(F.col("position") >= int(self.drop_first))
        start = F.create_map(*[x for c in self.categories for x in (F.lit(c), F.lit(self._start(c)))]) if self.categories else None
        if start is None:
            return first
        at = start[F.col("column")] + F.col("position") - int(self.drop_first)
        return first.unionByName(kept.select(at.alias("i"), F.concat_ws("_", "column", "level").alias("name")))

    def _start(self, column: str) -> int:
        before = self.categories[: self.categories.index(column)]
        return len(self.numeric) + sum(max(self.sizes[c] - self.drop_first, 0) for c in before)

    def positions(self, df: DataFrame, prefix: str = "__at_") -> DataFrame:
        """Add `<prefix><col>`: the position of the row's level among those of its column; null if unknown, null or dropped.

        A dictionary of a checked size is broadcast; a larger one meets the rows by shuffle,
        where adaptive execution splits a level that many rows share.
        """
        for c in self.categories:
            levels = self.dictionary.filter(F.col("column") == c)
            position = F.col("position") - int(self.drop_first)
            levels = levels.select(F.col("level").alias("__level"), F.when(position >= 0, position).alias(f"{prefix}{c}"))
            df = df.join(broadcast_if_small(levels), df[c].cast("string") == F.col("__level"), "left").drop("__level")
        return df

    def transform(self, df: DataFrame, out: str = "features", invalid: str = "error") -> DataFrame:
        """Add the sparse feature vector; other columns and all rows stay. Unknown levels are zero everywhere."""
        scaled: dict[str, Column] = {f"__n_{c}": (F.col(c) - self.means[c]) / (self.deviations[c] or 1.0) for c in self.numeric}
        wide = self.positions(df).withColumns(scaled) if scaled else self.positions(df)
        used = [c for c in self.categories if self.sizes[c] > self.drop_first]
        inputs = list(scaled)
        if used:
            counts = {c: self.sizes[c] - self.drop_first for c in used}
            # The encoder learns only how many levels there are; one past the last means none.
            shape = df.sparkSession.createDataFrame([tuple(float(n - 1) for n in counts.values())], [f"__at_{c}" for c in used])
            encoder = OneHotEncoder(
                inputCols=[f"__at_{c}" for c in used], outputCols=[f"__v_{c}" for c in used], handleInvalid="keep", dropLast=True
            ).fit(shape)
            wide = wide.withColumns({f"__at_{c}": F.coalesce(F.col(f"__at_{c}"), F.lit(n)).cast("double") for c, n in counts.items()})
            wide = encoder.transform(wide)
            inputs += [f"__v_{c}" for c in used]
        vectors = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid=invalid).transform(wide)
        return vectors.drop(*scaled, *[f"__at_{c}" for c in self.categories], *[f"__v_{c}" for c in used])


def fit_wide_preparation(
    train: DataFrame, numeric: Sequence[str], categories: Sequence[str] = (), drop_first: bool = False
) -> WidePreparation:
    """Learn means, deviations and the dictionary from `train`; there may be any number of levels."""
    means, deviations = {}, {}
    if numeric:
        row = train.agg(*[x for c in numeric for x in (F.avg(c).alias(f"{c}|m"), F.stddev_pop(c).alias(f"{c}|s"))]).first()
        means = {c: row[f"{c}|m"] or 0.0 for c in numeric}
        deviations = {c: row[f"{c}|s"] or 0.0 for c in numeric}
    cells = categories or []
    empty = "column string, level string, position long"
    dictionary = materialize(level_dictionary(train, cells)) if cells else train.sparkSession.createDataFrame([], empty)
    found = {r["column"]: r["count"] for r in dictionary.groupBy("column").count().collect()}  # one row per column
    sizes = {c: found.get(c, 0) for c in categories}
    return WidePreparation(list(numeric), list(categories), dictionary, sizes, means, deviations, drop_first)
