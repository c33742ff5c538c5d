"""Feature preparation: labels, scaling, encoding, splits, class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import as_flag
from millrace.operators.quantiles import exact_quantiles, quantile_values
from millrace.operators.sizing import broadcast_if_small

PRIME = 2_147_483_647
MAX_LEVELS = 1_000


def threshold_label(df: DataFrame, col: str, q: float = 0.75, out: str = "label") -> DataFrame:
    """1 where the value is above the q-quantile of the whole column."""
    cut = quantile_values(df, [col], {"cut": q})[f"{col}_cut"]
    return df.withColumn(out, as_flag(F.col(col) > F.lit(cut)))


def lookup_join(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left lookup in a mapping table; broadcast only when the table is checked to be small."""
    return df.join(broadcast_if_small(table), key, "left")


def rule_flags(df: DataFrame, rules: Mapping[str, Column], any_name: str = "any_rule") -> DataFrame:
    """One 0/1 column per rule and one that tells whether any rule fired."""
    flagged = df.withColumns({name: as_flag(test) for name, test in rules.items()})
    hit = F.greatest(*rules) if len(rules) > 1 else F.col(next(iter(rules)))
    return flagged.withColumn(any_name, hit)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Feature vector of the columns, one for every row.

    A missing value fails the query; with `invalid="keep"` it becomes NaN in the vector.
    Rows are only ever left out by `drop_missing` of the cleaning operators.
    """
    if invalid not in ("error", "keep"):
        raise ValueError("invalid is 'error' or 'keep'")
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


# --- scaling ---------------------------------------------------------------
# The parameters come from one aggregate and enter the plan as literals, so a scaled
# frame can be read many times without scanning the fitted table again.


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    stats = [x for c in cols for x in (F.avg(c).alias(f"{c}|mean"), F.stddev_pop(c).alias(f"{c}|std"))]
    row = (df if fit_on is None else fit_on).agg(*stats).first()
    return df.withColumns(
        {c: (F.col(c) - F.lit(row[f"{c}|mean"])) / F.lit(row[f"{c}|std"] or 1.0) for c in cols}
    )


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Columns stretched to [0, 1]; a constant column becomes 0.5."""
    limits = column_limits(df if fit_on is None else fit_on, cols)
    scaled = {}
    for c, (low, high) in limits.items():
        if low is not None and high > low:
            scaled[c] = (F.col(c) - low) / (high - low)
        else:
            scaled[c] = F.when(F.col(c).isNotNull(), 0.5)
    return df.withColumns(scaled)


def inverse_minmax(scaled: DataFrame, cols: Sequence[str], fit_on: DataFrame) -> DataFrame:
    """Back from [0, 1] to the units of `fit_on`."""
    limits = column_limits(fit_on, cols)
    return scaled.withColumns({c: F.col(c) * (high - low) + low for c, (low, high) in limits.items()})


def column_limits(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value of each column, in one pass."""
    row = df.agg(*[x for c in cols for x in (F.min(c).alias(f"{c}|lo"), F.max(c).alias(f"{c}|hi"))]).first()
    return {c: (row[f"{c}|lo"], row[f"{c}|hi"]) for c in cols}


# --- encoding --------------------------------------------------------------


def category_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted levels of each column. Refuses a column with more than `max_levels` levels."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    distinct = (
        df.select(F.explode(cells).alias("cell")).select("cell.*").filter("level is not null").distinct()
    )
    rows = distinct.limit(max_levels * len(cols) + 1).collect()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for row in rows:
        levels[row["column"]].append(row["level"])
    too_wide = [c for c in cols if len(levels[c]) > max_levels]
    if too_wide or len(rows) > max_levels * len(cols):
        raise ValueError(f"too many levels to encode as columns: {too_wide or list(cols)}")
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    drop_first: bool = False,
    levels: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """0/1 column `<col>_<level>` per level; a level unseen in `levels` is 0 everywhere."""
    levels = levels or category_levels(df, cols)
    encoded = {
        f"{c}_{level}": as_flag(F.col(c).cast("string") == level)
        for c in cols
        for level in list(levels[c])[1 if drop_first else 0 :]
    }
    return df.withColumns(encoded).drop(*cols)


@dataclass
class Preparation:
    """Scaling and encoding learned from the training rows only."""

    numeric: list[str]
    levels: dict[str, list[str]]
    means: dict[str, float]
    deviations: dict[str, float]
    drop_first: bool = False
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        start = 1 if self.drop_first else 0
        self.names = [*self.numeric, *(f"{c}_{v}" for c, vs in self.levels.items() for v in vs[start:])]

    def transform(self, df: DataFrame, out: str = "features", invalid: str = "error") -> DataFrame:
        """Add the feature vector; other columns and all rows stay (`invalid` as in `assemble`)."""
        start = 1 if self.drop_first else 0
        inputs = {
            f"__n_{c}": (F.col(c) - self.means[c]) / (self.deviations[c] or 1.0) for c in self.numeric
        }
        inputs |= {
            f"__c_{c}_{i}": F.coalesce(as_flag(F.col(c).cast("string") == level), F.lit(0))
            for c, vs in self.levels.items()
            for i, level in enumerate(vs[start:])
        }
        wide = df.withColumns(inputs)
        return assemble(wide, list(inputs), out, invalid).drop(*inputs)


def fit_preparation(
    train: DataFrame, numeric: Sequence[str], categories: Sequence[str] = (), drop_first: bool = False
) -> Preparation:
    """Learn means, deviations and levels: one aggregate and one distinct pass."""
    means: dict[str, float] = {}
    deviations: dict[str, float] = {}
    if numeric:
        row = train.agg(
            *[x for c in numeric for x in (F.avg(c).alias(f"{c}|m"), F.stddev_pop(c).alias(f"{c}|s"))]
        ).first()
        means = {c: row[f"{c}|m"] or 0.0 for c in numeric}
        deviations = {c: row[f"{c}|s"] or 0.0 for c in numeric}
    levels = category_levels(train, categories) if categories else {}
    return Preparation(list(numeric), levels, means, deviations, drop_first)


# --- splits ----------------------------------------------------------------


def integer_hash(key: Column | str, seed: int = 42) -> Column:
    """Number in [0, 2^31 - 1) from an integer key, equal in any engine with 64-bit integers."""
    k = F.col(key) if isinstance(key, str) else key
    x = F.pmod(k.cast("bigint"), F.lit(PRIME).cast("bigint"))
    for factor in (48_271, 69_621):
        x = (x * factor + seed) % F.lit(PRIME).cast("bigint")
    return x


def text_hash(*cols: Column | str, seed: int = 42) -> Column:
    """Number in [0, 2^31 - 1) from any columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(PRIME).cast("bigint"))


def random_split(df: DataFrame, hashed: Column, train_share: float) -> DataFrame:
    """Mark rows 'train' or 'test' by a hash of their key.

    The mark follows the key: it is the same after retries, repartitioning or a rerun.
    """
    return df.withColumn("part", F.when(hashed < int(train_share * PRIME), "train").otherwise("test"))


def stratified_split(df: DataFrame, label: str, hashed: Column, train_share: float) -> DataFrame:
    """The same, with the cut placed per class so each class keeps its share in both parts.

    Rows without a label stay and have no part.
    """
    keyed = df.withColumn("__hash", hashed)
    cuts = exact_quantiles(keyed, ["__hash"], [train_share], [label]).select(
        label, F.col("value").alias("__cut")
    )
    marked = keyed.join(broadcast_if_small(cuts), label, "left")
    part = F.when(F.col("__hash") < F.col("__cut"), "train").when(F.col("__cut").isNotNull(), "test")
    return marked.withColumn("part", part).drop("__hash", "__cut")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight) with weight = n / (classes * n_class)."""
    counts = df.dropna(subset=[label]).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    totals = counts.agg(
        F.struct(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k")).alias("s")
    ).scalar()
    return counts.select(label, (totals["n"] / (totals["k"] * F.col("n_class"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows with their balanced class weight; rows without a label stay and have no weight."""
    return df.join(broadcast_if_small(class_weights(df, label)), label, "left")
