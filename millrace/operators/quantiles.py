"""Exact, linearly interpolated quantiles that never gather a column in one task.

The built-in exact percentile keeps every distinct value of a group in one
aggregation buffer. Here a coarse sketch first brackets each wanted rank; only the
values inside a bracket are kept apart (with their counts) and everything below it is
counted. In large groups a bracket is cut once more into equal widths, their counts
tell which width holds the rank, and only its values are put in order. The ordered
window then holds a few millionths of the rows. Should a bracket ever miss its rank
the query fails loudly instead of returning a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from millrace.operators.lineage import materialize
from millrace.operators.sizing import local_if_small

ACCURACY = 1_000  # sketch rank error is 1/ACCURACY of the rows; keeps sketches of a task small
SLACK = 3 / ACCURACY
WHOLE_BELOW = 20_000  # groups up to this size are ranked without a bracket
REFINE_ABOVE = 10_000_000  # larger groups cut their brackets into widths
WIDTHS = 1_024
SKETCH_ROWS = 50_000  # group sketches up to this count are read and broadcast
BRACKETS = "array<struct<prob: double, low: double, high: double>>"


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) with null and NaN values and null keys left out."""
    if len(cols) == 1:
        out = df.select(*by, F.lit(cols[0]).alias("column"), F.col(cols[0]).cast("double").alias("value"))
    else:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
        )
        out = df.select(*by, F.explode(pairs).alias("pair")).select(*by, "pair.*")
    keep = F.col("value").isNotNull() & ~F.isnan("value")
    for key in by:
        keep = keep & F.col(key).isNotNull()
    return out.filter(keep)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., column, prob, n, value): quantiles of every column, per group if asked.

    Sizes and sketch run when this is called; the ranking runs with the returned frame.
    """
    probs = [float(p) for p in probs]
    keys = [*by, "column"]
    values = long_values(df, cols, by)
    if by:
        sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= WHOLE_BELOW:
            return _small_groups(values, keys, probs)
    sketch = values.groupBy(*keys).agg(*_sketch(probs))
    if not by:
        rows = sketch.collect()  # one row per named column
        return _pick(_cells_by_column(df, cols, rows), keys, max((r["n"] for r in rows), default=0))
    known = local_if_small(sketch, SKETCH_ROWS)
    if known is None:
        # Stored: two evaluations of a sketch may bracket differently, and both joins must see the same.
        return _pick(_cells_by_group(values, keys, materialize(sketch), len(probs)), keys, None)
    small = F.broadcast(df.sparkSession.createDataFrame(known, schema=sketch.schema))
    return _pick(_cells_by_group(values, keys, small, len(probs)), keys, max(known["n"].to_pylist(), default=0))


def quantile_values(df: DataFrame, cols: Sequence[str], probs: dict[str, float]) -> dict[str, float | None]:
    """Overall quantiles as numbers named `<column>_<label>`; None for a column without values.

    They re-enter later plans as literals, so a frame that uses them can be read many
    times without ranking again.
    """
    rows = exact_quantiles(df, cols, list(probs.values())).collect()  # columns x probs rows
    found = {(r["column"], r["prob"]): r["value"] for r in rows}
    return {f"{c}_{label}": found.get((c, float(p))) for c in cols for label, p in probs.items()}


def quantiles_wide(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., column, one column per label): quantiles side by side."""
    q = exact_quantiles(df, cols, list(probs.values()), by)
    fields = [
        F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(label) for label, p in probs.items()
    ]
    return q.groupBy(*by, "column").agg(*fields)


def _small_groups(values: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Groups that are all known to be small: one shuffle and one sorted, bounded array per group.

    Interpolates as `_pick` does, so both ways give the same digits.
    """
    ranked = values.groupBy(*keys).agg(F.sort_array(F.collect_list("value")).alias("ranked"))
    wanted = ranked.select(
        *keys, "ranked", F.size("ranked").cast("long").alias("n"), F.explode(F.array(*map(F.lit, probs))).alias("prob")
    )
    position = (F.col("n") - 1) * F.col("prob")
    start = F.floor(position)
    lower, upper = (F.get("ranked", x.cast("int")) for x in (start, F.ceil(position)))
    return wanted.select(*keys, "prob", "n", (lower + (upper - lower) * (position - start)).alias("value"))


def _sketch(probs: list[float]) -> list[Column]:
    """Row count and one (prob, low, high) bracket per probability."""
    marks = [max(p - SLACK, 0.0) for p in probs] + [min(p + SLACK, 1.0) for p in probs]
    cuts = F.percentile_approx("value", marks, ACCURACY)
    n, lowest, highest = F.count(F.lit(1)), F.min("value"), F.max("value")
    whole = n <= WHOLE_BELOW
    brackets = [
        F.struct(
            F.lit(p).alias("prob"),
            F.when(whole | F.lit(p <= SLACK), lowest).otherwise(F.get(cuts, F.lit(i))).alias("low"),
            F.when(whole | F.lit(p >= 1 - SLACK), highest)
            .otherwise(F.get(cuts, F.lit(i + len(probs))))
            .alias("high"),
        )
        for i, p in enumerate(probs)
    ]
    return [n.alias("n"), F.array(*brackets).alias("brackets")]


def _cell(value: Column, brackets: Sequence[tuple[Column, Column]]) -> tuple[Column, Column]:
    """Values inside a bracket stay apart; all values between the same brackets share a cell."""
    inside = reduce(or_, [(value >= low) & (value <= high) for low, high in brackets])
    passed = reduce(add, [F.when(value > high, 1).otherwise(0) for _, high in brackets])
    return F.when(inside, value).alias("slot"), passed.alias("passed")


def _cells_by_group(values: DataFrame, keys: list[str], sketch: DataFrame, width: int) -> DataFrame:
    brackets = [(F.get("brackets", F.lit(i))["low"], F.get("brackets", F.lit(i))["high"]) for i in range(width)]
    slot, passed = _cell(F.col("value"), brackets)
    counted = (
        values.join(sketch, keys)
        .select(*keys, slot, passed, "value")
        .groupBy(*keys, "slot", "passed")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("at"))
    )
    return counted.join(sketch, keys)


def _cells_by_column(df: DataFrame, cols: Sequence[str], sketch: list[Row]) -> DataFrame:
    """The same with the few brackets as literals, so no join is needed."""
    found = {r["column"]: r for r in sketch}
    entries, n, brackets = [], F.lit(None).cast("bigint"), F.lit(None).cast(BRACKETS)
    for c in cols:
        if c not in found:
            continue
        value, limits = F.col(c).cast("double"), found[c]["brackets"]
        slot, passed = _cell(value, [(F.lit(b["low"]), F.lit(b["high"])) for b in limits])
        entries.append(F.struct(F.lit(c).alias("column"), slot, passed, value.alias("at")))
        here = F.col("column") == c
        n = F.when(here, F.lit(found[c]["n"])).otherwise(n)
        literal = F.array(*[F.struct(*[F.lit(b[x]).alias(x) for x in ("prob", "low", "high")]) for b in limits])
        brackets = F.when(here, literal).otherwise(brackets)
    if not entries:
        empty = "column string, slot double, passed int, rows bigint, at double, n bigint, brackets " + BRACKETS
        return df.sparkSession.createDataFrame([], empty)
    cells = df.select(F.explode(F.array(*entries)).alias("e")) if len(entries) > 1 else df.select(entries[0].alias("e"))
    counted = (
        cells.select("e.*")
        .filter(F.col("at").isNotNull() & ~F.isnan("at"))
        .groupBy("column", "slot", "passed")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("at"))
    )
    return counted.withColumns({"n": n, "brackets": brackets})


def _pick(cells: DataFrame, keys: list[str], largest: int | None) -> DataFrame:
    """Interpolated value at every wanted rank; `largest` is the largest group, if known."""
    low, high, at = F.col("b.low"), F.col("b.high"), F.col("at")
    inside = at >= low
    width = F.when(high > low, F.least(F.floor((at - low) / (high - low) * WIDTHS), F.lit(WIDTHS - 1))).otherwise(0)
    # seen from one bracket, all cells below it are one: their count is all that matters
    counted = (
        cells.select(*keys, "n", "rows", "at", F.explode("brackets").alias("b"))
        .filter(at <= high)
        .groupBy(
            *keys,
            "n",
            F.col("b.prob").alias("prob"),
            F.when(inside, width).otherwise(-1).cast("int").alias("width"),
            F.when(inside, at).alias("slot"),
        )
        .agg(F.sum("rows").alias("rows"))
    )
    position = (F.col("n") - 1) * F.col("prob")
    start, end = F.floor(position), F.ceil(position)
    missed = F.raise_error(F.lit("quantile bracket missed its rank"))
    if largest is None or largest > REFINE_ABOVE:
        order = Window.partitionBy(*keys, "prob").orderBy("width")
        group = Window.partitionBy(*keys, "prob")
        widths = counted.groupBy(*keys, "n", "prob", "width").agg(F.sum("rows").alias("rows"))
        widths = widths.withColumn("upto", F.sum("rows").over(order)).withColumns(
            {
                "before": F.col("upto") - F.col("rows"),
                "below": F.coalesce(F.max(F.when(F.col("width") < 0, F.col("upto"))).over(group), F.lit(0)),
                "most": F.max("upto").over(group),
            }
        )
        holds = ((F.col("before") <= start) & (F.col("upto") > start)) | ((F.col("before") <= end) & (F.col("upto") > end))
        lost = (F.col("below") > start) | (F.col("most") <= end)
        wanted = widths.filter(F.when(lost, missed.cast("boolean")).otherwise(holds))
        inner = counted.join(wanted.select(*keys, "prob", "width", "before"), [*keys, "prob", "width"])
        ordered = Window.partitionBy(*keys, "prob", "width").orderBy("slot")
        running = inner.withColumn("upto", F.col("before") + F.sum("rows").over(ordered))
    else:
        ordered = Window.partitionBy(*keys, "prob").orderBy(F.col("slot").asc_nulls_first())
        running = counted.withColumn("upto", F.sum("rows").over(ordered))
    picked = running.groupBy(*keys, "prob", "n").agg(
        F.min(F.when(F.col("upto") > start, F.col("slot"))).alias("lower"),
        F.min(F.when(F.col("upto") > end, F.col("slot"))).alias("upper"),
        F.coalesce(F.max(F.when(F.col("slot").isNull(), F.col("upto"))), F.lit(0)).alias("below"),
    )
    lost = (F.col("below") > start) | F.col("upper").isNull()
    exact = F.col("lower") + (F.col("upper") - F.col("lower")) * (position - start)
    return picked.select(*keys, "prob", "n", F.when(lost, missed.cast("double")).otherwise(exact).alias("value"))
