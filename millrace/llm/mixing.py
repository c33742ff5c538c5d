"""Mixing sources to target weights by weighted fair queueing.

Each source is one queue. Its documents wait in a shuffled order; a document's virtual
finish time is the number of words its source has sent up to and with it, divided by the
source's target. All documents are served in order of finish time until the budget is
spent. A source whose target exceeds its own words is gone through again, at most
`passes` times in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import unpacked, word_count
from millrace.operators.lineage import materialize

#: Weights in order of the sources, repeating.
WEIGHTS = (5, 2, 1)
#: No source's target, and no document's share, goes beyond this many times its size.
PASSES = 3
#: Rows that one slice of a source's queue holds about.
SLICE_ROWS = 2_000
#: Pieces a range of finish times is cut into while the end of the budget is searched.
CUTS = 1024


def _queue_key(source: Column) -> Column:
    """Sorts as the source by code point, null after all others."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("t"))


def _place(doc_id: Column, seed: int) -> Column:
    """The document's place in the shuffle, uniform in [0, 2^60). Null ids share one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """queue, source_size, target: one row per source.

    Targets share the sum of all sizes by weight; a target stops at `passes` times its
    source's size, and what is left over goes to the others by weight, until none is above. With
    the sources ordered by passes * size / weight the stopped ones come first, so the
    common level of the others follows from two running sums over the source table.
    """
    sources = sized.groupBy("queue").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy("queue")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * passes)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "queue").rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))
    )
    # A source takes its cap while the level before it is above; the first that does not sets the level.
    levels = weighed.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    first_open = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "queue", "level")))
    shared = levels.withColumn("common", first_open.over(everything)["level"])
    return shared.select(
        "queue", "source_size",
        F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight")).alias("target"),
    )


def _queued(sized: DataFrame, plan: DataFrame, slices: int) -> DataFrame:
    """`sized` with source_size, target and `before_end`: words of its queue up to and with it.

    A queue is cut into `slices` by the shuffle place; slice totals are summed per queue
    and the running sum is taken inside one slice, so no task holds a whole queue.
    """
    width = (1 << 60) // slices + 1
    cut = sized.withColumn("slice", F.floor(F.col("place") / F.lit(width)).cast("long"))
    totals = cut.groupBy("queue", "slice").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("queue").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("queue", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    order = ["place", "doc_key", "size", "tie"]
    inside = W.partitionBy("queue", "slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    running = cut.withColumn("inside", F.sum("size").over(inside))
    return (
        running.join(offsets, ["queue", "slice"])
        .join(plan, "queue")
        .withColumn("before_end", F.col("offset") + F.col("inside"))
    )


def _finish(turn: int) -> Column:
    return (F.col("source_size") * turn + F.col("before_end")) / F.col("target")


def _served(cut: float | None, passes: int) -> Column:
    """How often the document is taken."""
    if cut is None:
        return F.lit(0).cast("long")
    taken = [F.when((F.col("size") > 0) & (_finish(t) <= F.lit(cut)), 1).otherwise(0) for t in range(passes)]
    total = taken[0]
    for t in taken[1:]:
        total = total + t
    return total.cast("long")


def _last_finish(queued: DataFrame, budget: int, passes: int) -> float | None:
    """The largest finish time at which all that has finished fits the budget.

    Equal finish times are served together or not at all. Finish times are cut into
    ranges, the range in which the budget ends is cut again until it holds one time; only
    the sums of at most CUTS ranges reach the driver in a round.
    """
    turns = queued.filter("size > 0").select(
        "size", F.explode(F.array(*[_finish(t) for t in range(passes)])).alias("finish")
    )
    ends = turns.agg(F.min("finish"), F.max("finish")).first()
    low, high, spent, best = ends[0], ends[1], 0, None
    while low is not None:
        span = F.lit(high) - F.lit(low)
        piece = F.when(span > 0, F.least(F.floor((F.col("finish") - low) / span * CUTS), F.lit(CUTS - 1))).otherwise(0)
        rows = (
            turns.filter(F.col("finish").between(low, high))
            .groupBy(piece.cast("int").alias("piece"))
            .agg(F.sum("size").alias("words"), F.min("finish").alias("low"), F.max("finish").alias("high"))
            .collect()
        )
        low = None
        for r in sorted(rows, key=lambda r: r["piece"]):
            if spent + r["words"] <= budget:
                spent, best = spent + r["words"], r["high"]
            elif r["low"] < r["high"]:
                low, high = r["low"], r["high"]
                break
            else:
                break
    return best


def _sized(docs: DataFrame, seed: int, **more: Column) -> DataFrame:
    sized = docs.select(
        docs["doc_id"].alias("doc_key"), _queue_key(docs["source"]).alias("queue"), word_count(docs["text"]).alias("size"),
        _place(docs["doc_id"], seed).alias("place"), *[v.alias(k) for k, v in more.items()],
    )
    return sized if "tie" in more else sized.withColumn("tie", F.lit(0).cast("long"))


def _plan(docs: DataFrame, seed: int, weights: tuple[int, ...], passes: int):
    sized = materialize(_sized(docs, seed))
    totals = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    slices = max(1, -(-totals[0] // SLICE_ROWS))
    plan = targets(sized, weights, passes)
    queued = materialize(_queued(sized, plan, slices))
    return plan, queued, slices, _last_finish(queued, totals[1], passes)


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = 5) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, one row per document.

    size is the number of words; taken is size times the number of times the mix takes
    the document. A null text has size 0 and is never taken; a null source is a source
    of its own, after all others; null ids share one place in the shuffle. Repeated rows
    are separate documents. An empty table gives no rows. The shuffle depends on the seed
    and the ids only, so reruns agree.
    """
    _, queued, _, cut = _plan(docs, seed, weights, passes)
    return queued.select(
        F.col("doc_key").alias("doc_id"),
        F.when(F.col("queue") != "t", F.substring("queue", 2, 1 << 30)).alias("source"),
        "size", "source_size", "target", (F.col("size") * _served(cut, passes)).alias("taken"),
    )


def mixed(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = 5) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it is taken.

    Columns are those of `docs`. The cut is found on ids and sizes; the second reading
    carries whole rows through one exchange by slice and no join on ids.
    """
    plan, _, slices, cut = _plan(docs, seed, weights, passes)
    columns = docs.columns
    whole = _sized(docs, seed, tie=F.xxhash64(docs["text"]), row=F.struct(*[docs[c] for c in columns]))
    served = _queued(whole, plan, slices).withColumn("times", _served(cut, passes)).filter("times > 0")
    return unpacked(served.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))), columns)
