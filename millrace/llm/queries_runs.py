"""The query of the operator that finds periodic runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import word_runs
from millrace.llm.common import words
from millrace.llm.registry import query
from millrace.session import Tables


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text; in about a tenth of the documents a part of the words repeats with a period that the id sets."""
    h, g, n, i0 = F.col("h"), F.floor(F.col("h") / 10), F.size("words"), F.col("first")
    chosen = (h % 10 == 0) & (F.length("text") > 0)
    # The words are a column of their own, so that they are cut once and not for every place.
    cut = (
        docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
        .withColumn("words", F.when(chosen, words(F.col("text"))))
        .withColumn("first", F.when(n > 0, (g % n).cast("int")))
        .withColumn("period", F.floor((n - i0) / (3 + g % 8)).cast("int") + 1)
    )
    repeated = F.transform("words", lambda x, i: F.when(i < i0, x).otherwise(F.get("words", i0 + (i - i0) % F.col("period"))))
    return cut.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def _more_repeats(best: Column, run: Column) -> Column:
    """The run with the greater exact length / period; the earlier one of equals."""
    better = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.when(better, run).otherwise(best)


@query("op12_periodic_runs")
def op12_periodic_runs(t: Tables):
    found = word_runs.collapse_runs(with_planted_period(t.documents))
    spelled = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"], F.lit("\n"))))
    none = F.lit(None).cast(word_runs.RUN)
    top = found.withColumn("top", F.aggregate("runs", none, _more_repeats))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("top").getField(f).alias(f) for f in ("start", "length", "period")],
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.regexp_replace(spelled, ",\n", "\n"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
