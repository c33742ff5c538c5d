"""Line dedup by the number of distinct sites a line spreads over.

A HyperLogLog sketch of the sites per line hash merges in an ordinary aggregation. Far
from the threshold the sketch decides; lines near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import packed, unpacked
from millrace.llm.hot_keys import join_counted
from millrace.operators.lineage import materialize

#: A line on at least so many sites is boilerplate.
MIN_SITES = 4
#: Broadcast at most so many boilerplate lines: those that hold more than this share of all lines.
HOT_LINES = 10_000
#: log2 of the sketch's registers; its relative error is 1.04 / sqrt(registers).
LOG_REGISTERS = 10
#: Standard errors around the threshold within which a line is counted exactly.
MARGIN = 4


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _lines(docs: DataFrame) -> DataFrame:
    """doc, mark, site, at, line_hash: every line that holds a word."""
    each = docs.select(
        docs["doc_id"].alias("doc"), F.xxhash64(docs["text"]).alias("mark"), docs["source"].alias("site"),
        F.posexplode(F.split(docs["text"], "\n", -1)).alias("at", "line"),
    )
    body = each.withColumn("line", _trimmed(F.col("line"))).filter("line != ''")
    return body.select("doc", "mark", "site", "at", F.xxhash64("line").alias("line_hash"))


def boilerplate(lines: DataFrame, total: int, min_sites: int = MIN_SITES) -> DataFrame:
    """line_hash, first_doc, first_at and held (its occurrences) of each line on at least `min_sites` sites.

    `total` is the number of lines.
    """
    error = MARGIN * 1.04 / (1 << LOG_REGISTERS) ** 0.5
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    spread = materialize(
        lines.groupBy("line_hash")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites"),
            F.min(F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "at")).alias("first"),
            F.count("site").alias("n"),
            F.count(F.lit(1)).alias("held"),
        )
        .filter((F.col("n") >= min_sites) & (F.col("sites") >= low))
    )
    near = F.col("sites") <= high
    close = spread.filter(near).select("line_hash", "held")
    exact = (
        join_counted(lines.select("line_hash", "site"), close, "line_hash", "held", total, HOT_LINES)
        .groupBy("line_hash")
        .agg(F.countDistinct("site").alias("exact"))
        .filter(F.col("exact") >= min_sites)
        .select("line_hash")
    )
    decided = spread.filter(~near).unionByName(spread.join(exact, "line_hash", "left_semi"))
    return decided.select("line_hash", F.col("first.doc").alias("first_doc"), F.col("first.at").alias("first_at"), "held")


def removals(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc, mark, drop: sorted line numbers that go, one row per document that loses any.

    Lines that very many documents share meet their occurrences by broadcast, of which there
    can only be HOT_LINES; the others by shuffle, none of them with many rows.
    """
    lines = materialize(_lines(docs))  # hashes and places only, for the passes below
    total = lines.count()
    known = materialize(boilerplate(lines, total, min_sites))
    first = F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("at") == F.col("first_at"))
    return (
        join_counted(lines, known, "line_hash", "held", total, HOT_LINES)
        .filter(~first)
        .groupBy("doc", "mark")
        .agg(F.sort_array(F.collect_set("at")).alias("drop"))
    )


def dedup_lines(docs: DataFrame, *, min_sites: int = MIN_SITES) -> DataFrame:
    """`docs` with the cross-site lines taken out of `text`, plus n_lines and n_removed.

    Columns: row (the input row as a struct), clean (the text left), n_lines, n_removed.
    Lines end at "\\n" and are compared without blanks around them. A line on at least
    `min_sites` distinct sources is boilerplate; it stays only where it occurs first, by
    smallest doc_id, then line number, so no passage is lost altogether. A table with fewer
    sources than `min_sites` loses nothing, an empty one gives no rows. Lines without a
    word always stay. A null source is no site. A null text stays null with 0 lines.
    Rows that repeat an id and a text are treated alike; a null id comes after all others.
    """
    left = packed(docs, doc=docs["doc_id"], mark=F.xxhash64(docs["text"]), body=docs["text"])
    drop = removals(docs, min_sites).withColumnsRenamed({"doc": "drop_doc", "mark": "drop_mark"})
    both = left.join(drop, (F.col("mark") == F.col("drop_mark")) & F.col("doc").eqNullSafe(F.col("drop_doc")), "left")
    cut = both.select("row", "body", "drop", F.split("body", "\n", -1).alias("lines"))
    left_at = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    left = cut.select("row", "body", "drop", "lines", F.when(F.col("drop").isNotNull(), left_at).alias("left_at"))
    kept = F.array_join(F.transform("left_at", lambda i: F.get(F.col("lines"), i)), "\n")
    return left.select(
        "row",
        F.when(F.col("drop").isNull(), F.col("body")).otherwise(kept).alias("clean"),
        F.when(F.col("body").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_removed"),
    )


def without_boilerplate(docs: DataFrame, *, min_sites: int = MIN_SITES) -> DataFrame:
    """`docs` with clean texts and, where there is such a column, their lengths."""
    done = dedup_lines(docs, min_sites=min_sites)
    more = {}
    if "n_chars" in docs.columns:
        more["n_chars"] = F.when(F.col("n_removed") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))
    return unpacked(done, docs.columns, text=F.col("clean"), **more)
