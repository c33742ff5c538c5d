"""Rules that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: no blank, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns of `docs` as one struct `row`, beside the derived columns of `more`.

    Packing keeps an operator's working columns apart from whatever extra columns the
    caller has, whatever their names. `unpacked` restores the caller's columns.
    """
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in more.items()])


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The packed columns again, some of them replaced."""
    return df.select(*[replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns])
