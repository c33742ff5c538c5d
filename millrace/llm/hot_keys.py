"""Joins on keys of which a few may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_counted(facts: DataFrame, table: DataFrame, key: str, count: str, total: int, most: int) -> DataFrame:
    """`facts` inner-joined with `table` on `key`, where `count` says how many facts hold each key of the table.

    `total` is at least the sum of `count` over the table, whose keys are distinct. Keys with more
    than total / most facts are broadcast: there can be fewer than `most` of them, whatever
    the data. The others have few facts each and meet by shuffle. Facts whose key is null
    or not in the table have no row; empty inputs give no rows.
    """
    heavy = table.filter(F.col(count) * most > total)
    light = table.filter(F.col(count) * most <= total)
    few = facts.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return facts.join(F.broadcast(heavy), key).unionByName(few.join(light, key))
