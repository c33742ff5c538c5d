"""Queries for readers and writers (IO): whole tables go out to files and come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.lineage import new_path
from millrace.plans.registry import query
from millrace.sources import readers, writers

c = F.col


def _csv(t, df, **options):
    path = new_path(t.spark, "csv")
    df.write.options(header=True, **options).csv(path)
    return path


@query(
    "io01_read_csv_strings",
    """select c_custkey::varchar as c_custkey, c_name, c_nationkey::varchar as c_nationkey,
         c_acctbal::varchar as c_acctbal, c_mktsegment from customer""",
)
def _(t):
    return readers.read_csv(t.spark, _csv(t, t.customer))


@query(
    "io02_read_csv_inferred_latin1",
    """select o_orderkey::integer as o_orderkey, 'Limón ' || o_orderpriority as place, o_totalprice from orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.concat(F.lit("Limón "), "o_orderpriority").alias("place"), "o_totalprice")
    path = _csv(t, rows, encoding="ISO-8859-1")
    return readers.read_csv(t.spark, path, infer=True, encoding="ISO-8859-1")


@query(
    "io03_read_csv_schema",
    "select p_partkey, p_name, p_size, p_retailprice from part",
)
def _(t):
    rows = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    return readers.read_csv(t.spark, _csv(t, rows), schema=rows.schema)


@query(
    "io04_read_delimited",
    """select event_type || '|' || strftime(ts, '%Y-%m-%d') as key, count(*) as total from events group by 1""",
)
def _(t):
    key = F.concat_ws("|", "event_type", F.date_format("ts", "yyyy-MM-dd")).alias("key")
    path = new_path(t.spark, "counts")
    writers.write_delimited(t.events.groupBy(key).agg(F.count(F.lit(1)).alias("total")), path)
    return readers.read_delimited(t.spark, path, ["key", "total"], ["string", "bigint"])


@query("io06_read_table", "select s_suppkey, s_name, s_acctbal from supplier")
def _(t):
    t.supplier.createOrReplaceTempView("millrace_supplier")
    return readers.read_table(t.spark, "millrace_supplier").select("s_suppkey", "s_name", "s_acctbal")


@query(
    "io07_write_csv",
    "select event_type, cast(ts as date)::varchar as day, count(*)::varchar as n from events group by all",
)
def _(t):
    path = new_path(t.spark, "csv")
    counts = t.events.groupBy("event_type", c("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    writers.write_csv(t.events.select("event_type"), path)
    writers.write_csv(counts, path)  # replaces the first result
    return readers.read_csv(t.spark, path)


@query(
    "io08_write_result",
    "select l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_returnflag from lineitem",
)
def _(t):
    path = new_path(t.spark, "result")
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    writers.write_result(rows.filter("l_returnflag = 'A'"), path)
    writers.write_result(rows, path, ["l_returnflag"])
    return t.spark.read.parquet(path)
