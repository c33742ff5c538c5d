"""Raw-looking text tables derived from whole clean tables, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import Tables

c = F.col


def dirty_sales(t: Tables) -> DataFrame:
    """Every line item as all-string point-of-sale text with markers, blanks and mixed dates."""
    ship = c("l_shipdate")
    return t.lineitem.select(
        F.concat(F.lit("TXN_"), c("l_orderkey"), F.lit("-"), c("l_partkey"), F.lit("-"), c("l_linenumber")).alias(
            "Transaction ID"
        ),
        F.when(c("l_partkey") % 13 == 0, "UNKNOWN")
        .when(c("l_partkey") % 17 == 0, "   ")
        .when(c("l_partkey") % 19 == 0, " NaN ")
        .otherwise(F.concat(F.lit("  Item   "), c("l_returnflag"), F.lit(" ")))
        .alias("Item"),
        F.when(c("l_suppkey") % 11 == 3, "ERROR").otherwise(c("l_quantity").cast("string")).alias("Quantity"),
        F.when(c("l_orderkey") % 11 == 0, "UNKNOWN")
        .when(
            c("l_orderkey") % 3 == 0,
            F.concat(F.lit("$"), F.replace(c("l_extendedprice").cast("string"), F.lit("."), F.lit(","))),
        )
        .otherwise(c("l_extendedprice").cast("string"))
        .alias("Price Per Unit"),
        F.when(c("l_orderkey") % 19 == 0, "error")
        .when(c("l_orderkey") % 23 == 0, F.lit(None))
        .when(c("l_orderkey") % 29 == 0, "unknown")
        .when(c("l_orderkey") % 31 == 0, "1.234.56")
        .otherwise(F.concat(c("l_extendedprice").cast("string"), F.lit(" usd")))
        .alias("Total Spent"),
        F.when(c("l_linenumber") == 5, F.lit(None)).otherwise(c("l_linestatus")).alias("Payment Method"),
        F.when(c("l_linenumber") == 6, "none").otherwise(F.concat(F.lit("Branch "), c("l_linenumber"))).alias("Location"),
        F.when(c("l_linenumber") % 4 == 0, F.date_format(ship, "MM/dd/yyyy"))
        .when(c("l_linenumber") % 4 == 1, F.date_format(ship, "yyyy-MM-dd"))
        .when(c("l_linenumber") % 4 == 2, F.date_format(ship, "dd/MM/yyyy"))
        .otherwise(F.when(c("l_orderkey") % 2 == 0, "not a date"))
        .alias("Transaction Date"),
    )


DIRTY_SALES = """
dirty_sales as (
  select 'TXN_' || l_orderkey || '-' || l_partkey || '-' || l_linenumber as "Transaction ID",
    case when l_partkey % 13 = 0 then 'UNKNOWN' when l_partkey % 17 = 0 then '   '
         when l_partkey % 19 = 0 then ' NaN ' else '  Item   ' || l_returnflag || ' ' end as "Item",
    case when l_suppkey % 11 = 3 then 'ERROR' else cast(l_quantity as varchar) end as "Quantity",
    case when l_orderkey % 11 = 0 then 'UNKNOWN'
         when l_orderkey % 3 = 0 then '$' || replace(cast(l_extendedprice as varchar), '.', ',')
         else cast(l_extendedprice as varchar) end as "Price Per Unit",
    case when l_orderkey % 19 = 0 then 'error' when l_orderkey % 23 = 0 then null
         when l_orderkey % 29 = 0 then 'unknown' when l_orderkey % 31 = 0 then '1.234.56'
         else cast(l_extendedprice as varchar) || ' usd' end as "Total Spent",
    case when l_linenumber = 5 then null else l_linestatus end as "Payment Method",
    case when l_linenumber = 6 then 'none' else 'Branch ' || l_linenumber end as "Location",
    case when l_linenumber % 4 = 0 then strftime(l_shipdate, '%m/%d/%Y')
         when l_linenumber % 4 = 1 then strftime(l_shipdate, '%Y-%m-%d')
         when l_linenumber % 4 = 2 then strftime(l_shipdate, '%d/%m/%Y')
         when l_orderkey % 2 = 0 then 'not a date' end as "Transaction Date"
  from lineitem)"""


def sql_text(col: str) -> str:
    """SQL form of the text rule."""
    x = rf"regexp_replace(trim({col}), '\s+', ' ', 'g')"
    return (
        f"case when {x} <> '' and upper({x}) not in ('UNKNOWN','ERROR','NULL','NONE','NAN') then lower({x}) end"
    )


def sql_number(col: str) -> str:
    """SQL form of the number rule."""
    return rf"try_cast(regexp_replace(replace({sql_text(col)}, ',', '.'), '[^0-9.\-]+', '', 'g') as double)"


def sql_month_first(col: str) -> str:
    return f"try_strptime({col}, ['%m/%d/%Y', '%Y-%m-%d', '%d/%m/%Y'])"


# the cleaned sales table: text, numbers, dates, whole-row duplicates, medians, labels
CLEAN_SALES = f"""{DIRTY_SALES},
typed as (
  select distinct {sql_text('"Transaction ID"')} as id, {sql_text('"Item"')} as item,
    try_cast("Quantity" as double) as quantity, {sql_number('"Price Per Unit"')} as unit_price,
    {sql_number('"Total Spent"')} as total, {sql_text('"Payment Method"')} as payment,
    {sql_text('"Location"')} as branch, {sql_month_first(sql_text('"Transaction Date"'))} as bought_at
  from dirty_sales where upper("Total Spent") <> 'ERROR'),
medians as (
  select quantile_cont(quantity, 0.5) as q, quantile_cont(unit_price, 0.5) as p, quantile_cont(total, 0.5) as s
  from typed),
clean_sales as (
  select id, coalesce(item, 'desconocido') as item, coalesce(quantity, round(q)) as quantity,
    coalesce(unit_price, p) as unit_price, coalesce(total, s) as total,
    coalesce(payment, 'no_definido') as payment, coalesce(branch, 'sin_sucursal') as branch, bought_at
  from typed, medians where bought_at is not null and id is not null)"""
