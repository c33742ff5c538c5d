"""Queries for sources, schema handling and cleaning (IO, CL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, numeric, text
from millrace.functions.dates import ISO_THEN_DAY_FIRST
from millrace.operators import cleaning
from millrace.operators.lineage import materialize
from millrace.plans.dirty import (
    CLEAN_SALES,
    DIRTY_SALES,
    dirty_sales,
    sql_month_first,
    sql_number,
    sql_text,
)
from millrace.plans.registry import query
from millrace.plans.sales_cleaning import clean_sales, type_sales
from millrace.sources import schema

c = F.col


@query(
    "io05_split_key",
    """select split_part(k, '|', 1) as event_type, cast(split_part(k, '|', 2) as date) as day, total
       from (select event_type || '|' || strftime(ts, '%Y-%m-%d') as k, count(*) as total
             from events group by 1)""",
)
def _(t):
    counts = t.events.groupBy(
        F.concat_ws("|", "event_type", F.date_format("ts", "yyyy-MM-dd")).alias("key")
    ).agg(F.count(F.lit(1)).alias("total"))
    return counts.select(
        text.split_key("key", 0).alias("event_type"),
        text.split_key("key", 1).cast("date").alias("day"),
        "total",
    )


@query(
    "io09_preview_head",
    "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 5",
)
def _(t):
    return schema.preview(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 5, ["o_orderkey"])


@query(
    "io09_preview_tail",
    "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey desc limit 5",
)
def _(t):
    return schema.preview(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 5, ["o_orderkey"], tail=True
    )


@query(
    "io10_clean_column_names",
    "select n_nationkey, n_name, n_regionkey from nation",
)
def _(t):
    padded = t.nation.toDF(*[f" {name}  " for name in t.nation.columns])
    return schema.clean_column_names(padded)


@query(
    "io11_find_column",
    "select event_type as label, count(*) as n from events where ts is not null group by 1",
)
def _(t):
    label = schema.find_column(t.events, ["provincia", "event_type"])
    when = schema.find_column(t.events, ["fecha", "time", "t"], mode="contains", fallback=0)
    return (
        t.events.filter(c(when).isNotNull())
        .groupBy(c(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "io12_rename_select",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, "Item" as item, "Quantity" as quantity,
       "Total Spent" as total, "Transaction Date" as bought_at from dirty_sales""",
)
def _(t):
    return schema.rename_select(
        dirty_sales(t),
        {
            "Transaction ID": "id",
            "Item": "item",
            "Quantity": "quantity",
            "Total Spent": "total",
            "Transaction Date": "bought_at",
        },
    )


@query(
    "io13_numeric_columns",
    """select l_quantity, l_extendedprice, l_discount, l_tax from lineitem""",
)
def _(t):
    rows = schema.drop_columns(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey"])
    return rows.select(*schema.numeric_columns(rows, exclude=["l_linenumber"]))


@query("io14_shape", "select count(*) as n_rows, cast(11 as bigint) as n_cols from lineitem")
def _(t):
    return schema.shape(t.lineitem)


@query(
    "io14_schema_report",
    """select 'id' as "column", 'bigint' as type, count(id) as non_null from (
         select l_orderkey as id, case when l_linenumber <> 5 then l_quantity end as q,
                case when l_linenumber <> 6 then l_linestatus end as s from lineitem)
       union all select 'q', 'double', count(case when l_linenumber <> 5 then l_quantity end) from lineitem
       union all select 's', 'string', count(case when l_linenumber <> 6 then l_linestatus end) from lineitem""",
)
def _(t):
    return schema.schema_report(
        t.lineitem.select(
            c("l_orderkey").alias("id"),
            F.when(c("l_linenumber") != 5, c("l_quantity")).alias("q"),
            F.when(c("l_linenumber") != 6, c("l_linestatus")).alias("s"),
        )
    )


@query(
    "cl01_normalize_text",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, {sql_text('"Item"')} as item,
        {sql_text('"Location"')} as branch from dirty_sales""",
)
def _(t):
    return dirty_sales(t).select(
        c("Transaction ID").alias("id"),
        text.normalize_text("Item").alias("item"),
        text.normalize_text("Location").alias("branch"),
    )


@query(
    "cl02_apply_columns",
    f"""with {DIRTY_SALES} select {sql_text('"Item"')} as item, {sql_text('"Payment Method"')} as payment,
        {sql_text('"Location"')} as branch, {sql_text('"Transaction Date"')} as bought_at from dirty_sales""",
)
def _(t):
    names = {"Item": "item", "Payment Method": "payment", "Location": "branch", "Transaction Date": "bought_at"}
    return cleaning.apply_columns(
        schema.rename_select(dirty_sales(t), names), list(names.values()), text.normalize_text
    )


@query(
    "cl03_parse_number",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, {sql_number('"Price Per Unit"')} as unit_price,
        {sql_number('"Total Spent"')} as total from dirty_sales""",
)
def _(t):
    return dirty_sales(t).select(
        c("Transaction ID").alias("id"),
        text.parse_number("Price Per Unit").alias("unit_price"),
        text.parse_number("Total Spent").alias("total"),
    )


@query(
    "cl04_drop_error_rows",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, "Total Spent" as total
        from dirty_sales where upper("Total Spent") <> 'ERROR'""",
)
def _(t):
    rows = dirty_sales(t).select(c("Transaction ID").alias("id"), c("Total Spent").alias("total"))
    return cleaning.drop_error_rows(rows, "total")


@query(
    "cl05_cast_columns",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, try_cast("Quantity" as double) as quantity,
        try_cast("Price Per Unit" as double) as unit_price from dirty_sales""",
)
def _(t):
    rows = dirty_sales(t).select(
        c("Transaction ID").alias("id"), c("Quantity").alias("quantity"), c("Price Per Unit").alias("unit_price")
    )
    return cleaning.cast_columns(rows, {"quantity": "double", "unit_price": "double"})


@query(
    "cl06_parse_timestamp_month_first",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, {sql_month_first('"Transaction Date"')} as bought_at
        from dirty_sales""",
)
def _(t):
    return dirty_sales(t).select(
        c("Transaction ID").alias("id"), dates.parse_timestamp("Transaction Date").alias("bought_at")
    )


@query(
    "cl06_parse_timestamp_day_first",
    """select event_id, cast(try_strptime(s, ['%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M', '%Y-%m-%d', '%d/%m/%Y',
         '%m/%d/%Y', '%m/%d/%Y %H:%M']) as date) as day
       from (select event_id, case event_id % 7 when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S')
               when 1 then strftime(ts, '%d/%m/%Y %H:%M') when 2 then strftime(ts, '%Y-%m-%d')
               when 3 then strftime(ts, '%d/%m/%Y') when 4 then strftime(ts, '%m/%d/%Y')
               when 5 then strftime(ts, '%m/%d/%Y %H:%M') else 'no date' end as s from events)""",
)
def _(t):
    layouts = [
        "yyyy-MM-dd HH:mm:ss",
        "dd/MM/yyyy HH:mm",
        "yyyy-MM-dd",
        "dd/MM/yyyy",
        "MM/dd/yyyy",
        "MM/dd/yyyy HH:mm",
    ]
    s = F.lit("no date")
    for i, layout in enumerate(layouts):
        s = F.when(c("event_id") % 7 == i, F.date_format("ts", layout)).otherwise(s)
    return t.events.select(
        "event_id", dates.day(dates.parse_timestamp(s, ISO_THEN_DAY_FIRST, fallback=False)).alias("day")
    )


@query(
    "cl07_parse_date",
    f"""with {DIRTY_SALES} select "Transaction ID" as id,
        cast(try_strptime("Transaction Date", '%m/%d/%Y') as date) as day from dirty_sales""",
)
def _(t):
    return dirty_sales(t).select(c("Transaction ID").alias("id"), dates.parse_date("Transaction Date").alias("day"))


@query(
    "cl08_scrub_strings",
    r"""with raw as (select page_id, strftime(p_date, '%m/%d/%Y') as fetched, url, html from
          (select page_id, url, html, date '2016-11-08' + cast(page_id % 300 as integer) as p_date from pages))
        select page_id, fetched, trim(regexp_replace(url, '[^a-zA-Z0-9\s\-.,]', '', 'g')) as url,
          trim(regexp_replace(html, '[^a-zA-Z0-9\s\-.,]', '', 'g')) as html from raw""",
)
def _(t):
    raw = t.pages.select(
        "page_id",
        F.date_format(F.date_add(F.lit("2016-11-08").cast("date"), (c("page_id") % 300).cast("int")), "MM/dd/yyyy").alias(
            "fetched"
        ),
        "url",
        "html",
    )
    return cleaning.scrub_strings(raw, exclude=["fetched"])


@query(
    "cl09_filter_numeric",
    rf"""with {DIRTY_SALES} select "Transaction ID" as id, "Quantity" as quantity, "Price Per Unit" as unit_price
        from dirty_sales where regexp_matches("Quantity", '^-?[0-9]+(\.[0-9]+)?$')
          and regexp_matches("Price Per Unit", '^-?[0-9]+(\.[0-9]+)?$')""",
)
def _(t):
    rows = dirty_sales(t).select(
        c("Transaction ID").alias("id"), c("Quantity").alias("quantity"), c("Price Per Unit").alias("unit_price")
    )
    return cleaning.filter_numeric(rows, ["quantity", "unit_price"])


@query(
    "cl10_non_numeric_rows",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, "Total Spent" as total from dirty_sales
        where "Total Spent" is not null and try_cast(trim("Total Spent") as double) is null""",
)
def _(t):
    rows = dirty_sales(t).select(c("Transaction ID").alias("id"), c("Total Spent").alias("total"))
    return cleaning.non_numeric_rows(rows, "total")


@query(
    "cl11_trim_columns",
    f"""with {DIRTY_SALES} select trim("Item") as item, trim("Location") as branch from dirty_sales""",
)
def _(t):
    rows = dirty_sales(t).select(c("Item").alias("item"), c("Location").alias("branch"))
    return cleaning.trim_columns(rows, ["item", "branch"])


@query(
    "cl12_normalize_category",
    """select province, count(*) as n from (
         select case event_type when 'click' then 'Limón' when 'view' then 'San José'
           else upper(event_type[1]) || lower(event_type[2:]) end as province from events) group by 1""",
)
def _(t):
    raw = (
        F.when(c("event_type") == "click", " limon ")
        .when(c("event_type") == "view", "SAN JOSE")
        .otherwise(F.concat(F.lit("  "), F.upper("event_type")))
    )
    return (
        t.events.groupBy(text.normalize_category(raw).alias("province"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "cl13_deduplicate",
    """select distinct l_returnflag, l_linestatus, l_quantity, l_discount from lineitem""",
)
def _(t):
    return cleaning.deduplicate(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@query(
    "cl14_drop_nulls",
    f"""with {DIRTY_SALES} select "Transaction ID" as id, "Total Spent" as total, "Payment Method" as payment
        from dirty_sales where "Total Spent" is not null and "Payment Method" is not null""",
)
def _(t):
    rows = dirty_sales(t).select(
        c("Transaction ID").alias("id"), c("Total Spent").alias("total"), c("Payment Method").alias("payment")
    )
    return cleaning.drop_nulls(rows)


@query(
    "cl15_impute_median",
    f"""with {CLEAN_SALES} select id, coalesce(quantity, round(q)) as quantity, coalesce(unit_price, p) as unit_price,
        coalesce(total, s) as total from typed, medians""",
)
def _(t):
    typed = materialize(type_sales(dirty_sales(t)))
    filled = cleaning.impute_median(typed, {"quantity": 0, "unit_price": None, "total": None})
    return filled.select("id", "quantity", "unit_price", "total")


@query(
    "cl16_impute_constant",
    f"""with {DIRTY_SALES} select coalesce({sql_text('"Item"')}, 'desconocido') as item,
        coalesce("Payment Method", 'no_definido') as payment from dirty_sales""",
)
def _(t):
    rows = dirty_sales(t).select(text.normalize_text("Item").alias("item"), c("Payment Method").alias("payment"))
    return cleaning.impute_constant(rows, {"item": "desconocido", "payment": "no_definido"})


@query(
    "cl17_impute_when",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity,
         case when l_discount = 0 then (case when l_linenumber = 1 then 0.0 end) else l_discount end as discount
       from lineitem""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.when(c("l_discount") != 0, c("l_discount")).alias("discount"),
    )
    return cleaning.impute_when(rows, "discount", c("l_linenumber") == 1, 0.0)


_MAGNITUDES = """
amounts as (select p_partkey, cast(p_retailprice as varchar) || ' million' as single,
  case when p_partkey % 5 = 0 then cast(p_size as varchar) || '–' || cast(p_size + 10 as varchar) || ' million'
       when p_partkey % 5 = 1 then cast(p_size as varchar) || '-' || cast(p_size + 3 as varchar) || ' million'
       when p_partkey % 5 = 2 then cast(p_size as varchar) || ' million' || cast(p_size * 2 as varchar) || ' million'
       when p_partkey % 5 = 3 then cast(p_size as varchar) || ' million' end as mixed from part)"""


def _amounts(t):
    size = c("p_size")
    unit = F.lit(" million")
    return t.part.select(
        "p_partkey",
        F.concat(c("p_retailprice").cast("string"), unit).alias("single"),
        F.when(c("p_partkey") % 5 == 0, F.concat(size, F.lit("–"), size + 10, unit))
        .when(c("p_partkey") % 5 == 1, F.concat(size, F.lit("-"), size + 3, unit))
        .when(c("p_partkey") % 5 == 2, F.concat(size, unit, size * 2, unit))
        .when(c("p_partkey") % 5 == 3, F.concat(size, unit))
        .alias("mixed"),
    )


@query(
    "cl18_parse_magnitude",
    f"""with {_MAGNITUDES} select p_partkey, try_cast(trim(replace(single, 'million', '')) as double) as amount
        from amounts""",
)
def _(t):
    return _amounts(t).select("p_partkey", text.parse_magnitude("single").alias("amount"))


@query(
    "cl19_parse_range_or_concat",
    f"""with {_MAGNITUDES} select p_partkey, case
          when regexp_matches(mixed, '[–-]') then
            (cast(split_part(replace(mixed, '–', '-'), '-', 1) as double)
             + cast(trim(replace(split_part(replace(mixed, '–', '-'), '-', 2), 'million', '')) as double)) / 2
          else cast(trim(split_part(mixed, 'million', 1)) as double) end as amount from amounts""",
)
def _(t):
    return _amounts(t).select("p_partkey", text.parse_range_or_concat("mixed").alias("amount"))


@query(
    "cl20_clip_percentiles",
    """with q as (select quantile_cont(l_extendedprice, 0.01) as lo, quantile_cont(l_extendedprice, 0.99) as hi
                  from lineitem)
       select l_orderkey, l_partkey, l_linenumber,
              round(least(greatest(l_extendedprice, lo), hi), 4) as price_clean from lineitem, q""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    clipped = cleaning.clip_percentiles(rows, "l_extendedprice", out="price_clean")
    return clipped.withColumn("price_clean", F.round("price_clean", 4)).drop("l_extendedprice")


@query(
    "cl20_clip_report",
    """with q as (select quantile_cont(l_extendedprice, 0.01) as lo, quantile_cont(l_extendedprice, 0.99) as hi
                  from lineitem)
       select round(max(lo), 6) as low, round(max(hi), 6) as high,
              count(*) filter (l_extendedprice < lo or l_extendedprice > hi) as outside, count(*) as n_rows
       from lineitem, q""",
)
def _(t):
    report = cleaning.clip_report(t.lineitem, "l_extendedprice")
    return report.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query(
    "cl21_iqr_outliers",
    """with v as (unpivot (select value as event_value, cast(user_id as double) as user_number from events)
                  on event_value, user_number into name "column" value v),
         q as (select "column", quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.75) as q3 from v group by 1)
       select "column", round(q1, 6) as q1, round(q3, 6) as q3, round(q1 - 1.5 * (q3 - q1), 6) as low,
              round(q3 + 1.5 * (q3 - q1), 6) as high,
              count(*) filter (v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) as outliers
       from v join q using ("column") group by "column", q1, q3""",
)
def _(t):
    rows = t.events.select(c("value").alias("event_value"), c("user_id").alias("user_number"))
    report = cleaning.iqr_outliers(rows, ["event_value", "user_number"])
    return report.withColumns({x: F.round(x, 6) for x in ("q1", "q3", "low", "high")})


@query(
    "cl22_duplicate_count",
    """select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates from
         (select count(*) as n from lineitem group by l_partkey, l_returnflag, l_linestatus)""",
)
def _(t):
    return cleaning.duplicate_count(t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus"))


@query(
    "cl23_null_report",
    f"""with {DIRTY_SALES}, n as (select count(*) as total, count("Total Spent") as a,
          count("Payment Method") as b, count("Transaction Date") as d, count("Item") as i from dirty_sales)
        select 'total' as "column", total - a as nulls, round((total - a) * 100.0::double / total, 6) as percent from n
        union all select 'payment', total - b, round((total - b) * 100.0::double / total, 6) from n
        union all select 'bought_at', total - d, round((total - d) * 100.0::double / total, 6) from n
        union all select 'item', total - i, round((total - i) * 100.0::double / total, 6) from n""",
)
def _(t):
    rows = schema.rename_select(
        dirty_sales(t),
        {"Total Spent": "total", "Payment Method": "payment", "Transaction Date": "bought_at", "Item": "item"},
    )
    return cleaning.null_report(rows).withColumn("percent", F.round("percent", 6))


@query(
    "cl24_cardinality_report",
    """select 'l_returnflag' as "column", count(distinct l_returnflag) as n_distinct from lineitem
       union all select 'l_partkey', count(distinct l_partkey) from lineitem
       union all select 'l_extendedprice', count(distinct l_extendedprice) from lineitem
       union all select 'l_shipdate', count(distinct l_shipdate) from lineitem""",
)
def _(t):
    return cleaning.cardinality_report(
        t.lineitem.select("l_returnflag", "l_partkey", "l_extendedprice", "l_shipdate")
    )


@query(
    "cl_clean_sales_job",
    f"""with {CLEAN_SALES} select item, payment, branch, cast(bought_at as date) as day, count(*) as sales,
        cast(sum(cast(total as decimal(18,2))) as double) as total,
        cast(sum(cast(quantity as decimal(18,2))) as double) as quantity from clean_sales group by all""",
)
def _(t):
    return (
        clean_sales(dirty_sales(t))
        .groupBy("item", "payment", "branch", dates.day("bought_at").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("sales"),
            numeric.money_sum("total").alias("total"),
            numeric.money_sum("quantity").alias("quantity"),
        )
    )
