"""Queries for aggregation, profiling, correlation, tests and windows (AG, CO, WN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.functions.numeric import money_sum
from millrace.operators import correlation, hypothesis, profiling, windows
from millrace.plans.dirty import CLEAN_SALES, dirty_sales
from millrace.plans.registry import query
from millrace.plans.sales_cleaning import clean_sales

c = F.col


def _round(df, cols, digits=6):
    return df.withColumns({x: F.round(x, digits) for x in cols})


_LONG = """v as (unpivot (select l_quantity as quantity, l_extendedprice as price, l_discount as discount
   from lineitem) on quantity, price, discount into name "column" value v)"""


@query(
    "ag01_describe",
    f"""with {_LONG} select "column", count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std,
        min(v) as min, max(v) as max, round(quantile_cont(v, 0.25), 6) as q1, round(quantile_cont(v, 0.5), 6) as median,
        round(quantile_cont(v, 0.75), 6) as q3 from v group by 1""",
)
def _(t):
    rows = t.lineitem.select(
        c("l_quantity").alias("quantity"), c("l_extendedprice").alias("price"), c("l_discount").alias("discount")
    )
    return _round(
        profiling.describe(rows, ["quantity", "price", "discount"]), ["mean", "std", "q1", "median", "q3"]
    )


@query(
    "ag01_describe_moments",
    """select 'value' as "column", count(value) as count, round(avg(value), 6) as mean,
         round(stddev_samp(value), 6) as std, min(value) as min, max(value) as max from events""",
)
def _(t):
    return _round(profiling.describe(t.events, ["value"], quartiles=False), ["mean", "std"])


@query(
    "ag02_group_sum",
    f"""with {CLEAN_SALES} select item, cast(sum(cast(total as decimal(18,2))) as double) as total
        from clean_sales group by 1""",
)
def _(t):
    return profiling.group_sum(clean_sales(dirty_sales(t)), ["item"], money_sum("total"))


@query(
    "ag03_group_agg",
    """select l_returnflag, l_linestatus, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as sales,
         cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity,
         cast(sum(cast(l_discount as decimal(18,2))) as double) as discount, count(*) as n
       from lineitem group by all""",
)
def _(t):
    return profiling.group_agg(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "sales": money_sum("l_extendedprice"),
            "quantity": money_sum("l_quantity"),
            "discount": money_sum("l_discount"),
            "n": F.count(F.lit(1)),
        },
    )


@query("ag04_group_count", "select c_mktsegment, count(*) as n from customer group by 1")
def _(t):
    return profiling.group_count(t.customer, ["c_mktsegment"])


@query(
    "ag04_group_count_keep_null",
    """select case when o_orderpriority <> '5-LOW' then o_orderpriority end as priority, count(*) as n
       from orders group by 1""",
)
def _(t):
    rows = t.orders.select(F.when(c("o_orderpriority") != "5-LOW", c("o_orderpriority")).alias("priority"))
    return profiling.group_count(rows, ["priority"], null_group="keep")


@query(
    "ag05_frequency_share",
    """select o_orderpriority, count(*) as n,
         round(count(*) * 100.0::double / (select count(o_orderpriority) from orders), 6) as percent
       from orders group by 1""",
)
def _(t):
    return _round(profiling.frequency_share(t.orders, "o_orderpriority"), ["percent"])


@query("ag06_daily_count", "select cast(ts as date) as day, count(*) as n from events group by 1")
def _(t):
    return profiling.daily_count(t.events, "ts")


@query(
    "ag07_daily_sum",
    """select cast(o_orderdate as date) as day, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
       from orders group by 1""",
)
def _(t):
    return profiling.daily_sum(t.orders, "o_orderdate", money_sum("o_totalprice"))


_PROVINCES = {"click": " limon ", "view": "SAN JOSE", "error": "  ", "signup": "heredia", "purchase": "CARTAGO"}


def _province():
    out = F.lit(None).cast("string")
    for kind, raw in _PROVINCES.items():
        out = F.when(c("event_type") == kind, raw).otherwise(out)
    return text.normalize_category(out)


def _province_days(t):
    return profiling.count_by(t.events, {"province": _province(), "day": c("ts").cast("date")})


_PROVINCE_DAYS = """province_days as (
  select case event_type when 'click' then 'Limón' when 'view' then 'San José' when 'signup' then 'Heredia'
           when 'purchase' then 'Cartago' end as province, cast(ts as date) as day, count(*) as n
  from events where event_type <> 'error' group by all)"""


@query("ag08_count_by", f"with {_PROVINCE_DAYS} select * from province_days")
def _(t):
    return _province_days(t)


@query(
    "ag09_group_stats",
    """select l_returnflag, round(avg(l_extendedprice), 3) as mean, round(median(l_extendedprice), 3) as median,
         round(stddev_samp(l_extendedprice), 3) as std, count(*) as n from lineitem group by 1""",
)
def _(t):
    # three digits: the median of an even count of cents may end in half a cent
    return profiling.group_stats(t.lineitem, "l_returnflag", "l_extendedprice", digits=3)


@query(
    "ag10_group_median",
    """select l_linestatus, 'l_quantity' as "column", round(median(l_quantity), 6) as median from lineitem group by 1
       union all
       select l_linestatus, 'l_extendedprice', round(median(l_extendedprice), 6) from lineitem group by 1""",
)
def _(t):
    return _round(profiling.group_median(t.lineitem, "l_linestatus", ["l_quantity", "l_extendedprice"]), ["median"])


@query(
    "ag10_group_median_many_keys",
    """select l_partkey, 'l_extendedprice' as "column", round(median(l_extendedprice), 6) as median
       from lineitem group by 1""",
)
def _(t):
    return _round(profiling.group_median(t.lineitem, "l_partkey", ["l_extendedprice"]), ["median"])


@query(
    "ag11_group_rate",
    """select o_orderpriority, round(avg(case when o_orderstatus = 'F' then 1 else 0 end) * 100, 6) as rate,
         count(*) as n from orders group by 1""",
)
def _(t):
    return _round(profiling.group_rate(t.orders, "o_orderpriority", c("o_orderstatus") == "F"), ["rate"])


@query(
    "ag12_target_profile",
    """select round(avg(l_extendedprice), 6) as mean, round(median(l_extendedprice), 6) as median,
         round(stddev_samp(l_extendedprice), 6) as std, round(skewness(l_extendedprice), 6) as skew from lineitem""",
)
def _(t):
    return _round(profiling.target_profile(t.lineitem, "l_extendedprice"), ["mean", "median", "std", "skew"])


@query(
    "ag13_segment_compare",
    """with f as (select (l_returnflag = 'R' and l_quantity > 25)::int as seg, (l_discount >= 0.05)::int as hit
                  from lineitem)
       select round(avg(hit) filter (seg = 1) * 100, 6) as rate_inside,
              round(avg(hit) filter (seg = 0) * 100, 6) as rate_outside,
              count(*) filter (seg = 1) as size, round(avg(seg) * 100, 6) as share from f""",
)
def _(t):
    out = profiling.segment_compare(
        t.lineitem, (c("l_returnflag") == "R") & (c("l_quantity") > 25), c("l_discount") >= 0.05
    )
    return _round(out, ["rate_inside", "rate_outside", "share"])


@query(
    "ag14_conditional_totals",
    """with f as (select count(*) as n, count_if(l_discount > 0.08) as a, count_if(l_tax = 0) as b,
                    count_if(l_quantity >= 45) as d from lineitem)
       select 'deep_discount' as flag, cast(a as bigint) as total, round(a * 100.0::double / n, 6) as percent from f
       union all select 'untaxed', cast(b as bigint), round(b * 100.0::double / n, 6) from f
       union all select 'bulk', cast(d as bigint), round(d * 100.0::double / n, 6) from f""",
)
def _(t):
    flags = t.lineitem.select(
        (c("l_discount") > 0.08).cast("int").alias("deep_discount"),
        (c("l_tax") == 0).cast("int").alias("untaxed"),
        (c("l_quantity") >= 45).cast("int").alias("bulk"),
    )
    return _round(profiling.conditional_totals(flags, flags.columns), ["percent"])


@query(
    "ag15_pivot",
    """select cast(date_trunc('month', l_shipdate) as date) as month,
         cast(sum(cast(l_extendedprice as decimal(18,2))) filter (l_returnflag = 'A') as double) as "A",
         cast(sum(cast(l_extendedprice as decimal(18,2))) filter (l_returnflag = 'N') as double) as "N",
         cast(sum(cast(l_extendedprice as decimal(18,2))) filter (l_returnflag = 'R') as double) as "R"
       from lineitem group by 1""",
)
def _(t):
    rows = t.lineitem.select(F.trunc("l_shipdate", "month").alias("month"), "l_returnflag", "l_extendedprice")
    return profiling.pivot(rows, "month", "l_returnflag", ["A", "N", "R"], money_sum("l_extendedprice"))


@query(
    "ag16_crosstab",
    "select o_orderstatus, o_orderpriority, count(*) as n from orders group by all",
)
def _(t):
    return profiling.crosstab(t.orders, "o_orderstatus", "o_orderpriority")


@query(
    "ag17_date_range",
    "select cast(min(o_orderdate) as date) as first, cast(max(o_orderdate) as date) as last from orders",
)
def _(t):
    return profiling.date_range(t.orders, "o_orderdate")


@query(
    "ag18_histogram",
    """with s as (select min(value) as lo, max(value) as hi from events)
       select cast(least(floor((value - lo) / ((hi - lo) / 40)), 39) as integer) as bin, count(*) as n,
         round(lo + least(floor((value - lo) / ((hi - lo) / 40)), 39) * ((hi - lo) / 40), 6) as low,
         round(lo + (least(floor((value - lo) / ((hi - lo) / 40)), 39) + 1) * ((hi - lo) / 40), 6) as high
       from events, s group by 1, 3, 4""",
)
def _(t):
    return _round(profiling.histogram(t.events, "value", 40), ["low", "high"])


@query(
    "ag18_histogram_by_class",
    """with s as (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem),
       b as (select l_returnflag, cast(least(floor((l_quantity - lo) / ((hi - lo) / 20)), 19) as integer) as bin,
               lo, (hi - lo) / 20 as w from lineitem, s)
       select l_returnflag, bin, count(*) as n, round(lo + bin * w, 6) as low, round(lo + (bin + 1) * w, 6) as high
       from b group by l_returnflag, bin, lo, w""",
)
def _(t):
    return _round(profiling.histogram(t.lineitem, "l_quantity", 20, ["l_returnflag"]), ["low", "high"])


@query(
    "ag19_box_stats",
    """with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
                    quantile_cont(value, 0.75) as q3 from events group by 1),
       v as (select e.event_type, value, q1, median, q3,
               value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
             from events e join q using (event_type))
       select event_type, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
         min(value) filter (inside) as whisker_low, max(value) filter (inside) as whisker_high,
         count(*) filter (not inside) as outliers from v group by event_type, q1, median, q3""",
)
def _(t):
    return _round(profiling.box_stats(t.events, "value", "event_type"), ["q1", "median", "q3"])


@query(
    "ag20_overall_mean_by",
    """select l_partkey, l_returnflag, round(avg(l_extendedprice), 6) as avg_l_extendedprice,
         round(avg(l_quantity), 6) as avg_l_quantity, round(avg(l_discount), 6) as avg_l_discount
       from lineitem group by all""",
)
def _(t):
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    out = profiling.overall_mean_by(t.lineitem, ["l_partkey", "l_returnflag"], cols)
    return _round(out, [f"avg_{x}" for x in cols])


_DAILY = """daily as (select cast(l_shipdate as date) as day,
   sum(cast(l_extendedprice as decimal(18,2)))::double as total from lineitem group by 1)"""


def _daily(t):
    return profiling.daily_sum(t.lineitem, "l_shipdate", money_sum("l_extendedprice"))


@query(
    "ag21_month_sums",
    f"""with {_DAILY} select cast(year(day) as integer) as year, cast(month(day) as integer) as month,
        round(sum(total), 2) as total from daily group by all""",
)
def _(t):
    return _round(profiling.month_sums(_daily(t), "day", "total"), ["total"], 2)


@query(
    "ag21_month_profile",
    f"""with {_DAILY} select cast(month(day) as integer) as month, round(avg(total), 4) as mean_daily
        from daily group by 1""",
)
def _(t):
    return _round(profiling.month_profile(_daily(t), "day", "total"), ["mean_daily"], 4)


@query("ag22_distinct_days", "select count(distinct cast(l_shipdate as date)) as days from lineitem")
def _(t):
    return profiling.distinct_days(t.lineitem, "l_shipdate")


_COR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "co01_correlation_matrix",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0 as r from lineitem" for a in _COR for b in _COR
    ),
)
def _(t):
    return _round(correlation.correlation_matrix(t.lineitem, _COR), ["r"])


_MEASURES = {f"m{i}": f"sin(l_partkey * {i + 1} + l_quantity) * l_extendedprice + {i} * l_suppkey" for i in range(9)} | {
    "tax": "case when l_linenumber <> 3 then l_tax end", "discount": "case when l_linenumber <> 4 then l_discount end", "same": "l_linenumber * 0 + 7.25",
}


@query(
    "co01_many_columns",
    f"with x as (select {', '.join(f'({e})::double as {n}' for n, e in _MEASURES.items())} from lineitem) "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, " + ("max(null::double)" if "same" in (a, b) else f"round(corr({a}, {b}), 6) + 0.0") + " as r from x"
        for a in _MEASURES for b in _MEASURES
    ),
)
def _(t):
    """More pairs than an aggregate takes: summed as blocks."""
    rows = t.lineitem.select(*[F.expr(e).cast("double").alias(n) for n, e in _MEASURES.items()])
    return _round(correlation.correlation_matrix(rows, list(_MEASURES)), ["r"])


@query(
    "co02_correlation_with",
    " union all ".join(
        f"""select '{x}' as "column", round(corr(l_extendedprice, {x}), 6) + 0.0 as r from lineitem"""
        for x in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    ),
)
def _(t):
    return _round(
        correlation.correlation_with(
            t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
        ),
        ["r"],
    )


_MOMENTS = """m as (select l_returnflag as g, count(*) as n, avg(l_extendedprice) as m,
   var_samp(l_extendedprice) as v from lineitem group by 1)"""

_T = """select x.g as group1, y.g as group2, x.n as n1, y.n as n2, round(x.m, 4) as mean1, round(y.m, 4) as mean2,
   round(x.m - y.m, 4) as difference, x.n + y.n - 2 as dof,
   round((x.m - y.m) / sqrt(((x.n - 1) * x.v + (y.n - 1) * y.v) / (x.n + y.n - 2) * (1.0::double / x.n + 1.0::double / y.n)), 6) as t
 from m x join m y on """


@query("co03_ttest_ind", f"with {_MOMENTS} {_T} x.g = 'A' and y.g = 'R'")
def _(t):
    out = hypothesis.ttest_ind(t.lineitem, "l_returnflag", "A", "R", "l_extendedprice")
    return _round(_round(out.drop("p", "significant"), ["mean1", "mean2", "difference"], 4), ["t"])


@query("co03_ttest_pairs", f"with {_MOMENTS} {_T} x.g < y.g")
def _(t):
    out = hypothesis.ttest_pairs(t.lineitem, "l_returnflag", "l_extendedprice")
    return _round(_round(out.drop("p", "significant"), ["mean1", "mean2", "difference"], 4), ["t"])


@query("co03_ttest_p_value")
def _(t):
    return hypothesis.ttest_pairs(t.events, "event_type", "value")


@query(
    "wn01_top_n_per_group",
    f"""with {_PROVINCE_DAYS} select province, day, n, cast(rank as integer) as rank from
        (select *, row_number() over (partition by province order by n desc, day) as rank from province_days)
        where rank <= 5""",
)
def _(t):
    return windows.top_n_per_group(_province_days(t), ["province"], [c("n").desc(), c("day").asc()], 5)


@query(
    "wn01_top_orders_per_customer",
    """select o_custkey, o_orderkey, o_totalprice, cast(rank as integer) as rank from
       (select o_custkey, o_orderkey, o_totalprice,
          row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders)
       where rank <= 3""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_n_per_group(rows, ["o_custkey"], [c("o_totalprice").desc(), c("o_orderkey").asc()], 3)


@query(
    "wn02_peak_per_group",
    """with d as (select event_type, cast(ts as date) as day, count(*) as n from events group by all)
       select event_type, day, n from
         (select *, row_number() over (partition by event_type order by n desc, day) as rank from d) where rank = 1""",
)
def _(t):
    days = profiling.count_by(t.events, {"event_type": c("event_type"), "day": c("ts").cast("date")})
    return windows.peak_per_group(days, "event_type", "day", "n")


_MONTHLY = """monthly as (select l_returnflag, cast(date_trunc('month', l_shipdate) as date) as month,
   sum(cast(l_extendedprice as decimal(18,2)))::double as total from lineitem group by all)"""


def _monthly(t):
    rows = t.lineitem.select("l_returnflag", F.trunc("l_shipdate", "month").alias("month"), "l_extendedprice")
    return profiling.group_agg(rows, ["l_returnflag", "month"], {"total": money_sum("l_extendedprice")})


@query(
    "wn03_moving_average",
    f"""with {_MONTHLY} select l_returnflag, month, total,
         round(case when count(*) over w3 = 3 then avg(total) over w3 end, 4) as ma3,
         round(case when count(*) over w12 = 12 then avg(total) over w12 end, 4) as ma12
        from monthly
        window w3 as (partition by l_returnflag order by month rows between 1 preceding and 1 following),
               w12 as (partition by l_returnflag order by month rows between 6 preceding and 5 following)""",
)
def _(t):
    out = windows.moving_average(_monthly(t), ["l_returnflag"], "month", "total", 3)
    return _round(windows.moving_average(out, ["l_returnflag"], "month", "total", 12), ["ma3", "ma12"], 4)


@query(
    "wn03_moving_average_30_days",
    """with d as (select o_orderstatus, cast(o_orderdate as date) as day,
                    sum(cast(o_totalprice as decimal(18,2)))::double as total from orders group by all)
       select o_orderstatus, day, round(case when count(*) over w = 30 then avg(total) over w end, 4) as ma30 from d
       window w as (partition by o_orderstatus order by day rows between 15 preceding and 14 following)""",
)
def _(t):
    rows = t.orders.withColumn("day", c("o_orderdate").cast("date"))
    daily = profiling.group_agg(rows, ["o_orderstatus", "day"], {"total": money_sum("o_totalprice")})
    out = windows.moving_average(daily, ["o_orderstatus"], "day", "total", 30)
    return _round(out.drop("total"), ["ma30"], 4)


@query(
    "wn04_difference",
    f"""with {_MONTHLY} select * from (select l_returnflag, month,
          round(total - lag(total) over (partition by l_returnflag order by month), 4) as diff from monthly)
        where diff is not null""",
)
def _(t):
    return _round(windows.difference(_monthly(t), ["l_returnflag"], "month", "total").drop("total"), ["diff"], 4)


@query(
    "wn05_order_by",
    "select s_suppkey, s_name, s_acctbal from supplier order by s_acctbal desc, s_suppkey",
)
def _(t):
    return t.supplier.select("s_suppkey", "s_name", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query(
    "wn06_top_k",
    """select event_id, event_type, value from events order by value desc, event_id limit 15""",
)
def _(t):
    return windows.top_k(t.events.select("event_id", "event_type", "value"), c("value"), 15, ties=["event_id"])


@query(
    "wn06_bottom_k",
    """select event_id, event_type, value from events order by value, event_id limit 10""",
)
def _(t):
    return windows.top_k(
        t.events.select("event_id", "event_type", "value"), c("value"), 10, ascending=True, ties=["event_id"]
    )


@query(
    "wn07_holdout_last",
    f"""with {_MONTHLY} select l_returnflag, month, total, case when row_number() over
          (partition by l_returnflag order by month desc) <= 6 then 'test' else 'train' end as part from monthly""",
)
def _(t):
    return windows.holdout_last(_monthly(t), ["l_returnflag"], "month", 6)
