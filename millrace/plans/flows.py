"""Whole jobs from raw text to result files, chained from the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import ISO_THEN_DAY_FIRST, parse_timestamp
from millrace.functions.numeric import money_sum
from millrace.operators import arima, cleaning, profiling, series, windows
from millrace.operators.lineage import materialize, new_path
from millrace.plans.registry import query
from millrace.sources import readers, schema, writers

c = F.col

# Names under which the report date and the province may appear.
DATE_ALIASES = ("fecha", "fecha y hora", "fecha_hora")
PROVINCE_ALIASES = ("provincia",)


@query(
    "flow_counting_job",
    """with d as (select event_type as province, cast(ts as date) as day, count(*) as n from events group by all),
         r as (select *, row_number() over (partition by province order by n desc, day) as rank from d)
       select province, day, n, cast(rank as integer) as rank from r where rank <= 5""",
)
def _(t):
    # raw reports: another header, one of three date layouts per row
    day = F.when(c("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(
        c("event_id") % 3 == 1, F.date_format("ts", "d/M/yyyy H:mm")
    ).otherwise(F.date_format("ts", "yyyy-M-d"))
    raw = new_path(t.spark, "reports")
    writers.write_csv(t.events.select(c("event_type").alias(" Provincia "), day.alias("Fecha y Hora")), raw)

    reports = readers.read_csv(t.spark, raw)
    province = schema.find_column(reports, PROVINCE_ALIASES, fallback=0)
    when = schema.find_column(reports, DATE_ALIASES, fallback=1)
    dated = {"province": c(f"`{province}`"), "day": parse_timestamp(c(f"`{when}`"), ISO_THEN_DAY_FIRST).cast("date")}
    counts = profiling.count_by(reports, dated)
    peaks = windows.top_n_per_group(counts, ["province"], [c("n").desc(), c("day").asc()], 5)
    out = new_path(t.spark, "peaks")
    writers.write_csv(peaks, out)
    return readers.read_csv(t.spark, out).select(
        "province", c("day").cast("date").alias("day"), c("n").cast("long").alias("n"), c("rank").cast("int").alias("rank")
    )


@query(
    "flow_store_orders",
    """select o_orderpriority as category, year(o_orderdate)::integer as year, count(*) as n,
         sum(o_totalprice::decimal(18,2))::double as sales
       from orders where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 and o_totalprice > 1000 group by all""",
)
def _(t):
    # raw orders: nulls, unreadable dates, text amounts with a currency sign
    bought = F.when(c("o_orderkey") % 11 == 0, "soon").otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    raw = t.orders.select(
        c("o_orderpriority").alias("category"),
        F.when(c("o_orderkey") % 7 != 0, F.concat(F.lit("$"), F.format_string("%.2f", "o_totalprice"))).alias("sales"),
        bought.alias("bought"),
    )
    present = cleaning.drop_nulls(raw, ["sales"])
    dated = cleaning.drop_nulls(present.withColumn("bought", parse_timestamp("bought")), ["bought"])
    typed = dated.withColumn("sales", F.regexp_replace("sales", r"[$,\s]", "").try_cast("double"))
    keys = typed.filter(c("sales") > 1000).withColumn("year", F.year("bought"))
    return profiling.group_agg(keys, ["category", "year"], {"n": F.count(F.lit(1)), "sales": money_sum("sales")})


@query(
    "flow_forecast_random_walk",
    """with q as (select quantile_cont(l_extendedprice, 0.01) as lo, quantile_cont(l_extendedprice, 0.99) as hi from lineitem),
         totals as (select l_returnflag, date_trunc('month', l_shipdate)::date as start,
           sum(greatest(least(l_extendedprice, hi), lo)) as total from lineitem, q group by all),
         holes as (select l_returnflag, last_day(start) as month, case when month(start) <> 7 then total end as value from totals),
         span as (select date_trunc('month', min(month)) as a, date_trunc('month', max(month)) as b from holes),
         cal as (select l_returnflag, last_day(unnest(generate_series(a, b, interval 1 month))::date) as month
           from (select distinct l_returnflag from holes), span),
         grid as (select cal.l_returnflag, cal.month, value, row_number() over (partition by cal.l_returnflag order by cal.month) as i
           from cal left join holes using (l_returnflag, month)),
         k as (select *, last_value(value ignore nulls) over b as v0, last_value(case when value is not null then i end ignore nulls) over b as i0,
             first_value(value ignore nulls) over f as v1, first_value(case when value is not null then i end ignore nulls) over f as i1 from grid
           window b as (partition by l_returnflag order by i rows between unbounded preceding and current row),
             f as (partition by l_returnflag order by i rows between current row and unbounded following)),
         s as (select l_returnflag, month, case when i1 is null or i1 = i0 then v0
             when i0 is not null then v0 + (v1 - v0) / (i1 - i0) * (i - i0) end as value from k),
         d as (select l_returnflag, month, value, value - lag(value) over (partition by l_returnflag order by month) as w from s where value is not null),
         m as (select l_returnflag, max_by(value, month) as final, avg(w * w) as s2 from d group by 1)
       select l_returnflag, i::integer as step, round(final, 3) as mean, round(1.959963984540054 * sqrt(s2 * i), 2) as margin
       from m, (select unnest(range(1, 4)) as i)""",
)
def _(t):
    smooth = _smooth_months(t)
    orders = arima.best_order(arima.arima_grid(smooth, "l_returnflag", 0, 0, d=1), "l_returnflag")
    ahead = arima.arima_forecast(smooth, "l_returnflag", orders, 3)
    return ahead.select(
        "l_returnflag", "step", F.round("mean", 3).alias("mean"), F.round((c("upper") - c("lower")) / 2, 2).alias("margin")
    )


def _smooth_months(t):
    clipped = cleaning.clip_percentiles(t.lineitem, "l_extendedprice")
    monthly = series.monthly_series(clipped, "l_returnflag", "l_shipdate", "l_extendedprice_clean")
    holes = monthly.withColumn("value", F.when((F.month("month") != 7) & (c("value") > 0), c("value")))
    return materialize(series.align_and_interpolate(holes, "l_returnflag"))


def forecast_chain(smooth, key: str, h: int = 3):
    """key, step, month, mean, lower, upper, then the test, order and back-test of the key's series; h rows per key.

    The unit-root test sets d, the order search tries p and q up to 2, and the back-test
    forecasts the last h known months from an order searched in the months before them.
    """
    search = lambda months: arima.best_order(arima.arima_grid(months, key), key)
    tests = arima.adf_test(smooth, key).select(key, "statistic", "p", "stationary", c("reason").alias("test_reason"))
    orders = materialize(search(smooth))
    train, _test = arima.split_last(smooth, key, h)
    scores = arima.arima_backtest(smooth, key, materialize(search(train)), h)
    found = (
        tests.withColumnRenamed("p", "p_value")
        .join(orders.select(key, "p", "d", "q", "aic", c("reason").alias("order_reason")), key, "left")
        .join(scores.select(key, "mape", "rmse", "grade", c("reason").alias("backtest_reason")), key, "left")
    )
    return arima.arima_forecast(smooth, key, orders, h).join(found, key, "left")


@query("flow_forecast")
def _(t):
    return forecast_chain(_smooth_months(t), "l_returnflag")
