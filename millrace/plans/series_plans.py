"""Queries for time series (TS)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from millrace.functions.numeric import money_sum
from millrace.operators import arima, forecast, profiling, series, windows
from millrace.operators.lineage import materialize, new_path
from millrace.plans.registry import query
from millrace.streaming.alerts import below_bound_stream, lasting_alerts
from millrace.streaming.sinks import run_available

c = F.col


def _round(df, cols, digits=6):
    return df.withColumns({x: F.round(x, digits) for x in cols})


def gapped_sales(t):
    """All line items, some moved to other months, so the calendar rules have gaps to fill."""
    y, m = F.year("l_shipdate"), F.month("l_shipdate")
    day = F.col("l_shipdate").cast("date")
    moved = (
        F.when((c("l_returnflag") == "A") & (y == 1997) & m.isin(3, 4), F.add_months(day, 2))
        .when((c("l_returnflag") == "N") & (y < 1996), F.add_months(day, 60))
        .when((c("l_returnflag") == "R") & (y > 2000), F.add_months(day, -60))
        .otherwise(day)
    )
    return t.lineitem.select("l_returnflag", moved.alias("l_shipdate"), "l_extendedprice")


_GAPPED = """gapped as (select l_returnflag, l_extendedprice, case
    when l_returnflag = 'A' and year(l_shipdate) = 1997 and month(l_shipdate) in (3, 4) then l_shipdate + interval 2 month
    when l_returnflag = 'N' and year(l_shipdate) < 1996 then l_shipdate + interval 60 month
    when l_returnflag = 'R' and year(l_shipdate) > 2000 then l_shipdate - interval 60 month
    else l_shipdate end as l_shipdate from lineitem)"""
_SERIES = """totals as (select l_returnflag, date_trunc('month', l_shipdate)::date as start,
    sum(l_extendedprice::decimal(18,2))::double as total from {src} group by all),
  spans as (select l_returnflag, unnest(generate_series(min(start), max(start), interval 1 month))::date as start
    from totals group by 1),
  series as (select l_returnflag, last_day(start) as month, coalesce(total, 0.0::double) as value
    from spans left join totals using (l_returnflag, start))"""


def monthly(t):
    return series.monthly_series(t.lineitem, "l_returnflag", "l_shipdate", money_sum("l_extendedprice"))


@query("ts01_monthly_series", f"with {_GAPPED}, {_SERIES.format(src='gapped')} select * from series")
def _(t):
    return series.monthly_series(gapped_sales(t), "l_returnflag", "l_shipdate", money_sum("l_extendedprice"))


@query(
    "ts02_align_and_interpolate",
    f"""with {_GAPPED}, {_SERIES.format(src='gapped')},
        holes as (select l_returnflag, month, case when value > 0 then value end as value from series),
        cal as (select l_returnflag, last_day(unnest(generate_series(lo, hi, interval 1 month))::date) as month
                from (select distinct l_returnflag from holes),
                     (select date_trunc('month', min(month)) as lo, date_trunc('month', max(month)) as hi from holes)),
        grid as (select l_returnflag, month, value, row_number() over (partition by l_returnflag order by month) as i
                 from cal left join holes using (l_returnflag, month)),
        k as (select *, last_value(value ignore nulls) over b as v0,
                last_value(case when value is not null then i end ignore nulls) over b as i0,
                first_value(value ignore nulls) over f as v1,
                first_value(case when value is not null then i end ignore nulls) over f as i1 from grid
              window b as (partition by l_returnflag order by i rows between unbounded preceding and current row),
                     f as (partition by l_returnflag order by i rows between current row and unbounded following))
        select l_returnflag, month, round(case when i1 is null or i1 = i0 then v0
          when i0 is not null then v0 + (v1 - v0) / (i1 - i0) * (i - i0) end, 4) as value from k""",
)
def _(t):
    monthly_totals = series.monthly_series(gapped_sales(t), "l_returnflag", "l_shipdate", money_sum("l_extendedprice"))
    holes = monthly_totals.withColumn("value", F.when(c("value") > 0, c("value")))
    return _round(series.align_and_interpolate(holes, "l_returnflag"), ["value"], 4)


def _decompose_sql(op: str, fit: str) -> str:
    return f"""with {_SERIES.format(src='lineitem')},
      base as (select l_returnflag, month, value,
          cast((row_number() over w - 1) % 12 as integer) as phase,
          case when count(*) over f = 13 then
            (sum(value) over f - (lag(value, 6) over w + lead(value, 6) over w) / 2) / 12 end as trend
        from series window w as (partition by l_returnflag order by month),
          f as (partition by l_returnflag order by month rows between 6 preceding and 6 following)),
      raw as (select l_returnflag, phase, avg(value {op} trend) as raw from base group by all),
      factors as (select l_returnflag, phase, raw {op} avg(raw) over (partition by l_returnflag) as seasonal from raw)
      select l_returnflag, month, value, phase, round(trend, 5) as trend, round(seasonal, 6) + 0.0 as seasonal,
        round(value {op} (trend {fit} seasonal), 6) + 0.0 as resid from base join factors using (l_returnflag, phase)"""


@query("ts03_seasonal_decompose", _decompose_sql("/", "*"))
def _(t):
    out = series.seasonal_decompose(monthly(t), "l_returnflag")
    return _round(_round(out, ["trend"], 5), ["seasonal", "resid"])


@query("ts03_seasonal_decompose_additive", _decompose_sql("-", "+").replace("6) + 0.0", "5) + 0.0"))
def _(t):
    out = series.seasonal_decompose(monthly(t), "l_returnflag", model="additive")
    return _round(out, ["trend", "seasonal", "resid"], 5)


@query(
    "ts03_strongest_month",
    f"""with d as ({_decompose_sql('/', '*')}) select l_returnflag, month, seasonal from
        (select *, row_number() over (partition by l_returnflag order by seasonal desc, month) as rn from d) where rn = 1""",
)
def _(t):
    out = series.strongest_month(series.seasonal_decompose(monthly(t), "l_returnflag"), "l_returnflag")
    return _round(out, ["seasonal"])


@query("ts04_adf_test")
def _(t):
    return arima.adf_test(monthly(t), "l_returnflag")


_DIFFED = f"""{_SERIES.format(src='lineitem')},
  diffed as (select * from (select l_returnflag, month,
      value - lag(value) over (partition by l_returnflag order by month) as value from series) where value is not null)"""


def _differenced(t):
    out = windows.difference(monthly(t), ["l_returnflag"], "month", "value")
    return out.select("l_returnflag", "month", c("diff").alias("value"))


@query(
    "ts05_acf",
    f"""with {_DIFFED},
      x as (select l_returnflag, row_number() over (partition by l_returnflag order by month) as i,
              value - avg(value) over (partition by l_returnflag) as x from diffed),
      r as (select a.l_returnflag, k.lag, sum(a.x * b.x) as s from x a, (select unnest(range(0, 16)) as lag) k, x b
            where b.l_returnflag = a.l_returnflag and b.i = a.i - k.lag group by all),
      z as (select l_returnflag, sum(x * x) as s0, count(*) as n from x group by 1),
      q as (select l_returnflag, cast(lag as integer) as lag, s / s0 as r, n from r join z using (l_returnflag))
      select l_returnflag, lag, round(r, 6) + 0.0 as r, n, round(case when lag = 0 then 0.0::double else 1.96::double * sqrt((1 + 2 *
        coalesce(sum(case when lag > 0 then r * r end) over (partition by l_returnflag order by lag
          rows between unbounded preceding and 1 preceding), 0.0)) / n) end, 6) as band from q""",
)
def _(t):
    return _round(series.acf(_differenced(t), "l_returnflag"), ["r", "band"])


@query("ts06_pacf")
def _(t):
    return series.pacf(_differenced(t), "l_returnflag")


@query("ts07_arima_grid")
def _(t):
    return arima.arima_grid(monthly(t), "l_returnflag")


@query("ts07_daily_order_search")
def _(t):
    """The order of every priority's daily totals, thousands of periods each."""
    days = _daily_by_priority(t).select("o_orderpriority", c("day").alias("month"), c("total").alias("value"))
    return arima.best_order(arima.arima_grid(days, "o_orderpriority", 1, 1), "o_orderpriority")


def _orders(s):
    """Best orders, fitted once and read again by the forecasts."""
    return materialize(arima.best_order(arima.arima_grid(s, "l_returnflag"), "l_returnflag"))


@query("ts08_arima_backtest")
def _(t):
    s = materialize(monthly(t))
    return arima.arima_backtest(s, "l_returnflag", _orders(s))


@query("ts08_arima_backtest_train_orders")
def _(t):
    s = materialize(monthly(t))
    train, _test = arima.split_last(s, "l_returnflag", 6)
    return arima.arima_backtest(s, "l_returnflag", _orders(train))


@query("ts09_arima_forecast")
def _(t):
    s = materialize(monthly(t))
    return arima.arima_forecast(s, "l_returnflag", _orders(s))


@query("ts10_series_summary")
def _(t):
    return arima.series_summary(materialize(monthly(t)), "l_returnflag")


def _daily_orders(t):
    return materialize(profiling.daily_sum(t.orders, "o_orderdate", money_sum("o_totalprice")))


@query("ts11_additive_forecast")
def _(t):
    return forecast.additive_forecast(_daily_orders(t), "day", "total").predict(90)


@query("ts12_forecast_components")
def _(t):
    return forecast.additive_forecast(_daily_orders(t), "day", "total").components(90)


def _daily_by_priority(t):
    total = t.orders.groupBy("o_orderpriority", c("o_orderdate").cast("date").alias("day")).agg(money_sum("o_totalprice").alias("total"))
    return materialize(total)


@query("ts11_series_forecasts")
def _(t):
    return forecast.series_forecasts(_daily_by_priority(t), "o_orderpriority", "day", "total").predict()


@query("ts12_series_components")
def _(t):
    return forecast.series_forecasts(_daily_by_priority(t), "o_orderpriority", "day", "total").components()


_GRAM_CHANGES = 3


def _gram_terms() -> list[str]:
    hinges = [f"greatest(t - {forecast.CHANGEPOINT_RANGE}::double * {i + 1} / {_GRAM_CHANGES}, 0.0::double)" for i in range(_GRAM_CHANGES)]
    waves = [f"{f}(d * {angle!r}::double)" for _, angle in forecast._waves() for f in ("sin", "cos")]
    return ["1.0::double", "t", *hinges, *waves, "y / scale"]


@query(
    "ts11_gram_sums",
    f"""with s as (select o_orderpriority as k, o_orderdate::date - date '1970-01-01' as d, sum(o_totalprice::decimal(18, 2))::double as y
         from orders group by all),
       b as (select *, (d - min(d) over w)::double / (max(d) over w - min(d) over w) as t, max(abs(y)) over w as scale
         from s window w as (partition by k)),
       x as (select k, [{", ".join(_gram_terms())}] as x from b)
       select k as o_orderpriority, i, j, round(sum(x[i + 1] * x[j + 1]), 5) + 0.0 as total from
         (select k, (p // {len(_gram_terms())})::integer as i, (p % {len(_gram_terms())})::integer as j, x from x,
           (select unnest(range({len(_gram_terms()) ** 2})) as p)) group by all""",
)
def _(t):
    grams = forecast.series_grams(_daily_by_priority(t), "o_orderpriority", "day", "total", _GRAM_CHANGES)
    n = len(_gram_terms())
    cells = grams.select("o_orderpriority", F.posexplode("gram").alias("at", "total"))
    out = cells.select("o_orderpriority", F.floor(c("at") / n).cast("int").alias("i"), (c("at") % n).alias("j"), "total")
    return _round(out, ["total"], 5)


@query(
    "ts11_planted_change",
    """with d as (select distinct o_orderpriority as k, o_orderdate::date as ds from orders),
       b as (select k, min(ds) as lo, max(ds) as hi, dense_rank() over (order by k) as r from d group by k)
       select k as o_orderpriority, (lo + round((hi - lo) * 0.8::double * (4 + 3 * r) / 25)::integer)::date as ds from b""",
)
def _(t):
    """A series whose slope changes on one known day per priority; no other day may be named."""
    days = t.orders.select("o_orderpriority", c("o_orderdate").cast("date").alias("ds")).distinct()
    spans = days.groupBy("o_orderpriority").agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    ranks = sorted(r[0] for r in spans.select("o_orderpriority").collect())
    rank = F.array_position(F.array(*map(F.lit, ranks)), c("o_orderpriority"))
    at = F.datediff("hi", "lo") * 0.8 * (4 + 3 * rank) / 25
    since = F.datediff("ds", "lo")
    y = 500 + 0.3 * since + 0.9 * F.greatest(since - at, F.lit(0.0))
    made = materialize(days.join(F.broadcast(spans), "o_orderpriority").select("o_orderpriority", "ds", y.alias("y")))
    return forecast.series_forecasts(made, "o_orderpriority", "ds", "y", 0).changes().drop("change")


@query(
    "ts12_planted_waves",
    """with d as (select distinct o_orderdate::date as ds from orders), x as (select ds, (ds - date '1970-01-01')::double as d from d)
       select ds, round(7 * sin(d * 2 * pi() / 7), 3) + 0.0 as weekly, round(40 * cos(d * 2 * pi() / 365.25::double), 3) + 0.0 as yearly from x""",
)
def _(t):
    days = t.orders.select(c("o_orderdate").cast("date").alias("ds")).distinct()
    d = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
    y = 300 + 0.05 * (d - 8000) + 7 * F.sin(d * 2 * math.pi / 7) + 40 * F.cos(d * 2 * math.pi / 365.25)
    parts = forecast.additive_forecast(materialize(days.withColumn("y", y)), "ds", "y", 0).components()
    return _round(parts.select("ds", "weekly", "yearly"), ["weekly", "yearly"], 3)


_BELOW = f"""with {_SERIES.format(src='lineitem')},
      m as (select l_returnflag, month, value, avg(value) over (partition by l_returnflag) * 1.02 as lower from series),
      n as (select *, row_number() over (partition by l_returnflag order by month) as i from m),
      g as (select *, i - row_number() over (partition by l_returnflag order by month) as island from n where value < lower),
      r as (select *, count(*) over (partition by l_returnflag, island) as run from g)
      select l_returnflag, month, value, round(lower, 4) as lower, run from r where run >= 2"""


def _limits(t):
    actual = monthly(t)
    mean = actual.groupBy("l_returnflag").agg((F.avg("value") * 1.02).alias("lower"))
    limits = actual.select("l_returnflag", "month").join(mean, "l_returnflag")
    return actual, limits


@query("ts13_below_lower_bound", _BELOW)
def _(t):
    return _round(series.below_lower_bound(*_limits(t), "l_returnflag", 2), ["lower"], 4)


@query("ts13_below_lower_bound_stream", _BELOW)
def _(t):
    """The same alerts from a stream that brings the months in five batches, out of order."""
    actual, limits = _limits(t)
    part = F.pmod(F.xxhash64("l_returnflag", "month"), F.lit(5))
    path = new_path(t.spark, "months")
    actual.join(limits, ["l_returnflag", "month"]).repartitionByRange(5, part).write.parquet(path)
    schema = t.spark.read.parquet(path).schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    written = run_available(below_bound_stream(stream, "l_returnflag"), "update")
    return _round(lasting_alerts(written, "l_returnflag", 2), ["lower"], 4)
