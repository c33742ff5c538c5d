"""Queries for features and evaluation (FE, ME)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import dates, numeric
from millrace.operators import correlation, features, metrics, wide_categories
from millrace.plans.readings import READINGS, labelled_readings
from millrace.plans.registry import query

c = F.col


def _round(df, cols, digits=6):
    return df.withColumns({x: F.round(x, digits) for x in cols})


@query("fe01_binary_label", "select o_orderkey, (o_orderstatus = 'F')::int as label from orders")
def _(t):
    return t.orders.select("o_orderkey", numeric.binary_label("o_orderstatus", "F").alias("label"))


@query(
    "fe02_threshold_label",
    """select o_orderkey, o_totalprice, (o_totalprice > (select quantile_cont(o_totalprice, 0.75) from orders))::int as label
       from orders""",
)
def _(t):
    return features.threshold_label(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 0.75)


@query("fe03_flag", "select p_partkey, (p_size <= 6)::int as small from part")
def _(t):
    return t.part.select("p_partkey", numeric.as_flag(c("p_size") <= 6).alias("small"))


@query(
    "fe04_bin_column",
    """select p_partkey, case when p_size > -1 and p_size <= 6 then '0-6m' when p_size > 6 and p_size <= 12 then '7-12m'
         when p_size > 12 and p_size <= 24 then '13-24m' when p_size > 24 and p_size <= 48 then '25-48m'
         when p_size > 48 and p_size <= 72 then '49-72m' end as segment from part""",
)
def _(t):
    segment = numeric.bin_column("p_size", numeric.TENURE_EDGES, numeric.TENURE_LABELS)
    return t.part.select("p_partkey", segment.alias("segment"))


@query(
    "fe05_count_matching",
    """select l_orderkey, l_partkey, l_linenumber, (l_discount > 0.05)::int + (l_tax > 0.04)::int + (l_quantity > 25)::int
         + (l_returnflag = 'R')::int as services from lineitem""",
)
def _(t):
    yes = lambda test: F.when(test, "Yes").otherwise("No")
    rows = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        yes(c("l_discount") > 0.05).alias("a"),
        yes(c("l_tax") > 0.04).alias("b"),
        yes(c("l_quantity") > 25).alias("d"),
        yes(c("l_returnflag") == "R").alias("e"),
    )
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", numeric.count_matching(["a", "b", "d", "e"], "Yes").alias("services")
    )


@query(
    "fe06_safe_ratio",
    """select l_orderkey, l_partkey, l_linenumber,
         case when l_discount > 0 then l_extendedprice / l_discount else l_extendedprice end as ratio from lineitem""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        numeric.safe_ratio("l_extendedprice", "l_discount", "l_extendedprice").alias("ratio"),
    )


@query(
    "fe07_lookup",
    """select p_partkey, case p_type when 'ECONOMY' then 10500 when 'STANDARD' then 11500 when 'PROMO' then 12500 end
         as threshold from part""",
)
def _(t):
    mapping = {"ECONOMY": 10500, "STANDARD": 11500, "PROMO": 12500}
    return t.part.select("p_partkey", numeric.lookup("p_type", mapping).alias("threshold"))


@query(
    "fe07_lookup_join",
    """select l_orderkey, l_linenumber, l_partkey, p_type, p_size from lineitem left join part on l_partkey = p_partkey""",
)
def _(t):
    table = t.part.select(c("p_partkey").alias("l_partkey"), "p_type", "p_size")
    return features.lookup_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), table, "l_partkey")


@query(
    "fe08_rule_flags",
    f"""with {READINGS} select udi, heat, power, overload, wear_zone, failure from labelled""",
)
def _(t):
    return labelled_readings(t).select("udi", "heat", "power", "overload", "wear_zone", "failure")


@query(
    "fe09_calendar_parts",
    """select event_id, cast(ts as date) as day, cast(month(ts) as integer) as month, cast(year(ts) as integer) as year,
         cast(date_trunc('month', ts) as date) as month_start from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        dates.day("ts").alias("day"),
        dates.month_number("ts").alias("month"),
        dates.year_number("ts").alias("year"),
        dates.month_start("ts").alias("month_start"),
    )


@query(
    "fe10_assemble",
    """select l_orderkey, l_partkey, l_linenumber, l_quantity as f0, l_extendedprice as f1, l_discount as f2
       from lineitem""",
)
def _(t):
    out = features.assemble(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    v = vector_to_array("features")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", *[v[i].alias(f"f{i}") for i in range(3)])


_ID = ["l_orderkey", "l_partkey", "l_linenumber"]


@query(
    "fe11_standardize",
    """with s as (select avg(l_quantity) as mq, stddev_pop(l_quantity) as sq, avg(l_extendedprice) as mp,
                    stddev_pop(l_extendedprice) as sp from lineitem)
       select l_orderkey, l_partkey, l_linenumber, round((l_quantity - mq) / sq, 6) + 0.0 as l_quantity,
         round((l_extendedprice - mp) / sp, 6) + 0.0 as l_extendedprice from lineitem, s""",
)
def _(t):
    cols = ["l_quantity", "l_extendedprice"]
    return _round(features.standardize(t.lineitem.select(*_ID, *cols), cols), cols)


@query(
    "fe12_minmax_scale",
    """with s as (select min(l_quantity) as a, max(l_quantity) as b, min(l_extendedprice) as d,
                    max(l_extendedprice) as e from lineitem)
       select l_orderkey, l_partkey, l_linenumber, (l_quantity - a) / (b - a) as l_quantity,
         (l_extendedprice - d) / (e - d) as l_extendedprice from lineitem, s""",
)
def _(t):
    cols = ["l_quantity", "l_extendedprice"]
    return features.minmax_scale(t.lineitem.select(*_ID, *cols), cols)


@query(
    "fe12_inverse_minmax",
    """select l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice from lineitem""",
)
def _(t):
    cols = ["l_quantity", "l_extendedprice"]
    rows = t.lineitem.select(*_ID, *cols)
    return _round(features.inverse_minmax(features.minmax_scale(rows, cols), cols, rows), cols, 2)


@query(
    "fe13_one_hot",
    """select l_orderkey, l_partkey, l_linenumber, (l_returnflag = 'A')::int as "l_returnflag_A",
         (l_returnflag = 'N')::int as "l_returnflag_N", (l_returnflag = 'R')::int as "l_returnflag_R",
         (l_linestatus = 'F')::int as "l_linestatus_F", (l_linestatus = 'O')::int as "l_linestatus_O" from lineitem""",
)
def _(t):
    return features.one_hot(t.lineitem.select(*_ID, "l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"])


@query(
    "fe13_wide_positions",
    """with d as (select c_custkey, c_name, c_nationkey, dense_rank() over (order by c_name) - 1 as name_at,
         dense_rank() over (order by c_nationkey::varchar) - 2 as nation_at, count(distinct c_name) over () + count(distinct c_nationkey) over () - 2 as width from customer),
       o as (select o_orderkey, o_custkey from orders)
       select o_orderkey, case when name_at > 0 then name_at - 1 end as name_at, case when nation_at >= 0 then nation_at end as nation_at, width
       from o left join d on o_custkey = c_custkey""",
)
def _(t):
    """A level per customer: positions of the ones in the sparse vectors, the first level of each column dropped."""
    prep = wide_categories.fit_wide_preparation(t.customer, [], ["c_name", "c_nationkey"], drop_first=True)
    rows = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select(c("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey", "left")
    at = prep.positions(rows)
    return at.select("o_orderkey", c("__at_c_name").alias("name_at"), c("__at_c_nationkey").alias("nation_at"), F.lit(prep.width).cast("long").alias("width"))


@query("fe14_wide_vectors")
def _(t):
    """Sparse vectors of scaled prices and a level per customer, learned from the training orders only."""
    marked = features.random_split(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"), features.integer_hash("o_orderkey"), 0.8)
    prep = wide_categories.fit_wide_preparation(marked.filter("part = 'train'"), ["o_totalprice"], ["o_custkey", "o_orderpriority"])
    return prep.transform(marked).select("o_orderkey", "part", "features")


@query(
    "fe13_one_hot_drop_first",
    """select l_orderkey, l_partkey, l_linenumber, (l_returnflag = 'N')::int as "l_returnflag_N",
         (l_returnflag = 'R')::int as "l_returnflag_R" from lineitem""",
)
def _(t):
    return features.one_hot(t.lineitem.select(*_ID, "l_returnflag"), ["l_returnflag"], drop_first=True)


_HASH = "((({k} % 2147483647) * 48271 + 42) % 2147483647 * 69621 + 42) % 2147483647"


@query(
    "fe14_column_transformer",
    """with s as (select avg(l_quantity) as m, stddev_pop(l_quantity) as d from lineitem)
       select l_orderkey, l_partkey, l_linenumber, round((l_quantity - m) / d, 6) + 0.0 as f0,
         (l_returnflag = 'A')::int::double as f1, (l_returnflag = 'N')::int::double as f2,
         (l_returnflag = 'R')::int::double as f3 from lineitem, s""",
)
def _(t):
    rows = t.lineitem.select(*_ID, "l_quantity", "l_returnflag")
    out = features.fit_preparation(rows, ["l_quantity"], ["l_returnflag"]).transform(rows)
    v = vector_to_array("features")
    return out.select(*_ID, *[F.round(v[i], 6).alias(f"f{i}") for i in range(4)])


@query(
    "fe15_fit_transform",
    f"""with split as (select *, {_HASH.format(k='o_orderkey')} < floor(0.8 * 2147483647) as train from orders),
        s as (select avg(o_totalprice) as m, stddev_pop(o_totalprice) as d from split where train)
        select o_orderkey, round((o_totalprice - m) / d, 6) + 0.0 as scaled,
          (o_orderstatus = 'F')::int::double as status_f from split, s where not train""",
)
def _(t):
    marked = features.random_split(t.orders, features.integer_hash("o_orderkey"), 0.8)
    prep = features.fit_preparation(marked.filter("part = 'train'"), ["o_totalprice"], ["o_orderstatus"])
    out = prep.transform(marked.filter("part = 'test'")).withColumn("v", vector_to_array("features"))
    return out.select("o_orderkey", F.round(c("v")[0], 6).alias("scaled"), c("v")[1].alias("status_f"))


@query(
    "fe16_random_split",
    f"""select o_orderkey, case when {_HASH.format(k='o_orderkey')} < floor(0.7 * 2147483647) then 'train' else 'test' end
        as part from orders""",
)
def _(t):
    return features.random_split(t.orders.select("o_orderkey"), features.integer_hash("o_orderkey"), 0.7)


@query(
    "fe17_stratified_split",
    f"""with h as (select o_orderkey, o_orderstatus, {_HASH.format(k='o_orderkey')} as h from orders),
        q as (select o_orderstatus, quantile_cont(h::double, 0.8) as cut from h group by 1)
        select o_orderkey, o_orderstatus, case when h < cut then 'train' else 'test' end as part
        from h join q using (o_orderstatus)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return features.stratified_split(rows, "o_orderstatus", features.integer_hash("o_orderkey"), 0.8)


@query(
    "fe18_class_weights",
    """with k as (select o_orderstatus, count(*) as n from orders group by 1)
       select o_orderkey, o_orderstatus, round((select sum(n) from k)::double / ((select count(*) from k) * n), 6) as weight
       from orders join k using (o_orderstatus)""",
)
def _(t):
    out = features.with_class_weights(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus")
    return _round(out, ["weight"])


_TARGET = "l_extendedprice + 1000 * l_quantity"


@query(
    "fe19_select_by_correlation",
    " union all ".join(
        f"""select '{x}' as "column", round(abs(corr({_TARGET}, {x})), 6) as strength from lineitem
            having abs(corr({_TARGET}, {x})) > 0.2"""
        for x in ("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    ),
)
def _(t):
    cols = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    rows = t.lineitem.select(*cols).withColumn("target", c("l_extendedprice") + 1000 * c("l_quantity"))
    kept = correlation.select_by_correlation(rows, "target", cols)
    strengths = correlation.correlation_with(rows, "target", kept)
    return strengths.select("column", F.round(F.abs("r"), 6).alias("strength"))


# --- evaluation: the whole line item table with a given label, guess and score ---


def _judged(t):
    return t.lineitem.select(
        (c("l_quantity") > 25).cast("int").alias("y"),
        (c("l_extendedprice") > 40000).cast("int").alias("pred"),
        c("l_extendedprice").alias("score"),
    )


_JUDGED = """j as (select (l_quantity > 25)::int as y, (l_extendedprice > 40000)::int as pred,
  l_extendedprice as score from lineitem)"""
_CELLS = """cells as (select count(*) filter (y = 0 and pred = 0) as tn, count(*) filter (y = 0 and pred = 1) as fp,
  count(*) filter (y = 1 and pred = 0) as fn, count(*) filter (y = 1 and pred = 1) as tp from j)"""
_RATES = """round((tp + tn)::double / (tp + tn + fp + fn), 6) as accuracy, round(tp::double / (tp + fp), 6) as precision,
  round(tp::double / (tp + fn), 6) as recall, round(2 * tp::double / (2 * tp + fp + fn), 6) as f1"""


@query("me01_confusion", f"with {_JUDGED}, {_CELLS} select * from cells")
def _(t):
    return metrics.confusion(_judged(t), "y", "pred")


@query("me02_binary_metrics", f"with {_JUDGED}, {_CELLS} select {_RATES} from cells")
def _(t):
    return _round(metrics.binary_metrics(_judged(t), "y", "pred"), ["accuracy", "precision", "recall", "f1"])


@query(
    "me03_class_report",
    f"""with {_JUDGED}, k as (
          select l as label, count(*) filter (y = l) as support, count(*) filter (pred = l) as said,
            count(*) filter (y = l and pred = l)::double as hit from j, (select unnest([0, 1]) as l) group by 1),
        r as (select label::varchar as label, hit / said as precision, hit / support as recall,
            2 * hit / (said + support) as f1, support from k)
        select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r
        union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
          sum(support)::bigint from r
        union all select 'weighted avg', round(sum(precision * support) / sum(support), 6),
          round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
          sum(support)::bigint from r""",
)
def _(t):
    return _round(metrics.class_report(_judged(t), "y", "pred"), ["precision", "recall", "f1"])


_TOTALS = """d as (select score, count(*) filter (y = 1) as pos, count(*) filter (y = 0) as neg from j group by 1),
  k as (select score, pos, neg, sum(pos) over w as pos_upto, sum(neg) over w as neg_upto,
          sum(pos) over () as pos_all, sum(neg) over () as neg_all from d window w as (order by score))"""


@query(
    "me04_roc_auc",
    f"""with {_JUDGED}, {_TOTALS} select round(sum(pos * ((neg_upto - neg)::double + 0.5::double * neg))
          / (max(pos_all)::double * max(neg_all)), 6) as auc from k""",
)
def _(t):
    return _round(metrics.roc_auc(_judged(t), "y", "score"), ["auc"])


@query(
    "me05_roc_points",
    f"""with {_JUDGED}, {_TOTALS} select score as cut, round((neg_all - neg_upto + neg)::double / neg_all, 6) as fpr,
          round((pos_all - pos_upto + pos)::double / pos_all, 6) as tpr from k""",
)
def _(t):
    return _round(metrics.roc_points(_judged(t), "y", "score"), ["fpr", "tpr"])


@query(
    "me05_pr_points",
    f"""with {_JUDGED}, {_TOTALS} select score as cut, round((pos_all - pos_upto + pos)::double
            / (pos_all - pos_upto + pos + neg_all - neg_upto + neg), 6) as precision,
          round((pos_all - pos_upto + pos)::double / pos_all, 6) as recall from k""",
)
def _(t):
    return _round(metrics.pr_points(_judged(t), "y", "score"), ["precision", "recall"])


@query(
    "me06_regression_metrics",
    """with p as (select l_extendedprice as y, l_quantity * 1500 as yhat from lineitem)
       select round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) as r2,
         round(sqrt(avg((y - yhat) * (y - yhat))), 6) as rmse, round(avg(abs(y - yhat)), 6) as mae,
         round(avg(abs((y - yhat) / y)) * 100, 6) as mape,
         round(avg((y between yhat * 0.5 and yhat * 1.5)::int) * 100, 6) as coverage from p""",
)
def _(t):
    rows = t.lineitem.select(c("l_extendedprice").alias("y"), (c("l_quantity") * 1500).alias("yhat")).withColumns(
        {"low": c("yhat") * 0.5, "high": c("yhat") * 1.5}
    )
    out = metrics.regression_metrics(rows, "y", "yhat", "low", "high")
    return _round(out, ["r2", "rmse", "mae", "mape", "coverage"])


@query(
    "me07_compare_models",
    """with j as (select (l_quantity > 25)::int as y, l_extendedprice as p from lineitem),
       m as (select 'cut 30k' as model, (p > 30000)::int as pred, y from j
             union all select 'cut 50k', (p > 50000)::int, y from j),
       k as (select model, count(*) filter (y = 0 and pred = 0) as tn, count(*) filter (y = 0 and pred = 1) as fp,
               count(*) filter (y = 1 and pred = 0) as fn, count(*) filter (y = 1 and pred = 1) as tp from m group by 1)
       select model, round((tp + tn)::double / (tp + tn + fp + fn), 4) as accuracy,
         round(tp::double / (tp + fp), 4) as precision, round(tp::double / (tp + fn), 4) as recall,
         round(2 * tp::double / (2 * tp + fp + fn), 4) as f1 from k""",
)
def _(t):
    rows = t.lineitem.select((c("l_quantity") > 25).cast("int").alias("y"), c("l_extendedprice").alias("p"))
    guess = lambda cut: rows.withColumn("pred", (c("p") > cut).cast("int"))
    return metrics.compare_models(
        {
            "cut 30k": metrics.binary_metrics(guess(30000), "y", "pred"),
            "cut 50k": metrics.binary_metrics(guess(50000), "y", "pred"),
        }
    )


@query(
    "me08_majority_baseline",
    """select o_orderstatus as label, round(n::double / (select count(*) from orders), 6) as accuracy
       from (select o_orderstatus, count(*) as n from orders group by 1) order by n desc, label limit 1""",
)
def _(t):
    return _round(metrics.majority_baseline(t.orders, "o_orderstatus"), ["accuracy"])


@query(
    "me09_grade",
    """select o_orderkey, case when o_totalprice / 5000 < 10 then 'excellent' when o_totalprice / 5000 < 15 then 'good'
         when o_totalprice / 5000 < 25 then 'moderate' else 'low' end as mape_grade,
         case when o_totalprice / 500000 >= 0.95 then 'excellent' when o_totalprice / 500000 >= 0.9 then 'acceptable'
         else 'insufficient' end as recall_grade from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        numeric.grade(c("o_totalprice") / 5000, numeric.MAPE_BANDS, "low", rising=False).alias("mape_grade"),
        numeric.grade(c("o_totalprice") / 500000, numeric.RECALL_BANDS, "insufficient").alias("recall_grade"),
    )


@query(
    "me10_probability_histogram",
    """with p as (select (l_quantity > 25)::int as y, l_extendedprice / 110000 as p from lineitem),
       s as (select min(p) as lo, (max(p) - min(p)) / 25 as w from p),
       b as (select y, cast(least(floor((p - lo) / w), 24) as integer) as bin, lo, w from p, s)
       select y, bin, count(*) as n, round(lo + bin * w, 6) as low, round(lo + (bin + 1) * w, 6) as high
       from b group by y, bin, lo, w""",
)
def _(t):
    rows = t.lineitem.select((c("l_quantity") > 25).cast("int").alias("y"), (c("l_extendedprice") / 110000).alias("p"))
    return _round(metrics.probability_histogram(rows, "p", "y"), ["low", "high"])
