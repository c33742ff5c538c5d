"""Queries for models and clustering (ML)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numeric import risk_bands
from millrace.operators import clustering, features, metrics, models
from millrace.operators.lineage import materialize
from millrace.plans.readings import SENSORS, labelled_readings
from millrace.plans.registry import query

c = F.col
_ID = ["l_orderkey", "l_partkey", "l_linenumber"]


def _round(df, cols, digits=6):
    return df.withColumns({x: F.round(x, digits) for x in cols})


def _least_squares(alpha: float) -> str:
    return f"""with s as (select count(*) as n, var_pop(l_quantity) * count(*) + {alpha} as xx,
         var_pop(l_discount) * count(*) + {alpha} as zz, covar_pop(l_quantity, l_discount) * count(*) as xz,
         covar_pop(l_quantity, l_extendedprice) * count(*) as xy, covar_pop(l_discount, l_extendedprice) * count(*) as zy,
         avg(l_quantity) as mx, avg(l_discount) as mz, avg(l_extendedprice) as my from lineitem),
       b as (select (xy * zz - zy * xz) / (xx * zz - xz * xz) as b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) as b2,
               mx, mz, my from s)
       select 'l_quantity' as term, round(b1, 4) as coefficient from b
       union all select 'l_discount', round(b2, 4) from b
       union all select 'intercept', round(my - b1 * mx - b2 * mz, 4) from b"""


@query("ml01_linear_regression", _least_squares(0))
def _(t):
    fit = models.linear_regression(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount"])
    return _round(fit.coefficients(t.lineitem), ["coefficient"], 4)


@query(
    "ml02_prediction_table",
    """with f as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a
                  from lineitem)
       select l_orderkey, l_partkey, l_linenumber, round(l_extendedprice, 2) as actual, round(a + b * l_quantity, 2) as predicted,
         round(l_extendedprice - (a + b * l_quantity), 2) + 0.0 as error from lineitem, f""",
)
def _(t):
    fit = models.linear_regression(t.lineitem, "l_extendedprice", ["l_quantity"])
    return models.prediction_table(fit, t.lineitem, "l_extendedprice", _ID)


def _split_readings(t, drop_first=False, spread=False):
    """Readings with a stratified split and features learned from the training part, written once."""
    rows = labelled_readings(t).select("udi", "variant", *SENSORS, "failure")
    marked = features.stratified_split(rows, "failure", features.text_hash("udi"), 0.8)
    train = marked.filter("part = 'train'")
    prep = features.fit_preparation(train, SENSORS, ["variant"], drop_first)
    return prep, materialize(prep.transform(marked).select("udi", "failure", "part", "features"), spread)


@query("ml03_logistic_regression")
def _(t):
    prep, rows = _split_readings(t, drop_first=True)
    model = models.logistic_regression(rows.filter("part = 'train'"), "failure", c=1.0)
    return models.feature_importance(model, prep, rows)


@query("ml03_logistic_balanced_metrics")
def _(t):
    _prep, rows = _split_readings(t, drop_first=True)
    train = features.with_class_weights(rows.filter("part = 'train'"), "failure")
    model = models.logistic_regression(train, "failure", c=100.0, weight="weight")
    scored = models.predict_class(models.predict_proba(model, rows.filter("part = 'test'")))
    auc = metrics.roc_auc(scored, "failure", "p").scalar()
    return metrics.binary_metrics(scored, "failure", "pred").withColumn("auc", auc)


@query("ml04_random_forest")
def _(t):
    _prep, rows = _split_readings(t, spread=True)
    train = features.with_class_weights(rows.filter("part = 'train'"), "failure")
    model = models.random_forest(train, "failure", weight="weight")
    scored = materialize(models.predict_proba(model, rows.filter("part = 'test'")).select("failure", "p"))
    auc = metrics.roc_auc(scored, "failure", "p").scalar()
    return metrics.binary_metrics(models.predict_class(scored), "failure", "pred").withColumn("auc", auc)


@query(
    "ml05_predict_class",
    """select l_orderkey, l_partkey, l_linenumber, l_extendedprice / 110000 as p,
         (l_extendedprice / 110000 >= 0.5)::int as pred from lineitem""",
)
def _(t):
    rows = t.lineitem.select(*_ID, (c("l_extendedprice") / 110000).alias("p"))
    return models.predict_class(rows)


@query(
    "ml06_risk_bands",
    """with r as (select case when l_extendedprice / 110000 > 0.6 then 'high' when l_extendedprice / 110000 >= 0.3 then 'medium'
                    else 'low' end as band, l_quantity from lineitem)
       select band, count(*) as n, round(avg(l_quantity), 6) as avg_quantity from r group by 1""",
)
def _(t):
    rows = t.lineitem.select(risk_bands(c("l_extendedprice") / 110000).alias("band"), "l_quantity")
    return rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 6).alias("avg_quantity"))


@query("ml07_feature_importance")
def _(t):
    prep, rows = _split_readings(t)
    model = models.logistic_regression(rows.filter("part = 'train'"), "failure")
    return models.strongest_features(models.feature_importance(model, prep, rows))


_FOLD_HASH = "(((o_orderkey % 2147483647) * 48271 + 42) % 2147483647 * 69621 + 42) % 2147483647"


@query(
    "ml08_stratified_folds",
    f"""with h as (select o_orderkey, o_orderstatus, {_FOLD_HASH} as h from orders),
        q as (select o_orderstatus, quantile_cont(h::double, [0.2, 0.4, 0.6, 0.8]) as cuts from h group by 1)
        select o_orderkey, o_orderstatus, cast((cuts[1] <= h)::int + (cuts[2] <= h)::int + (cuts[3] <= h)::int
          + (cuts[4] <= h)::int as integer) as fold from h join q using (o_orderstatus)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return models.stratified_folds(rows, "o_orderstatus", features.integer_hash("o_orderkey"), 5)


@query("ml08_cross_validate")
def _(t):
    _prep, rows = _split_readings(t, drop_first=True)
    train = rows.filter("part = 'train'").select("udi", "failure", "features")
    folded = materialize(models.stratified_folds(train, "failure", features.text_hash("udi", seed=7), 5))
    return models.cross_validate(folded, "failure", 5, [0.01, 1.0, 100.0])


@query("ml09_ridge_regression", _least_squares(500.0))
def _(t):
    fit = models.ridge_regression(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount"], alpha=500.0)
    return _round(fit.coefficients(t.lineitem), ["coefficient"], 4)


def _products(t):
    """Average price, quantity and sales per product."""
    return t.lineitem.groupBy("l_partkey").agg(
        F.avg("l_extendedprice").alias("price"),
        F.avg("l_quantity").alias("quantity"),
        F.avg(c("l_extendedprice") * (1 - c("l_discount"))).alias("sales"),
    )


@query("ml10_kmeans_elbow")
def _(t):
    return clustering.kmeans_elbow(clustering.feature_table(_products(t), ["sales", "quantity"]))


@query("ml11_kmeans_one_feature")
def _(t):
    points = clustering.feature_table(_products(t), ["sales"], scaled=False)
    return clustering.kmeans_fit(points, ["sales"], 5, scaled=False).original_centers()


@query("ml11_kmeans_two_features")
def _(t):
    points = clustering.feature_table(_products(t), ["sales", "quantity"])
    return clustering.kmeans_fit(points, ["sales", "quantity"], 4, seed=10).original_centers()


@query("ml12_silhouette")
def _(t):
    points = clustering.feature_table(_products(t), ["sales", "quantity"])
    return clustering.silhouette(clustering.kmeans_fit(points, ["sales", "quantity"], 4, seed=10).points)


@query(
    "ml13_cluster_profile",
    """with p as (select l_returnflag || l_linestatus as cluster, count(*) as size, avg(l_extendedprice) as price,
                    avg(l_quantity) as quantity from lineitem group by 1)
       select cluster, size, round(price, 6) as avg_l_extendedprice, round(quantity, 6) as avg_l_quantity,
         cast(row_number() over (order by price, cluster) as integer) as rank from p""",
)
def _(t):
    rows = t.lineitem.withColumn("cluster", F.concat("l_returnflag", "l_linestatus"))
    out = clustering.cluster_profile(rows, "cluster", ["l_extendedprice", "l_quantity"], "l_extendedprice")
    return _round(out, ["avg_l_extendedprice", "avg_l_quantity"])


@query("ml13_kmeans_profile")
def _(t):
    points = clustering.feature_table(_products(t), ["sales", "quantity"])
    fit = clustering.kmeans_fit(points, ["sales", "quantity"], 4, seed=10)
    return clustering.cluster_profile(fit.points, "cluster", ["sales", "quantity"], "sales")


@query("ml14_cluster_hulls")
def _(t):
    return clustering.cluster_hulls(t.lineitem, "l_returnflag", "l_quantity", "l_extendedprice")


def _pair(t, x, y):
    points = clustering.feature_table(_products(t), [x, y])
    return clustering.kmeans_fit(points, [x, y], 4, seed=10)


@query("ml15_clusters_price_quantity")
def _(t):
    return clustering.cluster_profile(_pair(t, "price", "quantity").points, "cluster", ["price", "quantity"], "price")


@query("ml15_clusters_price_sales")
def _(t):
    return clustering.cluster_profile(_pair(t, "price", "sales").points, "cluster", ["price", "sales"], "price")
