"""Queries for anomaly scores and alerts (AN) and their streaming forms (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import anomaly, features, metrics
from millrace.plans.readings import READINGS, SENSORS, labelled_readings
from millrace.plans.registry import query
from millrace.streaming.alerts import alert_stream, frozen_cuts
from millrace.streaming.daily import daily_counts_stream
from millrace.streaming.sinks import file_stream, latest, run_available

c = F.col


def _round(df, cols, digits=6):
    return df.withColumns({x: F.round(x, digits) for x in cols})


def scaled_readings(t):
    return features.standardize(labelled_readings(t).select("udi", "failure", *SENSORS), SENSORS)


@query("an01_isolation_forest")
def _(t):
    out = anomaly.score_isolation_forest(scaled_readings(t), ["udi"], SENSORS)
    return out.select("udi", "failure", "score", "decision", "pred")


@query("an02_one_class_machine")
def _(t):
    out = anomaly.score_one_class_machine(scaled_readings(t), SENSORS)
    return out.select("udi", "failure", "score", "decision", "pred")


def scored_readings(t):
    """Every reading with a given score (low is strange) and guess."""
    score = (c("torque") / 100 - c("wear") / 254).alias("score")
    return labelled_readings(t).select("udi", "failure", score).withColumn(
        "pred", F.when(c("score") < -0.3, -1).otherwise(1)
    )


_SCORED = f"""{READINGS},
scored as (select udi, failure, torque / 100 - wear / 254 as score,
  case when torque / 100 - wear / 254 < -0.3 then -1 else 1 end as pred from labelled)"""
_CELLS = """cells as (select count(*) filter (failure = 0 and pred = 1) as tn, count(*) filter (failure = 0 and pred = -1) as fp,
  count(*) filter (failure = 1 and pred = 1) as fn, count(*) filter (failure = 1 and pred = -1) as tp from scored)"""


@query(
    "an03_evaluate_anomaly",
    f"""with {_SCORED}, {_CELLS},
        d as (select -score as s, count(*) filter (failure = 1) as pos, count(*) filter (failure = 0) as neg from scored group by 1),
        k as (select pos, neg, sum(neg) over (order by s) as upto, sum(pos) over () as p, sum(neg) over () as n from d),
        a as (select sum(pos * ((upto - neg)::double + 0.5::double * neg)) / (max(p)::double * max(n)) as auc from k)
        select tn, fp, fn, tp, round(tp::double / (tp + fp), 6) as precision, round(tp::double / (tp + fn), 6) as recall,
          round(2 * tp::double / (2 * tp + fp + fn), 6) as f1, round(auc, 6) as auc from cells, a""",
)
def _(t):
    out = anomaly.evaluate_anomaly(scored_readings(t), "failure", "pred", "score")
    return _round(out, ["precision", "recall", "f1", "auc"])


@query("an03_compare_detectors")
def _(t):
    rows = scaled_readings(t)
    found = {
        "isolation forest": anomaly.score_isolation_forest(rows, ["udi"], SENSORS),
        "one-class machine": anomaly.score_one_class_machine(rows, SENSORS),
    }
    return metrics.misclassification_cost(
        metrics.compare_models(
            {name: anomaly.evaluate_anomaly(df, "failure", "pred", "score") for name, df in found.items()}
        )
    )


_LEVELLED = """q as (select quantile_cont(score, 0.1) as q10, quantile_cont(score, 0.25) as q25 from scored),
levelled as (select udi, failure, score, case when score <= q10 then 'Critical' when score <= q25 then 'Caution'
  else 'Normal' end as level from scored, q)"""


@query(
    "an04_alert_levels",
    f"with {_SCORED}, {_LEVELLED} select udi, failure, level from levelled",
)
def _(t):
    return anomaly.alert_levels(scored_readings(t), "score").select("udi", "failure", "level")


@query(
    "an04_alert_summary",
    f"""with {_SCORED}, {_LEVELLED} select level, count(*) as n, cast(sum(failure) as bigint) as failures,
        round(sum(failure) * 100.0::double / (select sum(failure) from levelled), 6) as failure_share
        from levelled group by 1""",
)
def _(t):
    levelled = anomaly.alert_levels(scored_readings(t), "score")
    return _round(anomaly.alert_summary(levelled, "failure"), ["failure_share"])


@query(
    "an05_threshold_sweep",
    f"""with {_SCORED},
        p as (select unnest(generate_series(80, 98, 2))::integer as percent),
        cuts as ({" union all ".join(f"select {p} as percent, quantile_cont(score, {1 - p / 100!r}) as cut from scored" for p in range(80, 99, 2))})
        select percent, round(cut, 6) + 0.0 as cut, round(coalesce(sum(failure) filter (score <= cut), 0) * 100.0::double / sum(failure), 6) as captured,
          round(count(*) filter (score <= cut) * 100.0::double / count(*), 6) as flagged
        from cuts, scored group by percent, cut""",
)
def _(t):
    return _round(
        anomaly.threshold_sweep(scored_readings(t), "failure", "score"), ["cut", "captured", "flagged"]
    )


@query(
    "an06_cost_compare",
    f"""with {READINGS}, m as (
          select 'wear' as model, failure, (wear > 190)::int as pred from labelled
          union all select 'torque', failure, (torque > 50)::int from labelled),
        k as (select model, count(*) filter (failure = 0 and pred = 1) as fp, count(*) filter (failure = 1 and pred = 0) as fn
              from m group by 1)
        select model, fn, fp, cast(10 * fn + fp as double) as cost from k""",
)
def _(t):
    rows = labelled_readings(t)
    frames = {
        "wear": metrics.confusion(rows.withColumn("pred", (c("wear") > 190).cast("int")), "failure", "pred"),
        "torque": metrics.confusion(rows.withColumn("pred", (c("torque") > 50).cast("int")), "failure", "pred"),
    }
    cells = metrics.compare_models(frames)
    return metrics.misclassification_cost(cells).select("model", "fn", "fp", "cost")


@query(
    "an07_score_timeline",
    f"""with {_SCORED}, {_LEVELLED} select udi, score, level, failure from levelled""",
)
def _(t):
    return anomaly.score_timeline(scored_readings(t), "udi", "failure", "score")


@query(
    "x01_daily_counts_stream",
    "select event_type, cast(ts as date) as day, count(*) as n from events group by all",
)
def _(t):
    stream = file_stream(t.spark, f"{t.root}/events.parquet")
    counts = daily_counts_stream(stream, "event_type", "ts")
    return latest(run_available(counts, "update"), ["event_type", "day"], "n")


@query(
    "x02_alert_stream",
    """with q as (select quantile_cont(value, 0.1) as a, quantile_cont(value, 0.25) as b from events)
       select event_id, value, case when value <= a then 'Critical' when value <= b then 'Caution' else 'Normal' end as level
       from events, q""",
)
def _(t):
    cuts = frozen_cuts(t.events, "value")
    stream = file_stream(t.spark, f"{t.root}/events.parquet").select("event_id", "value")
    return run_available(alert_stream(stream, "value", cuts)).select("event_id", "value", "level")
