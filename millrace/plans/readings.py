"""Machine readings derived from every line item, in Spark and in SQL alike."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import lookup
from millrace.operators.features import rule_flags
from millrace.session import Tables

c = F.col

SENSORS = ["air", "process", "rpm", "torque", "wear"]

# Overload threshold per product variant, rule limits.
OVERLOAD_LIMIT = {"L": 10500, "M": 11500, "H": 12500}
HEAT_DELTA, HEAT_RPM = 8.6, 1380
POWER_LOW, POWER_HIGH = 3500, 9000
WEAR_LOW, WEAR_HIGH = 200, 240


def failure_rules() -> dict[str, Column]:
    """Deterministic failure rules: heat, power, overload and wear zone."""
    power = c("torque") * c("rpm") * (2 * math.pi / 60)
    return {
        "heat": (c("process") - c("air") < HEAT_DELTA) & (c("rpm") < HEAT_RPM),
        "power": (power < POWER_LOW) | (power > POWER_HIGH),
        "overload": c("wear") * c("torque") > lookup("variant", OVERLOAD_LIMIT),
        "wear_zone": c("wear").between(WEAR_LOW, WEAR_HIGH),
    }


def readings(t: Tables) -> DataFrame:
    """One reading per line item: variant, two temperatures, speed, torque, wear."""
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("udi"),
        F.when(c("l_returnflag") == "A", "L").when(c("l_returnflag") == "N", "M").otherwise("H").alias("variant"),
        (F.lit(295.0) + c("l_tax") * 100).alias("air"),
        (F.lit(295.0) + c("l_tax") * 100 + 8 + c("l_discount") * 40).alias("process"),
        (F.lit(1200) + (c("l_suppkey") * 37 + c("l_linenumber") * 101) % 700).cast("double").alias("rpm"),
        (c("l_quantity") * 0.9 + 15).alias("torque"),
        ((c("l_partkey") * 7 + c("l_linenumber") * 13) % 254).cast("double").alias("wear"),
    )


def labelled_readings(t: Tables) -> DataFrame:
    return rule_flags(readings(t), failure_rules(), "failure")


READINGS = """
readings as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as udi,
    case l_returnflag when 'A' then 'L' when 'N' then 'M' else 'H' end as variant,
    295.0::double + l_tax * 100 as air, 295.0::double + l_tax * 100 + 8 + l_discount * 40 as process,
    (1200 + (l_suppkey * 37 + l_linenumber * 101) % 700)::double as rpm,
    l_quantity * 0.9::double + 15 as torque, ((l_partkey * 7 + l_linenumber * 13) % 254)::double as wear
  from lineitem),
flags as (
  select *, (process - air < 8.6 and rpm < 1380)::int as heat,
    (torque * rpm * (2 * pi() / 60) < 3500 or torque * rpm * (2 * pi() / 60) > 9000)::int as power,
    (wear * torque > case variant when 'L' then 10500 when 'M' then 11500 else 12500 end)::int as overload,
    (wear between 200 and 240)::int as wear_zone
  from readings),
labelled as (select *, greatest(heat, power, overload, wear_zone) as failure from flags)"""
