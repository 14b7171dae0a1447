"""Invariants of the moist-air functions."""

import math

from pyspark.sql import functions as F

from stayline.functions import air as fn
from stayline.plans import air
from stayline.sources.projection import AfterSales

READING = "reading_id int, dbt double, kind string, value double"


def solved(spark, *readings):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(readings)], READING)
    return [r for r in air.states(df).orderBy("reading_id").collect()]


def test_known_state(spark):
    s = solved(spark, (25.0, "RH", 50.0))[0].state
    # The stated relative humidity is the ratio to the saturated humidity ratio, a little below 50 %.
    assert (s.dbt, s.rh) == (25.0, 49.2) and abs(s.rh - 100 * s.mu) < 0.06
    assert abs(s.w - 0.00988) < 5e-5 and abs(s.h - 50.3) < 0.2 and abs(s.wbt - 17.9) < 0.15 and abs(s.dpt - 13.9) < 0.15


def test_second_inputs_agree(spark):
    s = solved(spark, (30.0, "RH", 40.0))[0].state
    again = solved(spark, (30.0, "WBT", s.wbt), (30.0, "DPT", s.dpt), (30.0, "W", s.w), (30.0, "V", s.v))
    for r in again:
        assert abs(r.state.w - s.w) < 2e-4 and abs(r.state.h - s.h) < 0.5


def test_temperatures_are_ordered(star):
    bad = air.states(star.readings).where("state.mu <= 1 AND (state.wbt > state.dbt + 0.01 OR state.dpt > state.wbt + 0.01)")
    # Below freezing the dew point refers to ice and the wet bulb to the single published formula.
    assert bad.where("state.wbt > 0.5").count() == 0


def test_errors_keep_the_row(spark):
    r = solved(spark, (25.0, "XX", 1.0), (None, "RH", 1.0), (25.0, "RH", None), (math.nan, "W", 0.01), (25.0, None, 1.0))
    assert [x.error for x in r] == ["unknown kind", "missing value", "missing value", "not a number", "unknown kind"]
    assert all(x.state is None for x in r)


def test_extreme_values_do_not_fail(spark):
    r = solved(spark, (-273.15, "RH", 50.0), (150.0, "RH", 100.0), (-300.0, "V", 1.0), (20.0, "W", -1.0))
    assert r[3].state.w == 0.0 and r[3].error is None


def test_mixing_lies_between(spark):
    streams = spark.createDataFrame([("a", 1.0, 0.004, 20.0), ("a", 3.0, 0.012, 60.0), ("b", 0.0, 0.01, 30.0)], "g string, mass double, w double, h double")
    got = {r.g: r for r in air.mix(streams, ["g"]).collect()}
    assert abs(got["a"].w_mix - 0.010) < 1e-12 and abs(got["a"].h_mix - 50.0) < 1e-9
    assert got["b"].w_mix is None


def test_default_chart(spark):
    chart = spark.createDataFrame([air.CHART_DBT], "dbt_min double, dbt_max double")
    points = air.curve_points(chart)
    lines = {(r.family, r.param) for r in points.select("family", "param").distinct().collect()}
    assert len(lines) <= len(air.CURVES) == 36
    assert points.where("w < 0 OR w > 0.031").count() == 0
    assert points.where("family = 'wbt' AND dbt < param").count() == 0
    sat = points.where("family = 'saturation'").orderBy("i").collect()
    assert sat[0].dbt == -10.0 and all(a.w < b.w for a, b in zip(sat, sat[1:]))


def test_processes_follow_their_rules(star: AfterSales):
    done = air.processes(star.process_runs).cache()
    assert done.where("error IS NOT NULL").count() == 0
    assert done.where("process_type LIKE 'SENSIBLE%' AND state1.w <> state2.w").count() == 0
    assert done.where("process_type LIKE '%HUMIDIFICATION' AND process_type NOT LIKE '%ING%' AND state1.dbt <> state2.dbt").count() == 0
    wet = done.where("process_type = 'EVAPORATIVE_COOLING' AND abs(state1.wbt - state2.wbt) > 0.02 AND state2.w > 0.0001")
    assert wet.count() == 0
    assert {r.n for r in done.select(F.size("metrics").alias("n")).distinct().collect()} == {3, 4, 5}


def test_unknown_process_is_an_error_row(spark, star):
    odd = star.process_runs.limit(1).withColumn("process_type", F.lit("DRYING"))
    assert air.processes(odd).first().error == "unknown process"


def test_saturation_is_continuous_at_zero(spark):
    df = spark.createDataFrame([(-1e-6,), (0.0,)], "t double")
    a, b = (r.p for r in df.select(fn.saturation_pressure(F.col("t")).alias("p")).collect())
    assert abs(a - b) < 0.5


def test_charts_are_dealt_over_the_partitions(spark):
    charts = spark.createDataFrame([(f"u{i}", 0.0, 30.0) for i in range(40)], "user_id string, dbt_min double, dbt_max double").coalesce(1)
    points = air.curve_points(charts)
    parts = points.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
