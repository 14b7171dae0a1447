"""Moist-air states, processes, mixing and chart curves over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import air
from stayline.functions.scalar import fixed_decimals, round_half_up

# Decimals of each property, kinds of second input, process types, curve parameters.
DECIMALS = {"dbt": 2, "wbt": 2, "dpt": 2, "rh": 1, "w": 6, "h": 3, "v": 4, "pv": 4, "mu": 4}
KINDS = ["WBT", "DPT", "RH", "W", "V"]
PROCESS_TYPES = [
    "SENSIBLE_HEATING",
    "SENSIBLE_COOLING",
    "HUMIDIFICATION",
    "DEHUMIDIFICATION",
    "COOLING_DEHUMIDIFICATION",
    "HEATING_HUMIDIFICATION",
    "EVAPORATIVE_COOLING",
    "ADIABATIC_MIXING",
]
CURVES = (
    [("saturation", 1.0, 300)]
    + [("rh", rh / 100.0, 200) for rh in range(10, 100, 10)]
    + [("wbt", float(wbt), 200) for wbt in range(-5, 31, 5)]
    + [("h", float(h), 200) for h in range(-10, 121, 10)]
    + [("v", v, 200) for v in (0.80, 0.84, 0.88, 0.92)]
)
METRIC_DECIMALS = {
    2: ["delta_t", "dbt_constant", "wbt_constant", "temperature_drop", "mixed_dbt"],
    3: ["heat_added", "heat_removed", "enthalpy_change", "total_heat_added", "total_heat_removed", "sensible_heat_removed",
        "latent_heat_removed", "mixed_h"],
    6: ["w_constant", "moisture_added", "moisture_removed", "mixed_w"],
}
CHART_DBT = (-10.0, 50.0)
CHART_W = (0.0, 0.031)


def _at_least_min(w: Column) -> Column:
    return F.greatest(F.lit(air.W_MIN), w)


def with_state(df: DataFrame, dbt: Column, w: Column, name: str = "state") -> DataFrame:
    """Add the full rounded state of (dry bulb, humidity ratio); NULL where either is missing."""
    t, ratio = F.col("_t"), F.col("_w")
    exact = df.withColumns({"_t": dbt, "_w": F.when(w.isNotNull(), _at_least_min(w))})
    solved = exact.withColumns(
        {"_wbt": air.wet_bulb(t, ratio), "_dpt": air.dew_point(ratio), "_ws": air.w_saturated(t)}
    )
    values = {
        "dbt": t,
        "wbt": F.col("_wbt"),
        "dpt": F.col("_dpt"),
        "rh": air.relative_humidity(ratio, F.col("_ws")) * 100.0,
        "w": ratio,
        "h": air.enthalpy(t, ratio),
        "v": air.specific_volume(t, ratio),
        "pv": air.vapour_pressure(ratio),
        "mu": air.saturation_degree(ratio, F.col("_ws")),
    }
    state = F.struct(*[round_half_up(values[p], d).alias(p) for p, d in DECIMALS.items()])
    return solved.withColumn(name, F.when(t.isNotNull() & ratio.isNotNull(), state)).drop("_t", "_w", "_wbt", "_dpt", "_ws")


def humidity_ratio(dbt: Column, kind: Column, value: Column) -> Column:
    """Humidity ratio from dry bulb and a second input of the given kind; NULL for another kind."""
    return (
        F.when(kind == "WBT", air.w_from_wet_bulb(dbt, value))
        .when(kind == "DPT", air.w_from_dew_point(value))
        .when(kind == "RH", air.w_from_rh(dbt, value / 100.0))
        .when(kind == "W", _at_least_min(value))
        .when(kind == "V", air.w_from_volume(dbt, value))
    )


def with_ratio(readings: DataFrame) -> DataFrame:
    """Add ``w`` and ``error``. A reading that cannot be used keeps its row and says why."""
    missing = F.col("dbt").isNull() | F.col("value").isNull()
    unusable = F.isnan("dbt") | F.isnan("value")
    error = (
        F.when(missing, "missing value")
        .when(unusable, "not a number")
        .when(~F.coalesce(F.col("kind").isin(KINDS), F.lit(False)), "unknown kind")
    )
    return readings.withColumn("error", error).withColumn(
        "w", F.when(F.col("error").isNull(), humidity_ratio(F.col("dbt"), F.col("kind"), F.col("value")))
    )


def states(readings: DataFrame) -> DataFrame:
    return with_state(with_ratio(readings), F.col("dbt"), F.col("w"))


def closed_forms(readings: DataFrame) -> DataFrame:
    """The properties that need no inversion, unrounded: all of them stay inside generated code."""
    t, w, w_sat = F.col("dbt"), F.col("w"), air.w_from_pressure(F.col("p_sat"))
    return with_ratio(readings).withColumn("p_sat", air.saturation_pressure(t)).withColumns(
        {
            "rh": air.relative_humidity(w, w_sat),
            "mu": air.saturation_degree(w, w_sat),
            "h": air.enthalpy(t, w),
            "v": air.specific_volume(t, w),
            "pv": air.vapour_pressure(w),
        }
    )


def _target(process: Column, s1: Column) -> dict[str, Column]:
    """Dry bulb and humidity ratio after the process, and for mixing the weighted values of both streams."""
    p1, p2, use_w = F.col("param1"), F.col("param2"), F.coalesce(F.col("use_w"), F.lit(True))
    m1 = F.coalesce(F.col("param3"), F.lit(1.0))
    w2 = _at_least_min(p2)
    other_w, other_h = round_half_up(w2, DECIMALS["w"]), round_half_up(air.enthalpy(p1, w2), DECIMALS["h"])
    w_mix = (m1 * s1["w"] + other_w) / (m1 + 1.0)
    h_mix = (m1 * s1["h"] + other_h) / (m1 + 1.0)
    constant_t = process.isin("HUMIDIFICATION", "DEHUMIDIFICATION")
    both = process.isin("COOLING_DEHUMIDIFICATION", "HEATING_HUMIDIFICATION")
    mixing = process == "ADIABATIC_MIXING"
    return {
        "_m1": F.when(mixing, m1),
        "_w_mix": F.when(mixing, w_mix),
        "_h_mix": F.when(mixing, h_mix),
        "_t2": F.when(constant_t, s1["dbt"]).when(mixing, air.dry_bulb_from(h_mix, w_mix)).otherwise(p1),
        "_w2": F.when(process.isin("SENSIBLE_HEATING", "SENSIBLE_COOLING"), s1["w"])
        .when(constant_t, F.when(use_w, p1).otherwise(air.w_from_rh(s1["dbt"], p1 / 100.0)))
        .when(both, F.when(use_w, p2).otherwise(air.w_from_rh(p1, p2 / 100.0)))
        .when(process == "EVAPORATIVE_COOLING", air.w_from_wet_bulb(p1, s1["wbt"]))
        .when(mixing, w_mix),
    }


def _metrics(process: Column, s1: Column, s2: Column) -> Column:
    """Result figures per process type, typed; differences are taken between the rounded states."""
    dh, dw, dt = s2["h"] - s1["h"], s2["w"] - s1["w"], s2["dbt"] - s1["dbt"]
    dh_out, dw_out, dt_out = s1["h"] - s2["h"], s1["w"] - s2["w"], s1["dbt"] - s2["dbt"]
    p1 = F.col("param1")
    figures = {
        "SENSIBLE_HEATING": {"heat_added": dh, "delta_t": p1 - s1["dbt"], "w_constant": s1["w"]},
        "SENSIBLE_COOLING": {"heat_removed": dh_out, "delta_t": s1["dbt"] - p1, "w_constant": s1["w"]},
        "HUMIDIFICATION": {"moisture_added": dw, "enthalpy_change": dh, "dbt_constant": s1["dbt"]},
        "DEHUMIDIFICATION": {"moisture_removed": dw_out, "enthalpy_change": dh, "dbt_constant": s1["dbt"]},
        "COOLING_DEHUMIDIFICATION": {
            "total_heat_removed": dh_out,
            "sensible_heat_removed": air.CP_AIR * dt_out,
            "latent_heat_removed": air.HEAT_OF_VAPOUR * dw_out,
            "moisture_removed": dw_out,
        },
        "HEATING_HUMIDIFICATION": {"total_heat_added": dh, "moisture_added": dw, "delta_t": dt},
        "EVAPORATIVE_COOLING": {
            "temperature_drop": dt_out,
            "moisture_added": dw,
            "wbt_constant": s1["wbt"],
            "enthalpy_change": dh,
        },
        "ADIABATIC_MIXING": {
            "mixed_dbt": F.col("_t2"),
            "mixed_w": F.col("_w_mix"),
            "mixed_h": F.col("_h_mix"),
            "mass_1": F.col("_m1"),
            "mass_2": F.lit(1.0),
        },
    }
    chosen = F
    for kind, named in figures.items():
        pairs = [x for name, value in named.items() for x in (F.lit(name), value)]
        chosen = chosen.when(process == kind, F.create_map(*pairs))
    return chosen


def processes(df: DataFrame) -> DataFrame:
    """Run each row's process from ``state1`` with its own parameters: adds ``state2``, ``metrics`` and ``error``."""
    process, s1 = F.col("process_type"), F.col("state1")
    error = F.when(s1.isNull(), "no first state").when(
        ~F.coalesce(process.isin(PROCESS_TYPES), F.lit(False)), "unknown process"
    )
    # Generated as one row per row: the first and second state are then solved one after the other, where
    # plain projections would be merged into a single, very large expression between the two solvers.
    targets = F.struct(*[c.alias(name) for name, c in _target(process, s1).items()])
    aimed = df.select("*", F.inline(F.array(targets)))
    done = with_state(aimed, F.col("_t2"), F.col("_w2"), "state2")
    return (
        done.withColumn("error", F.coalesce(error, F.when(F.col("state2").isNull(), "missing parameter")))
        .withColumn("metrics", F.when(F.col("error").isNull(), _metrics(process, s1, F.col("state2"))))
        .drop("_m1", "_w_mix", "_h_mix", "_t2", "_w2")
    )


def metric_text(name: Column, value: Column) -> Column:
    """A figure as printed: fixed decimals by kind, the masses of a mixture as they are."""
    printed = F
    for digits, names in METRIC_DECIMALS.items():
        printed = printed.when(name.isin(names), fixed_decimals(value, digits))
    return printed.otherwise(value.cast("string"))


def mix(streams: DataFrame, by: list[str], mass: str = "mass") -> DataFrame:
    """Adiabatic mixture of any number of streams per group, weighted by dry-air mass."""
    m = F.col(mass)
    mixed = streams.groupBy(*by).agg(
        F.sum(m).alias("mass"),
        F.try_divide(F.sum(m * F.col("w")), F.sum(m)).alias("w_mix"),
        F.try_divide(F.sum(m * F.col("h")), F.sum(m)).alias("h_mix"),
    )
    return mixed.withColumn("dbt_mix", air.dry_bulb_from(F.col("h_mix"), F.col("w_mix")))


def curve_points(charts: DataFrame) -> DataFrame:
    """The points of all curve families inside each chart (``dbt_min``, ``dbt_max``).

    Points are generated row by row from the chart, without joining it to a table of steps. A chart is a small row that
    gives some 7,000 points, so the charts are first dealt over all of the session's shuffle partitions: by their own
    size they would be read in one task.
    """
    parts = int(charts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = F.array(
        *[
            F.struct(F.lit(f).alias("family"), F.lit(p).alias("param"), F.lit(s).alias("steps"))
            for f, p, s in CURVES
        ]
    )
    family, param, t = F.col("family"), F.col("param"), F.col("dbt")
    low = F.when(family == "wbt", F.greatest(param, F.col("dbt_min"))).otherwise(F.col("dbt_min"))
    w = (
        F.when(family.isin("saturation", "rh"), air.w_from_rh(t, param))
        .when(family == "wbt", air.w_from_wet_bulb(t, param))
        .when((family == "h") & (air.HEAT_OF_VAPOUR + air.CP_VAPOUR * t > 0), air.w_from_enthalpy(t, param))
        .when(family == "v", air.w_from_volume(t, param))
    )
    return (
        charts.repartition(parts)
        .select("*", F.inline(lines))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("steps"))).alias("i"))
        .withColumn("dbt", low + F.col("i") * (F.col("dbt_max") - low) / F.col("steps"))
        .where((family != "wbt") | (t >= param))
        # Generated as one row per row, so that the limits below read the ratio and don't compute it again.
        .select("*", F.inline(F.array(F.struct(w.alias("w")))))
        .where(F.col("w").between(*CHART_W))
        .drop("steps")
    )
