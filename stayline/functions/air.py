"""Moist-air properties.

Closed forms are Column expressions. The two inverse functions (wet bulb and dew point) are found by
bisection over whole Arrow batches, because the same loop as a higher-order expression is many times slower.
Temperatures in degrees C, humidity ratio in kg/kg, enthalpy in kJ/kg, pressure in Pa (vapour pressure in kPa).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Standard pressure, smallest humidity ratio and the published coefficients of the
# saturation-pressure equations over water (t >= 0) and over ice (t < 0).
PRESSURE = 101325.0
W_MIN = 1e-7
KELVIN = 273.15
MASS_RATIO = 0.621945
GAS_CONSTANT = 287.042
VAPOUR_FACTOR = 1.6078
HEAT_OF_VAPOUR = 2501.0
CP_AIR = 1.006
CP_VAPOUR = 1.86
CP_WATER = 4.186
WET_BULB_SLOPE = 2.381
OVER_WATER = (-5800.2206, 1.3914993, -0.048640239, 4.1764768e-5, -1.4452093e-8, 6.5459673)
OVER_ICE = (-5674.5359, 6.3925247, -0.009677843, 6.2215701e-7, 2.0747825e-9, -9.484024e-13, 4.1635019)
BISECTIONS = 60


def _ln_saturation(k, ln, coefficients):
    """Exponent of the saturation pressure: c0/k + polynomial in k + c_last*ln(k), for Columns and arrays alike."""
    inverse, *poly, log_term = coefficients
    total, power = inverse / k + poly[0], k
    for c in poly[1:]:
        total = total + c * power
        power = power * k
    return total + log_term * ln(k)


def saturation_pressure(t: Column) -> Column:
    """NULL at and below absolute zero."""
    k = t + F.lit(KELVIN)
    over_water, over_ice = _ln_saturation(k, F.log, OVER_WATER), _ln_saturation(k, F.log, OVER_ICE)
    return F.exp(F.when(t >= 0, over_water).when(t > -KELVIN, over_ice))


def _at_least_min(w: Column) -> Column:
    return F.greatest(F.lit(W_MIN), w)


def w_from_pressure(pv: Column) -> Column:
    """Humidity ratio of a vapour pressure in Pa."""
    return _at_least_min(F.try_divide(MASS_RATIO * pv, PRESSURE - pv))


def w_from_rh(t: Column, fraction: Column) -> Column:
    return w_from_pressure(saturation_pressure(t) * fraction)


def w_saturated(t: Column) -> Column:
    return w_from_pressure(saturation_pressure(t))


def w_from_wet_bulb(t: Column, wb: Column) -> Column:
    gain = (HEAT_OF_VAPOUR - WET_BULB_SLOPE * wb) * w_saturated(wb) - CP_AIR * (t - wb)
    return _at_least_min(F.try_divide(gain, HEAT_OF_VAPOUR + CP_VAPOUR * t - CP_WATER * wb))


def w_from_dew_point(dp: Column) -> Column:
    return w_saturated(dp)


def w_from_volume(t: Column, v: Column) -> Column:
    return _at_least_min((F.try_divide(v * PRESSURE, GAS_CONSTANT * (t + KELVIN)) - 1.0) / VAPOUR_FACTOR)


def saturation_degree(w: Column, w_sat: Column) -> Column:
    return w / w_sat


def relative_humidity(w: Column, w_sat: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), w / w_sat))


def enthalpy(t: Column, w: Column) -> Column:
    return CP_AIR * t + w * (HEAT_OF_VAPOUR + CP_VAPOUR * t)


def specific_volume(t: Column, w: Column) -> Column:
    return GAS_CONSTANT * (t + KELVIN) * (1.0 + VAPOUR_FACTOR * w) / PRESSURE


def vapour_pressure(w: Column) -> Column:
    return w * PRESSURE / (MASS_RATIO + w) / 1000.0


def dry_bulb_from(h: Column, w: Column) -> Column:
    return (h - HEAT_OF_VAPOUR * w) / (CP_AIR + CP_VAPOUR * w)


def w_from_enthalpy(t: Column, h: Column) -> Column:
    """Humidity ratio on a line of constant enthalpy, without the lower bound."""
    return (h - CP_AIR * t) / (HEAT_OF_VAPOUR + CP_VAPOUR * t)


def _np_w_saturated(t: np.ndarray) -> np.ndarray:
    k = t + KELVIN
    p = np.exp(
        np.where(t >= 0, _ln_saturation(k, np.log, OVER_WATER), _ln_saturation(k, np.log, OVER_ICE))
    )
    return np.maximum(W_MIN, MASS_RATIO * p / (PRESSURE - p))


def _np_w_wet_bulb(t: np.ndarray, wb: np.ndarray) -> np.ndarray:
    gain = (HEAT_OF_VAPOUR - WET_BULB_SLOPE * wb) * _np_w_saturated(wb) - CP_AIR * (t - wb)
    return np.maximum(W_MIN, gain / (HEAT_OF_VAPOUR + CP_VAPOUR * t - CP_WATER * wb))


def _bisect(lo: np.ndarray, hi: np.ndarray, too_high) -> np.ndarray:
    for _ in range(BISECTIONS):
        mid = (lo + hi) / 2.0
        above = too_high(mid)
        lo, hi = np.where(above, lo, mid), np.where(above, mid, hi)
    return (lo + hi) / 2.0


@F.pandas_udf(T.DoubleType())
def wet_bulb(dbt: pd.Series, w: pd.Series) -> pd.Series:
    t, ratio = dbt.to_numpy("float64"), w.to_numpy("float64")
    root = _bisect(np.maximum(-50.0, t - 60.0), t, lambda mid: _np_w_wet_bulb(t, mid) > ratio)
    return pd.Series(np.where(np.isnan(t) | np.isnan(ratio), np.nan, root))


@F.pandas_udf(T.DoubleType())
def dew_point(w: pd.Series) -> pd.Series:
    ratio = w.to_numpy("float64")
    start = np.full_like(ratio, -60.0)
    root = _bisect(start, start + 150.0, lambda mid: _np_w_saturated(mid) >= ratio)
    return pd.Series(np.where(np.isnan(ratio), np.nan, root))
