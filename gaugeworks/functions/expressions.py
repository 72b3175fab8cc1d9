"""Column expressions shared by the operators.

All functions return ``pyspark.sql.Column`` objects built from built-in
functions only, so they stay inside whole-stage codegen and Catalyst can
fold the constants from the spec.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import SensorSpec



def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN becomes NULL; everything else is unchanged (cast to double)."""
    c = col_of(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c) -> Column:
    """Value as double when it is a finite number, else NULL.

    Non-numeric strings are rejected through ``try_cast``; NaN and
    +/-Infinity give NULL, so they are dropped from points.
    """
    d = col_of(c).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(math.inf)), d)


def range_flag(c, sensor: SensorSpec) -> Column:
    """1 when the reading lies outside the inclusive range, else 0.

    A missing reading is not an anomaly (NULL -> 0); NaN sorts above every
    number, so it counts as out of range.
    """
    c = col_of(c)
    return F.when((c < F.lit(sensor.lo)) | (c > F.lit(sensor.hi)), 1).otherwise(0)


def health_score(c, sensor: SensorSpec) -> Column:
    """Linear score: 1 at the range centre, 0 at and beyond either edge.

    ``greatest`` skips NULL, so a missing reading scores 0.0 (not NULL).
    """
    c = col_of(c)
    return F.greatest(
        F.lit(0.0),
        F.lit(1.0) - F.abs(c - F.lit(sensor.centre)) / F.lit(sensor.half_width),
    )


def mean_of(cols) -> Column:
    """Unweighted mean of a list of columns (sum / number of columns)."""
    cols = [col_of(c) for c in cols]
    if not cols:
        raise ValueError("mean_of needs at least one column")
    return reduce(add, cols) / F.lit(float(len(cols)))


def mean_of_present(cols) -> Column:
    """Mean of those columns of a list that are not NULL; NULL if none is."""
    cols = [col_of(c) for c in cols]
    if not cols:
        raise ValueError("mean_of_present needs at least one column")
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cols])
    count = reduce(add, [c.isNotNull().cast("int") for c in cols])
    return F.when(count > 0, total / count)


# --- fixed values: plant-activity model (optimal light 800, optimal
# --- temperature 22 with span 10 and floor 0.1, optimal pH 6.0 with span
# --- 1.5 and floor 0.3).
ACTIVITY_LIGHT_FULL = 800.0
ACTIVITY_TEMP_OPT, ACTIVITY_TEMP_SPAN, ACTIVITY_TEMP_FLOOR = 22.0, 10.0, 0.1
ACTIVITY_PH_OPT, ACTIVITY_PH_SPAN, ACTIVITY_PH_FLOOR = 6.0, 1.5, 0.3


def plant_activity(light, temperature, ph) -> Column:
    """Activity in [0, 1] from light, water temperature and pH.

    Missing or NaN temperature / pH fall back to the factor's floor; a
    missing light reading gives NULL (``least`` would otherwise yield 1).
    """
    light, temperature, ph = col_of(light), col_of(temperature), col_of(ph)
    light_f = F.least(F.lit(1.0), light / F.lit(ACTIVITY_LIGHT_FULL))
    temp_f = F.greatest(
        F.lit(ACTIVITY_TEMP_FLOOR),
        F.lit(1.0) - F.abs(nan_to_null(temperature) - F.lit(ACTIVITY_TEMP_OPT)) / F.lit(ACTIVITY_TEMP_SPAN),
    )
    ph_f = F.greatest(
        F.lit(ACTIVITY_PH_FLOOR),
        F.lit(1.0) - F.abs(nan_to_null(ph) - F.lit(ACTIVITY_PH_OPT)) / F.lit(ACTIVITY_PH_SPAN),
    )
    return F.when(light.isNotNull(), light_f * temp_f * ph_f)


def daily_factor(hour) -> Column:
    """Daily cycle in [0, 1]: 0 at midnight, 1 at noon, from the integer hour."""
    h = col_of(hour).cast("double")
    return (F.sin(F.lit(2 * math.pi) * (h - F.lit(6.0)) / F.lit(24.0)) + F.lit(1.0)) / F.lit(2.0)


# --- fixed values: light schedule (ramp up 6-8 h to 800, day 8-20 h as
# --- 800 + 200 sin(2 pi (h-8)/12), ramp down 20-22 h, dark otherwise).
def expected_light(hour) -> Column:
    """Scheduled light intensity for an integer hour of day."""
    h = col_of(hour).cast("double")
    return (
        F.when((h >= 6) & (h < 8), F.lit(800.0) * (h - F.lit(6.0)) / F.lit(2.0))
        .when((h >= 8) & (h < 20), F.lit(800.0) + F.lit(200.0) * F.sin(F.lit(2 * math.pi) * (h - F.lit(8.0)) / F.lit(12.0)))
        .when((h >= 20) & (h < 22), F.lit(800.0) * (F.lit(22.0) - h) / F.lit(2.0))
        .otherwise(F.lit(0.0))
    )


def clean_reading(c, sensor: SensorSpec) -> Column:
    """NaN -> NULL, then round half-even to the sensor's report precision."""
    return F.bround(nan_to_null(c), sensor.digits)


# --- fixed values: status line text: labels, units and the missing-value
# --- marker, in display order.
STATUS_MISSING = "ERROR"
STATUS_PARTS = (("Water: ", "°C"), (", pH: ", ""), (", EC: ", " mS/cm"), (", Level: ", "%"), (", Activity: ", ""))


def shown(c, unit: str = "") -> Column:
    """Value as text with a unit, or the missing-value marker."""
    c = col_of(c)
    return F.coalesce(F.concat(c.cast("string"), F.lit(unit)), F.lit(STATUS_MISSING))


def status_line(water_temperature, ph, ec, level, activity) -> Column:
    """One-line console summary of a reading (activity with two decimals)."""
    values = [water_temperature, ph, ec, level]
    parts = []
    for (label, unit), v in zip(STATUS_PARTS[:4], values):
        parts += [F.lit(label), shown(v, unit)]
    act = F.coalesce(F.format_string("%.2f", col_of(activity)), F.lit(STATUS_MISSING))
    return F.concat(*parts, F.lit(STATUS_PARTS[4][0]), act)


def epoch_nanos(ts) -> Column:
    """Timestamp as integer epoch nanoseconds (exact, computed in Spark)."""
    return F.unix_micros(col_of(ts).cast("timestamp")) * F.lit(1000)
