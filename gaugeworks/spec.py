"""Declarative sensor and pipeline specifications.

Every operator in the package is driven by a ``PipelineSpec``: the list of
ranged sensors, the extra system-state fields carried in each reading, the
activity column, window lengths and the watermark.  Operators expand the
spec into plain Spark column expressions, so the range table is never a
join and Catalyst constant-folds the bounds.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SensorSpec:
    """One ranged sensor: inclusive optimal range ``[lo, hi]`` and the
    number of decimals readings are reported with."""

    name: str
    lo: float
    hi: float
    digits: int = 1

    def __post_init__(self):
        if not self.lo < self.hi:
            raise ValueError(f"sensor {self.name!r}: lo ({self.lo}) must be < hi ({self.hi})")

    @property
    def centre(self) -> float:
        return (self.lo + self.hi) / 2

    @property
    def half_width(self) -> float:
        return (self.hi - self.lo) / 2


@dataclass(frozen=True)
class PipelineSpec:
    """Sensors, state fields and streaming parameters of one pipeline.

    ``state_fields`` are ``(name, spark_sql_type)`` pairs of the
    ``system_state`` block.  ``activity`` names the column aggregated next
    to the sensors (``None`` when a source has none).
    """

    sensors: tuple[SensorSpec, ...]
    state_fields: tuple[tuple[str, str], ...] = ()
    activity: str | None = None
    windows: tuple[str, ...] = ("5 minutes",)
    watermark: str = "30 seconds"
    time_col: str = "event_time"
    system_col: str = "system_id"
    default_system: str = "system_01"

    def __post_init__(self):
        names = [s.name for s in self.sensors]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate sensor names: {names}")

    @property
    def sensor_names(self) -> list[str]:
        return [s.name for s in self.sensors]

    @property
    def aggregate_columns(self) -> list[str]:
        """Columns summarised by the basic aggregation: sensors + activity."""
        cols = self.sensor_names
        if self.activity:
            cols = cols + [self.activity]
        return cols

    def sensor(self, name: str) -> SensorSpec:
        for s in self.sensors:
            if s.name == name:
                return s
        raise KeyError(name)

    def present(self, columns) -> list[SensorSpec]:
        """Sensors of the spec that exist as columns of a DataFrame."""
        cols = set(columns)
        return [s for s in self.sensors if s.name in cols]

    def with_(self, **kw) -> "PipelineSpec":
        return replace(self, **kw)


# --- fixed values: sensor ranges and report precision of the hydroponic
# --- domain (name, lo, hi, decimals), in the order readings carry them.
HYDROPONIC_SENSORS = (
    SensorSpec("water_temperature", 18.0, 25.0, 1),
    SensorSpec("water_ph", 5.5, 6.5, 2),
    SensorSpec("ec_tds", 1.2, 2.0, 2),
    SensorSpec("water_level_percent", 25.0, 95.0, 1),
    SensorSpec("air_temperature", 20.0, 28.0, 1),
    SensorSpec("humidity", 50.0, 70.0, 1),
    SensorSpec("light_intensity_ppfd", 0.0, 1200.0, 1),
)

# --- fixed values: system-state block of a reading (name, type).
HYDROPONIC_STATE = (
    ("plant_activity", "double"),
    ("last_refill", "int"),
    ("last_ph_adjust", "int"),
    ("last_nutrient_dose", "int"),
)

# --- fixed values: window lengths, watermark delay and the system id used
# --- when a record carries no key.
HYDROPONIC = PipelineSpec(
    sensors=HYDROPONIC_SENSORS,
    state_fields=HYDROPONIC_STATE,
    activity="plant_activity",
    windows=("5 minutes", "15 minutes", "1 hour"),
    watermark="30 seconds",
    default_system="hydro_system_01",
)

# Spec used over the provided ``events`` table: each event type acts as one
# sensor (sparse wide rows), all with the range (5, 100); the activity
# column is derived from ``props`` by the events adapter.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENTS = PipelineSpec(
    sensors=tuple(SensorSpec(t, 5.0, 100.0, 2) for t in EVENT_TYPES),
    state_fields=(("plant_activity", "double"),),
    activity="plant_activity",
    windows=("5 minutes", "15 minutes", "1 hour"),
    watermark="30 seconds",
)

# Dense four-sensor view of ``lineitem`` keyed on the ship date.
LINEITEM_SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM = PipelineSpec(
    sensors=(
        SensorSpec("l_quantity", 1.0, 50.0, 0),
        SensorSpec("l_extendedprice", 900.0, 100000.0, 2),
        SensorSpec("l_discount", 0.0, 0.1, 2),
        SensorSpec("l_tax", 0.0, 0.08, 2),
    ),
    activity=None,
    windows=("1 day",),
)
