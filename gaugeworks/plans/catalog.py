"""Registered queries over the provided tables.

Each entry maps a name to ``(build(spark, sf_dir) -> DataFrame, sql)``,
where ``sql`` is the DuckDB oracle (``None`` for operators without a
plain-SQL form, which are checked against brute force in the tests).
Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.control import ELAPSED_COLUMNS, HYDROPONIC_RULES, control_actions, elapsed_since_action
from ..operators.documents import discover_fields, expand_fields, field_inventory, unknown_sensor_points, with_document
from ..operators.parse import clean_readings, nan_to_null, parse_readings
from ..operators.points import line_protocol, newest_points, points_long, raw_points, window_points
from ..operators.readings import latest_readings, with_plant_activity, with_schedule, with_status_line
from ..operators.states import combined_from, corrected_states, merge_states, window_states
from ..operators.windows import ANALYSES, flatten_window, measurement_name
from ..session import ensure_utc
from ..sources.envelope import to_envelope
from ..sources.tables import events_as_hydroponic, events_wide, events_with_gaps, lineitem_dense, table
from ..spec import EVENT_TYPES, EVENTS, HYDROPONIC, LINEITEM
from . import sql as S

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

WINDOWS = {"5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour"}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def round_half_up_sql(c: str, digits: int = S.DIGITS) -> str:
    """``floor(x * 10^d + 0.5) / 10^d`` for |x| < 1e12 (NaN, +/-Inf and
    larger values pass through).  Plain IEEE operations, so Spark and the
    SQL oracle produce bit-identical doubles from identical inputs."""
    scale = f"{float(10**digits)!r}D"
    return (
        f"CASE WHEN abs({c}) < {S.ROUND_LIMIT!r}D "
        f"THEN CAST(floor({c} * {scale} + 0.5D) AS DOUBLE) / {scale} ELSE {c} END"
    )


def rounded(df: DataFrame, digits: int = S.DIGITS) -> DataFrame:
    """Round every double column (presentation for the oracle compare);
    one projection built from SQL text, so plan building costs a single
    round trip to the JVM."""
    return df.selectExpr(
        *[
            f"{round_half_up_sql(_q(f.name), digits)} AS {_q(f.name)}"
            if isinstance(f.dataType, T.DoubleType)
            else _q(f.name)
            for f in df.schema.fields
        ]
    )


def ntz(df: DataFrame) -> DataFrame:
    """Present timestamps as TIMESTAMP_NTZ (UTC wall clock), like the oracle."""
    return df.selectExpr(
        *[
            f"CAST({_q(f.name)} AS TIMESTAMP_NTZ) AS {_q(f.name)}"
            if isinstance(f.dataType, T.TimestampType)
            else _q(f.name)
            for f in df.schema.fields
        ]
    )


def present(df: DataFrame, digits: int = S.DIGITS) -> DataFrame:
    """``rounded`` + ``ntz`` in one projection."""
    exprs = []
    for f in df.schema.fields:
        c = _q(f.name)
        if isinstance(f.dataType, T.DoubleType):
            exprs.append(f"{round_half_up_sql(c, digits)} AS {c}")
        elif isinstance(f.dataType, T.TimestampType):
            exprs.append(f"CAST({c} AS TIMESTAMP_NTZ) AS {c}")
        else:
            exprs.append(c)
    return df.selectExpr(*exprs)


def _events_wide(spark, sf_dir):
    ensure_utc(spark)
    return events_wide(table(spark, sf_dir, "events"))


def _events_hydro(spark, sf_dir):
    ensure_utc(spark)
    return events_as_hydroponic(table(spark, sf_dir, "events"))


def _lineitem_dense(spark, sf_dir):
    ensure_utc(spark)
    return lineitem_dense(table(spark, sf_dir, "lineitem"))


def _analysis(kind: str, source, spec, window: str, by=None, **options):
    op = ANALYSES[kind]

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = op(source(spark, sf_dir), spec, window, by=by or (), **options)
        return present(flatten_window(out))

    return build


# --- A10-A12 x {5 min, 15 min, 1 h} over sparse wide events -------------
for _kind in ("basic", "anomaly", "health"):
    for _tag, _win in WINDOWS.items():
        register(
            f"{_kind}_{_tag}",
            S.ANALYSIS_SQL[_kind](S.events_wide_sql(), EVENTS, _win),
        )(_analysis(_kind, _events_wide, EVENTS, _win))

# grouping by system (D19)
register("basic_by_system_1h", S.basic_sql(S.events_wide_sql(), EVENTS, "1 hour", by="system_id"))(
    _analysis("basic", _events_wide, EVENTS, "1 hour", by=["system_id"])
)
register("health_by_system_1h", S.health_sql(S.events_wide_sql(), EVENTS, "1 hour", by="system_id"))(
    _analysis("health", _events_wide, EVENTS, "1 hour", by=["system_id"])
)
register("anomaly_by_system_1h", S.anomaly_sql(S.events_wide_sql(), EVENTS, "1 hour", by="system_id"))(
    _analysis("anomaly", _events_wide, EVENTS, "1 hour", by=["system_id"])
)
# dense four-sensor readings per day
register("basic_dense_1d", S.basic_sql(S.lineitem_dense_sql(), LINEITEM, "1 day"))(
    _analysis("basic", _lineitem_dense, LINEITEM, "1 day")
)
# ... and per return flag: three keys each holding about a third of all rows
register("basic_dense_by_flag_1d", S.basic_sql(S.lineitem_dense_sql(), LINEITEM, "1 day", by="system_id"))(
    _analysis("basic", _lineitem_dense, LINEITEM, "1 day", by=["system_id"])
)


# NULL and NaN values and NULL times: statistics skip them once NaN is NULL,
# an uncleaned NaN is an anomaly, a reading without a time is in no window
def _events_gaps(spark, sf_dir):
    ensure_utc(spark)
    return events_with_gaps(table(spark, sf_dir, "events"))


def _events_gaps_cleaned(spark, sf_dir):
    return nan_to_null(_events_gaps(spark, sf_dir), EVENTS)


register("null_rules_5m", S.basic_sql(S.events_gaps_sql("NULL"), EVENTS, "5 minutes"))(
    _analysis("basic", _events_gaps_cleaned, EVENTS, "5 minutes")
)
register("null_rules_health_5m", S.health_sql(S.events_gaps_sql("NULL"), EVENTS, "5 minutes"))(
    _analysis("health", _events_gaps_cleaned, EVENTS, "5 minutes")
)
register("health_skip_missing_5m", S.health_sql(S.events_gaps_sql("NULL"), EVENTS, "5 minutes", missing="skip"))(
    _analysis("health", _events_gaps_cleaned, EVENTS, "5 minutes", missing="skip")
)
register("null_rules_anomaly_5m", S.anomaly_sql(S.events_gaps_sql(), EVENTS, "5 minutes"))(
    _analysis("anomaly", _events_gaps, EVENTS, "5 minutes")
)


# the hydroponic ranges over dense derived readings
def _hydro_with_activity(spark, sf_dir):
    return with_plant_activity(_events_hydro(spark, sf_dir))


def _hydro_cte() -> str:
    return f"SELECT *, {S.ACTIVITY_SQL} AS plant_activity FROM (\n  {S.events_hydro_sql()}\n  ) h"


for _kind in ("basic", "anomaly", "health"):
    register(f"{_kind}_hydro_15m", S.ANALYSIS_SQL[_kind](_hydro_cte(), HYDROPONIC, "15 minutes"))(
        _analysis(_kind, _hydro_with_activity, HYDROPONIC, "15 minutes")
    )


# --- T8: one mergeable state for all analyses and lengths ------------------
def _combined(states: DataFrame, spec, window: str) -> DataFrame:
    return present(flatten_window(combined_from(states, spec, window)))


@register("combined_5m", S.combined_sql(S.events_wide_sql(), EVENTS, "5 minutes"))
def q_combined_5m(spark, sf_dir):
    return _combined(window_states(_events_wide(spark, sf_dir), EVENTS, "5 minutes"), EVENTS, "5 minutes")


def _rollup(window: str, by=()):
    """5-minute states, merged into longer windows (and without systems)."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        states = window_states(_events_wide(spark, sf_dir), EVENTS, "5 minutes", by=by)
        return _combined(merge_states(states, EVENTS, window), EVENTS, window)

    return build


register("rollup_15m", S.combined_sql(S.events_wide_sql(), EVENTS, "15 minutes"))(_rollup("15 minutes"))
register("rollup_1h", S.combined_sql(S.events_wide_sql(), EVENTS, "1 hour"))(_rollup("1 hour"))
register("rollup_systems_1h", S.combined_sql(S.events_wide_sql(), EVENTS, "1 hour"))(_rollup("1 hour", by=["system_id"]))


@register("rollup_null_rules_1h", S.combined_sql(S.events_gaps_sql("NULL"), EVENTS, "1 hour", missing="skip"))
def q_rollup_null_rules_1h(spark, sf_dir):
    states = window_states(_events_gaps_cleaned(spark, sf_dir), EVENTS, "5 minutes", missing="skip")
    return _combined(merge_states(merge_states(states, EVENTS, "15 minutes"), EVENTS, "1 hour"), EVENTS, "1 hour")


# --- T5: windows corrected by rows that came late --------------------------
#: Every 17th event counts as late in this query.
LATE = 17


@register(
    "late_corrections_5m",
    "SELECT * FROM (\n" + S.combined_sql(S.events_wide_sql(), EVENTS, "5 minutes") + "\n) c\n"
    f"WHERE window_start IN (SELECT time_bucket(INTERVAL '5 minutes', ts) FROM events WHERE event_id % {LATE} = 0)",
)
def q_late_corrections_5m(spark, sf_dir):
    ensure_utc(spark)
    events = table(spark, sf_dir, "events")
    late = F.col("event_id") % LATE == 0
    on_time, behind = (window_states(events_wide(events.where(c)), EVENTS, "5 minutes") for c in (~late, late))
    return _combined(corrected_states(on_time, behind, EVENTS), EVENTS, "5 minutes")


# --- F1-F3 / P1-P4: envelope round trip --------------------------------
def _events_envelope(spark, sf_dir):
    wide = _events_wide(spark, sf_dir)
    return to_envelope(wide, EVENTS, key_col="system_id", time_col="event_time")


@register(
    "parse_readings",
    "WITH w AS (\n  " + S.events_wide_sql().replace("SELECT ", "SELECT ts, ", 1) + "\n)\n"
    "SELECT ts AS kafka_timestamp, CAST(system_id AS VARCHAR) AS kafka_key,\n"
    "  epoch_us(event_time) // 1000 AS sensor_timestamp,\n  "
    + ", ".join(f"{S.r(t)} AS {t}" for t in EVENT_TYPES)
    + f", {S.r('plant_activity')} AS plant_activity,\n"
    "  epoch_ms(epoch_us(event_time) // 1000) AS event_time\nFROM w",
)
def q_parse_readings(spark, sf_dir):
    parsed = parse_readings(_events_envelope(spark, sf_dir), EVENTS)
    return present(parsed)


@register(
    "props_parse",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_props_parse(spark, sf_dir):
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


# --- F1 / P4: documents whose fields no spec names ----------------------
_DOCS_SQL = (
    "SELECT event_id, json_object('timestamp', epoch_us(ts) // 1000, 'sensors', json_object(event_type, value),\n"
    "  'props', CAST(props AS JSON)) AS doc FROM events"
)


def _event_documents(spark, sf_dir) -> DataFrame:
    """Events as JSON text: one sensor named by the event type, and the props."""
    ensure_utc(spark)
    doc = F.struct(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.create_map("event_type", "value").alias("sensors"),
        F.parse_json("props").alias("props"),
    )
    return with_document(table(spark, sf_dir, "events").select("event_id", F.to_json(doc).alias("value")))


@register(
    "variant_fields",
    "WITH d AS (" + _DOCS_SQL + ")\n"
    "SELECT t.fullkey AS path, CASE WHEN t.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'number' WHEN t.type = 'VARCHAR' THEN 'text'\n"
    "    ELSE lower(t.type) END AS kind, count(*) AS n_values,\n"
    "  min(CAST(t.atom AS DOUBLE)) AS min_value, max(CAST(t.atom AS DOUBLE)) AS max_value\n"
    "FROM d, json_tree(d.doc) t WHERE t.atom IS NOT NULL GROUP BY 1, 2",
)
def q_variant_fields(spark, sf_dir):
    return field_inventory(_event_documents(spark, sf_dir))


@register(
    "variant_wide",
    "WITH d AS (" + _DOCS_SQL + ")\n"
    "SELECT event_id, CAST(doc ->> '$.props.k' AS DOUBLE) AS props_k, CAST(doc ->> '$.timestamp' AS DOUBLE) AS timestamp, "
    + ", ".join(f"CAST(doc ->> '$.sensors.{t}' AS DOUBLE) AS sensors_{t}" for t in EVENT_TYPES)
    + " FROM d",
)
def q_variant_wide(spark, sf_dir):
    docs = _event_documents(spark, sf_dir)
    return expand_fields(docs, discover_fields(field_inventory(docs)), keep=["event_id"])


@register(
    "unknown_sensor_points",
    "SELECT 'raw_sensor_data' AS measurement, CAST(user_id AS VARCHAR) AS system_id,\n"
    "  epoch_ms(epoch_us(ts) // 1000) AS time, event_type AS field, value\n"
    f"FROM events WHERE value IS NOT NULL AND event_type NOT IN ({', '.join(repr(t) for t in EVENT_TYPES[:2])})",
)
def q_unknown_sensor_points(spark, sf_dir):
    known = EVENTS.with_(sensors=EVENTS.sensors[:2])
    return ntz(unknown_sensor_points(_events_envelope(spark, sf_dir), known))


# --- S5 / S6 / S7: points ----------------------------------------------
_RAW_FIELDS = list(EVENT_TYPES) + ["plant_activity"]


@register(
    "raw_points_long",
    "WITH w AS (\n  " + S.events_wide_sql() + "\n)\n"
    "SELECT 'raw_sensor_data' AS measurement, CAST(system_id AS VARCHAR) AS system_id,\n"
    "  event_time AS time, field, " + S.r("value") + " AS value\n"
    "FROM (UNPIVOT w ON " + ", ".join(_RAW_FIELDS) + " INTO NAME field VALUE value)\n"
    "WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)",
)
def q_raw_points_long(spark, sf_dir):
    pts = raw_points(_events_wide(spark, sf_dir), EVENTS)
    return present(points_long(pts))


@register(
    "raw_points_nulls",
    "WITH w AS (\n  " + S.events_gaps_sql() + "\n)\n"
    "SELECT 'raw_sensor_data' AS measurement, CAST(system_id AS VARCHAR) AS system_id,\n"
    "  coalesce(event_time, epoch_ms(sensor_timestamp)) AS time, field, " + S.r("value") + " AS value\n"
    "FROM (UNPIVOT w ON " + ", ".join(_RAW_FIELDS) + " INTO NAME field VALUE value)\n"
    "WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)",
)
def q_raw_points_nulls(spark, sf_dir):
    return present(points_long(raw_points(_events_gaps(spark, sf_dir), EVENTS)))


#: Events from this day on are written again by the second run of the query below.
SECOND_RUN = "2024-01-15"


def _two_runs_sql() -> str:
    first = S.events_gaps_sql().replace("SELECT ", "SELECT 1 AS run, event_id, ts, ", 1)
    changed = ", ".join(f"CASE WHEN event_id % 3 <> 0 THEN {c} * 2.0 END AS {c}" for c in _RAW_FIELDS)
    keys = "'raw_sensor_data' AS measurement, CAST(system_id AS VARCHAR) AS system_id, coalesce(event_time, epoch_ms(sensor_timestamp)) AS time"
    kept = " OR ".join(f"({c} IS NOT NULL AND NOT isnan({c}))" for c in _RAW_FIELDS)
    newest = ", ".join(f"{S.r(f'arg_max({c}, row(run, event_id)) FILTER ({c} IS NOT NULL AND NOT isnan({c}))')} AS {c}" for c in _RAW_FIELDS)
    return (
        f"WITH a AS (\n  {first}\n), b AS (SELECT 2 AS run, event_id, ts, system_id, event_time, sensor_timestamp, {changed}\n"
        f"  FROM a WHERE ts >= TIMESTAMP '{SECOND_RUN}'),\n"
        "both_runs AS (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b)\n"
        f"SELECT {keys}, {newest}\nFROM both_runs WHERE {kept} GROUP BY ALL"
    )


@register("points_compacted", _two_runs_sql())
def q_points_compacted(spark, sf_dir):
    """Raw points of two overlapping runs, the newest field values kept."""
    ensure_utc(spark)
    events = table(spark, sf_dir, "events")
    first = events_with_gaps(events, keep=("event_id", "ts")).withColumn("run", F.lit(1))
    again = first.where(F.col("ts") >= F.lit(SECOND_RUN).cast("timestamp_ntz"))
    again = again.withColumns({c: F.when(F.col("event_id") % 3 != 0, F.col(c) * 2.0) for c in _RAW_FIELDS}).withColumn("run", F.lit(2))
    both = first.unionByName(again)
    points = raw_points(both, EVENTS, keep=("run", "event_id"))
    return present(newest_points(points, F.struct("run", "event_id")))


def _basic_fields(spec) -> list[str]:
    out = []
    for c in spec.aggregate_columns:
        out += [f"{c}_{s}" for s in ("avg", "min", "max", "stddev", "count")]
    return out


@register(
    "window_points_long",
    "WITH b AS (\n" + S.basic_sql(S.events_wide_sql(), EVENTS, "5 minutes") + "\n), d AS (\n"
    "SELECT window_end AS time, analysis_type, window_duration, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _basic_fields(EVENTS))
    + " FROM b\n)\n"
    "SELECT 'aggregations_5_minutes' AS measurement, 'system_01' AS system_id, analysis_type, window_duration,\n"
    "  time, field, value\n"
    "FROM (UNPIVOT d ON " + ", ".join(_basic_fields(EVENTS)) + " INTO NAME field VALUE value)\n"
    "WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)",
)
def q_window_points_long(spark, sf_dir):
    out = ANALYSES["basic"](_events_wide(spark, sf_dir), EVENTS, "5 minutes")
    pts = window_points(rounded(out), EVENTS, measurement_name("basic", "5 minutes"))
    return present(points_long(pts))


@register(
    "window_points_by_system_1h",
    "WITH b AS (\n" + S.basic_sql(S.events_wide_sql(), EVENTS, "1 hour", ["system_id"]) + "\n), d AS (\n"
    "SELECT CAST(system_id AS VARCHAR) AS system_id, window_end AS time, analysis_type, window_duration, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _basic_fields(EVENTS))
    + " FROM b\n)\n"
    "SELECT 'aggregations_1_hour' AS measurement, system_id, analysis_type, window_duration,\n"
    "  time, field, value\n"
    "FROM (UNPIVOT d ON " + ", ".join(_basic_fields(EVENTS)) + " INTO NAME field VALUE value)\n"
    "WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)",
)
def q_window_points_by_system_1h(spark, sf_dir):
    out = ANALYSES["basic"](_events_wide(spark, sf_dir), EVENTS, "1 hour", by=["system_id"])
    pts = window_points(rounded(out), EVENTS, measurement_name("basic", "1 hour"))
    return present(points_long(pts))


def _line_sql() -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN '{c}=' || printf('%.6f', {c}) END" for c in _RAW_FIELDS
    )
    return (
        "WITH w AS (\n  " + S.events_wide_sql() + "\n)\n"
        "SELECT 'raw_sensor_data,system_id=' || CAST(system_id AS VARCHAR) || ' ' ||\n"
        f"  concat_ws(',', {parts}) || ' ' || CAST(epoch_us(event_time) * 1000 AS VARCHAR) AS line\n"
        "FROM w"
    )


@register("line_protocol", _line_sql())
def q_line_protocol(spark, sf_dir):
    pts = raw_points(_events_wide(spark, sf_dir), EVENTS)
    return line_protocol(pts, precision=6)


# --- R1-R5, R8 ---------------------------------------------------------
def _hydro_sql_from(select: str) -> str:
    return f"WITH h AS (\n  {S.events_hydro_sql()}\n)\nSELECT {select}\nFROM h"


@register(
    "clean_readings",
    _hydro_sql_from(
        "event_id, "
        + ", ".join(f"{S.bround_sql(s.name, s.digits)} AS {s.name}" for s in HYDROPONIC.sensors)
    ),
)
def q_clean_readings(spark, sf_dir):
    h = _events_hydro(spark, sf_dir).select("event_id", *HYDROPONIC.sensor_names)
    return clean_readings(h, HYDROPONIC)


@register("plant_activity", _hydro_sql_from(f"event_id, {S.r(S.ACTIVITY_SQL)} AS plant_activity"))
def q_plant_activity(spark, sf_dir):
    h = with_plant_activity(_events_hydro(spark, sf_dir))
    return rounded(h.select("event_id", "plant_activity"))


_DAILY_SQL = "(sin(2 * pi() * (hour(event_time) - 6) / 24.0) + 1.0) / 2.0"
_LIGHT_SQL = (
    "CASE WHEN hour(event_time) >= 6 AND hour(event_time) < 8 THEN 800.0 * (hour(event_time) - 6.0) / 2.0 "
    "WHEN hour(event_time) >= 8 AND hour(event_time) < 20 THEN 800.0 + 200.0 * sin(2 * pi() * (hour(event_time) - 8.0) / 12.0) "
    "WHEN hour(event_time) >= 20 AND hour(event_time) < 22 THEN 800.0 * (22.0 - hour(event_time)) / 2.0 "
    "ELSE 0.0 END"
)


@register(
    "daily_schedule",
    _hydro_sql_from(
        f"event_id, CAST(hour(event_time) AS INTEGER) AS hour, {S.r(_DAILY_SQL)} AS daily_factor, "
        f"{S.r(_LIGHT_SQL)} AS expected_light"
    ),
)
def q_daily_schedule(spark, sf_dir):
    h = with_schedule(_events_hydro(spark, sf_dir))
    return rounded(h.select("event_id", "hour", "daily_factor", "expected_light"))


def _shown_sql(c: str, unit: str = "") -> str:
    suffix = f" || '{unit}'" if unit else ""
    return f"coalesce(CAST({c} AS VARCHAR){suffix}, 'ERROR')"


@register(
    "status_line",
    "WITH h AS (\n  " + S.events_hydro_sql() + "\n), c AS (SELECT event_id, "
    + ", ".join(f"{S.bround_sql(s.name, s.digits)} AS {s.name}" for s in HYDROPONIC.sensors)
    + " FROM h), a AS (SELECT *, " + S.ACTIVITY_SQL + " AS plant_activity FROM c)\n"
    "SELECT event_id, 'Water: ' || " + _shown_sql("water_temperature", "°C")
    + " || ', pH: ' || " + _shown_sql("water_ph")
    + " || ', EC: ' || " + _shown_sql("ec_tds", " mS/cm")
    + " || ', Level: ' || " + _shown_sql("water_level_percent", "%")
    + " || ', Activity: ' || coalesce(" + S.fixed2_sql("plant_activity") + ", 'ERROR') AS status\nFROM a",
)
def q_status_line(spark, sf_dir):
    h = clean_readings(_events_hydro(spark, sf_dir), HYDROPONIC)
    h = with_status_line(with_plant_activity(h))
    return h.select("event_id", "status")


@register(
    "latest_readings",
    "SELECT user_id AS system_id, "
    + ", ".join(
        f"arg_max(value, row(ts, event_id)) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES
    )
    + ", max(ts) AS last_seen\nFROM events GROUP BY user_id",
)
def q_latest_readings(spark, sf_dir):
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    w = ev.select(
        F.col("user_id").alias("system_id"),
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        *[F.when(F.col("event_type") == F.lit(t), F.col("value")).alias(t) for t in EVENT_TYPES],
    )
    return latest_readings(w, EVENTS, tiebreak="event_id")


# --- R6 / R7: control actions and elapsed seconds -------------------------
@register("control_actions", S.control_actions_sql(HYDROPONIC_RULES, S.events_hydro_sql()))
def q_control_actions(spark, sf_dir):
    acts = control_actions(_events_hydro(spark, sf_dir), HYDROPONIC, HYDROPONIC_RULES, tiebreak="event_id")
    return present(acts)


@register("elapsed_since_action", S.elapsed_sql(HYDROPONIC_RULES, S.events_hydro_sql(), ELAPSED_COLUMNS))
def q_elapsed_since_action(spark, sf_dir):
    h = _events_hydro(spark, sf_dir)
    out = elapsed_since_action(h, HYDROPONIC, HYDROPONIC_RULES, tiebreak="event_id")
    return present(out.select("system_id", "event_id", "event_time", *ELAPSED_COLUMNS.values()))
