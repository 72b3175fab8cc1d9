"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

These strings are the correctness oracle: they are generated from the
same ``PipelineSpec`` as the Spark plans, but compute each result with
plain SQL over the provided tables (``time_bucket`` for tumbling windows,
``CASE`` for flags, ``arg_max`` for latest values, ``UNPIVOT`` for long
points).  Double outputs are rounded to ``DIGITS`` decimals on both sides
because summation order changes the last bits of averages.
"""

from __future__ import annotations

from ..functions import expressions as X
from ..spec import EVENT_TYPES, LINEITEM_SENSORS, PipelineSpec

DIGITS = 6

# --- wide-reading CTEs over the provided tables (mirror sources/tables.py)

K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def events_wide_sql() -> str:
    cols = ",\n    ".join(f"CASE WHEN event_type = '{t}' THEN value END AS {t}" for t in EVENT_TYPES)
    return (
        "SELECT user_id AS system_id, ts AS event_time,\n    "
        + cols
        + f",\n    CAST({K_SQL} AS DOUBLE) / 100.0 AS plant_activity\n  FROM events"
    )


def events_gaps_sql(nan: str = "CAST('NaN' AS DOUBLE)") -> str:
    cols = ",\n    ".join(f"CASE WHEN event_type = '{t}' THEN v END AS {t}" for t in EVENT_TYPES)
    return (
        "SELECT user_id AS system_id, CASE WHEN event_id % 13 <> 0 THEN ts END AS event_time,\n"
        "    epoch_us(ts) // 1000 AS sensor_timestamp,\n    "
        + cols
        + f",\n    CAST({K_SQL} AS DOUBLE) / 100.0 AS plant_activity\n  FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL "
        f"WHEN event_id % 7 = 0 THEN {nan} ELSE value END AS v FROM events) e"
    )


def lineitem_dense_sql() -> str:
    cols = ", ".join(f"{c} + 0.0 AS {c}" for c in LINEITEM_SENSORS)
    return f"SELECT l_returnflag AS system_id, l_shipdate AS event_time, {cols}\n  FROM lineitem"


def events_hydro_sql() -> str:
    k = f"CAST({K_SQL} AS DOUBLE)"
    return (
        "SELECT user_id AS system_id, event_id, ts AS event_time,\n"
        "    value / 10.0 + 10.0 AS water_temperature,\n"
        f"    {k} / 20.0 + 3.5 AS water_ph,\n"
        "    value / 100.0 AS ec_tds,\n"
        f"    {k} AS water_level_percent,\n"
        "    value / 20.0 + 15.0 AS air_temperature,\n"
        f"    {k} / 2.0 + 30.0 AS humidity,\n"
        "    value * 2.5 AS light_intensity_ppfd\n"
        "  FROM events"
    )


# plant activity from light, water temperature and pH (same constants as
# ``functions.expressions.plant_activity``)
ACTIVITY_SQL = (
    "CASE WHEN light_intensity_ppfd IS NOT NULL THEN "
    f"least(1.0, light_intensity_ppfd / {X.ACTIVITY_LIGHT_FULL!r}) * "
    f"greatest({X.ACTIVITY_TEMP_FLOOR!r}, 1.0 - abs(water_temperature - {X.ACTIVITY_TEMP_OPT!r}) / {X.ACTIVITY_TEMP_SPAN!r}) * "
    f"greatest({X.ACTIVITY_PH_FLOOR!r}, 1.0 - abs(water_ph - {X.ACTIVITY_PH_OPT!r}) / {X.ACTIVITY_PH_SPAN!r}) END"
)

ROUND_LIMIT = 1e12


def r(expr: str, digits: int = DIGITS) -> str:
    """Half-up rounding by plain IEEE operations (mirrors
    ``catalog.round_half_up``)."""
    scale = float(10**digits)
    return (
        f"(CASE WHEN abs({expr}) < {ROUND_LIMIT!r} "
        f"THEN floor(({expr}) * {scale!r} + 0.5) / {scale!r} ELSE ({expr}) END)"
    )


def bround_sql(expr: str, digits: int) -> str:
    """Spark ``bround``: half-even rounding of the shortest decimal text of
    the double."""
    return (
        f"(CASE WHEN isnan({expr}) THEN NULL ELSE "
        f"CAST(round_even(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE) END)"
    )


def fixed2_sql(expr: str) -> str:
    """Spark ``format_string('%.2f', x)``: half-up rounding of the decimal
    text of the double, printed with two decimals."""
    return f"CAST(CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DECIMAL(38, 2)) AS VARCHAR)"


def _bucket(window: str) -> tuple[str, str]:
    b = f"time_bucket(INTERVAL '{window}', event_time)"
    return f"{b} AS window_start", f"{b} + INTERVAL '{window}' AS window_end"


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def _window_query(cte: str, window: str, by, aggs: list[str], tail: list[str]) -> str:
    by = _by(by)
    start, end = _bucket(window)
    select = ",\n  ".join([start, end, *by, *aggs, *tail])
    group = ", ".join(str(i) for i in range(1, 3 + len(by)))
    return (
        f"WITH w AS (\n  {cte}\n)\nSELECT\n  {select}\nFROM w\n"
        f"WHERE event_time IS NOT NULL\nGROUP BY {group}"
    )


def _basic_aggs(spec: PipelineSpec) -> list[str]:
    aggs = []
    for c in spec.aggregate_columns:
        aggs += [
            f"{r(f'avg({c})')} AS {c}_avg",
            f"{r(f'min({c})')} AS {c}_min",
            f"{r(f'max({c})')} AS {c}_max",
            f"{r(f'stddev_samp({c})')} AS {c}_stddev",
            f"count({c}) AS {c}_count",
        ]
    return aggs


def basic_sql(cte: str, spec: PipelineSpec, window: str, by=None) -> str:
    tail = [f"'{window}' AS window_duration", "'basic_aggregation' AS analysis_type"]
    return _window_query(cte, window, by, _basic_aggs(spec), tail)


def _anomaly_aggs(spec: PipelineSpec) -> list[str]:
    return [
        f"CAST(sum(CASE WHEN {s.name} < {s.lo!r} OR {s.name} > {s.hi!r} THEN 1 ELSE 0 END) AS BIGINT)"
        f" AS {s.name}_range_anomaly"
        for s in spec.sensors
    ]


def anomaly_sql(cte: str, spec: PipelineSpec, window: str, by=None) -> str:
    aggs = [*_anomaly_aggs(spec), "count(*) AS total_readings"]
    return _window_query(cte, window, by, aggs, ["'anomaly_detection' AS analysis_type"])


def health_score_sql(s) -> str:
    return f"greatest(0.0, 1.0 - abs({s.name} - {s.centre!r}) / {s.half_width!r})"


def _health_aggs(spec: PipelineSpec, missing: str) -> list[str]:
    scores = [health_score_sql(s) for s in spec.sensors]
    if missing == "skip":
        scores = [f"CASE WHEN {s.name} IS NOT NULL THEN {e} END" for s, e in zip(spec.sensors, scores)]
    aggs = [f"{r(f'avg({e})')} AS avg_{s.name}_health_score" for s, e in zip(spec.sensors, scores)]
    overall = "(" + " + ".join(scores) + f") / {float(len(scores))!r}"
    if missing == "skip":
        count = " + ".join(f"CAST({s.name} IS NOT NULL AS INTEGER)" for s in spec.sensors)
        overall = "(" + " + ".join(f"coalesce({e}, 0.0)" for e in scores) + f") / nullif({count}, 0)"
    aggs.append(f"{r(f'avg({overall})')} AS avg_system_health")
    aggs.append(f"{r(f'avg({spec.activity})')} AS avg_{spec.activity}")
    return aggs


def health_sql(cte: str, spec: PipelineSpec, window: str, by=None, missing: str = "zero") -> str:
    aggs = [*_health_aggs(spec, missing), "count(*) AS total_readings"]
    tail = [f"'{window}' AS window_duration", "'system_health' AS analysis_type"]
    return _window_query(cte, window, by, aggs, tail)


def combined_sql(cte: str, spec: PipelineSpec, window: str, by=None, missing: str = "zero") -> str:
    """All three analyses in one row, straight from the readings."""
    aggs = [*_basic_aggs(spec), *_anomaly_aggs(spec), *_health_aggs(spec, missing), "count(*) AS total_readings"]
    return _window_query(cte, window, by, aggs, [f"'{window}' AS window_duration"])


ANALYSIS_SQL = {"basic": basic_sql, "anomaly": anomaly_sql, "health": health_sql}


# --- control actions: greedy cooldown chains as a recursive query --------
def _rule_sql(r) -> tuple[str, str]:
    conds = []
    if r.below is not None:
        conds.append(f"{r.sensor} < {r.below!r}")
    if r.above is not None:
        conds.append(f"{r.sensor} > {r.above!r}")
    cond = "(" + " OR ".join(conds) + f") AND NOT isnan({r.sensor})"
    if r.below is not None:
        act = f"CASE WHEN {r.sensor} < {r.below!r} THEN '{r.low_action or r.name}' ELSE '{r.high_action or r.name}' END"
    else:
        act = f"'{r.high_action or r.name}'"
    return cond, act


def control_chain_sql(rules, readings_cte: str) -> str:
    """CTEs ``r`` (readings in epoch micros), ``o`` (clock starts), ``e``
    (broken thresholds) and ``chain`` (each rule's actions, recursively:
    the next action is the first broken threshold more than a cooldown
    after the previous one)."""
    sensors = sorted({r.sensor for r in rules})
    elig = []
    for rule in rules:
        cond, act = _rule_sql(rule)
        elig.append(
            f"SELECT system_id, event_id AS tb, t, '{rule.name}' AS rule, {act} AS action, "
            f"{rule.sensor} AS value FROM r WHERE {cond}"
        )
    starts = "\n  UNION ALL ".join(
        f"SELECT system_id, '{rule.name}' AS rule, {int(round(rule.cooldown * 1e6))} AS cd, origin AS t, -1 AS tb FROM o"
        for rule in rules
    )
    return (
        "WITH RECURSIVE h AS (\n  " + readings_cte + "\n),\n"
        "r AS (SELECT system_id, event_id, event_time, epoch_us(event_time) AS t, " + ", ".join(sensors)
        + " FROM h WHERE event_time IS NOT NULL),\n"
        "o AS (SELECT system_id, min(t) AS origin FROM r GROUP BY system_id),\n"
        "e AS (\n  " + "\n  UNION ALL ".join(elig) + "\n),\n"
        "chain(system_id, rule, cd, t, tb) AS (\n  " + starts + "\n  UNION ALL\n"
        "  SELECT c.system_id, c.rule, c.cd, n.t, n.tb FROM chain c, LATERAL (\n"
        "    SELECT e.t, e.tb FROM e WHERE e.system_id = c.system_id AND e.rule = c.rule AND e.t > c.t + c.cd\n"
        "    ORDER BY e.t, e.tb LIMIT 1) n\n)"
    )


def control_actions_sql(rules, readings_cte: str) -> str:
    return (
        control_chain_sql(rules, readings_cte)
        + "\nSELECT c.system_id, c.rule, e.action, make_timestamp(c.t) AS event_time, "
        + r("e.value")
        + " AS value, c.tb\n"
        "FROM chain c JOIN e ON c.system_id = e.system_id AND c.rule = e.rule AND c.t = e.t AND c.tb = e.tb"
    )


def elapsed_sql(rules, readings_cte: str, columns: dict[str, str]) -> str:
    """Seconds since the last action (or clock start) per rule, by an
    as-of join on (time, tie-break) packed into one ordered key."""
    key = "CAST({a}.t AS HUGEINT) * 10000000000 + ({a}.{tb} + 1)"
    joins, outs = [], []
    for i, rule in enumerate(rules):
        a = f"a{i}"
        joins.append(
            f"ASOF LEFT JOIN (SELECT system_id, t, tb, {key.format(a='chain', tb='tb')} AS k FROM chain "
            f"WHERE rule = '{rule.name}') {a}\n  ON r.system_id = {a}.system_id AND {key.format(a='r', tb='event_id')} >= {a}.k"
        )
        outs.append(f"CAST((r.t - {a}.t) // 1000000 AS INTEGER) AS {columns[rule.name]}")
    return (
        control_chain_sql(rules, readings_cte)
        + "\nSELECT r.system_id, r.event_id, r.event_time, "
        + ", ".join(outs)
        + "\nFROM r\n"
        + "\n".join(joins)
    )
