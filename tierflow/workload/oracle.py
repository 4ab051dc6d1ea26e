"""The results of :mod:`tierflow.workload.queries` stated as SQL.

Written for any engine with DuckDB's functions; local time is UTC-5, the only
offset of the zone in the years of the data.
"""

from __future__ import annotations

from tierflow.operators import ELECTRICAL, ENERGY, FLAGS
from tierflow.workload.queries import CALENDAR, HOW, LOADS, SPLIT
from tierflow.workload.tables import ELECTRICAL_TYPES, ENERGY_TYPES, GAPS, MONTH, STATE_TEXTS, TEMPERATURE_TYPES

STAMP = "%Y-%m-%d %H:%M:%S.%f"


def _text(column: str) -> str:
    return f"strftime({column}, '{STAMP}')"


def _in(types) -> str:
    return "event_type IN (" + ", ".join(f"'{x}'" for x in types) + ")"


def _measures(names, expression: str) -> str:
    """One select item per measure; `expression` has {k} for its position."""
    items = []
    for k, name in enumerate(names, 1):
        value = expression.format(k=k)
        if name in GAPS:
            value = f"CASE WHEN event_type <> '{GAPS[name]}' THEN {value} END"
        items.append(f"{value} AS {name}")
    return ", ".join(items)


def _each(names, template: str) -> str:
    return ", ".join(template.format(name) for name in names)


def _states() -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_TEXTS.items())
    return f"CASE event_type {cases} END"


# Named relations the queries below pick from.
PARTS = {
    "ev": """SELECT event_id AS id, ts - INTERVAL 5 HOUR AS t, user_id AS node_id, event_type, value,
             strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS date,
             CAST(extract('hour' FROM ts - INTERVAL 5 HOUR) AS INTEGER) AS hour FROM events""",
    "electrical": f"SELECT node_id, date, hour, {_measures(ELECTRICAL, 'value * {k}')} FROM ev WHERE {_in(ELECTRICAL_TYPES)}",
    "energy": f"SELECT node_id, date, hour, {_measures(ENERGY, 'value + {k}')} FROM ev WHERE {_in(ENERGY_TYPES)}",
    "electrical_h": f"SELECT node_id, date, hour, {_each(ELECTRICAL, 'sum({0}) AS {0}')} FROM electrical GROUP BY ALL",
    "energy_h": f"SELECT node_id, date, hour, {_each(ENERGY, 'sum({0}) AS {0}')} FROM energy GROUP BY ALL",
    "temperature_h": f"SELECT node_id, date, hour, avg(value) AS temperature FROM ev WHERE {_in(TEMPERATURE_TYPES)} GROUP BY ALL",
    "state_n": f"""SELECT node_id, date, hour, CASE WHEN s LIKE 'Grid-connected%' THEN 'G' WHEN s LIKE 'Standby%' THEN 'B'
                 WHEN s LIKE 'Shutdown%' THEN 'D' ELSE 'B' END AS s
                 FROM (SELECT *, {_states()} AS s FROM ev WHERE {_in(STATE_TEXTS)})""",
    "state_h": f"""SELECT node_id, date, hour, CAST(max(s = 'G') AS INTEGER) AS {FLAGS[0]},
                 CAST(max(s = 'B') AS INTEGER) AS {FLAGS[1]}, CAST(max(s = 'D') AS INTEGER) AS {FLAGS[2]}
                 FROM state_n GROUP BY ALL""",
    "dim": """SELECT c_custkey AS node_id, c_custkey AS meter_id, c_mktsegment AS category,
              CAST(c_acctbal < 0 AS VARCHAR) AS archived, 'type ' || s_nationkey AS installation_type
              FROM customer JOIN supplier ON s_suppkey = c_custkey""",
    "early": f"SELECT * FROM ev WHERE t < '{SPLIT[1]}'",
    "late": f"SELECT id, t, node_id, event_type, -value AS value, date FROM ev WHERE t >= '{SPLIT[0]}'",
}
_EVENTS_H = ["ev", "electrical", "energy", "electrical_h", "energy_h"]
_GOLD = [*_EVENTS_H, "temperature_h", "state_n", "state_h", "dim"]
_EVENT_OUT = f"id, {_text('t')} AS time, node_id, event_type, value, date"
_EVENT_OUT_ROUNDED = _EVENT_OUT.replace(" value,", " round(value, 4) AS value,")


def _how(names) -> str:
    return ", ".join(f"{HOW.get(n, 'sum')}({n}) AS {n}" for n in names)


def _with(names, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({PARTS[n]})" for n in names) + " " + body


def _sums(table: str, names) -> str:
    return f"SELECT node_id, date, hour, {_each(names, 'round({0}, 4) AS {0}')} FROM {table}"


_GOLD_BODY = (
    f"""SELECT x.node_id, d.category, d.archived, d.installation_type, x.date, x.hour,
        {_each(ELECTRICAL, 'round(coalesce(x.{0}, 0), 4) AS {0}')}, {_each(ENERGY, 'round(coalesce(y.{0}, 0), 4) AS {0}')},
        {_each(FLAGS, 'coalesce(s.{0}, -1) AS {0}')}, round(coalesce(w.temperature, -1), 6) AS Temperature
        FROM electrical_h x
        JOIN energy_h y ON x.node_id = y.node_id AND x.date = y.date AND x.hour = y.hour
        LEFT JOIN state_h s ON x.node_id = s.node_id AND x.date = s.date AND x.hour = s.hour
        LEFT JOIN temperature_h w ON x.node_id = w.node_id AND x.date = w.date AND x.hour = w.hour
        LEFT JOIN dim d ON x.node_id = d.node_id
        WHERE x.date BETWEEN '{MONTH[0]}' AND '{MONTH[1]}'"""
)
GOLD = _with(_GOLD, _GOLD_BODY)
_ORDERS = f"SELECT o_orderkey, o_custkey, o_totalprice, {_text('o_orderdate')} AS o_orderdate FROM orders"
_STORED = _with(["ev"], f"SELECT {_EVENT_OUT} FROM ev")
_FIRST_WINS = f"""SELECT {_EVENT_OUT_ROUNDED} FROM (SELECT id, t, node_id, event_type, value, date FROM early
                  UNION ALL SELECT * FROM late WHERE id NOT IN (SELECT id FROM early))"""

PARTS |= {
    "electrical_x": f"SELECT node_id, date, hour, {_how(ELECTRICAL)} FROM electrical GROUP BY ALL",
    "energy_x": f"SELECT node_id, date, hour, {_how(ENERGY)} FROM energy GROUP BY ALL",
    "temperature_x": f"SELECT node_id, date, hour, {HOW['temperature']}(value) AS temperature FROM ev WHERE {_in(TEMPERATURE_TYPES)} GROUP BY ALL",
}


def _loads() -> str:
    """Windows of the scheduled loads: from midnight of the day the one before ended on."""
    parts, lo = [], f"strptime('{CALENDAR}', '%Y%m%d')"
    for now in LOADS:
        name = " || '_' || ".join(f"strftime({t}, '%Y%m%dT%H%M%S%f')" for t in (lo, f"TIMESTAMP '{now}'"))
        parts.append(
            f"SELECT {name} AS load, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered_on"
            f" FROM orders WHERE o_orderdate BETWEEN {lo} AND TIMESTAMP '{now}'"
        )
        lo = f"date_trunc('day', TIMESTAMP '{now}')"
    return " UNION ALL ".join(parts)


_NEW = "SELECT * FROM late WHERE id NOT IN (SELECT id FROM early)"

_KEYLESS = _with(
    ["ev", "early", "late"],
    f"""SELECT CASE WHEN event_type IN ('view', 'click') THEN CAST(id AS VARCHAR) END AS id, time, node_id, event_type, value, date
    FROM (SELECT {_EVENT_OUT_ROUNDED} FROM (SELECT id, t, node_id, event_type, value, date FROM early UNION ALL
    SELECT * FROM late WHERE event_type NOT IN ('view', 'click') OR id NOT IN (SELECT id FROM early)))""",
)

ORACLE: dict[str, str] = {
    "full_scan": _ORDERS,
    "bounded_scan": f"{_ORDERS} WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-01-01'",
    "timestamps_as_string": """SELECT event_id AS id, user_id AS node_id,
        rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS time FROM events""",
    "events_localized": _with(["ev"], f"SELECT {_EVENT_OUT}, hour FROM ev"),
    "date_pruned_scan": f"{_STORED} WHERE date BETWEEN '2024-01-05' AND '2024-01-25'",
    "batch_dates": _with(["ev"], "SELECT DISTINCT date FROM ev"),
    "rows_on_order_dates": """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS date FROM lineitem
        WHERE strftime(l_shipdate, '%Y-%m-%d') IN (SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 300000)""",
    "dimension_distinct": """SELECT * FROM customer UNION
        SELECT * REPLACE (CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal) FROM customer""",
    "dimension_versions": "SELECT DISTINCT * REPLACE (greatest(c_acctbal, 0.0) AS c_acctbal) FROM customer",
    "insert_if_absent": _with(["ev", "early", "late"], _FIRST_WINS),
    "insert_if_absent_indexed": _with(["ev", "early", "late"], _FIRST_WINS),
    "insert_if_absent_raw": _with(
        ["ev", "early", "late"],
        f"""SELECT {_EVENT_OUT_ROUNDED} FROM (SELECT id, t, node_id, event_type, value, date FROM early UNION ALL
        SELECT * FROM (SELECT * FROM late UNION ALL SELECT id, t + INTERVAL 1 HOUR, node_id, event_type, value - 1000, date FROM late)
        WHERE id NOT IN (SELECT id FROM early))""",
    ),
    "insert_if_absent_null_ids": _KEYLESS,
    "stream_recovery": _KEYLESS,
    "event_lineage": _with(
        ["ev", "early", "late"],
        f"""SELECT 'early' AS load, count(*) AS stored, 1 AS files, 1 AS moments FROM early
        UNION ALL SELECT 'late', count(*), 1, 1 FROM ({_NEW})""",
    ),
    "stream_counts": _with(
        ["ev", "early", "late"],
        f"""SELECT 'early' AS load, count(*) AS stored, count(DISTINCT date) AS dates, count(*) AS held FROM early
        UNION ALL SELECT 'late', (SELECT count(*) FROM ({_NEW})), count(DISTINCT date), (SELECT count(*) FROM ({_NEW})) FROM late""",
    ),
    "insert_if_absent_by_date": _with(["ev", "early", "late"], _FIRST_WINS),
    "stream_ingest": _STORED,
    "hourly_sum_electrical": _with(["ev", "electrical", "electrical_h"], _sums("electrical_h", ELECTRICAL)),
    "hourly_sum_energy": _with(["ev", "energy", "energy_h"], _sums("energy_h", ENERGY)),
    "hourly_sum_lineitem": """SELECT l_suppkey AS node_id, strftime(l_shipdate, '%Y-%m-%d') AS date,
        CAST(extract('hour' FROM l_shipdate) AS INTEGER) AS hour, round(sum(l_quantity), 4) AS l_quantity,
        round(sum(l_extendedprice), 4) AS l_extendedprice FROM lineitem GROUP BY 1, 2, 3""",
    "hourly_avg": _with(
        ["ev", "temperature_h"], "SELECT node_id, date, hour, round(temperature, 6) AS temperature FROM temperature_h"
    ),
    "state_flags": _with(["ev", "state_n", "state_h"], "SELECT * FROM state_h"),
    "node_dim": _with(["dim"], "SELECT * FROM dim"),
    "inner_hourly": _with(
        _EVENTS_H,
        """SELECT x.node_id, x.date, x.hour, round(vp1, 4) AS vp1, round(iaepd1, 4) AS iaepd1
        FROM electrical_h x JOIN energy_h y ON x.node_id = y.node_id AND x.date = y.date AND x.hour = y.hour""",
    ),
    "left_hourly": _with(
        [n for n in _GOLD if n not in ("energy", "energy_h", "dim")],
        f"""SELECT x.node_id, x.date, x.hour, round(vp1, 4) AS vp1, {_each(FLAGS, 'CAST(s.{0} AS VARCHAR) AS {0}')}, round(temperature, 6) AS temperature
        FROM electrical_h x LEFT JOIN state_h s ON x.node_id = s.node_id AND x.date = s.date AND x.hour = s.hour
        LEFT JOIN temperature_h w ON x.node_id = w.node_id AND x.date = w.date AND x.hour = w.hour""",
    ),
    "hours_with_nodes": _with(
        ["ev", "electrical", "electrical_h", "dim"],
        """SELECT x.node_id, x.date, x.hour, round(vp1, 4) AS vp1, d.category, d.archived, d.installation_type
        FROM electrical_h x LEFT JOIN dim d ON x.node_id = d.node_id""",
    ),
    "gold_wide": GOLD,
    "gold_wide_by_union": GOLD,
    "gold_wide_mixed": _with(
        [*_GOLD, "electrical_x", "energy_x", "temperature_x"],
        _GOLD_BODY.replace("electrical_h", "electrical_x").replace("energy_h", "energy_x").replace("temperature_h", "temperature_x"),
    ),
    "gold_from_views": _with(
        _GOLD,
        f"""SELECT x.node_id, x.date, x.hour, d.category, round(coalesce(x.vp1, 0) + coalesce(y.iaepd1, 0), 4) AS total,
        coalesce(s.Ind_Shutdown, -1) AS Ind_Shutdown, round(coalesce(w.temperature, -1), 6) AS Temperature
        FROM electrical_h x
        JOIN energy_h y ON x.node_id = y.node_id AND x.date = y.date AND x.hour = y.hour
        LEFT JOIN state_h s ON x.node_id = s.node_id AND x.date = s.date AND x.hour = s.hour
        LEFT JOIN temperature_h w ON x.node_id = w.node_id AND x.date = w.date AND x.hour = w.hour
        LEFT JOIN dim d ON x.node_id = d.node_id
        WHERE x.date BETWEEN '{MONTH[0]}' AND '{MONTH[1]}'""",
    ),
    "gold_partition_overwrite": _with(
        ["ev", "electrical", "electrical_h"],
        f"""SELECT node_id, date, hour, round(CASE WHEN date BETWEEN '{SPLIT[0]}' AND '{SPLIT[1]}' THEN -vp1 ELSE vp1 END, 4) AS vp1
        FROM electrical_h""",
    ),
    "registered_table": _STORED,
    "registered_in_steps": _with(["ev", "early", "late"], _FIRST_WINS),
    "row_count": "SELECT count(*) AS counted, count(*) AS stored FROM lineitem",
    "month_window": """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day,
        strftime(last_day(o_orderdate), '%Y-%m-%d') AS last_day, count(*) AS orders FROM orders GROUP BY 1, 2""",
    "high_water_mark": f"""SELECT o_orderpriority AS ingest, {_text('arg_max(o_orderdate, o_orderkey) - INTERVAL 3 DAYS')} AS lo,
        {_text('arg_max(o_orderdate, o_orderkey)')} AS hi, max(o_orderkey) AS run_ts FROM orders GROUP BY 1""",
    "scheduled_loads": _loads(),
    "control_scan": """SELECT 'nation-' || n_nationkey AS ingest, r_name AS db, n_name AS "table",
        'id:integer,k' || n_nationkey || ':double' AS columns, CASE WHEN n_nationkey % 2 = 1 THEN 'k' || n_nationkey END AS delta,
        strftime(make_date(2024, CAST(1 + n_nationkey % 12 AS INTEGER), 1), '%Y%m%d') AS start_date, 'jdbc' AS source_format,
        CAST(r_regionkey AS VARCHAR) AS region, 'parquet' AS bronze_format, 'parquet' AS silver_format, 'orc' AS gold_format,
        '/lake/bronze/' || n_name AS bronze_path, '/lake/silver/' || n_name AS silver_path,
        '/lake/silver/_checkpoints/' || n_name AS checkpoint_path, '/lake/bronze/_marks' AS marks_path
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "source_to_gold": GOLD,
}
