"""SQL answers of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

from torquelake.sources.dims import CAR_COLORS, CAR_MODELS


def _values(rows: list[tuple]) -> str:
    return "VALUES " + ", ".join(map(str, rows))


# The given tables as sensor events and cars, enriched and flagged.
PARTS = {
    "car_models": f"car_models(model_id, car_brand, car_model) AS ({_values(CAR_MODELS)})",
    "car_colors": f"car_colors(color_id, color_name) AS ({_values(CAR_COLORS)})",
    "cars": """cars AS (
  SELECT c_custkey AS car_id, 100000000 + c_custkey AS driver_id,
         CAST(1 + c_custkey % 7 AS INTEGER) AS model_id,
         CAST(1 + FLOOR(c_custkey / 7) % 7 AS INTEGER) AS color_id
  FROM customer)""",
    "sensors": """sensors AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time,
         CASE WHEN user_id % 10 = 0 THEN user_id + 1000000000000 ELSE user_id END AS car_id,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST((event_id * 37) % 161 AS INTEGER) END AS speed,
         CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST((event_id * 7919) % 8001 AS INTEGER) END AS rpm,
         CAST(1 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS INTEGER) AS gear
  FROM events)""",
    "enriched": """enriched AS (
  SELECT s.event_id, s.event_time, s.car_id, c.driver_id, m.car_brand AS brand_name,
         m.car_model AS model_name, k.color_name, s.speed, s.rpm, s.gear,
         CAST(round(s.speed / 30) AS INTEGER) AS expected_gear
  FROM sensors s LEFT JOIN cars c ON s.car_id = c.car_id
  LEFT JOIN car_models m ON c.model_id = m.model_id
  LEFT JOIN car_colors k ON c.color_id = k.color_id)""",
    "flagged": """flagged AS (
  SELECT *, CASE WHEN speed > 120 OR expected_gear <> gear OR rpm > 6000
                 THEN true ELSE false END AS is_alert
  FROM enriched)""",
    "windows": """windows AS (
  SELECT date_trunc('minute', event_time) AS window_start,
         date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
         count(*) AS num_of_rows,
         CAST(sum(CASE WHEN color_name = 'Black' THEN 1 ELSE 0 END) AS BIGINT) AS num_of_black,
         CAST(sum(CASE WHEN color_name = 'White' THEN 1 ELSE 0 END) AS BIGINT) AS num_of_white,
         CAST(sum(CASE WHEN color_name = 'Gray' THEN 1 ELSE 0 END) AS BIGINT) AS num_of_silver,
         max(speed) AS maximum_speed, max(gear) AS maximum_gear, max(rpm) AS maximum_rpm
  FROM flagged WHERE is_alert AND event_time IS NOT NULL GROUP BY 1, 2)""",
    # A stream holds back the windows that its watermark has not passed.
    "closed": """closed AS (
  SELECT * FROM windows WHERE window_end <= (
    SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 10 SECOND FROM flagged WHERE is_alert))""",
    "files": """files AS (
  SELECT CAST(o_orderdate AS DATE) AS partition, CAST(o_orderkey AS VARCHAR) AS path,
         (o_orderkey % 200000000 * 7919 % 200000000 * 7919) % 200000000 AS bytes, o_orderdate AS modified_at
  FROM orders)""",
}
SENSORS = ("sensors",)
CARS = ("cars",)
FLAGGED = ("car_models", "car_colors", "cars", "sensors", "enriched", "flagged")
ENRICHED = FLAGGED[:-1]
WINDOWS = (*FLAGGED, "windows")
CLOSED = (*WINDOWS, "closed")

ENRICHED_COLUMNS = (
    "event_id, event_time, car_id, driver_id, brand_name, model_name, color_name, speed, rpm, gear, expected_gear"
)
# Topics keep milliseconds.
MILLIS = "* REPLACE (date_trunc('millisecond', event_time) AS event_time)"
# The JSON text of a sensor event; missing values are left out.
SENSOR_JSON = """'{"event_id":"' || event_id || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g')
  || 'Z","car_id":' || car_id || CASE WHEN speed IS NULL THEN '' ELSE ',"speed":' || speed END
  || CASE WHEN rpm IS NULL THEN '' ELSE ',"rpm":' || rpm END || ',"gear":' || gear || '}'"""
MESSAGE = """'🚗 *Alert Aggregation*' || chr(10) || chr(10)
  || '⏰ ' || CAST(window_start AS VARCHAR) || ' → ' || CAST(window_end AS VARCHAR) || chr(10) || chr(10)
  || '📊 Total: `' || num_of_rows || '`' || chr(10)
  || '🎨 Black: `' || num_of_black || '` | White: `' || num_of_white || '` | Silver: `' || num_of_silver || '`'
  || chr(10) || chr(10)
  || '🏎️ Max Speed: `' || coalesce(CAST(maximum_speed AS VARCHAR), 'None')
  || '` | Gear: `' || coalesce(CAST(maximum_gear AS VARCHAR), 'None')
  || '` | RPM: `' || coalesce(CAST(maximum_rpm AS VARCHAR), 'None') || '`'"""


def _with(parts: tuple[str, ...], body: str) -> str:
    return "WITH " + ",\n".join(PARTS[part] for part in parts) + "\n" + body


def _count_text(table: str, count: str) -> str:
    return f"'📊 Table `{table}` has *' || format('{{:,}}', {count}) || '* rows'"


def _cells(columns: str, separator: str | None = None) -> str:
    cells = [f"coalesce(substr(CAST({c} AS VARCHAR), 1, 20), 'None')" for c in columns.split(", ")]
    if separator is not None:
        return f" || '{separator}' || ".join(cells)
    return ", ".join(f"{cell} AS {c}" for cell, c in zip(cells, columns.split(", "), strict=True))


def _integrity(check: str, keys: str, rows: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", {keys} AS offending_keys, "
        f"CAST(coalesce({rows}, 0) AS BIGINT) AS offending_rows FROM ({source})"
    )


def _duplicates(check: str, dim: str, key: str) -> str:
    return _integrity(
        check, "count(*)", "sum(n)", f"SELECT {key}, count(*) AS n FROM {dim} GROUP BY {key} HAVING count(*) > 1"
    )


def _unmatched(check: str, facts: str, dim: str, key: str) -> str:
    source = f"SELECT {key} FROM {facts} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"
    keys = f"count(DISTINCT {key}) + max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END)"
    return _integrity(check, f"coalesce({keys}, 0)", "count(*)", source)


def oracle_sql() -> dict[str, str]:
    flagged, enriched = f"SELECT {ENRICHED_COLUMNS}, is_alert FROM flagged", f"SELECT {ENRICHED_COLUMNS} FROM enriched"
    millis_flagged = _with(FLAGGED, f"SELECT {MILLIS} FROM flagged")
    raw = _with(SENSORS, f"SELECT {SENSOR_JSON} AS json_data, true AS has_id, true AS has_timestamp FROM sensors")
    cars_per = (
        "SELECT d.*, count(c.car_id) AS num_of_cars FROM {dim} d LEFT JOIN cars c ON c.{key} = d.{key} GROUP BY ALL"
    )
    return {
        # Sources, sinks, tables
        "topic_source_parse": _with(SENSORS, f"SELECT {MILLIS} FROM sensors"),
        "topic_roundtrip_enriched": _with(ENRICHED, f"SELECT {MILLIS} FROM enriched"),
        "stream_enriched_table": millis_flagged,
        "stream_raw_table": raw,
        "stream_unreadable_table": _with(
            SENSORS, f"SELECT substr({SENSOR_JSON}, 1, 25) AS json_data FROM sensors WHERE CAST(event_id AS BIGINT) % 41 = 0"
        ),
        "scan_cars": _with(CARS, "SELECT car_id, driver_id, model_id, color_id FROM cars"),
        "scan_car_models": _with(("car_models", "cars"), cars_per.format(dim="car_models", key="model_id")),
        "load_dims_reload": _with(
            ("car_models", "car_colors", "cars"),
            "SELECT 'cars' AS table_name, count(*) AS num_of_rows FROM cars "
            "UNION ALL SELECT 'car_models', count(*) FROM car_models "
            "UNION ALL SELECT 'car_colors', count(*) FROM car_colors",
        ),
        "inline_car_models": _with(("car_models", "cars"), cars_per.format(dim="car_models", key="model_id")),
        "inline_car_colors": _with(("car_colors", "cars"), cars_per.format(dim="car_colors", key="color_id")),
        "enriched_by_day": _with(
            FLAGGED,
            "SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_day, count(*) AS num_of_rows, "
            "count(*) FILTER (WHERE is_alert) AS num_of_alerts FROM flagged GROUP BY 1",
        ),
        # Columns and predicates
        "enrich": _with(ENRICHED, enriched),
        "enrich_large_dimension": _with(ENRICHED, enriched),
        "parse_sensor_json": _with(SENSORS, f"SELECT {MILLIS} FROM sensors"),
        "raw_capture": raw,
        "flag_alerts": _with(FLAGGED, flagged),
        "filter_alerts": _with(FLAGGED, f"SELECT {ENRICHED_COLUMNS} FROM flagged WHERE is_alert"),
        "alert_reasons": _with(
            FLAGGED,
            "SELECT event_id, is_alert, coalesce(speed > 120, false) AS is_speeding, "
            "coalesce(expected_gear <> gear, false) AS is_wrong_gear, coalesce(rpm > 6000, false) AS is_high_rpm, "
            "concat_ws(',', CASE WHEN speed > 120 THEN 'speeding' END, CASE WHEN expected_gear <> gear "
            "THEN 'wrong_gear' END, CASE WHEN rpm > 6000 THEN 'high_rpm' END) AS reasons FROM flagged",
        ),
        "expected_gear": _with(
            ENRICHED, "SELECT expected_gear, count(*) AS num_of_rows FROM enriched GROUP BY expected_gear"
        ),
        # Joins
        "join_event_car": _with(
            (*SENSORS, *CARS),
            "SELECT s.*, c.driver_id, c.model_id, c.color_id FROM sensors s LEFT JOIN cars c ON s.car_id = c.car_id",
        ),
        "join_event_model": _with(
            (*SENSORS, *CARS, "car_models"),
            "SELECT s.*, c.driver_id, c.model_id, c.color_id, m.car_brand, m.car_model FROM sensors s "
            "LEFT JOIN cars c ON s.car_id = c.car_id LEFT JOIN car_models m ON c.model_id = m.model_id",
        ),
        # Aggregates
        "alert_window_agg": _with(WINDOWS, "SELECT * FROM windows"),
        "alert_summary": _with(WINDOWS, "SELECT * FROM windows"),
        "count_rows": _with(FLAGGED, "SELECT count(*) AS num_of_rows FROM flagged"),
        "count_rows_text": f"SELECT count(*) AS num_of_rows, {_count_text('given.events', 'count(*)')} AS message FROM events",
        "alerts_by_color": _with(
            FLAGGED,
            "SELECT color_name, count(*) AS num_of_rows, count(*) FILTER (WHERE is_alert) AS num_of_alerts, "
            "max(speed) AS maximum_speed, max(gear) AS maximum_gear, max(rpm) AS maximum_rpm "
            "FROM flagged GROUP BY color_name",
        ),
        "alerts_on_day": _with(
            FLAGGED,
            "SELECT count(*) AS num_of_alerts FROM flagged WHERE is_alert "
            "AND event_time >= TIMESTAMP '2024-01-15' AND event_time < TIMESTAMP '2024-01-16'",
        ),
        "black_cars_over_100": _with(FLAGGED, f"{flagged} WHERE color_name = 'Black' AND speed > 100"),
        "notification_text": _with(WINDOWS, f"SELECT window_start, window_end, {MESSAGE} AS message FROM windows"),
        # Streams
        "stream_alert_window_agg": _with(CLOSED, "SELECT * FROM closed"),
        "stream_backfill_handover": _with(CLOSED, "SELECT * FROM closed"),
        "stream_chain_end_to_end": _with(CLOSED, "SELECT * FROM closed"),
        "stream_notifications": _with(CLOSED, f"SELECT window_start, window_end, {MESSAGE} AS message FROM closed"),
        # Looking around
        "preview_table": _with(
            FLAGGED,
            f"SELECT {_cells(ENRICHED_COLUMNS + ', is_alert')} FROM (SELECT * FROM flagged "
            "ORDER BY event_time, event_id LIMIT 5)",
        ),
        "preview_text": _with(
            FLAGGED,
            f"SELECT {_cells(ENRICHED_COLUMNS + ', is_alert', ' | ')} AS line FROM (SELECT * FROM flagged "
            "ORDER BY event_time, event_id LIMIT 5)",
        ),
        "run_select_bounded": _with(
            FLAGGED,
            "SELECT event_id, rpm, (SELECT greatest(count(*) - 10, 0) FROM flagged WHERE is_alert) AS more_rows "
            "FROM flagged WHERE is_alert ORDER BY rpm DESC NULLS LAST, event_id LIMIT 10",
        ),
        # Maintenance
        "dim_integrity": _with(
            ("car_models", "car_colors", "cars", "sensors"),
            "\nUNION ALL ".join(
                [
                    _duplicates("duplicate car", "cars", "car_id"),
                    _duplicates("duplicate model", "car_models", "model_id"),
                    _duplicates("duplicate color", "car_colors", "color_id"),
                    _unmatched("event without car", "sensors", "cars", "car_id"),
                    _unmatched("car without model", "cars", "car_models", "model_id"),
                    _unmatched("car without color", "cars", "car_colors", "color_id"),
                ]
            ),
        ),
        "plan_compaction": _with(
            ("files",),
            "SELECT CAST(partition AS VARCHAR) AS partition, path, bytes, "
            "CAST(floor((sum(bytes) OVER (PARTITION BY partition ORDER BY substr(md5(path), 1, 2), path "
            "ROWS UNBOUNDED PRECEDING) - bytes) / 134217728) AS BIGINT) AS bin FROM files WHERE bytes < 67108864",
        ),
        "plan_snapshot_expiry": """SELECT table_id, snapshot_id, committed_at FROM (
  SELECT o_custkey AS table_id, o_orderkey AS snapshot_id, o_orderdate AS committed_at,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank
  FROM orders) WHERE rank > 10 AND committed_at < TIMESTAMP '2001-08-01' - INTERVAL 3 DAY""",
        "plan_orphans": _with(
            ("files",),
            "SELECT path, bytes, modified_at FROM files f WHERE modified_at < TIMESTAMP '2001-08-01' - INTERVAL 1 DAY "
            "AND NOT EXISTS (SELECT 1 FROM events e WHERE CAST(e.event_id AS VARCHAR) = f.path)",
        ),
        # What ad-hoc SQL can do
        "sql_join_kinds": """SELECT 'inner' AS kind, count(*) AS num_of_rows FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
UNION ALL SELECT 'semi', count(*) FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
UNION ALL SELECT 'anti', count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
UNION ALL SELECT 'full', count(*) FROM (SELECT user_id FROM events GROUP BY user_id) e FULL JOIN customer ON e.user_id = c_custkey
UNION ALL SELECT 'theta', count(*) FROM orders JOIN customer ON o_custkey = c_custkey AND o_totalprice > c_acctbal""",
        "sql_rollup_color_model": _with(
            FLAGGED,
            "SELECT color_name, model_name, CAST(grouping(color_name, model_name) AS BIGINT) AS level, "
            "count(*) AS num_of_rows, count(*) FILTER (WHERE is_alert) AS num_of_alerts "
            "FROM flagged GROUP BY ROLLUP (color_name, model_name)",
        ),
        "sql_cube_grouping_sets": _with(
            FLAGGED,
            "SELECT 'cube' AS kind, color_name, brand_name, CAST(grouping(color_name, brand_name) AS BIGINT) AS level, "
            "count(*) AS num_of_rows, max(speed) AS maximum_speed FROM flagged GROUP BY CUBE (color_name, brand_name) "
            "UNION ALL SELECT 'sets', color_name, brand_name, CAST(grouping(color_name, brand_name) AS BIGINT), "
            "count(*), max(speed) FROM flagged GROUP BY GROUPING SETS ((color_name), (brand_name), ())",
        ),
        "sql_distinct_aggregates": _with(
            FLAGGED,
            "SELECT color_name, count(DISTINCT car_id) AS num_of_cars, count(DISTINCT gear) AS num_of_gears, "
            "CAST(sum(DISTINCT gear) AS BIGINT) AS sum_of_gears, count(*) AS num_of_rows FROM flagged GROUP BY color_name "
            "UNION ALL SELECT DISTINCT brand_name, 0, 0, 0, 0 FROM flagged",
        ),
        "sql_moving_frame": _with(
            SENSORS,
            "SELECT event_id, car_id, count(speed) OVER w AS num_of_speeds, max(speed) OVER w AS maximum_speed, "
            "CAST(sum(rpm) OVER w AS BIGINT) AS sum_of_rpm FROM sensors WINDOW w AS (PARTITION BY car_id, "
            "CAST(event_time AS DATE) ORDER BY event_time, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
        ),
        "compacted_table": millis_flagged.replace("date_trunc('millisecond', event_time)", "event_time"),
        "sql_top_speed_per_car": _with(
            FLAGGED,
            "SELECT car_id, event_id, speed, CAST(rank AS INTEGER) AS rank FROM (SELECT car_id, event_id, speed, row_number() OVER "
            "(PARTITION BY car_id ORDER BY speed DESC NULLS LAST, event_id) AS rank FROM flagged) WHERE rank <= 3",
        ),
        "sql_topk_rpm": _with(
            FLAGGED, "SELECT event_id, car_id, rpm FROM flagged ORDER BY rpm DESC NULLS LAST, event_id LIMIT 20"
        ),
        "sql_set_ops": """SELECT 'union' AS kind, count(*) AS num_of_rows FROM (SELECT user_id AS k FROM events UNION SELECT o_custkey FROM orders)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT user_id AS k FROM events INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'except', count(*) FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events)""",
    }
