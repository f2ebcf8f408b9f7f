"""The registered queries as DuckDB SQL, written from the definitions and not from the Spark plans.

Each statement is a WITH chain over the test tables, put together from the named parts below.
"""

from __future__ import annotations

import re

from tiffin.testbed.fixtures import AS_OF

_SECONDS = "CAST(floor(epoch({0})) AS BIGINT)"


def _minutes(start: str, end: str) -> str:
    return f"(({_SECONDS.format(end)} - {_SECONDS.format(start)}) / 60.0)::DOUBLE"


_CUT = f"(TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR)"

_REGION = (
    "CASE WHEN len(string_split(delivery_address, ',')) > 1 "
    "THEN trim(string_split(delivery_address, ',')[2]) END"
)

_START = "(o_orderkey*7919) % 1440"

_ALL_LATE = "delay_category <> 'on_time'"
_REPORTED_LATE = "delay_category = 'late'"

PARTS = {
    "fx_orders": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  (101 + o_custkey % 3)::INT AS store_id,
  o_orderdate + INTERVAL 1 MINUTE * ({_START})::INT AS event_time,
  o_orderdate + INTERVAL 1 MINUTE * ({_START} + (o_orderkey*31) % 120)::INT AS "timestamp",
  CASE WHEN o_orderkey % 50 = 0 THEN 'no region'
       ELSE concat(o_custkey::VARCHAR, ' Main St, ', r_name) END AS delivery_address,
  o_orderdate + INTERVAL 1 MINUTE * ({_START} + 30)::INT AS estimated_delivery_time,
  o_orderdate + INTERVAL 1 MINUTE * ({_START} + 30 + (o_orderkey*37) % 420 - 60)::INT
    AS actual_delivery_time
FROM orders JOIN region ON r_regionkey = o_custkey % 5""",
    "fx_events": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  (101 + o_custkey % 3)::INT AS store_id,
  o_orderdate + INTERVAL 1 MINUTE * ({_START} + step * (5 + (o_orderkey*17) % 40))::INT
    AS event_time,
  o_orderdate + INTERVAL 1 MINUTE * ({_START} + (o_orderkey*31) % 120)::INT AS "timestamp",
  event_type
FROM orders, (VALUES (0,'order_received'), (1,'order_in_preparation'),
  (2,'order_sent_out_for_delivery'), (3,'order_delivered'), (4,'order_archived')) s(step, event_type)""",
    "fx_complaints": """
SELECT l_orderkey*10 + l_linenumber AS complaint_id, l_orderkey AS order_id,
  l_shipdate AS timestamp_received,
  CASE l_linenumber % 5 WHEN 0 THEN 'Late delivery' WHEN 1 THEN 'Wrong order'
    WHEN 2 THEN 'Cold food' WHEN 3 THEN 'Missing item' ELSE 'Bad service' END AS complaint_type,
  CASE WHEN l_partkey % 20 = 0 THEN '  ' ELSE concat('part ', l_partkey::VARCHAR) END AS description
FROM lineitem""",
    "fx_weather": """
SELECT concat(' ', lower(r_name), ' ') AS location,
  l_shipdate + INTERVAL 1 MINUTE * ((l_orderkey*13 + l_linenumber*101) % 1440)::INT AS "timestamp",
  l_quantity - 10 AS temperature, round(l_discount*300, 2) AS precipitation,
  round(l_tax*600, 2) AS wind_speed,
  CASE l_partkey % 6 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Partly Cloudy' WHEN 2 THEN 'Cloudy'
    WHEN 3 THEN 'Rain' WHEN 4 THEN 'Storm' ELSE 'Fog' END AS weather_condition
FROM lineitem JOIN region ON r_regionkey = l_suppkey % 5""",
    "b_orders": f"""
SELECT * REPLACE (CASE WHEN order_id % 89 <> 0 THEN order_id END AS order_id,
  store_id::BIGINT AS store_id)
FROM fx_orders WHERE order_id % 97 <> 0 AND event_time >= {_CUT}""",
    "s_orders": f"""
SELECT DISTINCT order_id, customer_id, store_id, event_time, "timestamp" AS order_time,
  delivery_address, estimated_delivery_time, actual_delivery_time, delivery_delay,
  CASE WHEN delivery_delay <= 0 THEN 'on_time' ELSE 'late' END AS status
FROM (SELECT *, {_minutes("estimated_delivery_time", "actual_delivery_time")} AS delivery_delay
      FROM fx_orders)
WHERE order_id > 0 AND customer_id > 0 AND store_id > 0 AND delivery_address IS NOT NULL
  AND delivery_delay < 300 AND actual_delivery_time >= estimated_delivery_time""",
    "s_events": f"""
SELECT DISTINCT * FROM fx_events
WHERE order_id IS NOT NULL AND event_time >= {_CUT}
  AND event_type IN ('order_received', 'order_in_preparation', 'order_sent_out_for_delivery',
                     'order_delivered')""",
    "s_complaints": """
SELECT DISTINCT * FROM fx_complaints
WHERE complaint_id >= 1 AND order_id >= 1 AND timestamp_received IS NOT NULL
  AND trim(complaint_type) <> '' AND trim(description) <> ''""",
    "s_weather": f"""
SELECT DISTINCT o.order_id, o.order_time, o.region, w.temperature, w.precipitation, w.wind_speed,
  w.weather_condition
FROM (SELECT *, {_REGION} AS region FROM s_orders) o LEFT JOIN fx_weather w
  ON lower(o.region) = lower(trim(w.location))
  AND abs({_SECONDS.format("o.order_time")} - {_SECONDS.format('w."timestamp"')}) <= 3600""",
    "s_deliveries": """
SELECT order_id, customer_id, store_id, region, delivery_address, order_time,
  estimated_delivery_time, actual_delivery_time, delivery_delay, status, complaint_type,
  complaint_type IS NOT NULL AS had_complaint, temperature, precipitation, wind_speed,
  weather_condition,
  CASE WHEN delivery_delay < 5 THEN 'on_time' WHEN delivery_delay < 15 THEN 'minor_delay'
       WHEN delivery_delay < 60 THEN 'major_delay' ELSE 'extreme_delay' END AS delay_category
FROM (SELECT o.*, c.complaint_type, w.* EXCLUDE (order_id, order_time),
        row_number() OVER (PARTITION BY o.order_id
          ORDER BY c.complaint_type NULLS LAST, w.temperature NULLS LAST,
            w.precipitation NULLS LAST, w.wind_speed NULLS LAST,
            w.weather_condition NULLS LAST) AS pick
      FROM s_orders o LEFT JOIN s_complaints c ON c.order_id = o.order_id
        LEFT JOIN s_weather w ON w.order_id = o.order_id)
WHERE pick = 1 AND order_id > 0""",
    "s_history": """
SELECT order_id, event_type AS status, event_time AS effective_time,
  lead(event_time) OVER w AS end_time, lead(event_time) OVER w IS NULL AS is_current
FROM s_events WINDOW w AS (PARTITION BY order_id ORDER BY event_time, event_type)""",
    "s_calendar": """
SELECT date, dayname(date) AS day_of_week, dayname(date) IN ('Saturday', 'Sunday') AS is_weekend,
  strftime(date, '%m-%d') IN ('01-01', '12-25') AS is_holiday,
  dayname(date) = 'Friday' AS is_short_friday
FROM (SELECT unnest(generate_series(min(order_time)::DATE, max(order_time)::DATE,
        INTERVAL 1 DAY))::DATE AS date FROM s_orders)""",
    "g_complaints_by_type": """
SELECT complaint_type, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM s_complaints), 6) AS percent_of_orders
FROM s_complaints GROUP BY complaint_type""",
    "d_orders": """
SELECT order_id, CASE WHEN order_id % 97 = 0 THEN NULL ELSE customer_id END AS customer_id,
  CASE WHEN order_id % 41 = 0 THEN -5.0 WHEN order_id % 43 = 0 THEN 301.0
       ELSE delivery_delay END AS delivery_delay,
  CASE WHEN order_id % 61 = 0 THEN 'canceled' WHEN order_id % 67 = 0 THEN NULL
       ELSE status END AS status
FROM s_orders
UNION ALL SELECT order_id, customer_id, delivery_delay, status FROM s_orders WHERE order_id % 53 = 0
UNION ALL SELECT NULL, customer_id, delivery_delay, status FROM s_orders WHERE order_id % 59 = 0""",
    "d_weather": """
SELECT order_id, order_time, region,
  CASE WHEN order_id % 101 = 0 THEN -60.0 ELSE temperature END AS temperature,
  CASE WHEN order_id % 103 = 0 THEN -1.0 ELSE precipitation END AS precipitation,
  CASE WHEN order_id % 107 = 0 THEN 301.0 ELSE wind_speed END AS wind_speed, weather_condition
FROM s_weather""",
    "d_deliveries": """
SELECT order_id, CASE WHEN order_id % 11 <> 0 THEN customer_id END AS customer_id,
  CASE WHEN order_id % 13 <> 0 THEN store_id END AS store_id,
  CASE WHEN order_id % 17 <> 0 THEN order_time END AS order_time,
  CASE WHEN order_id % 19 <> 0 THEN delay_category END AS delay_category,
  CASE WHEN order_id % 23 <> 0 THEN order_time END AS ingestion_time
FROM s_deliveries""",
    "d_history": """
SELECT order_id, CASE WHEN order_id % 11 <> 0 THEN status END AS status,
  CASE WHEN order_id % 13 <> 0 THEN effective_time END AS effective_time, end_time,
  CASE WHEN order_id % 17 <> 0 THEN is_current END AS is_current,
  CASE WHEN order_id % 19 <> 0 THEN effective_time END AS ingestion_time
FROM s_history""",
    "d_calendar": """
SELECT date, CASE WHEN n % 11 <> 0 THEN day_of_week END AS day_of_week,
  CASE WHEN n % 13 <> 0 THEN is_weekend END AS is_weekend,
  CASE WHEN n % 17 <> 0 THEN is_holiday END AS is_holiday,
  CASE WHEN n % 19 <> 0 THEN is_short_friday END AS is_short_friday
FROM (SELECT *, date - DATE '1970-01-01' AS n FROM s_calendar)""",
}


def _by_region(late: str) -> str:
    return f"""
SELECT region, round(coalesce(avg_delay, 0), 6) AS avg_delivery_time,
  round(late / orders, 6) AS late_deliveries_pct,
  round(coalesce(complaints, 0) / orders, 6) AS complaints_pct
FROM (SELECT region, avg(delivery_delay) AS avg_delay, count(*) AS orders,
        count(CASE WHEN {late} THEN 1 END) AS late
      FROM s_deliveries WHERE region IS NOT NULL GROUP BY region)
LEFT JOIN (SELECT region, count(*) AS complaints
      FROM s_complaints JOIN s_deliveries USING (order_id) WHERE region IS NOT NULL
      GROUP BY region) USING (region)"""


def _daily(late: str) -> str:
    return f"""
SELECT d.date, total_orders, late_orders, weather_summary
FROM (SELECT order_time::DATE AS date, count(*) AS total_orders,
        count(CASE WHEN {late} THEN 1 END) AS late_orders
      FROM s_deliveries GROUP BY 1) d
LEFT JOIN (SELECT order_time::DATE AS date, first(weather_condition
        ORDER BY order_time, order_id, weather_condition) AS weather_summary
      FROM s_weather WHERE weather_condition IS NOT NULL GROUP BY 1) w ON w.date = d.date"""


def _hours(late: str) -> str:
    return f"""
SELECT hour(order_time)::INT AS hour_of_day, count(*) AS order_count,
  round(avg(delivery_delay), 6) AS avg_delivery_delay,
  round(count(CASE WHEN {late} THEN 1 END) / count(*), 6) AS late_orders_pct
FROM s_deliveries GROUP BY 1"""


def _impact(late: str) -> str:
    return f"""
SELECT d.weather_condition, round(coalesce(avg_delay, 0), 6) AS avg_delivery_delay,
  round(late / orders, 6) AS late_deliveries_pct,
  round(coalesce(complaints, 0) / orders, 6) AS complaints_pct
FROM (SELECT w.weather_condition, avg(delivery_delay) AS avg_delay, count(*) AS orders,
        count(CASE WHEN {late} THEN 1 END) AS late
      FROM s_deliveries d JOIN s_weather w USING (order_id) GROUP BY 1) d
LEFT JOIN (SELECT w.weather_condition, count(*) AS complaints
      FROM s_complaints JOIN s_weather w USING (order_id) GROUP BY 1) c
  ON c.weather_condition = d.weather_condition"""


def _business(weather: str) -> str:
    return f"""
SELECT o.order_time::DATE AS date, store_id, count(*) AS orders_count,
  count(CASE WHEN status = 'late' THEN 1 END) AS late_count,
  count(CASE WHEN status = 'on_time' THEN 1 END) AS on_time_count,
  count(c.order_id) AS complaints_count,
  round(avg(delivery_delay), 6) AS avg_delivery_delay,
  round(avg(prep), 6) AS avg_prep_time, round(avg(delivery), 6) AS avg_delivery_time,
  count(CASE WHEN severe THEN 1 END) AS severe_weather_count
FROM s_orders o
LEFT JOIN (SELECT DISTINCT order_id FROM s_complaints) c ON c.order_id = o.order_id
LEFT JOIN (SELECT order_id, {_minutes("received", "prepared")} AS prep,
        {_minutes("sent", "delivered")} AS delivery
      FROM (SELECT order_id,
          max(event_time) FILTER (event_type = 'order_received') AS received,
          max(event_time) FILTER (event_type = 'order_in_preparation') AS prepared,
          max(event_time) FILTER (event_type = 'order_sent_out_for_delivery') AS sent,
          max(event_time) FILTER (event_type = 'order_delivered') AS delivered
        FROM s_events GROUP BY order_id)) e ON e.order_id = o.order_id
LEFT JOIN {weather} w ON w.order_id = o.order_id
GROUP BY 1, 2"""


_SEVERE = "precipitation > 20 OR wind_speed > 40"


def _counts(source: str, rules: dict[str, str], key: str | None = None) -> str:
    lines = [
        f"SELECT '{name}' AS rule, count(*) AS violations FROM {source} WHERE {predicate}"
        for name, predicate in rules.items()
    ]
    if key:
        lines.append(
            f"SELECT 'duplicate_{key}', count(*) FROM (SELECT {key} FROM {source} "
            f"GROUP BY {key} HAVING count(*) > 1)"
        )
    return "\nUNION ALL ".join(lines)


def _nulls(*columns: str) -> dict[str, str]:
    return {f"null_{c}": f"{c} IS NULL" for c in columns}


_ORDER_RULES = {
    **_nulls("customer_id", "order_id"),
    "invalid_delivery_delay": "delivery_delay < 0 OR delivery_delay > 300",
    "invalid_status": "status NOT IN ('on_time', 'late')",
}
_TYPES = "('Late delivery', 'Missing item', 'Wrong order', 'Cold food')"
_COMPLAINT_RULES = {
    **_nulls("complaint_id", "order_id", "complaint_type"),
    "invalid_complaint_type": f"complaint_type NOT IN {_TYPES}",
}
_WEATHER_RULES = {
    **_nulls("order_id", "order_time", "region"),
    **_nulls("temperature", "precipitation", "wind_speed", "weather_condition"),
    "invalid_temperature": "temperature < -50 OR temperature > 60",
    "invalid_precipitation": "precipitation < 0",
    "invalid_wind_speed": "wind_speed < 0 OR wind_speed > 300",
}
_DELIVERY_RULES = _nulls(
    "order_id", "customer_id", "store_id", "order_time", "delay_category", "ingestion_time"
)
_STATUS_RULES = _nulls("order_id", "status", "effective_time", "ingestion_time", "is_current")
_CALENDAR_RULES = _nulls("date", "day_of_week", "is_weekend", "is_holiday", "is_short_friday")

QUERIES = {
    "bronze_orders": "SELECT * FROM b_orders",
    "bronze_order_events": f"""
SELECT * REPLACE (store_id::BIGINT AS store_id)
FROM fx_events WHERE event_time >= {_CUT}""",
    "bronze_complaints": f"""
SELECT * FROM fx_complaints WHERE timestamp_received >= {_CUT}""",
    "bronze_weather": f'SELECT * FROM fx_weather WHERE "timestamp" >= {_CUT}',
    "stream_bronze_orders": "SELECT * FROM b_orders",
    "stream_drop_replays": "SELECT DISTINCT * FROM b_orders",
    "stream_order_outcomes": f"""
SELECT CASE WHEN order_id % 97 = 0 THEN 'undecodable' WHEN event_time >= {_CUT} THEN 'accepted'
  ELSE 'late' END AS outcome,
  CASE WHEN order_id % 97 <> 0 THEN event_time::DATE END AS date, count(*) AS messages
FROM fx_orders GROUP BY ALL""",
    "silver_orders_clean": "SELECT * FROM s_orders",
    "silver_order_events_clean": "SELECT * FROM s_events",
    "silver_complaints_clean": "SELECT * FROM s_complaints",
    "silver_weather_enriched": "SELECT * FROM s_weather",
    "band_join_bucketed": f"""
SELECT DISTINCT lower(region) AS city, {_SECONDS.format("order_time")} AS order_second,
  temperature, precipitation, wind_speed, weather_condition
FROM s_weather WHERE weather_condition IS NOT NULL""",
    "silver_deliveries_enriched": "SELECT * FROM s_deliveries",
    "silver_dim_time": "SELECT * FROM s_calendar",
    "silver_order_status_scd2": "SELECT * FROM s_history",
    "gold_complaints_by_type": "SELECT * FROM g_complaints_by_type",
    "gold_delivery_metrics_by_region": _by_region(_REPORTED_LATE),
    "gold_delivery_metrics_by_region_late_fixed": _by_region(_ALL_LATE),
    "gold_delivery_summary_daily": _daily(_REPORTED_LATE),
    "gold_delivery_summary_daily_late_fixed": _daily(_ALL_LATE),
    "gold_daily_business_summary": _business(
        f"(SELECT order_id, {_SEVERE} AS severe FROM s_weather)"
    ),
    "gold_daily_business_summary_per_order": _business(
        f"(SELECT order_id, bool_or({_SEVERE}) AS severe FROM s_weather GROUP BY order_id)"
    ),
    "gold_peak_hours_analysis": _hours(_REPORTED_LATE),
    "gold_peak_hours_analysis_late_fixed": _hours(_ALL_LATE),
    "gold_store_performance": f"""
WITH placed AS (SELECT order_id, store_id, {_REGION} AS region, delivery_delay FROM s_deliveries)
SELECT s.store_id, s.region, round(coalesce(avg_delay, 0), 6) AS avg_delay, orders_total,
  round(coalesce(complaints, 0) / orders_total, 6) AS complaints_rate
FROM (SELECT store_id, region, avg(delivery_delay) AS avg_delay, count(*) AS orders_total
      FROM placed GROUP BY ALL) s
LEFT JOIN (SELECT store_id, region, count(*) AS complaints
      FROM s_complaints JOIN placed USING (order_id) GROUP BY ALL) c
  ON c.store_id = s.store_id AND c.region = s.region""",
    "gold_weather_impact_summary": _impact(_REPORTED_LATE),
    "gold_weather_impact_summary_late_fixed": _impact(_ALL_LATE),
    "dq_orders": _counts("d_orders", _ORDER_RULES, "order_id"),
    "dq_orders_issues": "\nUNION ALL ".join(
        [f"SELECT *, '{n}' AS issue FROM d_orders WHERE {p}" for n, p in _ORDER_RULES.items()]
        + [
            "SELECT *, 'duplicate_order_id' FROM d_orders WHERE order_id IN "
            "(SELECT order_id FROM d_orders GROUP BY order_id HAVING count(*) > 1)"
        ]
    ),
    "dq_complaints": _counts("s_complaints", _COMPLAINT_RULES, "complaint_id"),
    "dq_complaints_valid": f"SELECT * FROM s_complaints WHERE complaint_type IN {_TYPES}",
    "dq_weather": _counts("d_weather", _WEATHER_RULES),
    "dq_weather_valid": """
SELECT * FROM d_weather
WHERE order_id IS NOT NULL AND order_time IS NOT NULL AND region IS NOT NULL
  AND temperature BETWEEN -50 AND 60 AND precipitation >= 0 AND wind_speed BETWEEN 0 AND 300
  AND weather_condition IS NOT NULL""",
    "dq_deliveries": _counts("d_deliveries", _DELIVERY_RULES),
    "dq_order_status": _counts("d_history", _STATUS_RULES),
    "dq_order_status_valid": """
SELECT * FROM d_history
WHERE order_id IS NOT NULL AND status IS NOT NULL AND effective_time IS NOT NULL
  AND ingestion_time IS NOT NULL AND is_current IS NOT NULL""",
    "dq_dim_time": _counts("d_calendar", _CALENDAR_RULES),
    "json_decode_events": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""",
    "late_cutoff_events": """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-12 00:00:00' - INTERVAL 48 HOUR""",
    "pivot_events": """
SELECT user_id, max(ts) FILTER (event_type = 'click') AS click,
  max(ts) FILTER (event_type = 'error') AS error,
  max(ts) FILTER (event_type = 'purchase') AS purchase,
  max(ts) FILTER (event_type = 'view') AS "view"
FROM events GROUP BY user_id""",
    "scd2_events": """
SELECT user_id, event_type AS status, ts AS effective_time,
  lead(ts) OVER w AS end_time, lead(ts) OVER w IS NULL AS is_current
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
}

_NAMES = re.compile(r"\b(?:fx|b|s|d|g|run)_[a-z_]+\b")

# The full run feeds silver from the recent bronze rows: the same definitions on b_ instead of fx_.
PARTS["b_events"] = QUERIES["bronze_order_events"]
PARTS["b_complaints"] = QUERIES["bronze_complaints"]
PARTS["b_weather"] = QUERIES["bronze_weather"]


def _in_full_run(text: str) -> str:
    text = re.sub(r"\bfx_(?=orders|events|complaints|weather)", "b_", text)
    return _NAMES.sub(lambda m: "run_" + m[0] if m[0] in _SILVER else m[0], text)


_SILVER = ("s_orders", "s_events", "s_complaints", "s_weather", "s_deliveries", "s_history")
for _name in _SILVER:
    PARTS[f"run_{_name}"] = _in_full_run(PARTS[_name])

# The job's calendar has fixed bounds; the registered one has those of the data.
_FIXED_CALENDAR = PARTS["s_calendar"].split("FROM (")[0] + (
    "FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2029-12-31', "
    "INTERVAL 1 DAY))::DATE AS date)"
)
_RUN_TABLES = {
    "orders_bronze": "b_orders",
    "order_events_bronze": "b_events",
    "complaints_bronze": "b_complaints",
    "weather_bronze": "b_weather",
    "silver_orders_clean": "run_s_orders",
    "silver_order_events_clean": "run_s_events",
    "silver_complaints_clean": "run_s_complaints",
    "silver_weather_enriched": "run_s_weather",
    "silver_order_status_scd2": "run_s_history",
    "silver_deliveries_enriched": "run_s_deliveries",
    "silver_dim_time": f"({_FIXED_CALENDAR})",
    "gold_complaints_by_type": f"({_in_full_run(PARTS['g_complaints_by_type'])})",
    **{
        name: f"({_in_full_run(QUERIES[name])})"
        for name in (
            "gold_delivery_metrics_by_region",
            "gold_delivery_summary_daily",
            "gold_daily_business_summary",
            "gold_peak_hours_analysis",
            "gold_store_performance",
            "gold_weather_impact_summary",
        )
    },
}
# Columns of the stored tables: n number, s string, t timestamp, d date, b boolean.
_ORDER_IDS = {"order_id": "n", "customer_id": "n", "store_id": "n"}
_MEASURES = {"temperature": "n", "precipitation": "n", "wind_speed": "n", "weather_condition": "s"}
_PLANNED = {"estimated_delivery_time": "t", "actual_delivery_time": "t"}
_COMPLAINT = {
    "complaint_id": "n",
    "order_id": "n",
    "timestamp_received": "t",
    "complaint_type": "s",
    "description": "s",
}
_EVENT = {**_ORDER_IDS, "event_time": "t", "timestamp": "t", "event_type": "s"}
_SHARES = {"late_deliveries_pct": "n", "complaints_pct": "n"}
_RUN_COLUMNS = {
    "orders_bronze": {
        **_ORDER_IDS,
        "event_time": "t",
        "timestamp": "t",
        "delivery_address": "s",
        **_PLANNED,
    },
    "order_events_bronze": _EVENT,
    "complaints_bronze": _COMPLAINT,
    "weather_bronze": {"location": "s", "timestamp": "t", **_MEASURES},
    "silver_orders_clean": {
        **_ORDER_IDS,
        "event_time": "t",
        "order_time": "t",
        "delivery_address": "s",
        **_PLANNED,
        "delivery_delay": "n",
        "status": "s",
    },
    "silver_order_events_clean": _EVENT,
    "silver_complaints_clean": _COMPLAINT,
    "silver_weather_enriched": {"order_id": "n", "order_time": "t", "region": "s", **_MEASURES},
    "silver_order_status_scd2": {
        "order_id": "n",
        "status": "s",
        "effective_time": "t",
        "end_time": "t",
        "is_current": "b",
    },
    "silver_deliveries_enriched": {
        **_ORDER_IDS,
        "region": "s",
        "delivery_address": "s",
        "order_time": "t",
        **_PLANNED,
        "delivery_delay": "n",
        "status": "s",
        "complaint_type": "s",
        "had_complaint": "b",
        **_MEASURES,
        "delay_category": "s",
    },
    "silver_dim_time": {
        "date": "d",
        "day_of_week": "s",
        "is_weekend": "b",
        "is_holiday": "b",
        "is_short_friday": "b",
    },
    "gold_complaints_by_type": {"complaint_type": "s", "count": "n", "percent_of_orders": "n"},
    "gold_delivery_metrics_by_region": {"region": "s", "avg_delivery_time": "n", **_SHARES},
    "gold_delivery_summary_daily": {
        "date": "d",
        "total_orders": "n",
        "late_orders": "n",
        "weather_summary": "s",
    },
    "gold_daily_business_summary": {
        "date": "d",
        "store_id": "n",
        "orders_count": "n",
        "late_count": "n",
        "on_time_count": "n",
        "complaints_count": "n",
        "avg_delivery_delay": "n",
        "avg_prep_time": "n",
        "avg_delivery_time": "n",
        "severe_weather_count": "n",
    },
    "gold_peak_hours_analysis": {
        "hour_of_day": "n",
        "order_count": "n",
        "avg_delivery_delay": "n",
        "late_orders_pct": "n",
    },
    "gold_store_performance": {
        "store_id": "n",
        "region": "s",
        "avg_delay": "n",
        "orders_total": "n",
        "complaints_rate": "n",
    },
    "gold_weather_impact_summary": {
        "weather_condition": "s",
        "avg_delivery_delay": "n",
        **_SHARES,
    },
}
_AS_NUMBER = {
    "n": "{0}::DOUBLE",
    "s": "length({0})::DOUBLE",
    "t": "floor(epoch({0}))::DOUBLE",
    "d": "({0}::DATE - DATE '1970-01-01')::DOUBLE",
    "b": "{0}::INT::DOUBLE",
}


def _column_line(name: str, kind: str) -> str:
    number = _AS_NUMBER[kind].format(f'"{name}"')
    text = f'"{name}"' if kind == "s" else "NULL::VARCHAR"
    return (
        f"{{'column_name': '{name}', 'value_count': count(\"{name}\"), "
        f"'min_value': round(min({number}), 3), 'max_value': round(max({number}), 3), "
        f"'sum_value': round(sum({number}), 3), "
        f"'min_text': min({text}), 'max_text': max({text})}}"
    )


def _content(table: str) -> str:
    lines = ", ".join(_column_line(n, k) for n, k in _RUN_COLUMNS[table].items())
    return (
        f"SELECT '{table}' AS table_name, row_count, unnest(lines, max_depth := 2) "
        f"FROM (SELECT count(*) AS row_count, [{lines}] AS lines FROM {_RUN_TABLES[table]})"
    )


QUERIES["full_run_refreshed"] = "SELECT * FROM run_s_deliveries"
QUERIES["full_run"] = "\nUNION ALL ".join(_content(table) for table in _RUN_TABLES)

_RUN_RULES = {
    "silver_orders_clean": (_ORDER_RULES, "order_id"),
    "silver_complaints_clean": (_COMPLAINT_RULES, "complaint_id"),
    "silver_weather_enriched": (_WEATHER_RULES, None),
    "silver_deliveries_enriched": (_DELIVERY_RULES, None),
    "silver_order_status_scd2": (_STATUS_RULES, None),
    "silver_dim_time": (_CALENDAR_RULES, None),
}


def _with_stamp(table: str) -> str:
    """A stored table has a stamp, which is never null."""
    return f"(SELECT *, TIMESTAMP '{AS_OF}' AS ingestion_time FROM {_RUN_TABLES[table]})"


QUERIES["full_run_quality"] = "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, * FROM ({_counts(_with_stamp(table), *rules)})"
    for table, rules in _RUN_RULES.items()
)


def _needed(text: str, done: list[str]) -> None:
    for name in _NAMES.findall(text):
        if name in PARTS and name not in done:
            _needed(PARTS[name], done)
            done.append(name)


def statement(query: str) -> str:
    parts: list[str] = []
    _needed(query, parts)
    if not parts:
        return query
    chain = ",\n".join(f"{name} AS ({PARTS[name]}\n)" for name in parts)
    return f"WITH {chain}\nSELECT * FROM ({query}\n)"
