"""The registered queries as plain SQL over the provided tables, for DuckDB.

Base tables are common table expressions; a query lists only the ones it reaches.
"""

from __future__ import annotations

import re

from meterlake.plans.tables import AS_OF, REGIONS

_REGION_LIST = ", ".join(f"'{r}'" for r in REGIONS)
_NOW = f"TIMESTAMP '{AS_OF}'"
_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _shown(columns: str) -> str:
    """``name:kind`` words to a select list: d date, t timestamp, f double, i bigint, none as it is."""
    forms = {
        "d": "CAST({c} AS VARCHAR) AS {c}", "t": f"strftime({{c}}, {_STAMP}) AS {{c}}",
        "f": "CAST({c} AS DOUBLE) AS {c}", "i": "CAST({c} AS BIGINT) AS {c}", "": "{c}",
    }
    parts = (word.partition(":") for word in columns.split())
    return ", ".join(forms[kind].format(c=name) for name, _, kind in parts)


def _mean(total: str, rows: str) -> str:
    """Exact mean of a decimal total, half up to four places (totals are not negative)."""
    scaled = f"CAST(CAST({total} AS DECIMAL(38,4)) * 10000 AS HUGEINT)"
    return f"CAST(CAST((2 * {scaled} + {rows}) // (2 * {rows}) AS DOUBLE) / 10000 AS DECIMAL(18,4))"


def _hours(start: str, end: str, unit: str = "hour") -> str:
    return f"date_diff('{unit}', {start}, {end})"


def _reasons(pairs: list[tuple[str, str]], separator: str) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN {reason if reason.startswith('(') else repr(reason)} END" for condition, reason in pairs)
    return f"concat_ws('{separator}', {cases})"


_BLANK = "length(trim(coalesce(CAST({0} AS VARCHAR), ''))) = 0"
_SPARK_DOUBLE = (  # how a small double prints as text in Spark
    "CASE WHEN kwh <> 0 AND abs(kwh) < 0.001 THEN CAST(CAST(round(kwh * 10000) AS INTEGER) AS VARCHAR) || '.0E-4' "
    "ELSE CAST(kwh AS VARCHAR) END")
_TARIFF = ("CASE WHEN customer_segment = 'Small Business' THEN 'T-BIZ-2026' "
           "WHEN household_size <= 2 THEN 'T-ECO-2026' ELSE 'T-STD-2026' END")


def _date_id(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


_BASE: dict[str, str] = {
    "located": """
        SELECT c.*, r.r_regionkey, r.r_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "dim_region": """
        SELECT CAST(r_regionkey + 1 AS INTEGER) AS region_id, r_name AS region_name, 'UK' AS country,
               substr(r_name, 1, 2) AS postcode_area FROM region""",
    "dim_customer": """
        SELECT 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Small Business' WHEN 'MACHINERY' THEN 'Public Sector' ELSE 'Residential' END AS customer_segment,
               CAST(c_custkey % 5 + 1 AS INTEGER) AS household_size, CASE WHEN c_acctbal < 5000 THEN 'flat' ELSE 'house' END AS dwelling_type,
               CAST(r_regionkey + 1 AS INTEGER) AS region_id, DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date,
               c_acctbal >= 0 AS is_active, c_custkey AS k, r_name AS region_name
        FROM located""",
    "dim_meter": """
        SELECT 'MTR-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS meter_id, 'CUST-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS customer_id,
               CAST(p_size % 5 + 1 AS INTEGER) AS region_id, p_type AS meter_type,
               DATE '2015-01-01' + CAST(p_size AS INTEGER) AS installation_date, p_size > 10 AS is_active, p_partkey AS k
        FROM part""",
    "dim_tariff": """
        SELECT * FROM (VALUES ('T-STD-2026', 'Standard', 0.2860::DECIMAL(10,4), 0.5300::DECIMAL(10,4)),
                              ('T-ECO-2026', 'Eco', 0.2510::DECIMAL(10,4), 0.4900::DECIMAL(10,4)),
                              ('T-BIZ-2026', 'Business', 0.3150::DECIMAL(10,4), 0.7200::DECIMAL(10,4)))
               AS t (tariff_id, tariff_name, price_per_kwh, standing_charge_daily)""",
    "dim_date": f"""
        SELECT {_date_id('full_date')} AS date_id, full_date, year(full_date) AS year_number, quarter(full_date) AS quarter_number,
               month(full_date) AS month_number, monthname(full_date) AS month_name, day(full_date) AS day_of_month,
               dayname(full_date) AS day_of_week_name, isodow(full_date) >= 6 AS is_weekend
        FROM (SELECT CAST(o_orderdate AS DATE) AS full_date FROM orders UNION SELECT CAST(ts AS DATE) FROM events)""",
    "readings": """
        SELECT 'evt_' || lpad(CAST(e.event_id AS VARCHAR), 8, '0') AS event_id, 'MTR-' || lpad(CAST(e.user_id AS VARCHAR), 6, '0') AS meter_id,
               'CUST-' || lpad(CAST(e.user_id AS VARCHAR), 6, '0') AS customer_id, l.r_name AS region_name, CAST(l.r_regionkey + 1 AS INTEGER) AS region_id,
               date_trunc('second', e.ts) AS event_timestamp, CAST(date_trunc('second', e.ts) AS DATE) AS reading_date,
               CAST(CAST(e.value AS DECIMAL(12,4)) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(12,4)) AS kwh,
               CASE WHEN e.event_id % 7 <> 0 THEN CAST(230 + e.event_id % 16 AS DOUBLE) END AS voltage,
               CASE e.event_type WHEN 'error' THEN 'anomaly' WHEN 'signup' THEN 'heartbeat' ELSE 'reading' END AS event_type, e.event_id AS n
        FROM events e JOIN located l ON l.c_custkey = e.user_id""",
    "deliveries": """
        SELECT *, unnest(CASE WHEN event_type = 'anomaly' THEN [0, 1] ELSE [0] END) AS copy FROM readings""",
    "dirty": """
        SELECT CASE WHEN copy = 1 AND n % 2 = 0 THEN 'file_resent' ELSE 'file_' || CAST(n % 4 AS VARCHAR) END AS source_file, 'batch_1' AS batch_id,
               CASE WHEN n % 17 = 0 THEN '  ' ELSE meter_id END AS meter_id, customer_id,
               CASE WHEN n % 29 = 0 THEN 'Unknown' ELSE ' ' || region_name END AS region_name,
               CASE WHEN n % 23 = 0 THEN 'not-a-timestamp' ELSE strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') END AS reading_timestamp,
               CASE WHEN n % 31 = 0 THEN 'abc' WHEN n % 19 = 0 THEN '-' || CAST(kwh AS VARCHAR) ELSE CAST(kwh AS VARCHAR) END AS kwh,
               strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp, n, copy
        FROM deliveries""",
    "typed": """
        SELECT source_file, batch_id, meter_id AS raw_meter_id, kwh AS raw_kwh, nullif(trim(meter_id), '') AS meter_id,
               nullif(trim(customer_id), '') AS customer_id, nullif(trim(region_name), '') AS region_name,
               try_cast(reading_timestamp AS TIMESTAMP) AS reading_timestamp, try_cast(kwh AS DOUBLE) AS kwh,
               CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp,
               CAST(json_object('batch_id', batch_id, 'customer_id', customer_id, 'ingestion_timestamp', ingestion_timestamp, 'kwh', kwh,
                    'meter_id', meter_id, 'reading_timestamp', reading_timestamp, 'region_name', region_name, 'source_file', source_file) AS VARCHAR) AS raw_payload
        FROM dirty""",
}

_CONSUMPTION_RULES = [
    ("meter_id IS NULL", "Missing meter_id"), ("customer_id IS NULL", "Missing customer_id"),
    ("reading_timestamp IS NULL", "Invalid reading_timestamp"), ("kwh IS NULL OR NOT isfinite(kwh)", "Missing or invalid kwh"),
    ("kwh < 0", "Negative kwh"), (f"region_name IS NULL OR region_name NOT IN ({_REGION_LIST})", "Invalid region_name"),
]
_ROW_RULES = [
    (_BLANK.format("meter_id"), "Missing meter_id"), (_BLANK.format("customer_id"), "Missing customer_id"),
    ("try_cast(trim(reading_timestamp) AS TIMESTAMP) IS NULL", "Invalid reading_timestamp"), (_BLANK.format("kwh"), "Missing kwh"),
    (f"NOT ({_BLANK.format('kwh')}) AND NOT coalesce(try_cast(kwh AS DOUBLE) >= 0, FALSE)", "Negative or invalid kwh"),
    (f"coalesce(trim(region_name) NOT IN ({_REGION_LIST}), TRUE)", "Invalid region_name"),
]
_BASE["ranked"] = f"""
        SELECT *, meter_id IS NOT NULL AND reading_timestamp IS NOT NULL AND row_number() OVER (
                   PARTITION BY meter_id, reading_timestamp
                   ORDER BY source_file NULLS LAST, batch_id NULLS LAST, {_reasons(_CONSUMPTION_RULES, '; ')} <> '', raw_payload) > 1 AS repeated
        FROM typed"""
_BASE["judged"] = f"""
        SELECT *, {_reasons([*_CONSUMPTION_RULES, ('repeated', 'Duplicate meter_id and reading_timestamp')], '; ')} AS rejection_reason FROM ranked"""
_BASE["consumption_rejects"] = f"""
        SELECT 'bronze_historical_consumption' AS source_system, coalesce(source_file, 'unknown_file') || ':' || coalesce(raw_meter_id, 'missing_meter') AS source_reference,
               raw_payload, rejection_reason, {_NOW} AS rejected_at, batch_id
        FROM judged WHERE rejection_reason <> ''"""

# -- events
_BASE["payloads"] = """
        SELECT n, copy, CASE WHEN n % 37 = 0 THEN substr(t, 1, 40) WHEN n % 41 = 0 THEN '[' || t || ']' ELSE t END AS raw_event_payload FROM (
          SELECT n, copy, '{"event_id":"' || event_id || '","meter_id":"' || CASE WHEN n % 17 = 0 THEN '  ' ELSE meter_id END
            || '","customer_id":"' || customer_id || '","region_name":"' || CASE WHEN n % 29 = 0 THEN 'Unknown' ELSE region_name END
            || '","event_timestamp":"' || CASE WHEN n % 23 = 0 THEN 'not-a-timestamp' ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') END
            || '","kwh":' || CASE WHEN n % 31 = 0 THEN '"abc"' WHEN n % 19 = 0 THEN '-' || CAST(kwh AS VARCHAR) ELSE CAST(kwh AS VARCHAR) END
            || ',"voltage":' || CASE WHEN n % 43 = 0 THEN '0.0' ELSE coalesce(CAST(voltage AS VARCHAR), 'null') END
            || ',"event_type":"' || CASE WHEN n % 47 = 0 THEN 'unknown' ELSE event_type END
            || '","producer_timestamp":"' || strftime(event_timestamp + to_hours(CAST(copy AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') || '"}' AS t
          FROM deliveries)"""


def _field(name: str) -> str:
    return f"CASE WHEN NOT is_malformed THEN json_extract_string(raw_event_payload, '$.{name}') END"


_BASE["parsed"] = f"""
        SELECT raw_event_payload, is_malformed, {', '.join(f'{_field(c)} AS {c}' for c in ('event_id', 'meter_id', 'customer_id', 'region_name', 'event_type'))},
               {_field('event_timestamp')} AS event_timestamp, {_field('producer_timestamp')} AS producer_timestamp,
               try_cast(replace(replace({_field('event_timestamp')}, 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_ts,
               try_cast(replace(replace({_field('producer_timestamp')}, 'T', ' '), 'Z', '') AS TIMESTAMP) AS producer_ts,
               try_cast({_field('kwh')} AS DOUBLE) AS kwh, try_cast({_field('voltage')} AS DOUBLE) AS voltage
        FROM (SELECT raw_event_payload, NOT json_valid(raw_event_payload) OR NOT starts_with(ltrim(raw_event_payload), '{{') AS is_malformed FROM payloads)"""
_EVENT_RULES = [
    ("is_malformed", "Malformed JSON"),
    *[(_BLANK.format(c), f"Missing {c}") for c in ("event_id", "meter_id", "customer_id")],
    (f"region_name IS NULL OR region_name NOT IN ({_REGION_LIST})", "Invalid region_name"), ("event_ts IS NULL", "Invalid event_timestamp"),
    ("producer_ts IS NULL", "Invalid producer_timestamp"), ("kwh IS NULL OR NOT isfinite(kwh)", "Missing or invalid kwh"), ("kwh < 0", "Negative kwh"),
    ("voltage <= 0", "Invalid voltage"), ("event_type IS NULL OR event_type NOT IN ('reading', 'anomaly', 'heartbeat')", "Invalid event_type"),
    ("event_id IS NOT NULL AND place > 1", "Duplicate event_id in micro-batch"),
]
_BASE["judged_events"] = f"""
        SELECT *, {_reasons(_EVENT_RULES, ';')} AS rejection_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY raw_event_payload) AS place FROM parsed)"""
_BASE["good_events"] = f"""
        SELECT event_id, meter_id, customer_id, region_name, event_ts AS event_timestamp, kwh, voltage, event_type, 'local_file_stream' AS source_system,
               producer_ts AS producer_timestamp, {_NOW} AS ingestion_timestamp,
               sha256(event_id || '||' || meter_id || '||' || strftime(event_ts, {_STAMP})) AS record_hash, {_NOW} AS processed_timestamp
        FROM judged_events WHERE rejection_reason = ''"""
_FIELDS = ("event_id", "meter_id", "customer_id", "region_name", "event_timestamp", "kwh", "event_type", "source_system", "producer_timestamp")
_MISSING = "(concat_ws(', ', " + ", ".join(f"CASE WHEN {_BLANK.format(c)} THEN '{c}' END" for c in _FIELDS) + "))"
_BASE["row_events"] = f"""
        SELECT *, {_reasons([
            (f"{_MISSING} <> ''", f"('Missing required fields: ' || {_MISSING})"),
            (f"NOT ({_BLANK.format('region_name')}) AND trim(region_name) NOT IN ({_REGION_LIST})", "Invalid region_name"),
            (f"NOT ({_BLANK.format('event_timestamp')}) AND event_ts IS NULL", "Invalid event_timestamp"),
            ("NOT coalesce(kwh >= 0, TRUE)", "Negative or invalid kwh"), ("voltage <= 0", "Invalid voltage"),
            (f"NOT ({_BLANK.format('event_type')}) AND trim(event_type) NOT IN ('reading', 'anomaly', 'heartbeat')", "Invalid event_type"),
        ], '; ')} AS rejection_reason
        FROM (SELECT *, CASE WHEN voltage > 231 THEN 'local_file_stream' END AS source_system FROM parsed WHERE NOT is_malformed)"""

# -- weather
_BASE["weather_raw"] = """
        SELECT CASE WHEN n % 13 = 0 THEN 'yesterday' ELSE strftime(hour_at, '%Y-%m-%d %H:%M:%S') END AS weather_timestamp,
               CASE WHEN n % 11 = 0 THEN '' ELSE region_name END AS region_name, CASE WHEN n % 7 = 0 THEN 'cold' ELSE CAST(low AS VARCHAR) END AS temperature_c,
               CAST(high AS VARCHAR) AS humidity_percent, CAST(c AS VARCHAR) AS wind_speed_kph, '0.0' AS precipitation_mm,
               strftime(hour_at, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp
        FROM (SELECT region_name, date_trunc('hour', event_timestamp) AS hour_at, min(kwh) AS low, max(kwh) AS high, count(*) AS c, min(n) AS n
              FROM readings GROUP BY ALL)"""
_BASE["weather"] = f"""
        SELECT *, {_reasons([("weather_at IS NULL", "Invalid weather_timestamp"), ("temperature IS NULL", "Missing or invalid temperature_c"),
                             (f"region IS NULL OR region NOT IN ({_REGION_LIST})", "Invalid region_name")], '; ')} AS rejection_reason
        FROM (SELECT *, try_cast(weather_timestamp AS TIMESTAMP) AS weather_at, try_cast(temperature_c AS DOUBLE) AS temperature, nullif(trim(region_name), '') AS region,
                     CAST(json_object('humidity_percent', humidity_percent, 'ingestion_timestamp', ingestion_timestamp, 'precipitation_mm', precipitation_mm,
                       'region_name', region_name, 'temperature_c', temperature_c, 'weather_timestamp', weather_timestamp, 'wind_speed_kph', wind_speed_kph) AS VARCHAR) AS raw_payload
              FROM weather_raw)"""
_BASE["weather_good"] = f"""
        SELECT region AS region_name, weather_at AS weather_timestamp, CAST(weather_at AS DATE) AS weather_date, hour(weather_at) AS weather_hour,
               temperature AS temperature_c, CAST(humidity_percent AS DOUBLE) AS humidity_percent, CAST(wind_speed_kph AS DOUBLE) AS wind_speed_kph,
               CAST(precipitation_mm AS DOUBLE) AS precipitation_mm, CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp, {_NOW} AS processed_timestamp
        FROM weather WHERE rejection_reason = ''"""
_BASE["weather_rejects"] = f"""
        SELECT 'bronze_weather' AS source_system, 'weather:' || coalesce(region_name, 'missing_region') AS source_reference, raw_payload, rejection_reason,
               {_NOW} AS rejected_at, CAST(NULL AS VARCHAR) AS batch_id
        FROM weather WHERE rejection_reason <> ''"""

# -- aggregates of readings
_BASE["daily"] = f"""
        SELECT reading_date, region_name, sum(kwh) AS total_kwh, {_mean('sum(kwh)', 'count(*)')} AS average_kwh, count(*) AS reading_count,
               count(DISTINCT meter_id) AS unique_meter_count FROM readings GROUP BY ALL"""
_BASE["hourly"] = """
        SELECT date_trunc('hour', event_timestamp) AS window_start, date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end, region_name,
               sum(kwh) AS total_kwh, count(*) AS event_count, count(DISTINCT meter_id) AS unique_meter_count
        FROM readings WHERE event_type <> 'heartbeat' GROUP BY ALL"""
_BASE["found"] = f"""
        SELECT 'anom_' || event_id AS anomaly_id, event_id, meter_id, customer_id, region_name, region_id, event_timestamp,
               CASE WHEN event_type = 'anomaly' THEN 'producer_flagged_anomaly' ELSE 'high_kwh_threshold' END AS anomaly_type,
               CASE WHEN kwh > 10 THEN 0.95 ELSE 0.75 END AS anomaly_score, kwh, {_NOW} AS detected_at, 'meter_stream' AS source_system
        FROM readings WHERE event_type = 'anomaly' OR kwh > 10"""

# -- star schema
_BASE["fact_consumption"] = f"""
        SELECT f.*, CAST(round(CAST(kwh * price_per_kwh AS DECIMAL(24,8)) + standing_charge_daily, 4) AS DECIMAL(12,4)) AS estimated_cost
        FROM (SELECT l_orderkey * 10 + l_linenumber AS consumption_id, 'MTR-' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS meter_id, customer_id, region_id,
                     CASE WHEN l_returnflag <> 'N' THEN {_TARIFF} END AS tariff_id, {_TARIFF} AS tariff, {_date_id('o_orderdate')} AS date_id,
                     CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '23:59:59' AS reading_timestamp, CAST(l_quantity AS DECIMAL(12,4)) AS kwh,
                     'batch_load' AS source_system, 'batch_' || CAST(year(o_orderdate) AS VARCHAR) AS batch_id, l_linenumber, l_returnflag, l_linestatus
              FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN dim_customer ON k = o_custkey) f
        JOIN dim_tariff t ON t.tariff_id = f.tariff"""
_BASE["faulty"] = """
        SELECT * REPLACE (
            CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' AND l_linenumber = 1 AND l_linestatus = 'O' THEN 'MTR-X' ELSE meter_id END AS meter_id,
            CASE WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN 'CUST-X' ELSE customer_id END AS customer_id,
            CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN -1 ELSE region_id END AS region_id,
            CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'T-OLD' ELSE tariff_id END AS tariff_id,
            CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN -kwh ELSE kwh END AS kwh,
            CASE WHEN l_returnflag = 'A' AND l_linenumber = 3 THEN 19000101 ELSE date_id END AS date_id)
        FROM fact_consumption"""
_BASE["fact_reading"] = f"""
        SELECT event_id AS reading_id, meter_id, customer_id, region_id, {_date_id('event_timestamp')} AS date_id, event_timestamp, kwh,
               coalesce(nullif(voltage, 0), 230.0) AS voltage, 'meter_stream' AS source_system, event_id, event_type FROM readings"""
_BASE["fact_anomaly"] = f"""
        SELECT anomaly_id, event_id AS reading_id, meter_id, region_id, {_date_id('event_timestamp')} AS date_id, anomaly_type, anomaly_score, kwh,
               CAST(NULL AS DECIMAL(12,4)) AS expected_kwh, event_timestamp + INTERVAL 5 MINUTE AS detected_at, source_system FROM found"""
_BASE["pipeline_run"] = """
        SELECT 'RUN-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS pipeline_run_id, 'load_' || substr(o_orderpriority, 1, 1) AS pipeline_name,
               CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'streaming' ELSE 'batch' END AS pipeline_type,
               CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
               o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS started_at,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_seconds(o_orderkey * 37 % 86400) + to_seconds(amount % 7200) END AS finished_at,
               amount AS records_read, amount - amount % 100 AS records_written, amount % 100 AS records_rejected,
               CASE WHEN o_orderstatus = 'P' THEN 'order ' || CAST(o_orderkey AS VARCHAR) || ' did not load' END AS error_message
        FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders)"""
_BASE["quality_check"] = """
        SELECT 'DQ-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER) AS check_id,
               'RUN-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS pipeline_run_id, 'check_' || l_linenumber AS check_name,
               CASE WHEN l_linestatus = 'O' THEN 'fact_consumption' ELSE 'fact_reading' END AS table_name,
               CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'passed' ELSE 'warning' END AS status,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS failed_count, l_shipdate AS checked_at
        FROM lineitem"""

# -- serving views
_BASE["v_daily"] = f"""
        SELECT full_date AS reading_date, region_name, sum(kwh) AS total_kwh, {_mean('sum(kwh)', 'count(*)')} AS average_kwh, count(*) AS reading_count,
               count(DISTINCT meter_id) AS unique_meter_count
        FROM fact_consumption f JOIN dim_date USING (date_id) JOIN dim_region r USING (region_id) GROUP BY ALL"""
_BASE["v_monthly"] = f"""
        SELECT year(reading_date) AS year_number, month(reading_date) AS month_number, region_name, sum(total_kwh) AS total_kwh,
               {_mean('sum(total_kwh)', 'count(*)')} AS average_daily_kwh, max(unique_meter_count) AS unique_meter_count FROM v_daily GROUP BY ALL"""
_BASE["v_customer"] = f"""
        SELECT c.customer_id, c.customer_segment, r.region_name, sum(f.kwh) AS total_kwh, max(m.average_daily_kwh) AS average_daily_kwh,
               min(f.reading_timestamp) AS first_reading_timestamp, max(f.reading_timestamp) AS last_reading_timestamp
        FROM fact_consumption f JOIN dim_customer c ON c.customer_id = f.customer_id JOIN dim_region r ON r.region_id = f.region_id
        JOIN (SELECT customer_id, {_mean('sum(day_kwh)', 'count(*)')} AS average_daily_kwh
              FROM (SELECT customer_id, full_date, sum(kwh) AS day_kwh FROM fact_consumption JOIN dim_date USING (date_id) GROUP BY ALL) GROUP BY customer_id) m
          ON m.customer_id = f.customer_id
        GROUP BY c.customer_id, c.customer_segment, r.region_name"""
_BASE["v_latest"] = """
        SELECT meter_id, customer_id, region_name, event_timestamp, kwh, voltage
        FROM fact_reading JOIN dim_region USING (region_id)
        QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY event_timestamp DESC, reading_id DESC) = 1"""
_BASE["v_anomaly"] = """
        SELECT anomaly_id, meter_id, region_name, anomaly_type, anomaly_score, kwh, detected_at, source_system FROM fact_anomaly JOIN dim_region USING (region_id)"""
_BASE["v_runs"] = f"""
        SELECT pipeline_run_id, pipeline_name, pipeline_type, status, started_at, finished_at,
               {_hours('started_at', f'coalesce(finished_at, {_NOW})', 'second')} AS duration_seconds, records_read, records_written, records_rejected, error_message
        FROM pipeline_run"""
_BASE["v_kpis"] = """
        SELECT (SELECT coalesce(sum(kwh), 0) FROM fact_consumption) AS total_kwh, (SELECT count(*) FROM customer) AS total_customers,
               (SELECT count(*) FROM part) AS total_meters, (SELECT count(*) FROM fact_anomaly) AS total_anomalies,
               (SELECT max(t) FROM (SELECT max(reading_timestamp) AS t FROM fact_consumption UNION ALL SELECT max(event_timestamp) FROM fact_reading)) AS latest_reading_timestamp,
               (SELECT count(*) FROM pipeline_run WHERE status = 'failed') AS failed_pipeline_runs,
               (SELECT count(*) FROM quality_check WHERE status = 'failed') AS failed_data_quality_checks"""


def sql(body: str) -> str:
    """Put the base tables ``body`` reaches, directly or not, in front of it."""
    needed: set[str] = set()
    frontier = [body]
    while frontier:
        words = set(re.findall(r"\w+", frontier.pop()))
        fresh = (words & _BASE.keys()) - needed
        needed |= fresh
        frontier += [_BASE[name] for name in fresh]
    # _BASE lists every table after the ones it reads
    tables = ",\n".join(f"{name} AS ({text})" for name, text in _BASE.items() if name in needed)
    return f"WITH {tables}\n{body}" if tables else body


def _rows(table: str, columns: str, tail: str = "") -> str:
    return sql(f"SELECT {_shown(columns)} FROM {table} {tail}")


_ANOMALY = "anomaly_id meter_id region_name anomaly_type anomaly_score:f kwh:f detected_at:t source_system"
_VIEW_DAILY = "reading_date:d region_name total_kwh:f average_kwh:f reading_count:i unique_meter_count:i"
_VIEW_MONTHLY = "year_number:i month_number:i region_name total_kwh:f average_daily_kwh:f unique_meter_count:i"
_VIEW_CUSTOMER = "customer_id customer_segment region_name total_kwh:f average_daily_kwh:f first_reading_timestamp:t last_reading_timestamp:t"
_VIEW_LATEST = "meter_id customer_id region_name event_timestamp:t kwh:f voltage:f"
_VIEW_CHECKS = "check_id pipeline_run_id check_name table_name status failed_count:i checked_at:t"
_VIEW_RUNS = ("pipeline_run_id pipeline_name pipeline_type status started_at:t finished_at:t duration_seconds:i records_read:i "
              "records_written:i records_rejected:i error_message")
_RUNS = _VIEW_RUNS.replace("duration_seconds:i ", "")
_KPIS = ("total_kwh:f total_customers:i total_meters:i total_anomalies:i latest_reading_timestamp:t failed_pipeline_runs:i failed_data_quality_checks:i")
_REJECTS = "source_system source_reference raw_payload rejection_reason rejected_at:t batch_id"
_EVENTS = ("event_id meter_id customer_id region_name event_timestamp:t kwh voltage event_type source_system producer_timestamp:t "
           "ingestion_timestamp:t record_hash processed_timestamp:t")
_WEATHER = ("region_name weather_timestamp:t weather_date:d weather_hour:i temperature_c humidity_percent wind_speed_kph precipitation_mm "
            "ingestion_timestamp:t processed_timestamp:t")
_HOURLY = "window_start:t window_end:t region_name total_kwh:f event_count:i unique_meter_count:i"
_FACT = "FROM fact_consumption f JOIN dim_date d USING (date_id) JOIN dim_region r ON r.region_id = f.region_id"

ORACLE: dict[str, str] = {
    # typing, rules, cleaning
    "clean_text_typed": _rows("typed", "source_file batch_id meter_id customer_id region_name reading_timestamp:t kwh"),
    "rejection_reasons": sql(f"SELECT source_file, customer_id, raw_kwh, {_reasons(_CONSUMPTION_RULES, '; ')} AS rejection_reason FROM typed"),
    "row_rules": sql(f"SELECT source_file, customer_id, kwh, {_reasons(_ROW_RULES, '; ')} AS rejection_reason FROM dirty"),
    "rejects_by_reason": sql(f"""SELECT rejection_reason, count(*) AS rejected_count, strftime(min(rejected_at), {_STAMP}) AS first_rejected_at,
        strftime(max(rejected_at), {_STAMP}) AS latest_rejected_at FROM consumption_rejects GROUP BY rejection_reason"""),
    "event_rules": _rows("judged_events", "raw_event_payload rejection_reason"),
    "event_row_rules": _rows("row_events", "event_id producer_timestamp rejection_reason"),
    "classify_events": sql("""SELECT event_id, producer_timestamp, CASE WHEN rejection_reason <> '' THEN 'invalid' WHEN event_type = 'heartbeat' THEN 'heartbeat'
        WHEN event_type = 'anomaly' OR kwh > 10 THEN 'anomaly' ELSE 'reading' END AS event_class FROM row_events"""),
    "clean_consumption": sql(f"""SELECT batch_id, meter_id, customer_id, region_name, strftime(reading_timestamp, {_STAMP}) AS reading_timestamp,
        CAST(CAST(reading_timestamp AS DATE) AS VARCHAR) AS reading_date, hour(reading_timestamp) AS reading_hour, kwh, source_file,
        strftime(ingestion_timestamp, {_STAMP}) AS ingestion_timestamp,
        sha256(meter_id || '||' || customer_id || '||' || strftime(reading_timestamp, {_STAMP}) || '||' || {_SPARK_DOUBLE}) AS record_hash,
        '{AS_OF}' AS processed_timestamp FROM judged WHERE rejection_reason = ''"""),
    "rejected_consumption": _rows("consumption_rejects", _REJECTS),
    "clean_weather": _rows("weather_good", _WEATHER),
    "rejected_weather": _rows("weather_rejects", _REJECTS),
    "all_rejects": sql("""SELECT source_system, rejection_reason, count(*) AS rejected_count
        FROM (SELECT source_system, rejection_reason FROM consumption_rejects UNION ALL SELECT source_system, rejection_reason FROM weather_rejects) GROUP BY ALL"""),
    "clean_customers": sql("""SELECT customer_id, customer_segment, CAST(household_size AS BIGINT) AS household_size, dwelling_type, region_name, 'UK' AS country,
        substr(region_name, 1, 2) || '0' AS postcode_area, CASE WHEN k % 11 <> 0 THEN CAST(signup_date AS VARCHAR) END AS signup_date, is_active
        FROM dim_customer WHERE k % 53 <> 0"""),
    "clean_meters": sql("""SELECT meter_id, customer_id, region_name, meter_type, CAST(installation_date AS VARCHAR) AS installation_date, is_active
        FROM dim_meter JOIN dim_region USING (region_id)"""),
    "parse_events": _rows("parsed", "raw_event_payload is_malformed event_id meter_id kwh voltage event_ts:t producer_ts:t"),
    "clean_events": _rows("good_events", _EVENTS),
    "rejected_events": sql(f"""SELECT raw_event_payload, rejection_reason, '{AS_OF}' AS rejected_at, 'local_file_stream' AS source_system
        FROM judged_events WHERE rejection_reason <> ''"""),
    # aggregates
    "daily_region": _rows("daily", _VIEW_DAILY),
    "daily_customer": sql("""SELECT CAST(reading_date AS VARCHAR) AS reading_date, customer_id, meter_id, region_name, CAST(sum(kwh) AS DOUBLE) AS total_kwh,
        count(*) AS reading_count FROM readings GROUP BY ALL"""),
    "monthly_region": sql(f"""SELECT year(reading_date) AS year_number, month(reading_date) AS month_number, region_name, CAST(sum(total_kwh) AS DOUBLE) AS total_kwh,
        CAST({_mean('sum(total_kwh)', 'count(*)')} AS DOUBLE) AS average_daily_kwh, max(unique_meter_count) AS unique_meter_count FROM daily GROUP BY ALL"""),
    "customer_usage": sql(f"""SELECT customer_id, region_name, CAST(sum(day_kwh) AS DOUBLE) AS total_kwh,
        CAST({_mean('sum(day_kwh)', 'count(*)')} AS DOUBLE) AS average_daily_kwh, count(*) AS active_days,
        strftime(min(a), {_STAMP}) AS first_reading_timestamp, strftime(max(b), {_STAMP}) AS last_reading_timestamp
        FROM (SELECT customer_id, region_name, reading_date, sum(kwh) AS day_kwh, min(event_timestamp) AS a, max(event_timestamp) AS b FROM readings GROUP BY ALL)
        GROUP BY customer_id, region_name"""),
    "average_of_daily_sums": sql(f"""SELECT region_name, CAST({_mean('sum(total_kwh)', 'count(*)')} AS DOUBLE) AS average_daily_kwh FROM daily GROUP BY region_name"""),
    "activity_span": sql(f"""SELECT customer_id, count(DISTINCT reading_date) AS active_days, strftime(min(event_timestamp), {_STAMP}) AS first_reading_timestamp,
        strftime(max(event_timestamp), {_STAMP}) AS last_reading_timestamp FROM readings GROUP BY customer_id"""),
    "weather_features": sql(f"""SELECT strftime(event_timestamp, {_STAMP}) AS reading_timestamp, CAST(reading_date AS VARCHAR) AS reading_date,
        hour(event_timestamp) AS reading_hour, r.region_name, meter_id, customer_id, CAST(kwh AS DOUBLE) AS kwh,
        temperature_c, humidity_percent, wind_speed_kph, precipitation_mm
        FROM readings r LEFT JOIN weather_good w ON w.region_name = r.region_name AND w.weather_date = r.reading_date AND w.weather_hour = hour(r.event_timestamp)"""),
    "hourly_region": _rows("hourly", _HOURLY),
    "anomalies": _rows("found", "anomaly_id event_id meter_id customer_id region_name event_timestamp:t anomaly_type anomaly_score:f kwh:f detected_at:t source_system"),
    "duplicate_keys": sql("SELECT meter_id, reading_timestamp, count(*) AS duplicate_count FROM dirty GROUP BY ALL HAVING count(*) > 1"),
    "duplicate_event_ids": sql("SELECT event_id, count(*) AS duplicate_count FROM parsed WHERE event_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1"),
    "table_counts": sql(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (
        "dim_region", "dim_customer", "dim_meter", "dim_tariff", "dim_date", "fact_consumption", "fact_reading", "fact_anomaly", "pipeline_run", "quality_check"))),
    "region_month_matrix": sql("SELECT year_number, region_name, " + ", ".join(
        f"CAST(sum(CASE WHEN month_number = {m} THEN total_kwh END) AS DOUBLE) AS month_{m:02d}" for m in range(1, 13)) + " FROM v_monthly GROUP BY ALL"),
    # windows and limits
    "dedup_latest_per_key": sql("""SELECT source_file, batch_id, meter_id, customer_id, region_name, reading_timestamp, kwh, ingestion_timestamp FROM dirty
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ingestion_timestamp DESC, source_file DESC, kwh DESC, meter_id DESC) = 1"""),
    "latest_reading": sql(f"""SELECT event_id, meter_id, customer_id, region_name, strftime(event_timestamp, {_STAMP}) AS event_timestamp, CAST(kwh AS DOUBLE) AS kwh,
        voltage, event_type, 'meter_stream' AS source_system FROM readings WHERE event_type <> 'heartbeat'
        QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY event_timestamp DESC, event_id DESC) = 1"""),
    "row_number_per_key": sql(f"""SELECT region_name, event_id, strftime(event_timestamp, {_STAMP}) AS event_timestamp,
        row_number() OVER (PARTITION BY region_name ORDER BY event_timestamp, event_id) AS row_number FROM readings"""),
    "running_sum": sql(f"""SELECT region_name, event_id, strftime(event_timestamp, {_STAMP}) AS event_timestamp, CAST(kwh AS DOUBLE) AS kwh,
        CAST(sum(kwh) OVER (PARTITION BY region_name ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_kwh FROM readings"""),
    "recent_avg_anomaly": sql(f"""SELECT meter_id, event_id, strftime(event_timestamp, {_STAMP}) AS event_timestamp, CAST(kwh AS DOUBLE) AS kwh
        FROM (SELECT *, sum(kwh) OVER w AS s, count(*) OVER w AS c FROM readings
              WINDOW w AS (PARTITION BY meter_id ORDER BY event_timestamp, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
        WHERE s > 0 AND kwh * c > 3 * s"""),
    "event_numbers": sql("SELECT event_id, meter_id, row_number() OVER (ORDER BY meter_id, event_id) AS sequence_number FROM readings"),
    "top_latest": sql(f"""SELECT event_id, meter_id, strftime(event_timestamp, {_STAMP}) AS event_timestamp, CAST(kwh AS DOUBLE) AS kwh
        FROM (SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY event_timestamp DESC, event_id DESC) = 1) ORDER BY kwh DESC, meter_id LIMIT 10"""),
    "newest_anomalies": _rows("v_anomaly a", _ANOMALY, "WHERE region_name = 'ASIA' ORDER BY a.detected_at DESC, anomaly_id LIMIT 100"),
    # joins
    "range_join": sql(f"""SELECT customer_id, CAST(signup_date AS VARCHAR) AS signup_date, CAST(signup_date + household_size * 7 AS VARCHAR) AS trial_end,
        CAST(CAST(g.day AS DATE) AS VARCHAR) AS full_date, CAST({_date_id('g.day')} AS BIGINT) AS date_id, isodow(g.day) >= 6 AS is_weekend
        FROM dim_customer JOIN (SELECT unnest(generate_series(min(signup_date)::TIMESTAMP, max(signup_date + household_size * 7)::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM dim_customer) g
        ON g.day BETWEEN signup_date AND signup_date + household_size * 7"""),
    "range_join_times": sql(f"""SELECT h.event_id AS heartbeat_id, r.event_id, strftime(r.event_timestamp, {_STAMP}) AS event_timestamp FROM readings h JOIN readings r
        ON r.region_name = h.region_name AND r.event_timestamp BETWEEN h.event_timestamp AND h.event_timestamp + to_minutes(CAST(h.n % 7 * 10 AS INTEGER))
        WHERE h.event_type = 'heartbeat' AND r.event_type <> 'heartbeat'"""),
    "meter_slots": sql(f"""SELECT meter_id, CAST(slot_number AS BIGINT) AS slot_number,
        strftime(TIMESTAMP '2026-01-14' + to_hours(CAST((slot_number - 1) * 4 AS INTEGER)), {_STAMP}) AS event_timestamp,
        'READ-' || meter_id || '-0' || slot_number AS reading_id FROM (SELECT meter_id, unnest([1, 2, 3, 4, 5, 6]) AS slot_number FROM dim_meter)"""),
    "anomaly_readings": sql(f"""SELECT reading_id, anomaly_id, CAST(anomaly_score AS DOUBLE) AS anomaly_score, r.meter_id, strftime(r.event_timestamp, {_STAMP}) AS event_timestamp,
        CAST(r.kwh AS DOUBLE) AS kwh, r.voltage FROM fact_anomaly a JOIN fact_reading r USING (reading_id)"""),
    "inactive_parent": sql("""SELECT m.customer_id, m.meter_id, m.is_active AS child_is_active, c.is_active AS parent_is_active
        FROM dim_meter m JOIN dim_customer c ON c.customer_id = m.customer_id WHERE m.is_active AND NOT c.is_active"""),
    "lookup_rejects": sql("""SELECT consumption_id, customer_id, CAST(kwh AS DOUBLE) AS kwh FROM faulty f
        WHERE NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)"""),
    # star schema
    "dim_date": _rows("dim_date", "date_id:i full_date:d year_number:i quarter_number:i month_number:i month_name day_of_month:i day_of_week_name is_weekend"),
    "dim_region": sql("""SELECT region_name, row_number() OVER (ORDER BY region_name) AS region_id, 'UK' AS country, substr(region_name, 1, 2) || '0' AS postcode_area
        FROM (SELECT DISTINCT region_name FROM dim_customer WHERE k % 53 <> 0)"""),
    "surrogate_keys": sql("""SELECT p_type, CASE WHEN p_type < 'M' THEN known_no ELSE (SELECT count(DISTINCT p_type) FROM part WHERE p_type < 'M') + new_no END AS type_id
        FROM (SELECT p_type, row_number() OVER (PARTITION BY p_type < 'M' ORDER BY p_type DESC) AS known_no, row_number() OVER (PARTITION BY p_type < 'M' ORDER BY p_type) AS new_no
              FROM (SELECT DISTINCT p_type FROM part))"""),
    "upsert_dim": sql(f"""SELECT customer_id, customer_segment, CAST(household_size + CASE WHEN is_active THEN 1 ELSE 0 END AS BIGINT) AS household_size, is_active,
        CASE WHEN customer_segment <> 'Public Sector' THEN '2023-01-01 00:00:00' ELSE '{AS_OF}' END AS created_at
        FROM dim_customer WHERE customer_segment <> 'Public Sector' OR is_active"""),
    "upsert_changes": sql(f"""SELECT customer_id, customer_segment, CAST(household_size + CASE WHEN is_active THEN 1 ELSE 0 END AS BIGINT) AS household_size, is_active,
        CASE WHEN customer_segment <> 'Public Sector' THEN '2023-01-01 00:00:00' ELSE '{AS_OF}' END AS created_at
        FROM dim_customer WHERE customer_segment <> 'Public Sector' OR is_active"""),
    "dim_history": sql(f"""SELECT customer_id, customer_segment, CAST(household_size AS BIGINT) AS household_size, is_active, '2023-01-01 00:00:00' AS valid_from,
        CASE WHEN is_active THEN '{AS_OF}' END AS valid_to FROM dim_customer WHERE customer_segment <> 'Public Sector'
        UNION ALL SELECT customer_id, customer_segment, CAST(household_size + 1 AS BIGINT), is_active, '{AS_OF}', NULL FROM dim_customer WHERE is_active"""),
    "insert_missing": sql("SELECT reading_id, meter_id, CAST(CASE WHEN event_type = 'reading' THEN 0 ELSE kwh END AS DOUBLE) AS kwh FROM fact_reading"),
    "consumption_fact": sql(f"""SELECT meter_id, customer_id, CAST(region_id AS BIGINT) AS region_id, tariff_id, CAST({_date_id('reading_date')} AS BIGINT) AS date_id,
        CAST(reading_date AS VARCHAR) || ' 23:59:59' AS reading_timestamp, CAST(kwh AS DOUBLE) AS kwh,
        CAST(CAST(round(CAST(kwh * price_per_kwh AS DECIMAL(24,8)) + standing_charge_daily, 4) AS DECIMAL(12,4)) AS DOUBLE) AS estimated_cost,
        'phase2_gold' AS source_system, 'batch_7' AS batch_id
        FROM (SELECT r.meter_id, r.customer_id, r.region_id, r.reading_date, {_TARIFF} AS tariff_id, CAST(sum(kwh) AS DECIMAL(12,4)) AS kwh
              FROM readings r JOIN dim_customer c ON c.customer_id = r.customer_id GROUP BY ALL) JOIN dim_tariff USING (tariff_id)"""),
    "readings_fact": _rows("fact_reading", "reading_id meter_id customer_id region_id:i date_id:i event_timestamp:t kwh:f voltage:f source_system event_id"),
    "anomalies_fact": sql(f"""SELECT anomaly_id, event_id AS reading_id, meter_id, CAST(region_id AS BIGINT) AS region_id, CAST({_date_id('event_timestamp')} AS BIGINT) AS date_id,
        anomaly_type, CAST(anomaly_score AS DOUBLE) AS anomaly_score, CAST(kwh AS DOUBLE) AS kwh, '{AS_OF}' AS detected_at, source_system
        FROM found WHERE region_name <> 'ASIA'"""),
    "replace_batch": sql("""SELECT consumption_id, meter_id, CAST(kwh + CASE WHEN batch_id = 'batch_1996' THEN 1 ELSE 0 END AS DOUBLE) AS kwh, batch_id FROM fact_consumption"""),
    "replay_events": sql(f"""SELECT event_id, '{{"event_id":"' || event_id || '","meter_id":"' || meter_id || '","customer_id":"' || customer_id || '","region_name":"' || region_name
          || '","event_timestamp":"' || coalesce(strftime(try_cast(reading_timestamp AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ'), reading_timestamp)
          || '","voltage":230.0,"event_type":"' || CASE WHEN kwh > 10 THEN 'anomaly' ELSE 'reading' END
          || '","source_system":"batch_replay_stream","producer_timestamp":"' || strftime({_NOW}, '%Y-%m-%dT%H:%M:%SZ')
          || '","kwh":' || coalesce({_SPARK_DOUBLE}, '"' || raw_kwh || '"') || '}}' AS value
        FROM (SELECT * REPLACE (try_cast(kwh AS DOUBLE) AS kwh), kwh AS raw_kwh,
                     'replay_evt_' || lpad(CAST(row_number() OVER (ORDER BY source_file, customer_id, ingestion_timestamp, kwh, meter_id) AS VARCHAR), 8, '0') AS event_id
              FROM dirty)"""),
    # analytics
    "star_daily": sql(f"""SELECT CAST(full_date AS VARCHAR) AS full_date, region_name, CAST(sum(kwh) AS DOUBLE) AS total_kwh,
        CAST(sum(estimated_cost) AS DOUBLE) AS total_estimated_cost, count(*) AS reading_count {_FACT} GROUP BY ALL"""),
    "star_monthly": sql(f"""SELECT year_number, month_number, month_name, region_name, CAST(sum(kwh) AS DOUBLE) AS total_kwh,
        CAST(sum(estimated_cost) AS DOUBLE) AS total_estimated_cost {_FACT} GROUP BY ALL"""),
    "top_meters": sql("""SELECT meter_id, customer_segment, r.region_name, CAST(sum(kwh) AS DOUBLE) AS total_kwh, CAST(sum(estimated_cost) AS DOUBLE) AS total_estimated_cost
        FROM fact_consumption f JOIN dim_customer c ON c.customer_id = f.customer_id JOIN dim_region r ON r.region_id = f.region_id
        GROUP BY meter_id, customer_segment, r.region_name ORDER BY sum(kwh) DESC, meter_id, customer_segment, r.region_name LIMIT 5"""),
    "latest_by_meter": sql(f"""SELECT reading_id, meter_id, strftime(event_timestamp, {_STAMP}) AS event_timestamp, CAST(kwh AS DOUBLE) AS kwh, voltage FROM fact_reading
        QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY event_timestamp DESC, reading_id DESC) = 1"""),
    "running_daily": sql(f"""SELECT CAST(full_date AS VARCHAR) AS full_date, region_name, CAST(day_kwh AS DOUBLE) AS daily_kwh,
        CAST(sum(day_kwh) OVER (PARTITION BY region_name ORDER BY full_date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_region_kwh
        FROM (SELECT d.full_date, r.region_name, sum(kwh) AS day_kwh {_FACT} GROUP BY ALL)"""),
    "segment_average": sql(f"""SELECT customer_segment, count(DISTINCT c.customer_id) AS customer_count, count(*) AS fact_row_count,
        CAST({_mean('sum(kwh)', 'count(*)')} AS DOUBLE) AS average_daily_kwh, CAST(sum(kwh) AS DOUBLE) AS total_kwh
        FROM fact_consumption f JOIN dim_customer c ON c.customer_id = f.customer_id GROUP BY customer_segment"""),
    "tariff_cost": sql("""SELECT t.tariff_id, t.tariff_name, CAST(t.price_per_kwh AS DOUBLE) AS price_per_kwh, CAST(t.standing_charge_daily AS DOUBLE) AS standing_charge_daily,
        count(*) AS consumption_rows, CAST(sum(kwh) AS DOUBLE) AS total_kwh, CAST(sum(estimated_cost) AS DOUBLE) AS total_estimated_cost
        FROM fact_consumption f LEFT JOIN dim_tariff t ON t.tariff_id = f.tariff_id GROUP BY ALL"""),
    "anomaly_by_region": sql("""SELECT region_name, anomaly_type, count(*) AS anomaly_count, CAST(round(CAST(sum(anomaly_score) AS DECIMAL(18,4)) / count(*), 4) AS DOUBLE) AS average_anomaly_score,
        CAST(sum(kwh - coalesce(expected_kwh, 0)) AS DOUBLE) AS total_kwh_above_expected FROM fact_anomaly JOIN dim_region USING (region_id) GROUP BY region_name, anomaly_type"""),
    "weekday_weekend": sql(f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS consumption_rows,
        CAST({_mean('sum(kwh)', 'count(*)')} AS DOUBLE) AS average_kwh, CAST(sum(kwh) AS DOUBLE) AS total_kwh, CAST(sum(estimated_cost) AS DOUBLE) AS total_estimated_cost
        FROM fact_consumption JOIN dim_date USING (date_id) GROUP BY day_type"""),
    "freshness": sql(f"""SELECT source_name, strftime(t, {_STAMP}) AS latest_reading_timestamp, {_hours('t', _NOW)} AS hours_since_latest_reading
        FROM (SELECT 'batch_consumption' AS source_name, max(reading_timestamp) AS t FROM fact_consumption UNION ALL SELECT 'smart_meter_events', max(event_timestamp) FROM fact_reading)"""),
    "run_statistics": sql("""SELECT pipeline_name, pipeline_type, status, count(*) AS run_count, CAST(sum(records_read) AS BIGINT) AS total_records_read,
        CAST(sum(records_written) AS BIGINT) AS total_records_written, CAST(sum(records_rejected) AS BIGINT) AS total_records_rejected,
        CAST(sum(duration_seconds) // count(*) AS BIGINT) AS average_duration_seconds FROM v_runs GROUP BY ALL"""),
    "check_statistics": sql(f"""SELECT table_name, check_name, count(*) AS check_run_count, CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed_run_count,
        CAST(sum(failed_count) AS BIGINT) AS total_failed_records, strftime(max(checked_at), {_STAMP}) AS latest_checked_at FROM quality_check GROUP BY ALL"""),
    "failed_runs": _rows("pipeline_run", _RUNS, "WHERE status = 'failed'"),
    "failed_checks": _rows("quality_check", _VIEW_CHECKS, "WHERE status = 'failed'"),
    # views and serving
    "view_daily": _rows("v_daily", _VIEW_DAILY),
    "view_monthly": _rows("v_monthly", _VIEW_MONTHLY),
    "view_customer": _rows("v_customer", _VIEW_CUSTOMER),
    "view_latest": _rows("v_latest", _VIEW_LATEST),
    "view_anomaly": _rows("v_anomaly", _ANOMALY),
    "view_quality": _rows("quality_check", _VIEW_CHECKS),
    "view_runs": _rows("v_runs", _VIEW_RUNS),
    "kpis": _rows("v_kpis", _KPIS),
    "p_regions": sql("SELECT region_name FROM v_daily UNION SELECT region_name FROM v_monthly UNION SELECT region_name FROM v_latest UNION SELECT region_name FROM v_anomaly"),
    "p_daily": _rows("v_daily v", _VIEW_DAILY, """WHERE region_name = 'ASIA' AND v.reading_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
        ORDER BY v.reading_date, region_name LIMIT 1000"""),
    "p_daily_default": _rows("v_daily v", _VIEW_DAILY, "ORDER BY v.reading_date, region_name LIMIT 100"),
    "p_daily_bad_date": _rows("v_daily v", _VIEW_DAILY, "WHERE v.reading_date >= try_cast('not a date' AS DATE)"),
    "p_monthly": _rows("v_monthly", _VIEW_MONTHLY, "WHERE region_name = 'EUROPE' ORDER BY year_number, month_number LIMIT 100"),
    "p_customer": _rows("v_customer", _VIEW_CUSTOMER, "WHERE customer_id = 'CUST-000042'"),
    "p_latest": _rows("v_latest v", _VIEW_LATEST, "ORDER BY v.event_timestamp DESC, meter_id LIMIT 5000"),
    "p_latest_meter": _rows("v_latest", _VIEW_LATEST, "WHERE meter_id = 'MTR-000007'"),
    "p_anomalies": _rows("v_anomaly v", _ANOMALY, """WHERE region_name = 'AFRICA' AND v.detected_at >= TIMESTAMP '2024-01-05' AND v.detected_at < TIMESTAMP '2024-01-21'
        ORDER BY v.detected_at DESC, anomaly_id LIMIT 500"""),
    "p_kpis": _rows("v_kpis", _KPIS),
    "p_runs": _rows("v_runs v", _VIEW_RUNS, "WHERE status = 'failed' ORDER BY v.started_at DESC, pipeline_run_id LIMIT 50"),
    "p_checks": _rows("quality_check v", _VIEW_CHECKS, "WHERE status = 'failed' ORDER BY v.checked_at DESC, check_id LIMIT 100"),
    "p_freshness": sql(f"""SELECT strftime(latest_reading_timestamp, {_STAMP}) AS latest_reading_timestamp, {_hours('latest_reading_timestamp', _NOW)} AS hours_since_latest_reading FROM v_kpis"""),
    "p_sql": sql("SELECT region_name, CAST(sum(total_kwh) AS DOUBLE) AS total_kwh FROM v_daily WHERE reading_date >= DATE '1998-01-01' GROUP BY region_name"),
    # measures
    "measure_total_kwh": sql("SELECT CAST(sum(total_kwh) AS DOUBLE) AS total_kwh FROM v_daily"),
    "measure_average_daily_kwh": sql("""SELECT CAST(CAST((2 * CAST(sum(total_kwh) * 100000000 AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100000000 AS DOUBLE) AS average_daily_kwh
        FROM (SELECT CAST(total_kwh AS DECIMAL(18,4)) AS total_kwh FROM v_daily)"""),
    "measure_total_anomalies": sql("SELECT count(*) AS total_anomalies FROM v_anomaly"),
    "measure_active_meters": sql("SELECT count(DISTINCT meter_id) AS active_meters FROM v_latest"),
    "measure_latest_reading_timestamp": _rows("v_kpis", "latest_reading_timestamp:t"),
    "measure_failed_pipeline_runs": sql("SELECT count(*) AS failed_pipeline_runs FROM pipeline_run WHERE status = 'failed'"),
    "measure_failed_quality_checks": sql("SELECT count(*) AS failed_quality_checks FROM quality_check WHERE status = 'failed'"),
    "measure_anomaly_rate": sql("SELECT (SELECT count(*) FROM v_anomaly) / (SELECT count(DISTINCT meter_id) FROM v_latest) AS anomaly_rate"),
    "measure_anomaly_count_by_region": sql("SELECT region_name, count(*) AS anomaly_count FROM v_anomaly GROUP BY region_name"),
    "measure_top_latest_meters": _rows("v_latest v", _VIEW_LATEST, "ORDER BY v.kwh DESC, meter_id LIMIT 10"),
    # quality
    "null_meter_check": sql("""SELECT 'fact_consumption' AS table_name, CAST(consumption_id AS VARCHAR) AS record_id FROM faulty WHERE meter_id IS NULL
        UNION ALL SELECT 'fact_reading', reading_id FROM fact_reading WHERE meter_id IS NULL UNION ALL SELECT 'fact_anomaly', anomaly_id FROM fact_anomaly WHERE meter_id IS NULL"""),
    "null_customer_check": sql("""SELECT 'fact_consumption' AS table_name, CAST(consumption_id AS VARCHAR) AS record_id FROM faulty WHERE customer_id IS NULL
        UNION ALL SELECT 'fact_reading', reading_id FROM fact_reading WHERE customer_id IS NULL"""),
    "negative_check": sql("""SELECT 'fact_consumption' AS table_name, CAST(consumption_id AS VARCHAR) AS record_id, CAST(kwh AS DOUBLE) AS kwh FROM faulty WHERE kwh < 0
        UNION ALL SELECT 'fact_reading', reading_id, CAST(kwh AS DOUBLE) FROM fact_reading WHERE kwh < 0
        UNION ALL SELECT 'fact_anomaly', anomaly_id, CAST(kwh AS DOUBLE) FROM fact_anomaly WHERE kwh < 0"""),
    "future_check": sql(f"""SELECT 'fact_consumption' AS table_name, CAST(consumption_id AS VARCHAR) AS record_id, strftime(reading_timestamp, {_STAMP}) AS timestamp_value
        FROM faulty WHERE reading_timestamp > TIMESTAMP '2001-01-01'
        UNION ALL SELECT 'fact_reading', reading_id, strftime(event_timestamp, {_STAMP}) FROM fact_reading WHERE event_timestamp > TIMESTAMP '2001-01-01'"""),
    "orphan_rows": sql("""SELECT consumption_id, customer_id, CAST(kwh AS DOUBLE) AS kwh FROM faulty f
        WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)"""),
    "orphan_report": sql(" UNION ALL ".join(
        f"""SELECT '{fact}_missing_{dim}' AS issue_name, CAST(f.{record} AS VARCHAR) AS record_id, CAST(f.{dim}_id AS VARCHAR) AS missing_key FROM {source} f
        LEFT JOIN dim_{dim} x ON x.{dim}_id = f.{dim}_id WHERE x.{dim}_id IS NULL""" + (" AND f.tariff_id IS NOT NULL" if dim == "tariff" else "")
        for fact, source, record, dims in (("fact_consumption", "faulty", "consumption_id", ("meter", "customer", "region", "tariff", "date")),
                                           ("fact_reading", "fact_reading", "reading_id", ("meter", "customer", "region", "date"))) for dim in dims)),
    "quality_suite": sql(f"""SELECT 'AF-DQ-' || substr(sha1('RUN-00000007:' || check_name), 1, 18) AS check_id, 'RUN-00000007' AS pipeline_run_id, check_name, table_name,
        CASE WHEN failed_count = 0 THEN 'passed' ELSE 'failed' END AS status, failed_count, '{AS_OF}' AS checked_at FROM (
        SELECT 'consumption_has_rows' AS check_name, 'fact_consumption' AS table_name, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failed_count FROM faulty
        UNION ALL SELECT 'consumption_no_negative_kwh', 'fact_consumption', count(*) FROM faulty WHERE kwh < 0
        UNION ALL SELECT 'consumption_no_null_meter_id', 'fact_consumption', count(*) FROM faulty WHERE meter_id IS NULL
        UNION ALL SELECT 'consumption_latest_timestamp_present', 'fact_consumption', CASE WHEN max(reading_timestamp) IS NOT NULL THEN 0 ELSE 1 END FROM faulty
        UNION ALL SELECT 'consumption_no_missing_region', 'fact_consumption', count(*) FROM faulty WHERE region_id NOT IN (SELECT region_id FROM dim_region)
        UNION ALL SELECT 'reading_no_duplicate_id', 'fact_reading', count(*) FROM (SELECT reading_id FROM fact_reading GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'consumption_no_duplicate_id', 'fact_consumption', count(*) FROM (SELECT consumption_id FROM faulty GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'run_failed', 'pipeline_run', count(*) FROM pipeline_run WHERE status = 'failed'
        UNION ALL SELECT 'run_record_exists', 'pipeline_run', CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM pipeline_run WHERE pipeline_run_id = 'RUN-00000007')"""),
    "audit_unique": sql("SELECT consumption_id, count(*) AS duplicate_count FROM fact_consumption GROUP BY 1 HAVING count(*) > 1"),
    "audit_fk": sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS constraint_name, count(*) AS failed_count FROM {child} c WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"""
        for name, child, key, parent in (
            ("customer_region", "dim_customer", "region_id", "dim_region"), ("meter_customer", "dim_meter", "customer_id", "dim_customer"),
            ("meter_region", "dim_meter", "region_id", "dim_region"), ("consumption_meter", "faulty", "meter_id", "dim_meter"),
            ("consumption_customer", "faulty", "customer_id", "dim_customer"), ("consumption_region", "faulty", "region_id", "dim_region"),
            ("consumption_tariff", "faulty", "tariff_id", "dim_tariff"), ("consumption_date", "faulty", "date_id", "dim_date"),
            ("reading_meter", "fact_reading", "meter_id", "dim_meter"), ("reading_customer", "fact_reading", "customer_id", "dim_customer"),
            ("reading_region", "fact_reading", "region_id", "dim_region"), ("reading_date", "fact_reading", "date_id", "dim_date"),
            ("anomaly_reading", "fact_anomaly", "reading_id", "fact_reading"), ("anomaly_meter", "fact_anomaly", "meter_id", "dim_meter"),
            ("anomaly_region", "fact_anomaly", "region_id", "dim_region"), ("anomaly_date", "fact_anomaly", "date_id", "dim_date"),
            ("check_run", "quality_check", "pipeline_run_id", "pipeline_run")))),
    "audit_checks": sql(" UNION ALL ".join(f"SELECT '{name}' AS check_name, count(*) AS failed_count FROM faulty WHERE NOT ({ok})" for name, ok in (
        ("kwh_not_negative", "kwh >= 0"), ("cost_not_negative", "estimated_cost >= 0"), ("date_id_in_range", "date_id BETWEEN 20000101 AND 29991231"),
        ("meter_not_blank", "length(trim(meter_id)) > 0"), ("source_known", "source_system IN ('batch_load', 'sample_batch')")))),
    "audit_run_checks": sql(" UNION ALL ".join(f"SELECT '{name}' AS check_name, count(*) AS failed_count FROM pipeline_run WHERE NOT ({ok})" for name, ok in (
        ("status_known", "status IN ('started', 'running', 'succeeded', 'failed', 'cancelled')"), ("finish_after_start", "finished_at >= started_at"),
        ("counts_add_up", "records_read = records_written + records_rejected"), ("rejects_below_50", "records_rejected < 50")))),
    "audit_not_null": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS failed_count FROM faulty WHERE {c} IS NULL" for c in ("consumption_id", "meter_id", "customer_id", "tariff_id"))),
    "with_defaults": sql(f"""SELECT pipeline_run_id, strftime(coalesce(finished_at, {_NOW}), {_STAMP}) AS finished_at, coalesce(error_message, 'none') AS error_message,
        CAST(0 AS BIGINT) AS records_lost, 'received' AS processing_status FROM pipeline_run"""),
    # bookkeeping
    "run_ids": sql("""SELECT o_orderkey, 'AF-' || substr(sha1('daily_load:' || o_orderkey), 1, 20) AS run_id, 'AF-DQ-' || substr(sha1(o_orderkey || ':no_nulls'), 1, 18) AS check_id FROM orders"""),
    "run_log": _rows("pipeline_run", "pipeline_run_id status started_at:t records_read:i"),
    "observed_counts": sql("""SELECT count(*) AS rows, count(*) FILTER (kwh < 0) AS negative, count(*) FILTER (meter_id IS NULL) AS without_meter FROM faulty"""),
    "record_checks": sql("""SELECT check_id, CASE WHEN max(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) = 1 THEN 'failed' ELSE min(status) END AS status
        FROM quality_check GROUP BY check_id"""),
    # streams
    "stream_capture": sql(f"SELECT raw_event_payload, '{AS_OF}' AS ingestion_timestamp, 'local_file_stream' AS source_system FROM payloads"),
    "stream_resumed": sql(f"SELECT raw_event_payload, '{AS_OF}' AS ingestion_timestamp, 'local_file_stream' AS source_system FROM payloads"),
    "stream_invalid": sql(f"""SELECT raw_event_payload, reason AS rejection_reason, '{AS_OF}' AS rejected_at, 'local_file_stream' AS source_system
        FROM (SELECT *, array_to_string(list_filter(string_split(rejection_reason, ';'), lambda x: x <> 'Duplicate event_id in micro-batch'), ';') AS reason FROM judged_events) WHERE reason <> ''"""),
    "stream_offset_range": sql("""SELECT raw_event_payload, CAST(n % 4 AS VARCHAR) AS partition_id, CAST(place AS VARCHAR) AS "offset", 'eventhubs_emulator_kafka' AS source_system
        FROM (SELECT *, row_number() OVER (PARTITION BY n % 4 ORDER BY n, copy) - 1 AS place FROM payloads) WHERE place >= 100"""),
    "stream_metadata": sql("SELECT count(*) AS events, CAST(0 AS BIGINT) AS files_that_differ FROM payloads"),
    "stream_clean": _rows("good_events", _EVENTS),
    "stream_rejected": sql(f"""SELECT raw_event_payload, rejection_reason, '{AS_OF}' AS rejected_at, 'local_file_stream' AS source_system
        FROM judged_events WHERE rejection_reason <> ''"""),
    "stream_anomalies": sql("""SELECT 'anom_' || event_id AS anomaly_id, region_name, CASE WHEN event_type = 'anomaly' THEN 'producer_flagged_anomaly' ELSE 'high_kwh_threshold' END AS anomaly_type,
        CAST(CASE WHEN kwh > 10 THEN 0.95 ELSE 0.75 END AS DOUBLE) AS anomaly_score, kwh FROM good_events WHERE event_type = 'anomaly' OR kwh > 10"""),
    "stream_latest": sql(f"""SELECT meter_id, event_id, strftime(event_timestamp, {_STAMP}) AS event_timestamp, kwh FROM good_events WHERE event_type <> 'heartbeat'
        QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY good_events.event_timestamp DESC, event_id DESC) = 1"""),
    "stream_hourly": sql(f"""SELECT strftime(h, {_STAMP}) AS window_start, strftime(h + INTERVAL 1 HOUR, {_STAMP}) AS window_end, region_name, CAST(sum(CAST(kwh AS DECIMAL(12,4))) AS DOUBLE) AS total_kwh,
        count(*) AS event_count, count(DISTINCT meter_id) AS unique_meter_count
        FROM (SELECT *, date_trunc('hour', event_timestamp) AS h FROM good_events WHERE event_type <> 'heartbeat') GROUP BY h, region_name"""),
    "stream_hourly_merged": sql(f"""SELECT strftime(h, {_STAMP}) AS window_start, strftime(h + INTERVAL 1 HOUR, {_STAMP}) AS window_end, region_name, CAST(sum(CAST(kwh AS DECIMAL(12,4))) AS DOUBLE) AS total_kwh,
        count(*) AS event_count, count(DISTINCT meter_id) AS unique_meter_count
        FROM (SELECT *, date_trunc('hour', event_timestamp) AS h FROM good_events WHERE event_type <> 'heartbeat') GROUP BY h, region_name"""),
    "stream_metrics": sql("""SELECT count(*) AS total_events, count(*) FILTER (WHERE rejection_reason = '') AS valid_events, count(*) FILTER (WHERE rejection_reason <> '') AS rejected_events,
        count(*) FILTER (WHERE rejection_reason = '' AND (event_type = 'anomaly' OR kwh > 10)) AS anomaly_events FROM judged_events"""),
    "stream_dedup": sql(f"""SELECT DISTINCT event_id, customer_id, strftime(event_ts, {_STAMP}) AS event_timestamp FROM parsed WHERE event_ts IS NOT NULL"""),
    "stream_hours_closed": sql(f"""SELECT strftime(h, {_STAMP}) AS window_start, strftime(h + INTERVAL 1 HOUR, {_STAMP}) AS window_end, region_name,
        CAST(sum(CAST(kwh AS DECIMAL(12,4))) AS DOUBLE) AS total_kwh, count(*) AS event_count, count(DISTINCT meter_id) AS unique_meter_count
        FROM (SELECT *, date_trunc('hour', event_timestamp) AS h, max(event_timestamp) OVER () - INTERVAL 2 HOUR AS watermark FROM good_events)
        WHERE event_type <> 'heartbeat' AND h + INTERVAL 1 HOUR <= watermark GROUP BY h, region_name"""),
    "stream_latest_state": sql(f"""SELECT meter_id, event_id, strftime(event_ts, {_STAMP}) AS event_timestamp, kwh FROM parsed
        WHERE event_ts IS NOT NULL AND kwh >= 0 AND event_type <> 'heartbeat' QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY event_ts DESC, event_id DESC) = 1"""),
    "stream_latest_ttl": sql(f"""SELECT meter_id, event_id, strftime(event_ts, {_STAMP}) AS event_timestamp, kwh FROM (
          SELECT *, max(event_ts) OVER () - INTERVAL 2 HOUR AS watermark, row_number() OVER (PARTITION BY meter_id ORDER BY event_ts DESC, event_id DESC) AS age
          FROM parsed WHERE event_ts IS NOT NULL AND kwh >= 0 AND event_type <> 'heartbeat')
        WHERE age = 1 AND event_ts + INTERVAL 10 DAY >= watermark"""),
    # whole pipeline
    "batch_facts": sql(f"""SELECT row_number() OVER (ORDER BY meter_id, day, customer_id, region_id) AS consumption_id, meter_id, customer_id, CAST(region_id AS BIGINT) AS region_id, tariff_id,
        CAST({_date_id('day')} AS BIGINT) AS date_id, CAST(day AS VARCHAR) || ' 23:59:59' AS reading_timestamp, CAST(kwh AS DOUBLE) AS kwh,
        CAST(CAST(round(CAST(kwh * price_per_kwh AS DECIMAL(24,8)) + standing_charge_daily, 4) AS DECIMAL(12,4)) AS DOUBLE) AS estimated_cost,
        'phase2_gold' AS source_system, 'batch_1' AS batch_id
        FROM (SELECT g.meter_id, g.customer_id, n.region_id, CAST(g.reading_timestamp AS DATE) AS day, {_TARIFF} AS tariff_id, CAST(sum(CAST(g.kwh AS DECIMAL(12,4))) AS DECIMAL(12,4)) AS kwh
              FROM judged g JOIN dim_customer c ON c.customer_id = g.customer_id
              JOIN (SELECT region_name, row_number() OVER (ORDER BY region_name) AS region_id FROM (SELECT DISTINCT region_name FROM dim_customer)) n ON n.region_name = g.region_name
              WHERE g.rejection_reason = '' GROUP BY ALL) JOIN dim_tariff USING (tariff_id)"""),
    "batch_gold_daily": sql(f"""SELECT CAST(day AS VARCHAR) AS reading_date, region_name, CAST(sum(k) AS DOUBLE) AS total_kwh, CAST({_mean('sum(k)', 'count(*)')} AS DOUBLE) AS average_kwh,
        count(*) AS reading_count, count(DISTINCT meter_id) AS unique_meter_count
        FROM (SELECT *, CAST(reading_timestamp AS DATE) AS day, CAST(kwh AS DECIMAL(12,4)) AS k FROM judged WHERE rejection_reason = '') GROUP BY day, region_name"""),
    "batch_gate": sql(f"""SELECT 'batch_1' AS pipeline_run_id, 'fact_energy_consumption_' || check_name AS check_name, 'fact_consumption' AS table_name, 'passed' AS status,
        count(*) FILTER (WHERE kwh < 0 AND rejection_reason = '') AS failed_count, '{AS_OF}' AS checked_at
        FROM judged, (VALUES ('has_rows'), ('no_negative_kwh'), ('no_null_meter_id'), ('latest_timestamp_present'), ('no_missing_region_reference'),
          ('no_missing_customer_reference'), ('no_missing_meter_reference'), ('no_missing_tariff_reference'), ('no_missing_date_reference')) AS v (check_name) GROUP BY check_name
        UNION ALL SELECT 'batch_1', 'monitoring_pipeline_run_record_exists', 'pipeline_run', 'passed', 0, '{AS_OF}'"""),
    "batch_run_log": sql(f"""SELECT 'batch_pipeline' AS pipeline_name, 'succeeded' AS status, '{AS_OF}' AS started_at, '{AS_OF}' AS finished_at, (SELECT count(*) FROM dirty) AS records_read,
        (SELECT count(*) FROM (SELECT meter_id, customer_id, region_name, CAST(judged.reading_timestamp AS DATE) AS day FROM judged WHERE rejection_reason = '' GROUP BY ALL)) AS records_written"""),
    "batch_check_history": sql("""SELECT check_name, 'passed' AS status, CAST(0 AS BIGINT) AS failed_count FROM (VALUES ('monitoring_pipeline_run_record_exists'),
        ('fact_energy_consumption_has_rows'), ('fact_energy_consumption_no_negative_kwh'), ('fact_energy_consumption_no_null_meter_id'), ('fact_energy_consumption_latest_timestamp_present'),
        ('fact_energy_consumption_no_missing_region_reference'), ('fact_energy_consumption_no_missing_customer_reference'), ('fact_energy_consumption_no_missing_meter_reference'),
        ('fact_energy_consumption_no_missing_tariff_reference'), ('fact_energy_consumption_no_missing_date_reference')) AS v (check_name)"""),
    "stream_fact_readings": sql(f"""SELECT event_id AS reading_id, meter_id, CAST(r.region_id AS BIGINT) AS region_id, CAST({_date_id('event_timestamp')} AS BIGINT) AS date_id,
        strftime(event_timestamp, {_STAMP}) AS event_timestamp, kwh, coalesce(nullif(voltage, 0), 230) AS voltage FROM good_events g JOIN dim_region r ON r.region_name = g.region_name WHERE g.region_name <> 'ASIA'"""),
    "stream_fact_incremental": sql(f"""SELECT event_id AS reading_id, meter_id, CAST(r.region_id AS BIGINT) AS region_id, CAST({_date_id('event_timestamp')} AS BIGINT) AS date_id,
        strftime(event_timestamp, {_STAMP}) AS event_timestamp, kwh, coalesce(nullif(voltage, 0), 230) AS voltage FROM good_events g JOIN dim_region r ON r.region_name = g.region_name WHERE g.region_name <> 'ASIA'"""),
    "stream_fact_anomalies": sql("""SELECT 'anom_' || event_id AS anomaly_id, meter_id, CAST(r.region_id AS BIGINT) AS region_id,
        CASE WHEN event_type = 'anomaly' THEN 'producer_flagged_anomaly' ELSE 'high_kwh_threshold' END AS anomaly_type, kwh
        FROM good_events g JOIN dim_region r ON r.region_name = g.region_name WHERE g.region_name <> 'ASIA' AND (event_type = 'anomaly' OR kwh > 10)"""),
    "stream_unknown_regions": sql("""SELECT 'fact_reading' AS table_name, event_id AS record_id, region_name FROM good_events WHERE region_name = 'ASIA'
        UNION ALL SELECT 'fact_anomaly', 'anom_' || event_id, region_name FROM good_events WHERE region_name = 'ASIA' AND (event_type = 'anomaly' OR kwh > 10)"""),
    # bad values and lost rows
    "reject_unstorable_kwh": sql("""SELECT event_id, CASE WHEN n % 59 = 0 THEN '1e300' WHEN n % 61 = 0 THEN '1e12' ELSE 'Infinity' END AS kwh,
        'Missing or invalid kwh' AS rejection_reason FROM readings WHERE n % 59 = 0 OR n % 61 = 0 OR n % 67 = 0"""),
    "csv_reordered_header": _rows("dirty", "source_file batch_id meter_id customer_id region_name reading_timestamp kwh ingestion_timestamp"),
    "csv_quoted_header": _rows("dirty", "source_file batch_id meter_id customer_id region_name reading_timestamp kwh ingestion_timestamp"),
    "csv_multiline": sql("""SELECT meter_id, customer_id || chr(10) || 'second, line' || CASE WHEN region_id > 2 THEN chr(10) ELSE '' END AS customer_id, meter_type, CAST(NULL AS VARCHAR) AS corrupt_record
        FROM dim_meter"""),
    "csv_surplus_fields": sql("""SELECT meter_id || ',' || customer_id || ',EUROPE,smart,2020-01-01,true,too much' AS corrupt_record FROM dim_meter"""),
    "rejected_metadata": sql("""SELECT 'bronze_customers' AS source_system, 'customers:' || CASE WHEN k % 53 = 0 THEN 'missing_customer_id' ELSE customer_id END AS source_reference,
        concat_ws('; ', CASE WHEN k % 53 = 0 THEN 'Missing customer_id' END, CASE WHEN k % 11 = 0 THEN 'Invalid signup_date' END) AS rejection_reason
        FROM dim_customer, (VALUES (0), (1)) v(copy) WHERE (k % 53 = 0 OR k % 11 = 0) AND (copy = 0 OR customer_segment = 'Residential')"""),
    "batch_dimension_rejects": sql("""SELECT 'dim_customer:' || customer_id AS source_reference, 'No dimension row, or a total that cannot be stored' AS rejection_reason
        FROM dim_customer WHERE region_name = 'ASIA'"""),
    "late_rows": sql(f"""SELECT event_id, CAST(n % 3 AS BIGINT) AS batch_id FROM (SELECT *, max(CASE WHEN n % 3 = 0 THEN event_timestamp END) OVER () AS m0, max(CASE WHEN n % 3 <= 1 THEN event_timestamp END) OVER () AS m1 FROM readings)
        WHERE n % 3 = 1 AND event_timestamp < m0 - INTERVAL 10 DAY OR n % 3 = 2 AND event_timestamp < m1 - INTERVAL 10 DAY"""),
    "lookup_drop": sql("""SELECT meter_id, r.region_name FROM dim_meter JOIN dim_region r USING (region_id) WHERE r.region_name <> 'ASIA'"""),
    "load_anomalies": sql("""SELECT anomaly_id, meter_id, CAST(region_id AS BIGINT) AS region_id FROM found"""),
    "unknown_regions": sql("""SELECT anomaly_id, region_name FROM found WHERE region_name = 'ASIA'"""),
    # sources and sinks
    "io_csv_tree": _rows("dirty", "source_file batch_id meter_id customer_id region_name reading_timestamp kwh ingestion_timestamp"),
    "io_parquet_table": sql(f"""SELECT meter_id, customer_id, region_name, strftime(event_timestamp, {_STAMP}) AS reading_timestamp, CAST(reading_date AS VARCHAR) AS reading_date,
        hour(event_timestamp) AS reading_hour, CAST(kwh AS DOUBLE) AS kwh FROM readings"""),
    "io_versioned_table": sql(f"""SELECT meter_id, customer_id, region_name, strftime(event_timestamp, {_STAMP}) AS reading_timestamp, CAST(reading_date AS VARCHAR) AS reading_date,
        hour(event_timestamp) AS reading_hour, CAST(kwh AS DOUBLE) AS kwh FROM readings"""),
    "io_compacted_batches": sql(f"""SELECT meter_id, customer_id, region_name, strftime(event_timestamp, {_STAMP}) AS reading_timestamp, CAST(reading_date AS VARCHAR) AS reading_date,
        hour(event_timestamp) AS reading_hour, CAST(kwh AS DOUBLE) AS kwh, 'batch_' || hour(event_timestamp) % 4 AS batch_id FROM readings"""),
    "io_replace_batch": sql("""SELECT consumption_id, meter_id, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE kwh END AS DOUBLE) AS kwh, l_returnflag AS batch_id FROM fact_consumption"""),
    "io_json_events": _rows("readings", "event_id meter_id event_type n"),
    "kafka_envelopes": sql(f"""SELECT raw_event_payload, '{AS_OF}' AS ingestion_timestamp, 'eventhubs_emulator_kafka' AS source_system, CAST(copy AS VARCHAR) AS partition_id,
        CAST(n AS VARCHAR) AS "offset", '{{"topic":"meter-events","kafka_timestamp":"{AS_OF}","timestamp_type":0}}' AS producer_metadata FROM payloads"""),
}
