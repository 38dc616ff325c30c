"""The registered queries stated in SQL, for comparison in another engine."""

from __future__ import annotations

from lakejobs.plans.state_oracle import state_sql

C1 = "TIMESTAMP '2024-01-11 00:00:00'"
C2 = "TIMESTAMP '2024-01-21 00:00:00'"
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"
EVT = f"""evt AS (
    SELECT user_id AS source_pk, ts AS ts_event, event_id AS source_pos,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
           event_type, value, {K} AS k, ts + to_minutes({K}) AS ingest_ts
    FROM events)"""
DUP = EVT + """, dup AS (
    SELECT * FROM evt
    UNION ALL
    SELECT * REPLACE (ingest_ts + INTERVAL 60 MINUTES AS ingest_ts) FROM evt
    WHERE source_pos % 10 = 0)"""
BAD = """bad AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 97 = 0 THEN -value ELSE value END AS value,
        CASE WHEN event_id % 89 <> 0 THEN props END AS props)
    FROM events)"""


def _uuid(text: str) -> str:
    h = f"md5({text})"
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "concat_ws('-', " + ", ".join(f"substr({h}, {a}, {n})" for a, n in parts) + ")"


def _index(lat: str, lon: str, p: int) -> tuple[str, str]:
    xb, yb = (5 * p + 1) // 2, 5 * p // 2

    def one(v: str, low: str, span: str, bits: int) -> str:
        size = 2**bits
        return (
            f"CASE WHEN {v} BETWEEN -{low} AND {low} THEN least(CAST(floor(({v} + "
            f"CAST({low} AS DOUBLE)) / CAST({span} AS DOUBLE) * CAST({size} AS DOUBLE)) "
            f"AS BIGINT), {size - 1}) END"
        )

    return one(lon, "180", "360", xb), one(lat, "90", "180", yb)


def _cell(x: str, y: str, p: int) -> str:
    """Geohash text of integer cell coordinates."""
    xb, yb = (5 * p + 1) // 2, 5 * p // 2
    chars = []
    for i in range(p):
        bits = []
        for b in range(5):
            at = 5 * i + b
            source = f"({x} >> {xb - 1 - at // 2})" if at % 2 == 0 else f"({y} >> {yb - 1 - at // 2})"
            bits.append(f"({source} & 1) * {16 >> b}")
        chars.append(f"substr('{ALPHABET}', CAST({' + '.join(bits)} AS BIGINT) + 1, 1)")
    joined = " || ".join(chars)
    return f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {joined} END"


E = "event_id"
TEL = f"""pos AS (
    SELECT *, {K} AS k,
           CAST(({E} * 7919) % 180001 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(90 AS DOUBLE) AS lat,
           CAST(({E} * 104729) % 360001 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon
    FROM events),
idx AS (SELECT *, {_index('lat', 'lon', 7)[0]} AS cx, {_index('lat', 'lon', 7)[1]} AS cy FROM pos),
tel AS (
    SELECT {E} AS seq, {_uuid(f'CAST({E} AS VARCHAR)')} AS event_id,
           CASE WHEN {E} % 71 = 0 THEN 'V' || CAST(user_id AS VARCHAR)
                ELSE 'VIN' || lpad(CAST(user_id AS VARCHAR), 14, '0') END AS vin,
           {_uuid("CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d')")} AS trip_id,
           date_trunc('milliseconds', ts) AS event_ts,
           {E} % 83 = 0 AS offset_zone,
           CAST(({E} * 7) % 600 AS INTEGER) AS sample_gap_sec,
           lat AS latitude, lon AS longitude,
           CASE WHEN {E} % 89 <> 0
                THEN CAST({E} % 500 AS DOUBLE) / CAST(10 AS DOUBLE) END AS altitude_m,
           CASE WHEN {E} % 101 = 0 THEN '9q8yyj0' ELSE {_cell('cx', 'cy', 7)} END AS geo_hash,
           CASE WHEN {E} % 97 = 0 THEN -value ELSE value END AS speed_kph,
           CAST({E} % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) AS heading_deg,
           CAST({E} AS DOUBLE) / CAST(10 AS DOUBLE) AS odometer_km,
           CAST({E} % 9000 AS INTEGER) AS engine_rpm,
           CAST(k + CASE WHEN {E} % 103 = 0 THEN 100 ELSE 0 END AS DOUBLE) AS throttle_pct,
           {E} % 10 = 0 AS brake_active,
           CAST(100 - k AS DOUBLE) AS fuel_level_pct,
           CAST({E} % 30 + 80 AS DOUBLE) AS coolant_temp_c,
           CAST({E} % 20 AS DOUBLE) / CAST(10 AS DOUBLE) + CAST(12 AS DOUBLE) AS battery_voltage_v,
           CAST({E} % 40 + 200 AS DOUBLE) AS fl, CAST({E} % 39 + 200 AS DOUBLE) AS fr,
           CAST({E} % 38 + 200 AS DOUBLE) AS rl,
           CASE WHEN {E} % 107 <> 0 THEN CAST({E} % 37 + 200 AS DOUBLE) END AS rr,
           CAST({E} % 7 AS DOUBLE) / CAST(10 AS DOUBLE) AS ax,
           CAST({E} % 9 AS DOUBLE) / CAST(10 AS DOUBLE) AS ay,
           CAST(9.81 AS DOUBLE) AS az, cx, cy
    FROM idx)"""

# The first damage that applies to a line, in the order it is dealt.
DAMAGE = """CASE WHEN seq % 211 = 0 THEN 'not_json' WHEN seq % 223 = 0 THEN 'wrong_type'
    WHEN seq % 227 = 0 THEN 'empty_record' WHEN seq % 229 = 0 THEN 'not_json'
    WHEN seq % 233 = 0 THEN 'not_json' WHEN seq % 239 = 0 THEN 'bad_time'
    WHEN seq % 241 = 0 THEN 'wrong_type' WHEN seq % 251 = 0 THEN 'blank'
    ELSE 'decoded' END"""

# Which records break which rule, in contract order.
FAULTS = {
    "vin": "seq % 71 = 0",
    "event_ts": "offset_zone",
    "speed_kph": "speed_kph < 0",
    "throttle_pct": "throttle_pct > 100",
    "tire_pressure_kpa": "rr IS NULL",
}
EXPECTED = {
    "vin": "str (17)",
    "event_ts": "str (iso-8601)",
    "speed_kph": "float",
    "throttle_pct": "float",
    "tire_pressure_kpa": "object",
}
ERRORS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} THEN '{f}' END" for f, c in FAULTS.items()
) + ")"
FIRST = "CASE " + " ".join(f"WHEN {c} THEN '{f}'" for f, c in FAULTS.items()) + " ELSE '' END"
FIRST_TYPE = (
    "CASE " + " ".join(f"WHEN {c} THEN '{EXPECTED[f]}'" for f, c in FAULTS.items()) + " ELSE '' END"
)

STATE = "source_pk, op, ts_event, source_pos, event_type, value, k"
LATEST = f"""SELECT {STATE} FROM (
    SELECT *, row_number() OVER (PARTITION BY source_pk ORDER BY ts_event DESC, source_pos DESC) AS rn
    FROM {{source}}) WHERE rn = 1"""
LIVE = f"WITH {EVT} SELECT * FROM ({LATEST.format(source='evt')}) WHERE op <> 'd'"

HISTORY = "source_pk, op, source_pos, event_type, value, valid_from, valid_to, is_current"
SCD2 = f"""WITH {EVT}, one AS (
    SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY source_pk, ts_event ORDER BY source_pos DESC) AS rn FROM evt) WHERE rn = 1),
h AS (SELECT *, ts_event AS valid_from,
        lead(ts_event) OVER (PARTITION BY source_pk ORDER BY ts_event) AS valid_to FROM one)
SELECT source_pk, op, source_pos, event_type, value, valid_from, valid_to,
       valid_to IS NULL AS is_current FROM h WHERE op <> 'd'"""


def _tracked(key: str, tracked: str) -> str:
    return f"""WITH {EVT}, one AS (
    SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY {key}, ts_event ORDER BY source_pos DESC) AS rn FROM evt) WHERE rn = 1),
marked AS (SELECT *, lag(op) OVER w AS before_op, lag({tracked}) OVER w AS before_value,
        row_number() OVER w AS n
    FROM one WINDOW w AS (PARTITION BY {key} ORDER BY ts_event)),
kept AS (SELECT * FROM marked
    WHERE n = 1 OR (op = 'd') <> (before_op = 'd') OR {tracked} <> before_value),
h AS (SELECT *, ts_event AS valid_from,
        lead(ts_event) OVER (PARTITION BY {key} ORDER BY ts_event) AS valid_to FROM kept)
SELECT source_pk, op, source_pos, event_type, value, valid_from, valid_to,
       valid_to IS NULL AS is_current FROM h WHERE op <> 'd'"""


def _late(allowed: str, source: str = "") -> str:
    part = f"PARTITION BY {source}" if source else ""
    return f"""{EVT}, flagged AS (SELECT *, ts_event < max(ts_event) OVER (
        {part} ORDER BY ingest_ts, source_pos ROWS UNBOUNDED PRECEDING)
        - INTERVAL {allowed} AS is_late FROM evt)"""


BATCHES = """SELECT event_type, (rn - 1) // 100 AS batch_no, count(*) AS n_events,
       arg_min(user_id, event_id) AS first_label, arg_max(user_id, event_id) AS last_label
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
GROUP BY 1, 2"""

OFFSETS = f"""WITH {EVT} SELECT event_type, source_pos, previous_pos,
       CASE WHEN source_pos <= previous_pos THEN 'regression' ELSE 'gap' END AS kind
FROM (SELECT *, lag(source_pos) OVER (
        PARTITION BY event_type ORDER BY ingest_ts, source_pos) AS previous_pos FROM evt)
WHERE source_pos <= previous_pos OR source_pos > previous_pos + 1"""

LATE_TOTALS = """count(*) AS total_rows, count(*) FILTER (is_late) AS late_rows,
       CAST(count(*) FILTER (is_late) AS DOUBLE) * 100 / count(*) AS late_pct FROM flagged"""

METRICS = f"""{BAD}, per AS (
    SELECT event_type AS source, CAST(count(*) FILTER (props IS NULL) AS DOUBLE) * 100 / count(*) AS a,
           CAST(count(*) FILTER (value < 0) AS DOUBLE) * 100 / count(*) AS b,
           CAST(count(*) AS DOUBLE) AS c
    FROM bad GROUP BY 1),
verdicts AS (
    SELECT source, 'null_props_pct' AS metric, a AS value, a <= 1.1 AS passed FROM per
    UNION ALL SELECT source, 'negative_pct', b, b <= 1.0 FROM per
    UNION ALL SELECT source, 'rows', c, c >= 100 FROM per)"""

AUDIT = f"""{EVT}, audit AS (
    SELECT event_type AS source,
           CAST(date_diff('day', DATE '2024-01-01', CAST(ts_event AS DATE)) AS BIGINT) AS batch_id,
           count(*) AS input_rows, count(*) FILTER (source_pos % 97 = 0) AS error_rows,
           count(*) * 20 AS duration_ms, max(ts_event) AS watermark, max(ingest_ts) AS recorded_at
    FROM evt GROUP BY 1, 2)"""

PROJECTED = f"""WITH {TEL} SELECT event_id, upper(vin) AS vin, trip_id, event_ts, sample_gap_sec,
       latitude, longitude, coalesce(altitude_m, 0) AS altitude_m, geo_hash, speed_kph,
       heading_deg, odometer_km, engine_rpm, throttle_pct, brake_active, fuel_level_pct,
       coolant_temp_c, battery_voltage_v, fl AS tire_pressure_kpa_fl, fr AS tire_pressure_kpa_fr,
       rl AS tire_pressure_kpa_rl, coalesce(rr, 0) AS tire_pressure_kpa_rr,
       ax AS accel_m_s2_x, ay AS accel_m_s2_y, az AS accel_m_s2_z
FROM tel"""

DECODED = f"""WITH {TEL} SELECT event_id, vin, trip_id, event_ts, sample_gap_sec, latitude,
       longitude, altitude_m, geo_hash, speed_kph, heading_deg, odometer_km, engine_rpm,
       throttle_pct, brake_active, fuel_level_pct, coolant_temp_c, battery_voltage_v,
       fl AS tire_pressure_kpa_fl, fr AS tire_pressure_kpa_fr, rl AS tire_pressure_kpa_rl,
       rr AS tire_pressure_kpa_rr, ax AS accel_m_s2_x, ay AS accel_m_s2_y, az AS accel_m_s2_z
FROM tel WHERE {DAMAGE} = 'decoded'"""


def oracle() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["batch_summaries"] = BATCHES
    sql["batch_summaries_cut"] = BATCHES
    sql["envelope"] = f"""WITH {EVT} SELECT event_type, op, ts_event, source_pos,
        value AS payload_value, k AS payload_k, md5(CAST(source_pos AS VARCHAR)) AS trace_id,
        source_pk FROM evt"""
    sql["idem_key"] = f"""WITH {EVT} SELECT source_pos, sha256(CAST(source_pk AS VARCHAR) || '|'
        || CAST(ts_event AS VARCHAR) || '|' || op) AS idem_key FROM evt"""
    sql["bucket_counts"] = """SELECT CAST(CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8)
        AS BIGINT) % 64 AS INTEGER) AS bucket, count(*) AS n_rows FROM orders GROUP BY 1"""
    sql["partition_counts"] = """SELECT strftime(ts, '%Y-%m-%d') AS event_date,
        CAST(extract(hour FROM ts) AS INTEGER) AS event_hour, count(*) AS n_rows
        FROM events GROUP BY 1, 2"""
    sql["canonical_lines"] = """SELECT event_id, '{"body":{"at":' || event_id || ',"type":"'
        || event_type || '"},"event_id":' || event_id || ',"pk":' || user_id || '}' AS line
        FROM events"""
    sql["truncated_times"] = "SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events"

    sql["validate_split"] = f"""WITH {BAD} SELECT event_id,
        CASE WHEN value >= 0 AND props IS NOT NULL THEN 'accepted' ELSE 'rejected' END AS verdict
        FROM bad"""
    sql["first_error_counts"] = f"""WITH {BAD} SELECT
        CASE WHEN value < 0 THEN 'value' ELSE 'props' END AS field,
        CASE WHEN value < 0 THEN 'float' ELSE 'str' END AS expected, count(*) AS n_rows
        FROM bad WHERE value < 0 OR props IS NULL GROUP BY 1, 2"""
    gone = "altitude_m IS NULL"
    sql["contract_verdicts"] = f"""WITH {TEL} SELECT seq,
        CASE WHEN {gone} THEN 'altitude_m' ELSE '' END AS missing,
        CASE WHEN {gone} THEN '' ELSE {ERRORS} END AS errors, '' AS warnings,
        CASE WHEN {gone} THEN '' ELSE {FIRST} END AS first_field,
        CASE WHEN {gone} THEN '' ELSE {FIRST_TYPE} END AS expected,
        NOT ({gone}) AND {ERRORS} = '' AS is_valid FROM tel"""
    sql["documented_verdicts"] = f"""WITH {TEL} SELECT seq, '' AS missing, {ERRORS} AS errors,
        concat_ws(',', CASE WHEN speed_kph > 250 THEN 'speed_kph' END,
            CASE WHEN engine_rpm > 8000 THEN 'engine_rpm' END) AS warnings,
        {FIRST} AS first_field, {FIRST_TYPE} AS expected, {ERRORS} = '' AS is_valid FROM tel"""
    sql["contract_projection"] = PROJECTED
    sql["aligned_schema"] = f"""SELECT event_id, CASE WHEN ts < {C2} THEN user_id % 100
        ELSE user_id END AS user_no, value, CASE WHEN ts < {C2} THEN 'v1' ELSE 'v2' END AS origin
        FROM events"""

    columns = ("event_id", "ts", "user_id", "event_type", "value", "props")
    sql["null_pct"] = f"WITH {BAD} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_rows,
        CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*) AS null_pct FROM bad"""
        for c in columns
    )
    sql["pk_uniqueness"] = """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1"""
    sql["count_reconcile"] = f"""WITH {DUP}, t AS (SELECT * FROM evt WHERE ts_event >= {C1})
        SELECT (SELECT count(*) FROM t) AS target_rows,
               (SELECT count(DISTINCT source_pos) FROM t) AS target_keys,
               (SELECT count(*) FROM dup) AS source_rows,
               (SELECT count(DISTINCT source_pos) FROM dup) AS source_keys,
               (SELECT count(DISTINCT source_pos) FROM dup
                WHERE source_pos NOT IN (SELECT source_pos FROM t)) AS missing_keys,
               (SELECT count(DISTINCT source_pos) FROM t
                WHERE source_pos NOT IN (SELECT source_pos FROM dup)) AS extra_keys"""
    sql["late_rate"] = f"WITH {_late('15 MINUTES')} SELECT {LATE_TOTALS}"
    sql["late_rate_cut"] = sql["late_rate"]
    sql["late_rate_by_source"] = (
        f"WITH {_late('60 MINUTES', 'event_type')} SELECT event_type, {LATE_TOTALS} GROUP BY 1"
    )
    sql["split_late"] = f"""WITH {_late('15 MINUTES', 'event_type')} SELECT source_pos,
        CASE WHEN is_late THEN 'late' ELSE 'on_time' END AS side FROM flagged"""
    sql["offset_violations"] = OFFSETS
    sql["offset_violations_cut"] = OFFSETS
    sql["quality_gate"] = f"""WITH {METRICS} SELECT * FROM verdicts
        UNION ALL SELECT source, 'not_measured', CAST(NULL AS DOUBLE), FALSE FROM per"""
    sql["pipeline_status"] = f"""WITH {METRICS}, {AUDIT}
        SELECT b.source, date_sub('second', newest_event, newest_arrival) AS lag_sec,
               newest_event - INTERVAL 15 MINUTES AS watermark, last_batch_id, dq_passed
        FROM (SELECT event_type AS source, max(ts_event) AS newest_event,
                     max(ingest_ts) AS newest_arrival FROM evt GROUP BY 1) b
        JOIN (SELECT source, max(batch_id) AS last_batch_id FROM audit GROUP BY 1) a USING (source)
        JOIN (SELECT source, bool_and(passed) AS dq_passed FROM verdicts GROUP BY 1) v
            USING (source)"""
    sql["ops_metrics"] = f"""WITH {AUDIT} SELECT source, count(*) AS runs,
        CAST(sum(input_rows) AS BIGINT) AS input_rows,
        CAST(sum(error_rows) AS BIGINT) AS error_rows,
        CAST(sum(error_rows) AS DOUBLE) / CAST(sum(input_rows) AS DOUBLE) AS error_rate,
        CAST(sum(input_rows) AS DOUBLE) / (CAST(sum(duration_ms) AS DOUBLE) / CAST(1000 AS DOUBLE))
            AS rows_per_sec,
        count(*) FILTER (duration_ms > 1000) AS slow_runs,
        date_sub('second', max(watermark), max(recorded_at)) AS lag_sec
        FROM audit GROUP BY 1"""
    sql["gap_check"] = f"""WITH {TEL}, g AS (SELECT *, lag(event_ts) OVER (
            PARTITION BY vin ORDER BY event_ts, seq) AS before_ts FROM tel)
        SELECT seq, coalesce(date_sub('second', before_ts, event_ts), -1) AS actual_gap_sec,
               before_ts IS NULL OR date_sub('second', before_ts, event_ts) = sample_gap_sec
               AS gap_ok FROM g"""
    sql["odometer_check"] = f"""WITH {TEL}, g AS (SELECT *, odometer_km - lag(odometer_km) OVER (
            PARTITION BY vin ORDER BY event_ts, seq) AS step FROM tel)
        SELECT seq, CASE WHEN step IS NULL THEN 'first' WHEN step < 0 THEN 'backwards'
            WHEN abs(step - speed_kph * sample_gap_sec / CAST(3600 AS DOUBLE)) > 2 THEN 'off'
            ELSE 'ok' END AS odometer_verdict FROM g"""
    step = "longitude + CAST(0.001373291015625 AS DOUBLE)"
    sx, sy = _index("latitude", f"({step})", 7)
    sql["geohash_check"] = f"""WITH {TEL}, shifted AS (SELECT *, {sx} AS sx, {sy} AS sy FROM tel),
        stated AS (SELECT seq, cx, cy, CASE WHEN seq % 5 = 0 THEN {_cell('sx', 'sy', 7)}
            ELSE geo_hash END AS code FROM shifted),
        near AS (SELECT seq, code, dx, dy, (cx + dx + 262144) % 262144 AS nx, cy + dy AS ny
            FROM stated, (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy)),
        named AS (SELECT *, {_cell('nx', 'ny', 7)} AS cell FROM near WHERE ny BETWEEN 0 AND 131071)
        SELECT seq, coalesce(bool_or(code = cell AND dx = 0 AND dy = 0), FALSE) AS exact_ok,
               coalesce(bool_or(code = cell), FALSE) AS tolerant_ok FROM named GROUP BY 1"""

    sql["dedup_event_id"] = f"""WITH {DUP} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY source_pos ORDER BY ingest_ts DESC) AS rn FROM dup) WHERE rn = 1"""
    sql["dedup_idem_key"] = f"""WITH {DUP} SELECT source_pk, ts_event, op, source_pos, ingest_ts
        FROM (SELECT *, row_number() OVER (PARTITION BY source_pk, ts_event, op
        ORDER BY source_pos DESC, ingest_ts DESC) AS rn FROM dup) WHERE rn = 1"""
    rest = (
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
        "l_linestatus"
    )
    order = ", ".join(f"{c} DESC" for c in ["l_shipdate", *rest.split(", ")])
    line_latest = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""
    sql["dedup_lineitem"] = line_latest
    sql["merge_current"] = LIVE
    sql["merge_current_small"] = LIVE
    sql["merge_lineitem"] = f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity
        FROM ({line_latest})"""
    sql["merge_incremental"] = LIVE
    sql["rebuild"] = f"WITH {EVT} {LATEST.format(source='evt')}"
    sql["scd2"] = SCD2
    sql["scd2_tracked"] = _tracked("source_pk", "event_type")
    sql["scd2_cut"] = _tracked("event_type", "source_pk")
    sql["scd2_merge"] = SCD2
    sides = ", ".join(
        f"""{name} AS (SELECT * FROM ({LATEST.format(source=f'(SELECT * FROM evt WHERE ts_event < {cut})')})
        WHERE op <> 'd')"""
        for name, cut in (("o", C1), ("n", "TIMESTAMP '9999-01-01'"))
    )
    sql["snapshot_diff"] = f"""WITH {EVT}, {sides}
        SELECT CASE WHEN o.source_pk IS NULL THEN 'insert' WHEN n.source_pk IS NULL THEN 'delete'
                    ELSE 'update' END AS change,
               coalesce(n.source_pk, o.source_pk) AS source_pk, n.ts_event AS ts_event,
               coalesce(n.source_pos, -1) AS source_pos, n.value AS value
        FROM o FULL JOIN n ON o.source_pk = n.source_pk
        WHERE o.source_pk IS NULL OR n.source_pk IS NULL
           OR (o.ts_event, o.source_pos, o.value) IS DISTINCT FROM (n.ts_event, n.source_pos, n.value)"""
    sql["apply_deletes"] = """SELECT * FROM orders WHERE o_orderkey NOT IN (
        SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag = 'R'))"""
    sql["backfill"] = LIVE
    sql["fence"] = f"""WITH {EVT}, rows AS (
            SELECT source_pos, ts_event, 'live' AS writer_id, value FROM evt
            UNION ALL
            SELECT source_pos, ts_event, 'backfill', value + 1 FROM evt
            WHERE ts_event >= TIMESTAMP '2024-01-09' AND ts_event < TIMESTAMP '2024-01-23'),
        owned AS (SELECT *, CASE WHEN ts_event >= {C1} AND ts_event < {C2} THEN 'backfill'
            WHEN ts_event >= {C2} AND ts_event < TIMESTAMP '2024-03-01' THEN 'live' END AS owner
            FROM rows)
        SELECT source_pos, writer_id, value FROM owned WHERE owner IS NULL OR owner = writer_id"""
    sql["fence_many"] = f"""WITH {EVT}, rows AS (SELECT source_pos, ts_event,
            'w' || CAST(source_pos % 4 AS VARCHAR) AS writer_id FROM evt),
        fences AS (SELECT 'w' || CAST(id % 3 AS VARCHAR) AS owner, {C1} + to_seconds(id * 7) AS a,
            {C1} + to_seconds(id * 7 + id % 40 + 1) AS b FROM (SELECT unnest(range(10000)) AS id)),
        hit AS (SELECT source_pos, bool_or(owner = writer_id) AS own FROM rows JOIN fences
            ON ts_event >= a AND ts_event < b GROUP BY 1)
        SELECT source_pos, writer_id FROM rows LEFT JOIN hit USING (source_pos)
        WHERE own IS NULL OR own"""
    sql["enrich_orders"] = """SELECT o_orderkey, o_totalprice, c_name, n_name,
        c_custkey IS NOT NULL AS matched_c_custkey, n_nationkey IS NOT NULL AS matched_n_nationkey
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey"""

    money = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"
    sql["orders_last_30d"] = f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderstatus,
        count(*) AS n_orders, {money} AS revenue FROM orders
        WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAYS GROUP BY 1, 2"""
    sql["customer_mrr"] = f"""SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS order_month,
        count(*) AS n_orders, {money} AS revenue FROM orders GROUP BY 1, 2"""
    qty = "CAST(l_quantity AS DECIMAL(18,2))"
    sql["inventory_position"] = f"""SELECT p_partkey, p_name,
        CAST(coalesce(a, 0) AS DOUBLE) AS returned_qty, CAST(coalesce(b, 0) AS DOUBLE) AS shipped_qty,
        CAST(coalesce(a, 0) - coalesce(b, 0) AS DOUBLE) AS position
        FROM part LEFT JOIN (SELECT l_partkey,
            sum(CASE WHEN l_returnflag = 'R' THEN {qty} ELSE 0 END) AS a,
            sum(CASE WHEN l_returnflag <> 'R' THEN {qty} ELSE 0 END) AS b
            FROM lineitem GROUP BY 1) ON p_partkey = l_partkey"""
    sql["customer_summary"] = f"""SELECT c_custkey, c_name, c_mktsegment, n_name, r_name,
        coalesce(n_orders, 0) AS n_orders, coalesce(spent, 0) AS total_spent, last_order
        FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
            ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, {money} AS spent,
            max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON c_custkey = o_custkey"""
    sql["vehicle_current"] = f"""WITH {TEL} SELECT vin, event_id, event_ts, odometer_km, speed_kph,
        geo_hash FROM (SELECT *, row_number() OVER (PARTITION BY vin
        ORDER BY event_ts DESC, event_id DESC) AS rn FROM tel) WHERE rn = 1"""
    sql["trip_summary"] = f"""WITH {TEL} SELECT vin, trip_id, min(event_ts) AS started_at,
        max(event_ts) AS ended_at, count(*) AS n_events,
        max(odometer_km) - min(odometer_km) AS distance_km, max(speed_kph) AS max_speed_kph,
        CAST(count(*) FILTER (brake_active) AS DOUBLE) / count(*) AS brake_share
        FROM tel GROUP BY 1, 2"""
    gx, gy = _index("latitude", "longitude", 3)
    sql["geo_grid"] = f"""WITH {TEL}, g AS (SELECT *, {gx} AS gx, {gy} AS gy FROM tel),
        c AS (SELECT *, {_cell('gx', 'gy', 3)} AS cell FROM g)
        SELECT cell, count(*) AS n_events, count(DISTINCT vin) AS n_vehicles,
        CAST(sum(CAST(speed_kph AS DECIMAL(18,2))) AS DOUBLE) / count(speed_kph) AS mean_speed_kph
        FROM c GROUP BY 1"""
    sql["geohash_cells"] = f"WITH {TEL} SELECT seq, {_cell('cx', 'cy', 7)} AS cell FROM tel"
    sql["last_week"] = """SELECT event_id, ts FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAYS"""

    sql["jsonl_reasons"] = f"""WITH {TEL} SELECT {DAMAGE} AS reason, count(*) AS n_lines FROM tel
        WHERE {DAMAGE} <> 'blank' GROUP BY 1"""
    sql["jsonl_events"] = DECODED
    sql["land_files"] = f"""WITH {TEL}, j AS (SELECT *, {DAMAGE} AS damage FROM tel)
        SELECT CASE WHEN damage <> 'decoded' THEN 'undecodable'
                    WHEN {gone} OR {ERRORS} <> '' THEN 'invalid' ELSE 'accepted' END AS verdict,
               CASE WHEN damage <> 'decoded' THEN damage WHEN {gone} THEN 'missing altitude_m'
                    ELSE {FIRST} END AS reason, count(*) AS n_rows
        FROM j WHERE damage <> 'blank' GROUP BY 1, 2"""
    sql["ingest_totals"] = f"""WITH {TEL}, j AS (SELECT *, {DAMAGE} AS damage FROM tel)
        SELECT count(*) FILTER (damage = 'decoded') AS events_written,
               count(*) FILTER (damage = 'decoded') AS events,
               count(*) FILTER (damage NOT IN ('decoded', 'blank')) AS errors FROM j"""
    sql["jsonl_sink_roundtrip"] = PROJECTED
    sql["rotate_files"] = """SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type
        || '","user_id":' || user_id || '}' AS value, TRUE AS within_limit FROM events"""

    sql["bronze_scan"] = f"""WITH {EVT} SELECT source_pk, ts_event, source_pos, op, value,
        CAST(CAST('0x' || substr(md5(CAST(source_pk AS VARCHAR)), 1, 8) AS BIGINT) % 4 AS INTEGER)
            AS bucket FROM evt WHERE ts_event >= {C1} AND ts_event < {C2}"""
    sql["read_since"] = f"""WITH {EVT} SELECT source_pos, ts_event FROM evt
        WHERE source_pos > (SELECT max(source_pos) FROM evt WHERE ts_event < {C1})"""
    sql["read_since_by_partition"] = f"""WITH {EVT}, known AS (
            SELECT event_type, max((ts_event, source_pos)) AS mark FROM evt
            WHERE ts_event < {C2} - to_days(CAST(length(event_type) AS INTEGER)) GROUP BY 1)
        SELECT evt.event_type, source_pos, ts_event FROM evt LEFT JOIN known USING (event_type)
        WHERE mark IS NULL OR (ts_event, source_pos) > mark"""
    sql["silver_versions"] = LIVE
    sql["silver_restart"] = LIVE
    sql["publish_upsert"] = f"""WITH {EVT} SELECT source_pk, ts_event, source_pos, value
        FROM ({LATEST.format(source='evt')}) WHERE op <> 'd'"""
    sql["retain_days"] = f"""WITH {EVT} SELECT source_pos, ts_event FROM evt
        WHERE CAST(ts_event AS DATE) > (SELECT CAST(max(ts_event) AS DATE) FROM evt) - 7"""
    bucket = """CAST(CAST('0x' || substr(md5(CAST(source_pk AS VARCHAR)), 1, 8) AS BIGINT) % 4
        AS INTEGER) AS bucket"""
    sql["compact_files"] = f"""WITH {EVT} SELECT source_pos, ts_event, op, value,
        strftime(ts_event, '%Y-%m-%d') AS event_date, CAST(1 AS BIGINT) AS n_files FROM evt"""
    sql["file_health"] = """SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n_rows,
        count(DISTINCT event_id % 6) AS n_files FROM events GROUP BY 1"""
    sql["relayout_table"] = f"""WITH {EVT} SELECT source_pk, ts_event, source_pos, op, value,
        {bucket} FROM evt"""
    sql["run_totals"] = f"""WITH {BAD} SELECT 'events' AS source, 'bronze' AS stage,
        CAST(0 AS BIGINT) AS batch_id, count(*) AS input_rows,
        count(*) FILTER (NOT value < 0) AS output_rows, count(*) FILTER (value < 0) AS error_rows
        FROM bad"""

    sql["bronze_stream"] = f"""WITH {EVT} SELECT source_pk, ts_event, source_pos, op, value,
        strftime(ts_event, '%Y-%m-%d') AS event_date FROM evt"""
    sql["jsonl_stream"] = DECODED
    sql["dedup_stream"] = f"WITH {EVT} SELECT source_pos, ts_event, source_pk, value FROM evt"
    sql["kpi_stream"] = """SELECT date_trunc('hour', ts) AS window_start,
        date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n_events,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
        FROM events GROUP BY 1, 2, 3
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR
            <= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTES"""
    sql["kpi_stream_open"] = """SELECT date_trunc('hour', ts) AS window_start,
        date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n_events
        FROM events GROUP BY 1, 2, 3"""
    sql["silver_stream"] = LIVE
    sql["stream_totals"] = """WITH c AS (SELECT event_id % 120, count(*) AS n FROM events GROUP BY 1)
        SELECT n AS n_rows, count(*) AS n_batches, CAST((SELECT count(*) FROM events) AS BIGINT)
            AS all_rows, CAST((SELECT count(*) FROM c) AS BIGINT) AS all_batches
        FROM c GROUP BY 1"""
    sql["land_stream_files"] = sql["land_files"]
    sql["split_late_stream"] = f"""WITH {EVT}, w AS (SELECT *, ts_event >= {C2}
            OR source_pos % 5 = 0 AS second FROM evt)
        SELECT source_pos, second AND ts_event < (SELECT max(ts_event) FROM w WHERE NOT second)
            - INTERVAL 15 MINUTES AS late FROM w"""
    sql["split_late_by_source"] = f"""WITH {EVT}, w AS (SELECT *, ts_event >= {C2}
            OR (event_type = 'click' AND ts_event >= {C1}) OR source_pos % 5 = 0 AS second FROM evt),
        m AS (SELECT event_type, max(ts_event) AS mark FROM w WHERE NOT second GROUP BY 1)
        SELECT 'own' AS judge, source_pos,
            coalesce(second AND ts_event < mark - INTERVAL 15 MINUTES, FALSE) AS late
        FROM w LEFT JOIN m USING (event_type)
        UNION ALL SELECT 'least', source_pos,
            second AND ts_event < (SELECT min(mark) FROM m) - INTERVAL 15 MINUTES FROM w"""
    sql["stopped_streams"] = f"""WITH {EVT} SELECT stream, source_pos,
            stream = 'ends' AS ended_by_itself, FALSE AS is_active
        FROM evt, (VALUES ('waits'), ('ends')) AS s(stream)"""
    sql["bus_records"] = f"""WITH {EVT} SELECT event_type AS topic,
        CAST(source_pk % 4 AS INTEGER) AS source_partition, source_pos,
        CAST(source_pk AS VARCHAR) AS source_pk,
        CASE WHEN source_pos % 97 = 0 OR source_pos % 89 = 0 OR source_pos % 83 = 0 THEN NULL
            ELSE k END AS k,
        CASE WHEN source_pos % 97 = 0 THEN 'tombstone' WHEN source_pos % 89 = 0 THEN 'not_json'
            WHEN source_pos % 83 = 0 THEN 'wrong_type' END AS reason FROM evt"""
    sql["contract_diff"] = """WITH c AS (SELECT table_name AS t, CASE WHEN table_name = 'lineitem'
            THEN CASE column_name WHEN 'l_orderkey' THEN 'o_orderkey' WHEN 'l_quantity'
            THEN 'o_custkey' ELSE column_name END ELSE column_name END AS field,
            CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
            WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS kind
        FROM information_schema.columns WHERE table_name IN ('orders', 'lineitem')),
        a AS (SELECT * FROM c WHERE t = 'orders'), w AS (SELECT * FROM c WHERE t = 'lineitem')
        SELECT coalesce(a.field, w.field) AS field,
            CASE WHEN a.field IS NULL THEN 'added' WHEN w.field IS NULL THEN 'removed'
            ELSE 'narrowed' END AS change,
            coalesce(a.kind, '') AS actual_type, coalesce(w.kind, '') AS wanted_type
        FROM a FULL JOIN w ON a.field = w.field WHERE a.kind IS DISTINCT FROM w.kind"""
    sql["gated_lake_job"] = f"""WITH {EVT}, good AS (SELECT * FROM evt
            WHERE ts_event < {C1} OR ts_event >= {C2})
        SELECT source_pk, ts_event, source_pos, value, CAST(3 AS BIGINT) AS runs
        FROM ({LATEST.format(source='good')}) WHERE op <> 'd'"""
    sql["lake_job"] = f"""WITH {EVT} SELECT event_type, op, count(*) AS n_users
        FROM ({LATEST.format(source='evt')}) WHERE op <> 'd' GROUP BY 1, 2"""
    sql |= state_sql(sql)
    return sql
