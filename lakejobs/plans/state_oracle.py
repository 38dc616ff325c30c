"""SQL for the queries over what jobs keep between runs."""

from __future__ import annotations

C1 = "TIMESTAMP '2024-01-11 00:00:00'"
C2 = "TIMESTAMP '2024-01-21 00:00:00'"
_LOG = """log AS (
    SELECT {key} AS source_pk, ts AS ts_event, event_id AS source_pos,
        CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, value,
        CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS bucket
    FROM events)"""
LOG = _LOG.format(key="user_id")
ENTITY = "((user_id % 40) * 100 + CAST(regexp_extract(props, '[0-9]+') AS BIGINT))"


def _expiry() -> str:
    """Three rounds of: judge by the marks, merge, raise the marks, expire."""
    again = f"ts_event < {C1} AND op <> 'd'"
    rows = {
        1: f"ts_event < {C1}",
        2: f"(ts_event >= {C1} AND ts_event < {C2}) OR ({again} AND source_pos % 5 = 0)",
        3: f"ts_event >= {C2} OR ({again} AND source_pos % 7 = 0)",
    }
    steps = [_LOG.format(key=ENTITY), "s0 AS (SELECT * FROM log WHERE FALSE)",
             "m0 AS (SELECT bucket, ts_event AS mark FROM log WHERE FALSE)"]
    for n, which in rows.items():
        p = n - 1
        steps += [
            f"""late{n} AS (SELECT log.* FROM log JOIN m{p} USING (bucket) WHERE ({which})
                AND ts_event < mark AND source_pk NOT IN (SELECT source_pk FROM s{p}))""",
            f"""m{n} AS (SELECT bucket, max(mark) AS mark FROM (SELECT * FROM m{p} UNION ALL
                SELECT bucket, ts_event - INTERVAL 3 DAY FROM log WHERE {which}) GROUP BY 1)""",
            f"""t{n} AS (SELECT * FROM s{p} UNION ALL SELECT * FROM log WHERE ({which})
                AND source_pos NOT IN (SELECT source_pos FROM late{n}))""",
            f"""s{n} AS (SELECT t.* FROM (SELECT * FROM t{n} QUALIFY row_number() OVER (
                PARTITION BY source_pk ORDER BY ts_event DESC, source_pos DESC) = 1) t
                JOIN m{n} USING (bucket) WHERE op <> 'd' OR ts_event >= mark)""",
        ]
    columns = "source_pk, op, ts_event, source_pos"
    parts = [
        f"SELECT {n} AS n, '{kind}' AS kind, {columns} FROM {t}{n}"
        for n in rows
        for kind, t in (("too late", "late"), ("state", "s"))
    ]
    return "WITH " + ", ".join(steps) + " " + " UNION ALL ".join(parts)


def _holes() -> str:
    early, middle = f"ts < {C1} AND event_id % 11 <> 0", f"ts < {C2} AND event_id % 22 <> 0"
    last = f"(ts >= {C2} AND event_id % 13 <> 0) OR event_id % 33 = 0"
    seen = [early, f"({early}) OR ({middle})", f"({early}) OR ({middle}) OR ({last})"]
    parts = [
        f"""SELECT {n} AS after_batch, source_partition, before + 1 AS lo, pos - 1 AS hi FROM (
            SELECT source_partition, pos, lag(pos) OVER (PARTITION BY source_partition ORDER BY pos)
                AS before
            FROM (SELECT event_id % 4 AS source_partition, event_id // 4 AS pos FROM events
                WHERE {which}))
        WHERE pos > before + 1"""
        for n, which in enumerate(seen, 1)
    ]
    return " UNION ALL ".join(parts)


def state_sql(sql: dict[str, str]) -> dict[str, str]:
    """By query name; sql has the statements that some of them share."""
    return {
        "land_once": sql["land_files"],
        "tombstone_expiry": _expiry(),
        "offset_holes": _holes(),
        "offset_replay": f"""SELECT event_id, event_id // 4 AS pos FROM events
            WHERE ts >= {C2}""",
        "pack_files": f"""WITH {LOG}, days AS (SELECT *, CAST(ts_event AS DATE) AS event_date
                FROM log), small AS (SELECT event_date, count(DISTINCT source_pos % 10) AS n
                FROM days WHERE source_pos % 10 >= 7 GROUP BY 1)
            SELECT source_pos, op, value, CAST(event_date AS VARCHAR) AS event_date,
                source_pos % 10 >= 7 AND coalesce(n, 0) >= 2 AS packed
            FROM days LEFT JOIN small USING (event_date)""",
        "pack_and_swap": f"""WITH {LOG} SELECT source_pos, ts_event, op, value,
            CAST(CAST(ts_event AS DATE) AS VARCHAR) AS event_date, CAST(1 AS BIGINT) AS n_files
            FROM log""",
        "history_regions": sql["scd2"],
        "distinct_sketches": """WITH e AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
                FROM events), s AS (SELECT day AS scope, * FROM e UNION ALL
                SELECT event_type, * FROM e UNION ALL SELECT 'all', * FROM e)
            SELECT scope, count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct,
                TRUE AS in_bound FROM s GROUP BY 1""",
        "contract_versions": """SELECT 'v' || (event_id % 3 + 1) AS version, event_id,
                user_id AS user, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
                CASE WHEN event_id % 3 > 0 THEN event_type END AS kind,
                CASE WHEN event_id % 3 = 2 THEN CASE event_type WHEN 'signup' THEN 'c'
                    WHEN 'error' THEN 'd' ELSE 'u' END || ',' || event_type ELSE '' END AS tags,
                CASE WHEN event_id % 3 = 2 THEN 'web' ELSE 'unknown' END AS origin,
                'backward' AS chain FROM events""",
        # A line's file was landed for the first version that could take it; blank lines are none.
        "lineage_files": """SELECT 'vehicles/' || version AS publication, count(*) AS n_lines
            FROM (SELECT unnest(range(1, 6)) AS version) JOIN events ON event_id % 5 < version
            WHERE event_id % 251 <> 0 OR event_id % 211 = 0 OR event_id % 223 = 0
                OR event_id % 227 = 0 OR event_id % 229 = 0 OR event_id % 233 = 0
                OR event_id % 239 = 0 OR event_id % 241 = 0 GROUP BY ALL""",
    }
