"""The same results in SQL, written independently of the plans (DuckDB dialect)."""

from __future__ import annotations


def canonical(c: str) -> str:
    h = rf"regexp_replace(lower({c}), 'urn:uuid:|[{{}}\s-]', '', 'g')"
    return (
        f"CASE WHEN regexp_full_match({h}, '[0-9a-f]{{32}}') THEN substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||substr({h},17,4)||'-'||substr({h},21,12) "
        f"ELSE nullif(trim(lower({c})), '') END"
    )


_RECORDS = f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY rid, event_ord ORDER BY inserted_at DESC NULLS LAST) AS nth,
           count(*) OVER (PARTITION BY rid, event_ord) AS copies
    FROM (SELECT {canonical("run_id")} AS rid, * EXCLUDE (run_id) FROM error_events)
  ) WHERE nth = 1"""

_PARENTS = f"SELECT DISTINCT {canonical('run_id')} AS rid FROM app_run_logs"

_REFS = f"""
  SELECT 'acquisition_history' AS table_name, strftime(inserted_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS period, {canonical("run_id")} AS run_id FROM acquisition_history
  UNION
  SELECT 'error_events', strftime(inserted_at AT TIME ZONE 'UTC', '%Y-%m-%d'), {canonical("run_id")} FROM error_events"""

_ORPHANS = f"SELECT * FROM ({_REFS}) r WHERE run_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({_PARENTS}) p WHERE p.rid = r.run_id)"

# Records by day of event time: a record without run_id is one of its own per distinct time and arrival.
_ARRIVED = f"""
  SELECT table_name, run_id, item, date_trunc('hour', min(t)) AS hour, min(arrival) AS arrival FROM (
    SELECT 'error_events' AS table_name, {canonical("run_id")} AS run_id, event_ord::VARCHAR AS item, dt AT TIME ZONE 'UTC' AS t, inserted_at AT TIME ZONE 'UTC' AS arrival FROM error_events
    UNION ALL
    SELECT 'acquisition_history', {canonical("run_id")}, system_id, capture_datetime AT TIME ZONE 'UTC', inserted_at AT TIME ZONE 'UTC' FROM acquisition_history
  ) WHERE t IS NOT NULL AND arrival <= date_trunc('hour', t) + INTERVAL 73 HOUR
  GROUP BY table_name, run_id, item, date_trunc('day', t), CASE WHEN run_id IS NULL OR item IS NULL THEN (t, arrival) END"""

# p5: events, then a walk over what they hold. A field value that is a string of an object or array counts as that. State e: below an event, A: an
# array of attempts, a: an attempt or below it (fresh: the attempt itself), S: an array of steps, s: a step.
_OPENED = "CASE WHEN json_type(k.value) = 'VARCHAR' AND w.obj AND json_valid(k.value ->> '$') AND regexp_matches(k.value ->> '$', '^[ \\t\\r\\n]*[{[]') THEN (k.value ->> '$')::JSON ELSE k.value END"
_RAW = "CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN (j ->> '$')::JSON END ELSE j END"
_WALK = f"""
  WITH RECURSIVE logged AS (
    SELECT rid, unnest(l) AS j, (generate_subscripts(l, 1) - 1)::INT AS ord FROM (
      SELECT {canonical("run_id")} AS rid, json_extract(warn_error_logs, '$[*]') AS l FROM app_run_logs WHERE json_valid(warn_error_logs) AND json_type(warn_error_logs) = 'ARRAY')),
  raw AS (SELECT rid, ord, {_RAW} AS j FROM (SELECT {canonical("run_id")} AS rid, event_ord AS ord, raw_event::JSON AS j FROM error_events WHERE json_valid(raw_event))),
  every AS (SELECT rid, ord, j::VARCHAR AS j FROM (SELECT rid, ord, j FROM logged UNION ALL SELECT rid, ord, j FROM raw) WHERE json_type(j) = 'OBJECT'),"""
_CASES = f"""{_WALK}
  events AS (SELECT DISTINCT rid, ord, j FROM every),
  walk(rid, ord, att, step, state, fresh, j, obj) AS (
    SELECT rid, ord, -1, -1, 'e', false, j::JSON, true FROM events
    UNION ALL
    SELECT rid, ord,
           CASE WHEN state = 'e' AND named AND kind = 'OBJECT' THEN 0 WHEN state = 'A' THEN place ELSE att END,
           CASE WHEN state = 'a' AND named AND kind = 'OBJECT' THEN 0 WHEN state = 'S' THEN place ELSE step END,
           CASE WHEN state = 'e' AND named THEN CASE kind WHEN 'OBJECT' THEN 'a' ELSE 'A' END WHEN state = 'A' THEN 'a'
                WHEN state = 'a' AND named THEN CASE kind WHEN 'OBJECT' THEN 's' ELSE 'S' END WHEN state = 'S' THEN 's' ELSE state END,
           kind = 'OBJECT' AND (state IN ('A', 'S') OR named), v, kind = 'OBJECT'
    FROM (
      SELECT w.*, v, json_type(v) AS kind, w.obj AND (w.state = 'e' AND key = 'attempts' OR w.state = 'a' AND key = 'steps') AS named, CASE WHEN NOT w.obj THEN key::INT END AS place
      FROM (SELECT w.rid, w.ord, w.att, w.step, w.state, w.obj, k.key, {_OPENED} AS v FROM walk w, json_each(w.j) k WHERE w.state <> 's') w
      WHERE json_type(v) IN ('OBJECT', 'ARRAY')))"""

# p5: all tables. A row is an event, or an element of a field that has a table (those of objects in arrays, and of both kinds of parents); other
# objects are walked with their path as prefix. open: an array whose elements are the rows.
_TABLES = "'attempts', 'steps', 'files'"
_ROWS = f"""{_WALK}
  walk(e, rid, ord, tbl, id, parent, pos, prefix, state, j, obj) AS (
    SELECT row_number() OVER (), rid, ord, 'event', '', NULL::VARCHAR, 0, '', 'row', j::JSON, true FROM every
    UNION ALL
    SELECT e, rid, ord, CASE WHEN named THEN key ELSE tbl END,
           CASE WHEN state = 'open' THEN id || '[' || key || ']' WHEN named THEN path || CASE kind WHEN 'OBJECT' THEN '[0]' ELSE '' END ELSE id END,
           CASE WHEN named THEN id ELSE parent END, CASE WHEN state = 'open' THEN key::INT WHEN named THEN 0 ELSE pos END,
           CASE WHEN state = 'open' OR named THEN '' ELSE prefix || key || '.' END,
           CASE WHEN named AND kind = 'ARRAY' THEN 'open' WHEN state = 'open' OR named THEN 'row' ELSE 'part' END, v, kind = 'OBJECT'
    FROM (
      SELECT w.*, json_type(v) AS kind, w.obj AND json_type(v) IN ('OBJECT', 'ARRAY') AND key IN ({_TABLES}) AS named, CASE w.id WHEN '' THEN '' ELSE w.id || '/' END || key AS path
      FROM (SELECT w.* EXCLUDE (j), k.key, {_OPENED} AS v FROM walk w, json_each(w.j) k WHERE w.obj OR w.state = 'open') w
    ) WHERE state = 'open' OR named OR kind = 'OBJECT'),
  fields AS (
    SELECT e, id, prefix || key AS field, v ->> '$' AS text FROM (SELECT w.e, w.id, w.prefix, w.state, k.key, {_OPENED} AS v FROM walk w, json_each(w.j) k WHERE w.obj)
    WHERE json_type(v) <> 'OBJECT' AND NOT (json_type(v) = 'ARRAY' AND key IN ({_TABLES})))"""


def _flat_table(name: str, fields: str, more: str = "") -> str:
    columns = ", ".join(f"max(text) FILTER (field = '{f}') AS {f.replace('.', '__')}" for f in fields.split())
    return f"""{_ROWS}
      SELECT rid AS run_id, ord AS event_ord, r.id AS row_id, parent AS parent_id, pos AS position, {columns}, NULL::VARCHAR AS element_value{more}
      FROM (SELECT * FROM walk WHERE state = 'row' AND obj AND tbl = '{name}') r LEFT JOIN fields f ON f.e = r.e AND f.id = r.id GROUP BY r.e, rid, ord, r.id, parent, pos"""


SQL = {
    "p5_table_sizes": f"{_ROWS} SELECT tbl AS table_name, count(*) AS rows, count(*) FILTER (obj) AS objects, count(*) FILTER (parent <> '') AS below_another_table FROM walk WHERE state = 'row' GROUP BY tbl",
    "p5_events": _flat_table("event", "dt err_msg func note.job_id note.message note.skip_reason note.sme note.system_id note.transfer.kind note.txt tag type"),
    "p5_attempts": _flat_table("attempts", "detail.phase host limits.kbps limits.tries no proto steps"),
    "p5_steps": _flat_table("steps", "ms op rc", ", regexp_extract(r.id, 'attempts\\[(\\d+)\\]', 1)::INT AS attempt_ord"),
    "p5_found": f"{_CASES} SELECT DISTINCT rid AS run_id, ord AS event_ord, att AS attempt_ord, step AS step_ord FROM walk WHERE fresh AND state IN ('a', 's')",
    "p1_found": f"""
      WITH records AS ({_RECORDS}), total AS (SELECT count(*) AS n FROM records)
      SELECT fingerprint, entity FROM records, total WHERE fingerprint IS NOT NULL
      GROUP BY fingerprint, entity, total.n HAVING count(*) * 100 >= total.n""",
    "p1_pair_bursts": f"""
      WITH records AS ({_RECORDS}), gaps AS (
        SELECT fingerprint, entity, epoch_us(dt) AS us,
               epoch_us(dt) - lag(epoch_us(dt)) OVER (PARTITION BY fingerprint, entity, dt IS NULL ORDER BY dt) AS gap
        FROM records)
      SELECT fingerprint, entity, count(*) AS n, count(us) AS timed, min(us) AS first_us, max(us) AS last_us,
             count(*) FILTER (us IS NOT NULL AND (gap IS NULL OR gap > 1800000000)) AS bursts, coalesce(max(gap), 0) AS max_gap_us
      FROM gaps GROUP BY fingerprint, entity""",
    "p2_found": f"""
      SELECT table_name, run_id, item FROM ({_ARRIVED})
      WHERE run_id IS NOT NULL AND arrival > hour + INTERVAL 3 HOUR AND arrival <= hour + INTERVAL 73 HOUR""",
    "p2_hourly_counts": f"""
      SELECT table_name, hour, count(*) FILTER (arrival <= hour + INTERVAL 3 HOUR) AS published,
             count(*) FILTER (arrival > hour + INTERVAL 3 HOUR) AS corrections, count(*) AS records
      FROM ({_ARRIVED}) WHERE arrival <= hour + INTERVAL 73 HOUR GROUP BY table_name, hour""",
    "p3_found": _ORPHANS,
    "p3_orphan_report": f"SELECT table_name, period, count(*) AS orphan_runs, min(run_id) AS first_run, max(run_id) AS last_run FROM ({_ORPHANS}) GROUP BY table_name, period",
    "p6_found": f"SELECT rid AS run_id, event_ord FROM ({_RECORDS}) WHERE copies > 1",
    "p6_messages": f"""
      SELECT rid AS run_id, event_ord, inserted_at AT TIME ZONE 'UTC' AS inserted_at, src_app_name, type, func, tag, err_msg, note_message, entity, fingerprint,
             dt AT TIME ZONE 'UTC' AS dt, raw_event, copies
      FROM (
        SELECT *, count(*) OVER (PARTITION BY rid, event_ord) AS copies,
               row_number() OVER (PARTITION BY rid, event_ord ORDER BY inserted_at DESC NULLS LAST, src_app_name DESC NULLS LAST, type DESC NULLS LAST, func DESC NULLS LAST,
                 tag DESC NULLS LAST, err_msg DESC NULLS LAST, note_message DESC NULLS LAST, entity DESC NULLS LAST, fingerprint DESC NULLS LAST, dt DESC NULLS LAST, raw_event DESC NULLS LAST) AS nth
        FROM (SELECT {canonical("run_id")} AS rid, * EXCLUDE (run_id) FROM error_events)
      ) WHERE nth = 1""",
}
