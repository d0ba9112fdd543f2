"""The same results in SQL, written independently of the plans (DuckDB dialect).

Only fixed values are shared with the code: the classification patterns, the scrubs and line patterns, and the producers. What they
have to give is pinned in ``tests/test_expectations.py``.
"""

from __future__ import annotations

from faultweave.functions.classify import ENGINE, TRANSPORT
from faultweave.functions.text import PROGRESS_HEAD, PROGRESS_ROW, PROGRESS_SECOND, SCRUBS, STACK_FRAME
from faultweave.plans.preparation_sql import canonical
from faultweave.sources.tables import PRODUCERS, SELF_APP

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _trimmed(x: str) -> str:
    return f"nullif(trim({x}, {_BLANKS}), '')"


def _string(v: str, path: str) -> str:
    return f"CASE WHEN json_type({v}, '{path}') = 'VARCHAR' THEN {v} ->> '{path}' END"


def _cases(text: str, rules: tuple, value) -> str:
    return " ".join(f"WHEN regexp_matches({text}, {_quoted(r[4])}) THEN {value(r)}" for r in rules)


def _category(text: str) -> str:
    return f"CASE {_cases(text, TRANSPORT + ENGINE, lambda r: _quoted(r[0]))} ELSE 'unknown' END"


def _error_type(text: str) -> str:
    return f"CASE {_cases(text, TRANSPORT + ENGINE, lambda r: _quoted(r[1]))} ELSE '' END"


def _flag(text: str, i: int) -> str:
    return f"CASE {_cases(text, TRANSPORT + ENGINE, lambda r: str(r[i]).lower())} ELSE false END"


def _normal(source: str, text: str) -> str:
    """A query of (text, normal) for the distinct texts of ``source``: lines first, by windows, then the scrubs."""
    scrubbed = "body"
    for pattern, placeholder in SCRUBS:
        scrubbed = f"regexp_replace({scrubbed}, {_quoted(pattern)}, '{placeholder}', 'g')"
    return f"""
      SELECT text, lower(trim(regexp_replace({scrubbed}, '\\s+', ' ', 'g'), {_BLANKS})) AS normal FROM (
        SELECT text, coalesce(string_agg(line, ' ' ORDER BY pos) FILTER (kept), '') AS body FROM (
          SELECT *, NOT head AND NOT frame AND NOT (row_like AND coalesce(opened, false)) AS kept FROM (
            SELECT *, last_value(CASE WHEN NOT row_like THEN head END IGNORE NULLS) OVER (PARTITION BY text ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opened FROM (
              SELECT text, pos, line, regexp_matches(line, {_quoted(PROGRESS_HEAD)}) AS head, regexp_matches(line, {_quoted(STACK_FRAME)}) AS frame,
                     regexp_matches(line, {_quoted(PROGRESS_SECOND)}) OR regexp_matches(line, {_quoted(PROGRESS_ROW)}) AS row_like
              FROM (SELECT text, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (SELECT text, regexp_split_to_array(text, '[\\r\\n]+') AS l FROM (SELECT DISTINCT {text} AS text FROM {source}))))))
        GROUP BY text)"""


_SOURCE = f"""
  SELECT * FROM app_run_logs WHERE app_name IN ({", ".join(map(_quoted, PRODUCERS))}) AND app_name <> '{SELF_APP}' AND warn_error_logs IS NOT NULL AND inserted_at > TIMESTAMPTZ '1970-01-01 00:00:00+00'"""


def _elements(source: str) -> str:
    return f"""
      SELECT run_id, app_name, inserted_at, unnest(l) AS ev, generate_subscripts(l, 1) - 1 AS event_ord FROM (
        SELECT run_id, app_name, inserted_at, json_extract(warn_error_logs, '$[*]') AS l FROM ({source}) WHERE json_valid(warn_error_logs) AND json_type(warn_error_logs) = 'ARRAY')"""


_TEXT = "coalesce(" + ", ".join(_trimmed(_string("ev", p)) for p in ("$.err_msg", "$.note.message", "$.note.txt", "$.note.skip_reason")) + ", '')"


def _sys(x: str) -> str:
    return f"CASE WHEN regexp_full_match({_trimmed(x)}, '(?i)SME\\d{{5}}') THEN upper({_trimmed(x)}) END"


_DT = _string("ev", "$.dt")
_PRINTED = f"try_strptime(regexp_extract({_DT}, '^\\w{{3}} (\\w{{3}} \\d{{2}} \\d{{4}} \\d{{2}}:\\d{{2}}:\\d{{2}}) GMT', 1) || ' ' || regexp_extract({_DT}, 'GMT([+-]\\d{{4}})', 1), '%b %d %Y %H:%M:%S %z')"
_EVENTS = f"""
  SELECT {canonical("run_id")} AS run_id, event_ord::INT AS event_ord, left(app_name, 64) AS src_app_name, app_name, left({_string("ev", "$.type")}, 8) AS type, left({_string("ev", "$.func")}, 64) AS func,
         left({_string("ev", "$.tag")}, 32) AS tag, {_trimmed(_string("ev", "$.err_msg"))} AS err_msg, {_trimmed(_string("ev", "$.note.message"))} AS note_message,
         left({_trimmed(_string("ev", "$.note.sme"))}, 16) AS sme, {_trimmed(_string("ev", "$.note.job_id"))} AS job_id,
         coalesce({_sys(_string("ev", "$.note.system_id"))}, {_sys(_string("ev", "$.note.sme"))}) AS system_id,
         1::SMALLINT AS fp_version, '' AS phase, date_trunc('milliseconds', coalesce(TRY_CAST({_DT} AS TIMESTAMPTZ), {_PRINTED})) AT TIME ZONE 'UTC' AS dt, {_TEXT} AS event_text,
         inserted_at AT TIME ZONE 'UTC' AS inserted_at, coalesce(ev ->> '$.func', '') AS raw_func, coalesce(ev ->> '$.tag', '') AS raw_tag, coalesce(ev ->> '$.type', '') AS raw_type
  FROM ({_elements(_SOURCE)}) WHERE json_type(ev) = 'OBJECT'"""


def _part(x: str) -> str:
    return f"replace(replace({x}, chr(92), chr(92) || chr(92)), '|', chr(92) || '|')"


_FLAT = f"""
  WITH e AS MATERIALIZED ({_EVENTS}), n AS ({_normal("e", "event_text")})
  SELECT run_id, event_ord, src_app_name, type, func, tag, err_msg, note_message, sme, job_id, system_id, left(coalesce({_trimmed("sme")}, system_id, '__global__'), 64) AS entity,
         sha1({" || '|' || ".join(_part(x) for x in ("app_name", "raw_func", "raw_tag", "raw_type", "normal"))}) AS fingerprint, fp_version,
         {_category("event_text")} AS error_category, {_error_type("event_text")} AS error_type, phase, dt, event_text, inserted_at
  FROM e JOIN n ON e.event_text = n.text"""

_SKIPPED = """
  SELECT {rid} AS run_id, NULL::INT AS event_ord, 'payload is not an array' AS reason FROM ({source})
  WHERE warn_error_logs IS NOT NULL AND coalesce(CASE WHEN json_valid(warn_error_logs) THEN json_type(warn_error_logs) NOT IN ('ARRAY', 'NULL') ELSE true END, true)
  UNION ALL
  SELECT {rid}, event_ord::INT, 'event is not an object' FROM ({elements}) WHERE json_type(ev) <> 'OBJECT'"""

_COLUMNS = "src_app_name, type, func, tag, err_msg, note_message, sme, job_id, system_id, entity, fingerprint, fp_version, error_category, error_type, phase, dt, raw_event"
_FACTS = f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, event_ord ORDER BY inserted_at NULLS FIRST, {", ".join(c.strip() + " NULLS FIRST" for c in _COLUMNS.split(","))}) AS nth
    FROM (SELECT {canonical("run_id")} AS run_id, * EXCLUDE (run_id) FROM error_events)) WHERE nth = 1"""

_JSON = "CASE WHEN json_valid(raw_event) THEN raw_event END"
_MESSAGES = f"""
  SELECT *, coalesce(dt, inserted_at) AS ts,
         coalesce({_trimmed("err_msg")}, {_trimmed("note_message")}, {_trimmed(_string(_JSON, "$.note.txt"))}, {_trimmed(_string(_JSON, "$.note.skip_reason"))}, '') AS msg
  FROM ({_FACTS})"""


def _incidents(where: str = "true") -> str:
    """Roll-up, representative by a ranked window, and enrichment by a ranked window."""
    return f"""
      SELECT a.*, r.run_id AS sample_run_id, r.msg AS sample_message, CASE WHEN r.error_category = 'unknown' THEN coalesce(s.error_category, 'unknown') ELSE r.error_category END AS category,
             CASE WHEN r.error_category = 'unknown' AND s.error_category IS NOT NULL THEN 'oracle' ELSE 'classifier' END AS category_source, r.error_type, r.type, '' AS phase, r.func
      FROM (SELECT fingerprint, entity, count(*) AS occurrence_count, min(ts) AS first_seen, max(ts) AS last_seen,
                   coalesce(string_agg(DISTINCT src_app_name, ',' ORDER BY src_app_name), '') AS apps, coalesce(string_agg(DISTINCT system_id, ',' ORDER BY system_id), '') AS systems
            FROM m WHERE {where} GROUP BY ALL) a
      JOIN (SELECT *, row_number() OVER (PARTITION BY fingerprint, entity ORDER BY ts DESC, run_id DESC, event_ord DESC) AS place FROM m WHERE {where}) r
        ON r.place = 1 AND a.fingerprint = r.fingerprint AND a.entity = r.entity
      LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY system_id ORDER BY inserted_at DESC, error_category DESC) AS place FROM acquisition_history
                 WHERE error_category IS NOT NULL AND error_category <> 'unknown') s ON s.place = 1 AND s.system_id = r.system_id"""


_M = f"m AS MATERIALIZED (SELECT * FROM ({_MESSAGES}) WHERE fingerprint IS NOT NULL)"
_ALL = f"WITH {_M}, i AS MATERIALIZED ({_incidents()})"


def _at(day: int) -> str:
    return f"TIMESTAMPTZ '2026-06-{day:02d} 00:00:00+00'"


_NOW = "TIMESTAMPTZ '2026-06-30 00:00:00+00'"
_OUTCOMES = f"SELECT {canonical('run_id')} AS rid, * FROM acquisition_history"
_LOGS = f"SELECT {canonical('run_id')} AS rid, * FROM app_run_logs WHERE inserted_at > {_NOW} - INTERVAL 14 DAY"
_LAST = f"""
  SELECT system_id AS entity, max(coalesce(capture_datetime, inserted_at)) AS last_success FROM ({_OUTCOMES}) ah
  WHERE successful_acquisition AND inserted_at > {_NOW} - INTERVAL 14 DAY AND EXISTS (SELECT 1 FROM ({_LOGS}) l WHERE l.rid = ah.rid AND l.app_name = 'data_acquisition') GROUP BY system_id"""


def _plain(columns: str, times: str = "first_seen, last_seen") -> str:
    t = [x.strip() for x in times.split(",")]
    return ", ".join(f"{c} AT TIME ZONE 'UTC' AS {c}" if c in t else c for c in (x.strip() for x in columns.split(",")))


_INCIDENT = "fingerprint, entity, occurrence_count, first_seen, last_seen, apps, systems, sample_run_id, sample_message, category, category_source, error_type, type, phase, func"

_TIMERS = """
  SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS run, event_type || CASE WHEN k % 3 <> 0 THEN '.' || (k % 5) ELSE '' END AS label, floor(value * 1000)::BIGINT AS ms, '10.0.' || (k % 4) AS subnet, ts
  FROM (SELECT *, (props ->> '$.k')::INT AS k FROM events)"""


def _stats(by: str, source: str, least: int = 1) -> str:
    return f"""
      SELECT {by}, n AS count, min(ms) AS min_ms, min(ms) FILTER (place = floor((n - 1) * 0.5)) AS p50_ms, min(ms) FILTER (place = floor((n - 1) * 0.95)) AS p95_ms, max(ms) AS max_ms
      FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY ms) - 1 AS place, count(*) OVER (PARTITION BY {by}) AS n FROM ({source}) WHERE ms IS NOT NULL) WHERE n >= {least} GROUP BY {by}, n"""


_TAXONOMY = ", ".join(f"({_quoted(c)}, {_quoted(t)}, {str(m).lower()}, {str(s).lower()}, {i})" for i, (c, t, m, s, _) in enumerate(TRANSPORT + ENGINE))

# The job's runs: a record belongs to the run whose window its first delivery arrived in.
_RUN_OF = f"CASE WHEN inserted_at <= {_at(8)} THEN 1 WHEN inserted_at <= {_at(15)} THEN 2 WHEN inserted_at <= {_at(22)} THEN 3 ELSE 5 END"
_RUNS = f"""
  WITH flat AS MATERIALIZED (SELECT * REPLACE (inserted_at AT TIME ZONE 'UTC' AS inserted_at, dt AT TIME ZONE 'UTC' AS dt) FROM ({_FLAT})),
  first AS MATERIALIZED (
    SELECT *, {_RUN_OF} AS run, coalesce(dt, inserted_at) AS ts FROM (
      SELECT *, row_number() OVER (PARTITION BY run_id, event_ord ORDER BY inserted_at, {", ".join(c + " NULLS FIRST" for c in "src_app_name, type, func, tag, err_msg, note_message, sme, job_id, system_id, entity, fingerprint".split(", "))}) AS nth
      FROM flat WHERE run_id IS NOT NULL) WHERE nth = 1),
  made AS MATERIALIZED (SELECT fingerprint, entity, min(run) AS run, max(run) AS last_run FROM first GROUP BY ALL)"""


def _run_time(run: str) -> str:
    return f"CASE {run} WHEN 1 THEN TIMESTAMP '2026-06-08' WHEN 2 THEN TIMESTAMP '2026-06-15' WHEN 3 THEN TIMESTAMP '2026-06-22' ELSE TIMESTAMP '2100-01-01' END"


_ID = "md5(fingerprint || '|' || coalesce(entity, ''))"

SQL = {
    "materialize_runs": f"""
      {_RUNS} SELECT r.run::INT AS run, (SELECT count(*) FROM first f WHERE f.run = r.run) AS appended, (SELECT count(*) FROM made m WHERE m.run = r.run) AS inserted,
        (SELECT count(*) FROM made m WHERE m.run <= r.run) AS incidents FROM range(1, 6) r(run)""",
    "materialized_incidents": f"""
      {_RUNS} SELECT a.fingerprint, a.entity, occurrence_count, first_seen AT TIME ZONE 'UTC' AS first_seen, last_seen AT TIME ZONE 'UTC' AS last_seen, r.run_id AS sample_run_id, r.event_text AS sample_message,
        {_run_time("m.run")} AS created_at, {_run_time("m.last_run")} AS updated_at
      FROM (SELECT fingerprint, entity, count(*) AS occurrence_count, min(ts) AS first_seen, max(ts) AS last_seen FROM first GROUP BY ALL) a
      JOIN (SELECT *, row_number() OVER (PARTITION BY fingerprint, entity ORDER BY ts DESC, run_id DESC, event_ord DESC) AS place FROM first) r
        ON r.place = 1 AND a.fingerprint = r.fingerprint AND a.entity = r.entity
      JOIN made m ON m.fingerprint = a.fingerprint AND m.entity = a.entity""",
    "state_writeback": f"""
      {_RUNS}, seen AS (SELECT fingerprint, entity, max(ts) FILTER (run <= 3) AS before, max(ts) AS now FROM first GROUP BY ALL HAVING count(*) FILTER (run <= 3) > 0),
      n AS (SELECT count(*) FILTER (before = now) AS hit, count(*) FILTER (before <> now) AS gone FROM seen)
      SELECT 1 AS attempt, hit AS updated, gone AS skipped, 0::BIGINT AS same, hit AS marked FROM n UNION ALL SELECT 2, 0::BIGINT, gone, hit, hit FROM n""",
    "dossiers": f"""
      {_ALL} SELECT {_ID} AS id, category, category_source, type, count(*) OVER (PARTITION BY fingerprint) AS entity_count, occurrence_count, entity, func,
        first_seen AT TIME ZONE 'UTC' AS first_seen, last_seen AT TIME ZONE 'UTC' AS last_seen, sample_message FROM i""",
    "recovery_facts": f"""
      {_ALL} SELECT {_ID} AS id, i.entity, i.last_seen AT TIME ZONE 'UTC' AS last_seen, nullif(split_part(apps, ',', 1), '') AS src_app, last_success AT TIME ZONE 'UTC' AS last_success FROM i LEFT JOIN ({_LAST}) s USING (entity)""",
    "incident_detail": f"{_ALL} SELECT {_ID} AS id, {_plain(_INCIDENT)} FROM i ORDER BY occurrence_count DESC, i.last_seen DESC, fingerprint, entity LIMIT 1",
    "apps_contain": f"{_ALL} SELECT contains(',' || apps || ',', ',data_acquisition,') AS has_app, count(*) AS incidents, sum(occurrence_count)::BIGINT AS events FROM i GROUP BY 1",
    "filtered_counts": f"""
      SELECT entity, sum((type IS NOT DISTINCT FROM 'ERROR')::INT)::BIGINT AS errors, sum((type IS NOT DISTINCT FROM 'WARN')::INT)::BIGINT AS warnings,
        count(DISTINCT CASE WHEN type = 'ERROR' THEN fingerprint END) AS error_kinds, max(CASE WHEN dt IS NULL THEN inserted_at END) AT TIME ZONE 'UTC' AS last_untimed
      FROM ({_FACTS}) GROUP BY entity""",
    "skipped_samples": "SELECT * FROM (" + _SKIPPED.format(rid=canonical("run_id"), source="SELECT * FROM app_run_logs", elements=_elements("SELECT * FROM app_run_logs")) + ") ORDER BY run_id NULLS FIRST, event_ord NULLS FIRST, reason LIMIT 20",
    "timer_scalars": f"""
      WITH t AS ({_TIMERS}), k AS (SELECT run, split_part(label, '.', 1) AS prefix, count(DISTINCT label) AS k FROM t WHERE contains(label, '.') GROUP BY ALL)
      SELECT run, label, ms AS last_ms FROM (SELECT *, row_number() OVER (PARTITION BY run, label ORDER BY ts DESC, ms DESC) AS place FROM t) l
      WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM k WHERE k.run = l.run AND k.prefix = split_part(l.label, '.', 1) AND contains(l.label, '.') AND k >= 3)""",
    "source_scan_window": f"""
      SELECT run_id, app_name, length(warn_error_logs)::INT AS payload_chars, inserted_at AT TIME ZONE 'UTC' AS inserted_at FROM ({_SOURCE})
      WHERE inserted_at > {_at(8)} - INTERVAL 30 SECOND AND inserted_at <= {_at(15)}""",
    "flatten_events": _FLAT,
    "raw_event_keys": f"""
      SELECT key, count(*) AS events, min(CASE WHEN json_type(v) = 'VARCHAR' THEN v ->> '$' END) AS first_text, max(CASE WHEN json_type(v) = 'VARCHAR' THEN v ->> '$' END) AS last_text
      FROM (SELECT k.key, k.value AS v FROM ({_elements(_SOURCE)}) e, json_each(e.ev) k WHERE json_type(e.ev) = 'OBJECT') GROUP BY key""",
    "event_text": f"SELECT event_text, count(*) AS events FROM ({_EVENTS}) GROUP BY 1",
    "fingerprint": f"SELECT fingerprint, src_app_name, type, count(*) AS events FROM ({_FLAT}) GROUP BY ALL",
    "entity_key": f"SELECT entity, system_id, count(*) AS events FROM ({_FLAT}) GROUP BY ALL",
    "skipped_events": _SKIPPED.format(rid=canonical("run_id"), source=_SOURCE, elements=_elements(_SOURCE)),
    "malformed_payloads": "SELECT reason, count(*) AS records FROM (" + _SKIPPED.format(rid="run_id", source="SELECT * FROM app_run_logs", elements=_elements("SELECT * FROM app_run_logs")) + ") GROUP BY reason",
    "dedupe_append": f"""
      WITH e AS (SELECT {canonical("run_id")} AS run_id, event_ord, inserted_at FROM error_events)
      SELECT DISTINCT run_id, event_ord FROM e WHERE inserted_at > {_at(15)} AND run_id IS NOT NULL AND event_ord IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM e o WHERE o.inserted_at <= {_at(15)} AND o.run_id = e.run_id AND o.event_ord = e.event_ord)""",
    "normalize_text": f"WITH a AS MATERIALIZED ({_MESSAGES}) SELECT normal, count(*) AS messages FROM ({_normal('a', 'msg')}) GROUP BY normal",
    "classify_events": f"""
      SELECT {_category("msg")} AS category, {_error_type("msg")} AS error_type, {_flag("msg", 2)} AS manual_intervention, {_flag("msg", 3)} AS successful_acquisition, count(*) AS events, min(msg) AS first_message
      FROM ({_MESSAGES}) GROUP BY 1, 2, 3, 4""",
    "classify_layers": f"""
      SELECT CASE {_cases("msg", TRANSPORT, lambda r: "'transport'")} {_cases("msg", ENGINE, lambda r: "'engine'")} ELSE 'none' END AS layer, error_category, count(*) AS events FROM ({_MESSAGES}) GROUP BY 1, 2""",
    "backfill_category": f"SELECT {_category('msg')} AS category, count(*) AS filled FROM ({_MESSAGES}) WHERE error_category IS NULL GROUP BY 1",
    "taxonomy_table": f"""
      SELECT category, arg_min(error_type, i) AS error_type, arg_min(manual_intervention, i) AS manual_intervention, arg_min(successful_acquisition, i) AS successful_acquisition
      FROM (VALUES {_TAXONOMY}) t(category, error_type, manual_intervention, successful_acquisition, i) GROUP BY category""",
    "agg_incidents": f"""
      SELECT fingerprint, entity, count(*) AS occurrence_count, min(ts) AT TIME ZONE 'UTC' AS first_seen, max(ts) AT TIME ZONE 'UTC' AS last_seen,
             coalesce(string_agg(DISTINCT src_app_name, ',' ORDER BY src_app_name), '') AS apps, coalesce(string_agg(DISTINCT system_id, ',' ORDER BY system_id), '') AS systems
      FROM ({_MESSAGES}) GROUP BY fingerprint, entity""",
    "representative": f"""
      SELECT fingerprint, entity, run_id, event_ord, msg, error_category FROM (
        SELECT *, row_number() OVER (PARTITION BY fingerprint, entity ORDER BY ts DESC, run_id DESC, event_ord DESC) AS place FROM ({_MESSAGES})) WHERE place = 1""",
    "enriched_incidents": f"{_ALL} SELECT {_plain(_INCIDENT)} FROM i",
    "category_source": f"{_ALL} SELECT category, category_source, count(*) AS incidents, sum(occurrence_count)::BIGINT AS events FROM i GROUP BY ALL",
    "incremental_merge": f"{_ALL} SELECT {_plain(_INCIDENT)} FROM i",
    "rebuild_equals_incremental": f"{_ALL} SELECT count(*) AS incidents, 0::BIGINT AS different FROM i",
    "merge_inserted": f"""
      {_ALL} SELECT inserted, count(*) AS incidents, sum(n)::BIGINT AS events FROM (
        SELECT fingerprint, entity, count(*) FILTER (inserted_at <= {_at(15)}) = 0 AS inserted, count(*) AS n FROM m GROUP BY fingerprint, entity) GROUP BY inserted""",
    "blast_radius": f"{_ALL} SELECT fingerprint, entity, occurrence_count, (SELECT count(*) FROM i j WHERE j.fingerprint = i.fingerprint) AS entity_count FROM i",
    "recovery_semi": f"SELECT entity, last_success AT TIME ZONE 'UTC' AS last_success FROM ({_LAST})",
    "incident_last_success": f"""
      {_ALL} SELECT fingerprint, entity, last_seen AT TIME ZONE 'UTC' AS last_seen, CASE WHEN last_success > last_seen THEN last_success END AT TIME ZONE 'UTC' AS recovered_at
      FROM i LEFT JOIN ({_LAST}) s USING (entity)""",
    "success_after_incident": f"""
      {_ALL} SELECT fingerprint, entity FROM i WHERE EXISTS (
        SELECT 1 FROM acquisition_history s WHERE s.successful_acquisition AND s.system_id = i.entity AND coalesce(s.capture_datetime, s.inserted_at) > i.last_seen)""",
    "foreign_audit": f"""
      SELECT app_name, count(*) AS foreign_rows FROM ({_OUTCOMES}) ah JOIN ({_LOGS}) l ON ah.rid = l.rid
      WHERE ah.inserted_at > {_NOW} - INTERVAL 14 DAY AND app_name <> 'data_acquisition' GROUP BY app_name""",
    "unlinked_anti": f"""
      SELECT count(*) AS unlinked_rows FROM ({_OUTCOMES}) ah WHERE inserted_at BETWEEN {_NOW} - INTERVAL 2 DAY AND {_NOW} - INTERVAL 1 HOUR AND NOT EXISTS (SELECT 1 FROM ({_LOGS}) l WHERE l.rid = ah.rid)""",
    "noop_update": f"""
      {_ALL}, o AS ({_incidents(f"inserted_at <= {_at(22)}")}) SELECT i.fingerprint, i.entity, i.sample_run_id, i.category, i.category_source FROM i JOIN o USING (fingerprint, entity)
      WHERE i.sample_run_id IS DISTINCT FROM o.sample_run_id OR i.category IS DISTINCT FROM o.category OR i.category_source IS DISTINCT FROM o.category_source""",
    "state_guard": f"""
      {_ALL}, o AS (SELECT fingerprint, entity, max(ts) AS seen FROM m WHERE inserted_at <= {_at(22)} GROUP BY ALL)
      SELECT outcome, CASE WHEN outcome = 'updated' THEN 'seen' END AS mark, count(*) AS incidents FROM (
        SELECT CASE WHEN o.fingerprint IS NULL THEN 'kept' WHEN o.seen = i.last_seen THEN 'updated' ELSE 'skipped' END AS outcome FROM i LEFT JOIN o USING (fingerprint, entity)) GROUP BY outcome""",
    "drilldown_topn": f"""
      WITH f AS MATERIALIZED ({_FACTS}), t AS (SELECT fingerprint, entity FROM f WHERE fingerprint IS NOT NULL AND entity IS NOT NULL GROUP BY ALL ORDER BY count(*) DESC, fingerprint, entity LIMIT 1)
      SELECT run_id, event_ord, dt AT TIME ZONE 'UTC' AS dt, type, func FROM f JOIN t USING (fingerprint, entity) ORDER BY f.dt DESC NULLS LAST, run_id DESC, event_ord DESC LIMIT 50""",
    "incident_list_topk": f"""
      {_ALL} SELECT fingerprint, entity, occurrence_count, last_seen AT TIME ZONE 'UTC' AS last_seen, category FROM i ORDER BY occurrence_count DESC, i.last_seen DESC, fingerprint, entity LIMIT 20""",
    "incident_rollup": f"{_ALL} SELECT category, type, count(*) AS incidents, sum(occurrence_count)::BIGINT AS events, count(DISTINCT fingerprint) AS fingerprints FROM i GROUP BY ALL",
    "mixed_type_guard": f"SELECT fingerprint, count(DISTINCT type) AS types FROM ({_FACTS}) WHERE fingerprint IS NOT NULL GROUP BY 1 HAVING count(DISTINCT type) > 1",
    "duplicate_key_guard": f"SELECT n AS deliveries, count(*) AS records FROM (SELECT count(*) AS n FROM error_events GROUP BY {canonical('run_id')}, event_ord) GROUP BY n",
    "watermark_advance": """
      SELECT source_key, greatest(coalesce(last_inserted_at, TIMESTAMPTZ '1970-01-01 00:00:00+00'), m) AT TIME ZONE 'UTC' AS last_inserted_at FROM pipeline_state FULL JOIN (
        SELECT 'util.app_run_logs' AS source_key, max(inserted_at) AS m FROM app_run_logs UNION ALL SELECT 'incidents.error_events', max(inserted_at) FROM error_events) USING (source_key)""",
    "run_stats_quantiles": _stats("label", _TIMERS),
    "duration_buckets": f"""
      SELECT label, count(*) FILTER (ms < 10000) AS b0_10, count(*) FILTER (ms >= 10000 AND ms < 30000) AS b10_30, count(*) FILTER (ms >= 30000 AND ms < 60000) AS b30_60,
             count(*) FILTER (ms >= 60000 AND ms < 90000) AS b60_90, count(*) FILTER (ms >= 90000) AS b90 FROM ({_TIMERS}) GROUP BY label""",
    "prefix_rollup": _stats(
        "run, shown",
        f"""SELECT t.run, ms, CASE WHEN k >= 3 THEN t.prefix || '.*' ELSE label END AS shown
            FROM (SELECT *, split_part(label, '.', 1) AS prefix FROM ({_TIMERS})) t
            LEFT JOIN (SELECT run, split_part(label, '.', 1) AS prefix, count(DISTINCT label) AS k FROM ({_TIMERS}) WHERE contains(label, '.') GROUP BY ALL) p
              ON p.run = t.run AND p.prefix = t.prefix AND contains(label, '.')""",
    ),
    "subnet_rollup": _stats("run, subnet", _TIMERS, 2),
    "run_span": f"SELECT run, count(*) AS event_count, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS wall_clock_ms FROM ({_TIMERS}) GROUP BY run",
}
