"""DuckDB SQL for each registered query (views: the driver tables by name).

Written from the semantics in the query docstrings, independently of the Spark code path.
"""

from __future__ import annotations

W = 3_600_000_000  # batch width, microseconds (1 hour)
DAY = 86_400_000_000
LIMIT = 330.0

# shared CTEs: processor batch log over whole days, empty batches included
BATCH_LOG_CTES = f"""
ev AS (
  SELECT event_id, event_type AS proc, ts, value, epoch_us(ts) AS us FROM events
),
bounds AS (
  SELECT proc, (min(us) // {DAY}) * {DAY} AS lo, (max(us) // {DAY} + 1) * {DAY} AS hi FROM ev GROUP BY proc
),
spine AS (
  SELECT proc, lo + unnest(range(0::BIGINT, ((hi - lo) // {W})::BIGINT)) * {W} AS bs FROM bounds
),
counts AS (
  SELECT proc, (us // {W}) * {W} AS bs, count(*) AS n,
         max(CASE WHEN value > {LIMIT} THEN 1 ELSE 0 END) AS failed
  FROM ev GROUP BY ALL
),
hist AS (
  SELECT event_type AS ds, strftime(CAST(ts AS DATE) - 1, '%Y%m%d') AS value, ts AS updated_at FROM events
),
blog AS (
  SELECT s.proc, s.bs, (s.bs + {W}) // 1000 AS batch_time,
         strftime(make_timestamp(s.bs), '%Y%m%d') AS date,
         CAST((s.bs % {DAY}) // {W} AS INTEGER) AS batch,
         coalesce(c.n, 0) AS num_records, CAST(coalesce(c.failed, 0) AS INTEGER) AS failed,
         make_timestamp(s.bs + {W}) AS probe
  FROM spine s LEFT JOIN counts c ON s.proc = c.proc AND s.bs = c.bs
),
batch_log AS (
  SELECT b.proc, b.batch_time, b.date, b.batch, b.num_records, b.failed, coalesce(h.value, '') AS sync
  FROM blog b ASOF LEFT JOIN hist h ON b.proc = h.ds AND h.updated_at <= b.probe
),
start_state AS (
  SELECT proc,
         strftime(make_timestamp(bs), '%Y%m%d') AS trace,
         CAST((bs % {DAY}) // {W} AS INTEGER) + 1 AS batch_num,
         (bs + {W}) // 1000 AS commit_time
  FROM (SELECT event_type AS proc, (min(epoch_us(ts)) // {W}) * {W} AS bs FROM events GROUP BY 1)
)"""

REPLAY = f"""
WITH RECURSIVE {BATCH_LOG_CTES},
lg AS (
  SELECT proc, batch_time, num_records AS n, failed, sync,
         row_number() OVER (PARTITION BY proc ORDER BY batch_time) AS i
  FROM batch_log
),
rec AS (
  SELECT l.proc, l.i, l.batch_time, s.trace, s.batch_num, s.commit_time, false AS dead,
         CASE WHEN l.batch_time <= s.commit_time THEN 'redo'
              WHEN l.n = 0 AND l.sync >= s.trace THEN 'switch'
              WHEN l.failed = 0 THEN 'commit' ELSE 'abort' END AS outcome
  FROM lg l JOIN start_state s ON l.proc = s.proc
  WHERE l.i = 1
  UNION ALL
  SELECT proc, i, batch_time, trace, batch_num, commit_time, dead,
         CASE WHEN dead THEN 'ignored'
              WHEN batch_time <= commit_time THEN 'redo'
              WHEN n = 0 AND sync >= trace THEN 'switch'
              WHEN failed = 0 THEN 'commit' ELSE 'abort' END AS outcome
  FROM (
    SELECT l.proc, l.i, l.batch_time, l.n, l.failed, l.sync,
           CASE WHEN r.outcome = 'switch'
                THEN strftime(strptime(r.trace, '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') ELSE r.trace END AS trace,
           CASE WHEN r.outcome = 'switch' THEN 0 WHEN r.outcome = 'commit' THEN r.batch_num + 1
                ELSE r.batch_num END AS batch_num,
           CASE WHEN r.outcome = 'commit' THEN r.batch_time ELSE r.commit_time END AS commit_time,
           r.dead OR r.outcome = 'abort' AS dead
    FROM rec r JOIN lg l ON l.proc = r.proc AND l.i = r.i + 1
  )
)
SELECT proc, batch_time, trace, CAST(batch_num AS INTEGER) AS batch_num, outcome FROM rec
"""


def _fmt_batch(x: str) -> str:
    """SQL twin of Java's ``%0,2d``: two digits at least, thousands separated by commas."""
    return (f"(CASE WHEN {x} < 10 THEN '0' || CAST({x} AS VARCHAR) WHEN {x} < 1000 THEN CAST({x} AS VARCHAR) "
            f"ELSE format('{{:,}}', {x}) END)")


def _sign(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 16) AS UBIGINT)"


SLOT = f"((epoch_us(ts) // {W}) * {W})"
LATEST_CTE = """latest AS (
  SELECT event_type AS ds, arg_max(strftime(CAST(ts AS DATE) - 1, '%Y%m%d'), ts) AS latest
  FROM events GROUP BY event_type
)"""
HIST_CTE = """hist AS (
  SELECT event_type AS ds, strftime(CAST(ts AS DATE) - 1, '%Y%m%d') AS value, ts AS updated_at FROM events
)"""
USER_SYNC_CTES = f"""{LATEST_CTE},
users AS (SELECT DISTINCT user_id AS proc FROM events),
up AS (SELECT DISTINCT user_id AS proc, event_type AS ds FROM events WHERE event_type IS NOT NULL),
user_sync AS (
  SELECT u.proc, min(CASE WHEN up.ds IS NULL THEN NULL ELSE coalesce(l.latest, '') END) AS sync
  FROM users u LEFT JOIN up ON u.proc IS NOT DISTINCT FROM up.proc LEFT JOIN latest l ON up.ds = l.ds
  GROUP BY u.proc
)"""
SYNC_AT = f"""
WITH {HIST_CTE},
p AS (SELECT event_id, event_type AS proc, ts AS probe_time FROM events),
ups AS (SELECT DISTINCT event_type AS ds FROM events),
pu AS (SELECT p.event_id, p.proc, p.probe_time, ups.ds FROM p JOIN ups ON p.proc <> ups.ds),
m AS (
  SELECT pu.event_id, pu.proc, pu.probe_time, h.value
  FROM pu ASOF LEFT JOIN hist h ON pu.ds = h.ds AND h.updated_at <= pu.probe_time
)
SELECT event_id, proc, probe_time, min(coalesce(value, '')) AS sync FROM m GROUP BY event_id, proc, probe_time
"""
SEQ_CTE = """seqd AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS seq
  FROM events
)"""

ORACLES: dict[str, str] = {
    "replay_ledger": REPLAY,
    "replay_ledger_stream": REPLAY,
    "batchify": f"""
SELECT event_id, event_type, {SLOT} AS batch_start_us,
       strftime(make_timestamp({SLOT}), '%Y%m%d') AS date,
       CAST(({SLOT} % {DAY}) // {W} AS INTEGER) AS batch,
       ({SLOT} + {W}) // 1000 AS batch_time
FROM events""",
    "batch_counts": f"WITH {BATCH_LOG_CTES} SELECT proc, date, batch, batch_time, num_records FROM blog",
    "batch_log": f"WITH {BATCH_LOG_CTES} SELECT proc, batch_time, date, batch, num_records, failed, sync FROM batch_log",
    "failed_outputs": f"""
SELECT strftime(make_timestamp({SLOT}), '%Y%m%d') AS date, CAST(({SLOT} % {DAY}) // {W} AS INTEGER) AS batch,
       count(*) AS num_ops, count_if(event_type = 'error' AND props IS NOT NULL) AS num_failed
FROM events GROUP BY ALL""",
    "skip_committed": f"""
WITH {BATCH_LOG_CTES}
SELECT b.proc, b.batch_time, b.num_records
FROM batch_log b LEFT JOIN start_state s ON b.proc = s.proc
WHERE b.batch_time > coalesce(s.commit_time, 0)""",
    "batch_outcome": f"""
WITH {BATCH_LOG_CTES},
o AS (
  SELECT b.proc, b.batch_time, b.num_records,
         CASE WHEN b.batch_time <= s.commit_time THEN 'redo'
              WHEN b.num_records = 0 AND b.sync >= s.trace THEN 'switch'
              WHEN coalesce(b.failed, 0) = 0 THEN 'commit' ELSE 'abort' END AS outcome
  FROM batch_log b JOIN start_state s ON b.proc = s.proc
)
SELECT proc, batch_time, outcome, outcome = 'commit' AND num_records = 0 AS delayed FROM o""",
    "record_value": "SELECT CAST(value AS VARCHAR) AS value FROM events",
    "sign64": f"""
SELECT event_id, CAST({_sign('CAST(user_id AS VARCHAR)')} AS VARCHAR) AS key_sign,
       CAST({_sign('event_type')} AS VARCHAR) AS type_sign
FROM events""",
    "hash_partition": "SELECT event_id, " + ", ".join(
        f"CAST({_sign('CAST(user_id AS VARCHAR)')} % {n} AS INTEGER) AS p{n}" for n in (7, 8, 12)) + " FROM events",
    "assign_partition": f"""
SELECT event_id, CAST({_sign('CAST(user_id AS VARCHAR)')} % 12 AS INTEGER) AS part_hash,
       CAST(NULL AS INTEGER) AS part_random, CAST(3 AS INTEGER) AS part_fixed, CAST(NULL AS INTEGER) AS part_negative
FROM events""",
    "parse_commit": f"""
WITH c AS (
  SELECT event_id, strftime(ts, '%Y%m%d') || '/' || {_fmt_batch('b')} || '00/' || CAST(event_id AS VARCHAR) AS commit
  FROM (SELECT event_id, ts, CAST((hour(ts) * 60 + minute(ts)) // 10 AS INTEGER) AS b FROM events)
),
p AS (
  SELECT event_id, commit,
         regexp_full_match(commit, '([0-9]{{8}})/([0-9]{{2}})00/([0-9]*)') AS m,
         regexp_extract(commit, '^([0-9]{{8}})/([0-9]{{2}})00/([0-9]*)$', 1) AS d,
         regexp_extract(commit, '^([0-9]{{8}})/([0-9]{{2}})00/([0-9]*)$', 2) AS bb,
         regexp_extract(commit, '^([0-9]{{8}})/([0-9]{{2}})00/([0-9]*)$', 3) AS mst
  FROM c
),
q AS (
  SELECT *, CASE WHEN mst = '0' THEN CAST(0 AS BIGINT) ELSE TRY_CAST(mst AS BIGINT) END AS ms FROM p
),
v AS (SELECT *, m AND ms IS NOT NULL AS valid FROM q)
SELECT event_id, commit,
       CASE WHEN valid THEN d END AS commit_date,
       CASE WHEN valid THEN CAST(bb AS INTEGER) END AS commit_batch,
       CASE WHEN valid THEN ms END AS commit_ms,
       CASE WHEN valid THEN (CASE WHEN mst = '0' THEN 0 ELSE CAST(bb AS INTEGER) + 1 END) END AS next_batch,
       valid
FROM v""",
    "batch_path": f"""
SELECT event_id, d || '/' || f || '00' AS path, d || '/' || f || '00/' || CAST(event_id AS VARCHAR) AS commit
FROM (
  SELECT event_id, strftime(ts, '%Y%m%d') AS d, {_fmt_batch('m')} AS f
  FROM (SELECT event_id, ts, hour(ts) * 60 + minute(ts) AS m FROM events)
)""",
    "next_day": """
SELECT event_id, strftime(ts, '%Y%m%d') AS date,
       strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y%m%d') AS next_date
FROM events""",
    "current_meta": """
SELECT event_type AS ds, 'latest' AS field, arg_max(strftime(CAST(ts AS DATE) - 1, '%Y%m%d'), ts) AS value,
       max(ts) AS updated_at
FROM events GROUP BY event_type""",
    "sync_point": f"WITH {USER_SYNC_CTES} SELECT proc, sync FROM user_sync",
    "sync_at": SYNC_AT,
    "sync_at_window": SYNC_AT,
    "sync_at_broadcast": SYNC_AT,
    "resume_state": f"""
WITH {USER_SYNC_CTES},
sg AS (
  SELECT user_id AS proc, strftime(ts, '%Y%m%d') AS d, CAST(hour(ts) AS INTEGER) AS h, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1 AND event_type <> 'signup'
),
st AS (
  SELECT u.proc, s.sync, sg.d, sg.h, sg.event_id, sg.proc IS NULL AS fresh,
         strftime(try_strptime(substr(s.sync, 1, 8), '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') AS next_sync
  FROM users u LEFT JOIN user_sync s ON u.proc IS NOT DISTINCT FROM s.proc
  LEFT JOIN sg ON u.proc = sg.proc
)
SELECT proc,
       CASE WHEN fresh THEN next_sync ELSE d END AS trace,
       CAST(CASE WHEN fresh THEN 0 WHEN event_id = 0 THEN 0 ELSE h + 1 END AS INTEGER) AS batch_num,
       CAST(CASE WHEN fresh THEN 0 ELSE event_id END AS BIGINT) AS commit_time,
       CASE WHEN coalesce(CASE WHEN fresh THEN next_sync ELSE d END, '') = '' THEN 'no date to trace' END AS error
FROM st""",
    "fail_ratio": """
SELECT strftime(ts, '%Y%m%d') AS date, count_if(event_type = 'error') AS failed, count(*) AS total,
       count_if(event_type = 'error') / (count(*) + CAST(0.01 AS DOUBLE)) AS fail_ratio
FROM events GROUP BY 1""",
    "with_counters": f"""
SELECT sum(CAST(({SLOT} % {DAY}) // {W} AS BIGINT)) AS acc, count(*) AS records FROM events""",
    "counter_table": f"""
SELECT event_type AS proc, sum(CAST(({SLOT} % {DAY}) // {W} AS BIGINT)) AS acc, count(*) AS records
FROM events GROUP BY 1""",
    "enrich": """
SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment, n.n_name
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "sequence_numbers": f"WITH {SEQ_CTE} SELECT * FROM seqd",
    "resume_after": f"""
WITH {SEQ_CTE},
fd AS (SELECT event_type, min(CAST(ts AS DATE)) AS d FROM events GROUP BY 1),
cnt AS (
  SELECT e.event_type AS name, count(*) AS value
  FROM events e JOIN fd ON e.event_type = fd.event_type WHERE CAST(e.ts AS DATE) = fd.d GROUP BY 1
)
SELECT s.* FROM seqd s LEFT JOIN cnt ON s.event_type = cnt.name
WHERE s.seq >= coalesce(cnt.value, 0)""",
    "append_per_partition": """
SELECT CAST(value AS VARCHAR) AS value FROM events
UNION ALL
SELECT t.m AS value FROM (VALUES ('end of partition'), ('checked')) t(m)
CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE ts IS NOT NULL) r""",
    "append_rows": """
SELECT CAST(value AS VARCHAR) AS value FROM events
UNION ALL
SELECT t.m AS value FROM (VALUES ('end of partition'), ('checked')) t(m)""",
    "dated_topics": """
WITH ds AS (SELECT r.r_name AS ds, n.n_name AS topic FROM region r JOIN nation n ON r.r_regionkey = n.n_regionkey),
req AS (
  SELECT DISTINCT strftime(e.ts, '%Y%m%d') AS date, r.r_name AS name
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT DISTINCT req.date, ds.topic, ds.topic || '-' || req.date AS dated_topic FROM req JOIN ds ON req.name = ds.ds""",
    "prepare_messages": f"""
SELECT CAST(user_id AS VARCHAR) AS key, CAST(value AS VARCHAR) AS value,
       event_type || '-' || strftime(ts, '%Y%m%d') AS topic,
       CAST({_sign('CAST(user_id AS VARCHAR)')} % 12 AS INTEGER) AS "partition"
FROM events""",
    "read_dated_topics": """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(value AS VARCHAR) AS value FROM events WHERE event_type IS NOT NULL""",
    "run_days": """
WITH per AS (SELECT event_type, min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events GROUP BY 1)
SELECT strftime(ts, '%Y%m%d') AS date, CAST(0 AS INTEGER) AS batch, CAST(value AS VARCHAR) AS value
FROM events WHERE CAST(ts AS DATE) BETWEEN (SELECT min(lo) FROM per) AND (SELECT min(hi) FROM per)""",
    "current_meta_log": """
SELECT s.stage, m.* FROM (VALUES ('before'), ('after'), ('more')) s(stage), (
  SELECT event_type AS ds, 'latest' AS field, arg_max(strftime(CAST(ts AS DATE) - 1, '%Y%m%d'), ts) AS value, max(ts) AS updated_at
  FROM events GROUP BY event_type) m""",
    "chained_processors": """
WITH per AS (SELECT event_type, min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events GROUP BY 1)
SELECT strftime(ts, '%Y%m%d') AS date, CAST(value AS VARCHAR) AS value
FROM events WHERE CAST(ts AS DATE) >= (SELECT min(lo) FROM per) AND CAST(ts AS DATE) < (SELECT min(hi) FROM per)""",
    "routed_batches": """
SELECT event_type AS key, CASE WHEN value > 100 THEN NULL ELSE 'v' || chr(10) || CAST(value AS VARCHAR) END AS value FROM events""",
    "numbered_batches": """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS seq FROM events""",
    "ledger_counters": """
SELECT 'values_result' AS proc, t.name, t.value FROM (
  SELECT 'records' AS name, count(*) AS value FROM events UNION ALL
  SELECT 'long' AS name, count_if(strlen(CAST(value AS VARCHAR)) > 5) AS value FROM events) t""",
    "pinned_lookup": """
SELECT CAST(e.value AS VARCHAR) || '|' || coalesce(c.c_name, '') AS value
FROM events e LEFT JOIN customer c ON CAST(e.user_id AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)""",
    "stream_fail_ratio": """
SELECT strftime(ts, '%Y%m%d') AS date, count_if(event_type = 'error') AS failed, count(*) AS total,
       count_if(event_type = 'error') / (count(*) + CAST(0.01 AS DOUBLE)) AS fail_ratio
FROM events WHERE ts IS NOT NULL GROUP BY 1""",
    "live_sync": SYNC_AT,
    "failed_and_resumed": "SELECT CAST(value AS VARCHAR) AS value, 1 AS failures FROM events",
    "capped_batches": "SELECT count(*) AS records, true AS within_cap FROM events",
    "continuous_day": "SELECT count(*) AS records, count(*) AS num_input_rows, true AS finished FROM events",
    "write_by_key": "SELECT event_type, CAST(value AS VARCHAR) AS value FROM events",
    "committed_batches": f"""
SELECT e.event_type AS proc, strftime(make_timestamp(e.bs), '%Y%m%d') AS date,
       CAST((e.bs % {DAY}) // {W} AS INTEGER) AS batch, CAST(e.value AS VARCHAR) AS value
FROM (SELECT event_type, value, {SLOT} AS bs FROM events) e
JOIN ({REPLAY}) rep ON rep.proc = e.event_type AND rep.batch_time = (e.bs + {W}) // 1000
WHERE rep.outcome = 'commit'""",
    "ledger_latest": f"""
SELECT proc,
       arg_max(trace || '/' || {_fmt_batch('batch_num')} || '00/' || CAST(batch_time AS VARCHAR), batch_time) AS commit,
       arg_max(trace || '/' || {_fmt_batch('batch_num')} || '00', batch_time) AS latest,
       count(*) AS batches
FROM ({REPLAY}) rep WHERE outcome = 'commit' GROUP BY proc""",
    "resume_from_ledger": f"""
WITH last AS (
  SELECT proc, arg_max(trace, batch_time) AS d, arg_max(batch_num, batch_time) AS b, max(batch_time) AS t
  FROM ({REPLAY}) rep WHERE outcome = 'commit' GROUP BY proc
),
procs AS (SELECT DISTINCT event_type AS proc FROM events)
SELECT p.proc, l.d AS trace,
       CAST(CASE WHEN l.proc IS NULL THEN 0 ELSE l.b + 1 END AS INTEGER) AS batch_num,
       CAST(coalesce(l.t, 0) AS BIGINT) AS commit_time,
       CASE WHEN l.d IS NULL THEN 'no date to trace' END AS error
FROM procs p LEFT JOIN last l ON p.proc = l.proc""",
    "read_counters": "SELECT event_type AS name, count(*) AS value, CAST(NULL AS VARCHAR) AS error FROM events GROUP BY 1",
}
