"""DuckDB twins of the registered queries (the correctness oracle).

The same derivation rules as ``plans.derived`` and the operator semantics
written directly as SQL over whole tables: plain (unchunked) windows, so they
also check the chunked scans of the Spark side.
"""

from __future__ import annotations

# --- action requests from embeddings ---------------------------------------
_EMB_REQUESTS = """
emb_rows AS (
  SELECT ['aloha','arx5','ur5','franka'][label % 4 + 1] AS robot,
         vec_id // 3 AS req_no,
         CASE WHEN (vec_id // 3) % 37 = 5 THEN NULL
              ELSE ['joint','leftjoint','leftpos','leftjoint'][label % 4 + 1] END AS action_type,
         vec_id,
         list_transform(range(1, CAST(([14,7,7,8][label % 4 + 1] - CASE WHEN vec_id % 17 = 0 THEN 1 ELSE 0 END) AS BIGINT) + 1), lambda i: list_sum(list_transform(range(i, len(embedding) + 1, CAST(([14,7,7,8][label % 4 + 1] - CASE WHEN vec_id % 17 = 0 THEN 1 ELSE 0 END) AS BIGINT)), lambda j: CAST(embedding[j] AS DOUBLE)))) AS vec
  FROM embeddings
),
requests AS (
  SELECT robot || '-' || CAST(req_no AS VARCHAR) AS request_id, robot,
         CAST(req_no * 45000 AS BIGINT) AS ts_us, action_type,
         list(vec ORDER BY vec_id) AS actions,
         CAST(CASE WHEN req_no % 53 = 11 THEN 0 ELSE 20000 + 10000 * (req_no % 4) END AS BIGINT) AS duration_us
  FROM emb_rows GROUP BY robot, req_no, action_type
),
"""

# --- validation -> explode -> velocity -> retime -> timeline over `requests` ---
_CHAIN = """
spec(robot, dof_num, pos_num) AS (VALUES ('aloha', 6, 16), ('arx5', 6, 6), ('ur5', 6, 6), ('franka', 7, 7)),
req_typed AS (
  SELECT r.*, s.dof_num, s.pos_num,
         CASE WHEN action_type IS NULL THEN NULL WHEN contains(action_type, 'left') THEN 'left'
              WHEN contains(action_type, 'right') THEN 'right' ELSE 'both' END AS arm,
         CASE WHEN action_type IS NULL THEN NULL WHEN contains(action_type, 'pos') THEN 'pos' ELSE 'joint' END AS mode
  FROM requests r LEFT JOIN spec s USING (robot)
),
req_checked AS (
  SELECT *, CAST(CASE WHEN action_type IS NULL THEN NULL
                      ELSE (CASE WHEN mode = 'pos' THEN pos_num + 1 ELSE dof_num + 1 END)
                           * (CASE WHEN arm = 'both' THEN 2 ELSE 1 END) END AS INTEGER) AS expected_len
  FROM req_typed
),
act_rows AS (
  SELECT request_id, robot, ts_us, action_type, duration_us, dof_num, arm, mode, expected_len,
         CAST(len(actions) AS INTEGER) AS n_actions,
         unnest(actions) AS action, CAST(unnest(range(len(actions))) AS INTEGER) AS seq
  FROM req_checked
),
act_bad AS (
  SELECT *, CAST(len(action) AS INTEGER) AS actual_len,
         coalesce(CAST(len(action) AS INTEGER) <> expected_len, false) AS is_bad,
         CAST(min(CASE WHEN action_type IS NOT NULL AND dof_num IS NOT NULL AND len(action) <> expected_len
                       THEN seq END) OVER (PARTITION BY request_id) AS INTEGER) AS first_bad_pos,
         CAST(min(CASE WHEN action IS NULL THEN seq END) OVER (PARTITION BY request_id) AS INTEGER) AS null_pos
  FROM act_rows
),
validated AS (
  SELECT *, CASE WHEN dof_num IS NULL THEN 'unknown_robot'
                 WHEN action_type IS NULL AND n_actions > 0 THEN 'missing_action_type'
                 WHEN null_pos IS NOT NULL AND (first_bad_pos IS NULL OR null_pos < first_bad_pos)
                   THEN CASE WHEN seq >= null_pos THEN 'null_action'
                             WHEN duration_us IS NULL OR duration_us <= 0 THEN 'bad_duration' END
                 WHEN first_bad_pos IS NOT NULL THEN 'bad_arity'
                 WHEN duration_us IS NULL OR duration_us <= 0 THEN 'bad_duration' END AS quarantine_reason
  FROM act_bad
),
executable AS (
  SELECT *, CAST(CAST(action AS FLOAT[]) AS DOUBLE[]) AS position,
         ts_us + CAST(seq AS BIGINT) * duration_us AS t_nominal_us
  FROM validated WHERE quarantine_reason IS NULL
),
vel0 AS (
  SELECT *, coalesce(lag(position) OVER (PARTITION BY robot, arm ORDER BY ts_us, request_id, seq),
                     list_transform(position, lambda x: 0.0)) AS last0
  FROM executable
),
vel1 AS (
  SELECT *, len(last0) <> len(position) AS shape_mismatch,
         CASE WHEN len(last0) = len(position) THEN
              list_transform(list_zip(position, last0), lambda z: (z[1] - z[2]) / (duration_us / 1e6)) END AS velocity
  FROM vel0
),
vel2 AS (
  SELECT *, list_max(list_transform(velocity, lambda x: abs(x))) AS max_abs,
         list_max(list_transform(
           CASE WHEN len(velocity) = 0 THEN velocity
                WHEN arm = 'both' THEN list_concat(list_slice(velocity, 1, len(velocity) // 2 - 1),
                                                   list_slice(velocity, len(velocity) // 2 + 1, len(velocity) - 1))
                ELSE list_slice(velocity, 1, len(velocity) - 1) END, lambda x: abs(x))) AS max_abs_no_gripper
  FROM vel1
),
retimed AS (
  SELECT *, coalesce(max_abs > 10.0 AND NOT isnan(max_abs), false) AS retimed,
         CAST(CASE WHEN coalesce(max_abs > 10.0 AND NOT isnan(max_abs), false)
                        AND max_abs_no_gripper IS NOT NULL AND NOT isnan(max_abs_no_gripper)
                   THEN round(CAST(duration_us AS DOUBLE) * max_abs_no_gripper / 10.0)
                   ELSE CAST(duration_us AS DOUBLE) END AS BIGINT) AS period_us
  FROM vel2
),
tl0 AS (
  SELECT *, sum(period_us) OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s_run
  FROM retimed
),
tl1 AS (
  SELECT *, CAST(s_run + max(ts_us - s_run) OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS e_us
  FROM tl0
),
timeline AS (
  SELECT *, greatest(ts_us, prev_end_us) AS g_us,
         prev_end_us IS NULL OR greatest(ts_us, prev_end_us) - prev_end_us >= period_us AS overrun,
         greatest(ts_us, prev_end_us) - ts_us AS wait_us,
         e_us - greatest(ts_us, prev_end_us) AS busy_us,
         CAST(greatest(greatest(ts_us, prev_end_us) - prev_end_us, 0) AS BIGINT) AS gap_us
  FROM (SELECT *, lag(e_us) OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq) AS prev_end_us FROM tl1)
)
"""

_REQUESTS = _EMB_REQUESTS.rstrip().rstrip('"') + _CHAIN


# --- scalar action log from events -----------------------------------------
_SCALAR = """
slog AS (
  SELECT CAST(user_id AS VARCHAR) AS robot, CAST(event_id AS VARCHAR) AS request_id, 0 AS seq,
         epoch_us(ts) AS ts_us, CAST(round(value * 100) AS BIGINT) * 4000000 AS period_us
  FROM events
),
s_tl0 AS (
  SELECT *, sum(period_us) OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s_run
  FROM slog
),
s_tl1 AS (
  SELECT *, CAST(s_run + max(ts_us - s_run) OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS e_us
  FROM s_tl0
),
s_timeline AS (
  SELECT *, greatest(ts_us, prev_end_us) AS g_us,
         prev_end_us IS NULL OR greatest(ts_us, prev_end_us) - prev_end_us >= period_us AS overrun,
         greatest(ts_us, prev_end_us) - ts_us AS wait_us
  FROM (SELECT *, lag(e_us) OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq) AS prev_end_us FROM s_tl1)
)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["action_validation"] = _with(_REQUESTS) + """
SELECT request_id, seq, robot, action_type, arm, mode, expected_len, actual_len, is_bad, first_bad_pos,
       quarantine_reason, quarantine_reason IS NULL AS effective
FROM validated
"""

ORACLE["batch_outcome"] = _with(_REQUESTS) + """
, outc AS (
  SELECT r.request_id, r.robot, CAST(len(r.actions) AS INTEGER) AS n_actions,
         (SELECT any_value(v.first_bad_pos) FROM validated v WHERE v.request_id = r.request_id) AS first_bad_pos,
         (SELECT any_value(v.null_pos) FROM validated v WHERE v.request_id = r.request_id) AS null_pos,
         r.dof_num, r.action_type
  FROM req_checked r
), outc2 AS (
  SELECT *, CASE WHEN dof_num IS NULL THEN 'unknown_robot'
                 WHEN action_type IS NULL AND n_actions > 0 THEN 'missing_action_type'
                 WHEN null_pos IS NOT NULL AND (first_bad_pos IS NULL OR null_pos < first_bad_pos) THEN 'null_action'
                 WHEN first_bad_pos IS NOT NULL THEN 'bad_arity' END AS err
  FROM outc
)
SELECT request_id, robot, n_actions, first_bad_pos,
       CASE WHEN err IS NULL THEN 'success' ELSE 'error' END AS result,
       CASE WHEN err = 'bad_arity' THEN 'The number and type of actions do not match!'
            WHEN err = 'missing_action_type' THEN 'argument of type ''NoneType'' is not iterable'
            WHEN err = 'null_action' THEN 'object of type ''NoneType'' has no len()'
            WHEN err = 'unknown_robot' THEN 'unknown robot tag' END AS message,
       CASE WHEN err IN ('missing_action_type', 'null_action') THEN 400 ELSE 200 END AS http_status,
       err = 'bad_arity' AS clears_queue
FROM outc2
"""

ORACLE["action_chunk"] = _with(_REQUESTS) + """
, split AS (
  SELECT *, CASE WHEN arm = 'left' THEN CAST(action AS FLOAT[])
                 WHEN arm = 'both' THEN CAST(list_slice(action, 1, len(action) // 2) AS FLOAT[]) END AS l,
            CASE WHEN arm = 'right' THEN CAST(action AS FLOAT[])
                 WHEN arm = 'both' THEN CAST(list_slice(action, len(action) // 2 + 1, len(action)) AS FLOAT[]) END AS r
  FROM executable
)
SELECT request_id, seq, robot, arm, t_nominal_us,
       CAST(len(l) AS INTEGER) AS left_len, CAST(len(r) AS INTEGER) AS right_len,
       CASE WHEN l IS NOT NULL THEN round(list_reduce(list_prepend(0.0::DOUBLE, CAST(l AS DOUBLE[])),
            lambda a, b: a + b), 6) END AS left_sum,
       CASE WHEN r IS NOT NULL THEN round(list_reduce(list_prepend(0.0::DOUBLE, CAST(r AS DOUBLE[])),
            lambda a, b: a + b), 6) END AS right_sum
FROM split
"""

ORACLE["step_velocity"] = _with(_REQUESTS) + """
SELECT request_id, seq, robot, arm, shape_mismatch, round(max_abs, 6) AS max_abs,
       round(max_abs_no_gripper, 6) AS max_abs_no_gripper
FROM vel2
"""

ORACLE["retime_actions"] = _with(_REQUESTS) + """
SELECT request_id, seq, robot, retimed, period_us FROM retimed
"""

# The worker's loop, one row of each robot at a time: only commands that ran become the last position.
_WORKER = """
acts AS (
  SELECT e.robot, e.request_id, e.seq, e.ts_us, e.duration_us, e.arm, e.position,
         (SELECT count(*) FROM clears c WHERE c.robot = e.robot AND c.ts_us <= e.ts_us) AS segment_id,
         (SELECT max(c.ts_us) FROM clears c WHERE c.robot = e.robot AND c.ts_us <= e.ts_us) AS segment_start_us,
         (SELECT min(c.ts_us) FROM clears c WHERE c.robot = e.robot AND c.ts_us > e.ts_us) AS next_clear_us,
         row_number() OVER (PARTITION BY robot ORDER BY ts_us, request_id, seq) AS n
  FROM executable e
), worker AS (
  SELECT DISTINCT robot, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS segment_id, CAST(NULL AS VARCHAR) AS request_id,
         CAST(NULL AS INTEGER) AS seq, CAST(NULL AS DOUBLE[]) AS ran, CAST(NULL AS DOUBLE[]) AS prev,
         CAST(NULL AS BIGINT) AS period_us, CAST(NULL AS BIGINT) AS g_us, CAST(NULL AS BIGINT) AS e_us, false AS dropped,
         CAST(NULL AS BIGINT) AS e_prev, CAST(NULL AS DOUBLE) AS max_abs
  FROM acts
  UNION ALL
  SELECT robot, n, segment_id, request_id, seq, CASE WHEN dropped THEN ran ELSE position END, position, period_us, g_us, e_us, dropped, e_prev, max_abs
  FROM (SELECT *, coalesce(g_us >= next_clear_us, false) AS dropped
  FROM (SELECT *, greatest(ts_us, e_prev) AS g_us, greatest(ts_us, e_prev + period_us) AS e_us
  FROM (SELECT *, CAST(CASE WHEN max_abs > 10.0 THEN round(CAST(duration_us AS DOUBLE) * max_abs_no_gripper / 10.0)
                            ELSE CAST(duration_us AS DOUBLE) END AS BIGINT) AS period_us
  FROM (SELECT *, list_max(list_transform(velocity, lambda x: abs(x))) AS max_abs,
               list_max(list_transform(
                 CASE WHEN arm = 'both' THEN list_concat(list_slice(velocity, 1, len(velocity) // 2 - 1),
                                                         list_slice(velocity, len(velocity) // 2 + 1, len(velocity) - 1))
                      ELSE list_slice(velocity, 1, len(velocity) - 1) END, lambda x: abs(x))) AS max_abs_no_gripper
  FROM (SELECT *, list_transform(list_zip(position, last0), lambda z: (z[1] - z[2]) / (duration_us / 1e6)) AS velocity
  FROM (SELECT a.*, w.ran, CASE WHEN w.segment_id = a.segment_id THEN w.e_us ELSE a.segment_start_us END AS e_prev,
               coalesce(CASE WHEN w.segment_id = a.segment_id THEN w.prev ELSE w.ran END,
                        list_transform(a.position, lambda x: 0.0)) AS last0
        FROM worker w JOIN acts a ON a.robot = w.robot AND a.n = w.n + 1))))))
)
, executed AS (
  SELECT a.*, w.dropped, w.period_us, w.g_us, w.e_us, w.max_abs, w.max_abs > 10.0 AS retimed,
         w.e_us - w.g_us AS busy_us, CAST(greatest(w.g_us - w.e_prev, 0) AS BIGINT) AS gap_us,
         w.e_prev IS NULL OR w.g_us - w.e_prev >= w.period_us AS overrun
  FROM worker w JOIN acts a ON a.robot = w.robot AND a.n = w.n
)
"""
# a request with a wrong action clears the queue
_ERROR_CLEARS = """
clears AS (
  SELECT DISTINCT robot, ts_us FROM validated WHERE quarantine_reason = 'bad_arity'
)
"""


def _executed(requests: str, clears: str) -> str:
    return _with(requests, clears, _WORKER).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLE["execution_with_clears"] = _executed(_REQUESTS, _ERROR_CLEARS) + """
SELECT request_id, seq, robot, segment_id, dropped, CASE WHEN NOT dropped THEN period_us END AS period_us,
       CASE WHEN NOT dropped THEN g_us END AS g_us, CASE WHEN NOT dropped THEN e_us END AS e_us
FROM executed
"""

ORACLE["execution_timeline"] = _executed(_REQUESTS, _ERROR_CLEARS) + """
SELECT request_id, seq, robot, ts_us, period_us, g_us, e_us, overrun FROM executed WHERE NOT dropped
"""

ORACLE["motion_segments"] = _executed(_REQUESTS, _ERROR_CLEARS) + """
SELECT request_id, seq, robot, segment_id, segment_start_us, next_clear_us, g_us, e_us, dropped FROM executed
"""

ORACLE["robot_execution_summary"] = _executed(_REQUESTS, _ERROR_CLEARS) + """
, per AS (
  SELECT robot, count(*) FILTER (WHERE NOT dropped) AS n_actions, count(*) FILTER (WHERE dropped) AS n_dropped,
         round(max(max_abs) FILTER (WHERE NOT dropped), 6) AS max_velocity,
         count(*) FILTER (WHERE retimed AND NOT dropped) AS n_retimed,
         round(sum(busy_us) FILTER (WHERE NOT dropped) / 1e6, 6) AS busy_s, round(sum(gap_us) FILTER (WHERE NOT dropped) / 1e6, 6) AS idle_s
  FROM executed GROUP BY robot
), bad AS (
  SELECT robot, count(*) FILTER (WHERE is_bad) AS n_bad FROM validated GROUP BY robot
)
SELECT bad.robot, coalesce(n_actions, 0) AS n_actions, coalesce(n_dropped, 0) AS n_dropped, n_bad, max_velocity, coalesce(n_retimed, 0) AS n_retimed, busy_s, idle_s
FROM bad LEFT JOIN per USING (robot)
"""

ORACLE["asof_position"] = _executed(_REQUESTS, _ERROR_CLEARS) + """
, obs AS (
  SELECT request_id AS obs_id, robot, arm, ts_us + 10000 AS t_us FROM req_checked WHERE action_type IS NOT NULL
), ev AS (
  SELECT robot, arm, g_us AS t, 0 AS tag, ts_us AS cmd_ts, request_id AS cmd_request_id, seq AS cmd_seq,
         position AS cmd_position, NULL::VARCHAR AS obs_id, NULL::BIGINT AS t_us FROM executed WHERE NOT dropped
  UNION ALL
  SELECT robot, arm, t_us, 1, NULL::BIGINT, NULL::VARCHAR, NULL::INTEGER, NULL::DOUBLE[], obs_id, t_us FROM obs
), ev2 AS (
  SELECT *, last_value(CASE WHEN tag = 0 THEN struct_pack(r := cmd_request_id, s := cmd_seq, p := cmd_position) END
                       IGNORE NULLS) OVER (PARTITION BY robot, arm ORDER BY t, tag, cmd_ts, cmd_request_id, cmd_seq
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lastc
  FROM ev
)
SELECT obs_id, robot, arm, t_us, lastc.r AS cmd_request_id, lastc.s AS cmd_seq,
       CASE WHEN lastc.p IS NOT NULL THEN round(list_reduce(list_prepend(0.0::DOUBLE, lastc.p),
            lambda a, b: a + b), 6) END AS cmd_position_sum
FROM ev2 WHERE tag = 1
"""

ORACLE["execution_timeline_events"] = _with(_SCALAR) + """
SELECT robot, request_id, ts_us, period_us, g_us, e_us, overrun, wait_us FROM s_timeline
"""

ORACLE["pending_backlog"] = _with(_SCALAR) + """
, ev AS (
  SELECT robot, ts_us AS t, 1 AS d, NULL::BIGINT AS obs_id FROM s_timeline
  UNION ALL SELECT robot, g_us, -1, NULL FROM s_timeline
  UNION ALL SELECT CAST(user_id AS VARCHAR), epoch_us(ts) + 500000, 0, event_id FROM events
), ev2 AS (
  SELECT *, sum(d) OVER (PARTITION BY robot ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pending
  FROM ev
)
SELECT obs_id, robot, t AS t_us, CAST(pending AS BIGINT) AS pending FROM ev2 WHERE obs_id IS NOT NULL
"""

# --- job path from events ---------------------------------------------------
_EVK = """
evk AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2
                         WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS tidx,
         CASE event_type WHEN 'signup' THEN 'assigned' WHEN 'view' THEN 'prepare' WHEN 'click' THEN 'ready'
                         WHEN 'purchase' THEN 'running' WHEN 'error' THEN 'failed' END AS mapped_status
  FROM events
),
polls AS (
  SELECT event_id AS poll_id, CAST(user_id AS VARCHAR) AS job_id, epoch_us(ts) AS poll_ts_us,
         CASE WHEN k % 50 = 7 THEN NULL ELSE mapped_status END AS status,
         CASE WHEN event_type <> 'signup' THEN 'robot-' || CAST(user_id % 8 AS VARCHAR) END AS robot_id,
         k >= 97 AS poll_error, k % 13 <> 0 AS start_ok
  FROM evk
),
starts AS (
  SELECT job_id, min(poll_ts_us) AS start_us, arg_min(start_ok, poll_ts_us) AS start_ok
  FROM polls WHERE status = 'ready' GROUP BY job_id
),
jobobs AS (
  SELECT event_id AS obs_id, CAST(user_id AS VARCHAR) AS job_id,
         CASE WHEN k % 10 <> 0 THEN epoch_us(ts) END AS state_ts_us,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN 'size_none' WHEN k % 10 = 2 THEN 'abnormal'
              ELSE 'normal' END AS state,
         CAST(CASE WHEN k % 10 = 0 OR k % 20 = 14 THEN NULL WHEN k % 10 = 3 THEN 1 + k % 4 ELSE 0 END AS INTEGER) AS pending_actions
  FROM evk
),
cpolls AS (
  SELECT user_id % 10 AS collection_id, event_id AS poll_id, epoch_us(ts) AS poll_ts_us, user_id, k, tidx,
         CASE WHEN k < 5 THEN 0 ELSE 1 + k % 3 END AS n_jobs
  FROM evk
),
cjobs AS (
  SELECT collection_id, poll_id, poll_ts_us, CAST(i AS INTEGER) AS pos, CAST(user_id + 10 * i AS VARCHAR) AS job_id,
         CASE WHEN i = 0 AND k >= 95 THEN 'paused'
              ELSE ['assigned','prepare','ready','running','finished','cancelled','failed'][(tidx + i * k) % 7 + 1]
         END AS status,
         'robot-' || CAST((user_id + i) % 8 AS VARCHAR) AS robot_id
  FROM (SELECT *, unnest(range(n_jobs)) AS i FROM cpolls)
),
rollup AS (
  SELECT c.collection_id, c.poll_id, c.poll_ts_us, CAST(c.n_jobs AS INTEGER) AS n_jobs,
         coalesce(j.has_active, false) AS has_active, CAST(coalesce(j.n_terminal, 0) AS INTEGER) AS n_terminal,
         NOT coalesce(j.has_active, false) AND coalesce(j.n_terminal, 0) = c.n_jobs AS is_idle
  FROM cpolls c LEFT JOIN (
    SELECT poll_id, bool_or(status IN ('assigned','prepare','ready','running')) AS has_active,
           count(*) FILTER (WHERE status IN ('finished','cancelled','failed')) AS n_terminal
    FROM cjobs GROUP BY poll_id) j USING (poll_id)
)
"""

ORACLE["flatten_job_collection"] = _with(_EVK) + """
SELECT collection_id, poll_id, pos, job_id, status, robot_id FROM cjobs
"""

ORACLE["latest_job_status"] = _with(_EVK) + """
SELECT job_id, l.st AS status, l.rid AS robot_id, last_poll_us, n_polls FROM (
  SELECT job_id, arg_max(struct_pack(st := status, rid := robot_id), poll_ts_us) AS l,
         max(poll_ts_us) AS last_poll_us, count(*) AS n_polls
  FROM polls WHERE status IS NOT NULL GROUP BY job_id)
"""

ORACLE["collection_rollup"] = _with(_EVK) + """
SELECT collection_id, poll_id, n_jobs, has_active, n_terminal, is_idle FROM rollup
"""

ORACLE["idle_exit"] = _with(_EVK) + """
, r1 AS (
  SELECT *, sum(CASE WHEN is_idle THEN 0 ELSE 1 END) OVER (PARTITION BY collection_id ORDER BY poll_ts_us, poll_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM rollup
), r2 AS (
  SELECT *, sum(CASE WHEN is_idle THEN 1 ELSE 0 END) OVER (PARTITION BY collection_id, grp ORDER BY poll_ts_us, poll_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM r1
)
SELECT collection_id, count(*) AS n_polls, arg_min(poll_id, poll_ts_us) FILTER (WHERE run >= 3) AS exit_poll_id,
       min(poll_ts_us) FILTER (WHERE run >= 3) AS exit_ts_us
FROM r2 GROUP BY collection_id
"""

ORACLE["ready_queue"] = _with(_EVK) + """
SELECT collection_id, poll_id, pos, job_id, robot_id FROM cjobs WHERE status = 'ready'
"""

ORACLE["await_running_outcome"] = _with(_EVK) + """
, dec AS (
  SELECT p.job_id, arg_min(struct_pack(err := p.poll_error, st := p.status, t := p.poll_ts_us), p.poll_ts_us) AS f
  FROM polls p JOIN starts s USING (job_id)
  WHERE p.poll_ts_us > s.start_us AND p.poll_ts_us <= s.start_us + 43200000000
    AND (p.poll_error OR (p.status IS NOT NULL AND p.status <> 'prepare'))
  GROUP BY p.job_id
)
SELECT s.job_id, s.start_us,
       CASE WHEN d.f IS NULL THEN 2 WHEN d.f.err THEN 3 WHEN d.f.st = 'running' THEN 0 ELSE 1 END AS code,
       coalesce(d.f.t, s.start_us + 43200000000) AS decided_us, d.f.st AS status
FROM starts s LEFT JOIN dec d USING (job_id)
"""

ORACLE["job_run_summary"] = _with(_EVK) + """
, it AS (
  SELECT p.job_id, p.poll_id, p.poll_ts_us, s.start_us, p.status, p.poll_error, o.state, o.state_ts_us, o.pending_actions,
         CASE WHEN o.state IS NULL AND o.state_ts_us IS NULL THEN 'no_state' WHEN o.state = 'size_none' THEN 'size_none'
              WHEN o.state IS NULL OR o.state <> 'normal' THEN 'not_normal' WHEN o.pending_actions IS NULL OR o.pending_actions <> 0 THEN 'pending'
         END AS skip
  FROM polls p JOIN starts s USING (job_id) JOIN jobobs o ON o.obs_id = p.poll_id
  WHERE s.start_ok AND p.poll_ts_us > s.start_us
), it2 AS (
  SELECT *, CASE WHEN poll_error OR status IS NULL OR poll_id % 23 = 7 THEN 'exception' WHEN status <> 'running' THEN 'not_running'
                 WHEN skip = 'size_none' THEN 'exception'
                 WHEN skip IS NULL AND poll_ts_us - start_us > 86400000000 THEN 'max_wait' END AS endr
  FROM it
), ends AS (
  SELECT job_id, min(poll_ts_us) AS end_us, arg_min(endr, poll_ts_us) AS end_reason FROM it2
  WHERE endr IS NOT NULL GROUP BY job_id
), agg AS (
  SELECT i.job_id, count(*) AS n_iterations,
         count(*) FILTER (WHERE (i.endr IS NULL AND i.skip IS NULL) OR i.endr = 'max_wait') AS n_inferences,
         count(*) FILTER (WHERE (i.endr IS NULL OR i.endr = 'max_wait') AND i.skip = 'no_state') AS n_skip_no_state,
         count(*) FILTER (WHERE (i.endr IS NULL OR i.endr = 'max_wait') AND i.skip = 'not_normal') AS n_skip_not_normal,
         count(*) FILTER (WHERE (i.endr IS NULL OR i.endr = 'max_wait') AND i.skip = 'pending') AS n_skip_pending
  FROM it2 i LEFT JOIN ends e USING (job_id)
  WHERE e.end_us IS NULL OR i.poll_ts_us <= e.end_us GROUP BY i.job_id
)
SELECT s.job_id, s.start_us, e.end_us,
       coalesce(a.n_iterations, 0) AS n_iterations, coalesce(a.n_inferences, 0) AS n_inferences,
       coalesce(a.n_skip_no_state, 0) AS n_skip_no_state, coalesce(a.n_skip_not_normal, 0) AS n_skip_not_normal,
       coalesce(a.n_skip_pending, 0) AS n_skip_pending, e.end_reason
FROM starts s LEFT JOIN agg a USING (job_id) LEFT JOIN ends e USING (job_id)
WHERE s.start_ok
"""

ORACLE["first_device_assignment"] = _with(_EVK) + """
SELECT job_id, arg_min(robot_id, poll_ts_us) AS robot_id, min(poll_ts_us) AS assigned_us
FROM polls WHERE robot_id IS NOT NULL GROUP BY job_id
"""

ORACLE["actionable_observations"] = _with(_EVK) + """
SELECT obs_id, job_id, state, pending_actions,
       CASE WHEN state IS NULL AND state_ts_us IS NULL THEN 'no_state' WHEN state = 'size_none' THEN 'size_none'
            WHEN state IS NULL OR state <> 'normal' THEN 'not_normal' WHEN pending_actions IS NULL OR pending_actions <> 0 THEN 'pending' END
         AS skip_reason
FROM jobobs
"""

# --- arm streams and frames from conversations -------------------------------
_STREAMS = """
streams AS (
  SELECT conv_id AS episode, CASE WHEN role = 'assistant' THEN 'right' ELSE 'left' END AS arm, turn, text,
         list_transform(range(1, 7), lambda i: ((length(text) * i) % 1000) / 100.0::DOUBLE) AS joint,
         turn / 10.0::DOUBLE AS gripper,
         list_transform(range(1, 17), lambda i: ((length(text) + i * 7) % 100) / 10.0::DOUBLE) AS pose,
         CAST(row_number() OVER (PARTITION BY conv_id, role = 'assistant' ORDER BY turn) - 1 AS BIGINT) AS frame_idx
  FROM conversations
),
frames AS (
  SELECT l.episode, l.frame_idx, l.turn AS left_turn, r.turn AS right_turn, l.text AS left_text, r.text AS right_text,
         l.joint AS left_joint, l.gripper AS left_gripper, l.pose AS left_pose,
         r.joint AS right_joint, r.gripper AS right_gripper, r.pose AS right_pose,
         ['joint','pos','leftjoint','leftpos','rightjoint','rightpos',NULL][l.episode % 7 + 1] AS action_type,
         length(l.text) % 11 <> 0 AS left_enabled, length(r.text) % 13 <> 0 AS right_enabled
  FROM streams l JOIN streams r ON l.episode = r.episode AND l.frame_idx = r.frame_idx
  WHERE l.arm = 'left' AND r.arm = 'right'
),
meta AS (
  SELECT 'task_' || CAST(conv_id % 4 AS VARCHAR) AS task, conv_id AS episode,
         1.75e9::DOUBLE + CAST(conv_id AS DOUBLE) * 100.0::DOUBLE AS start_time,
         1.75e9::DOUBLE + CAST(conv_id AS DOUBLE) * 100.0::DOUBLE
           + CAST(count(*) * 30 AS DOUBLE) / (29.5::DOUBLE + CAST(conv_id % 5 AS DOUBLE) * 0.25::DOUBLE) AS end_time,
         CAST(count(*) * 30 AS BIGINT) AS frames
  FROM conversations GROUP BY conv_id
)
"""

_SUM = "CASE WHEN {x} IS NOT NULL THEN round(list_reduce(list_prepend(0.0::DOUBLE, {x}), lambda a, b: a + b), 6) END"

ORACLE["observation_state"] = _with(_STREAMS) + """
, v AS (
  SELECT *, CASE WHEN action_type IS NULL THEN NULL WHEN contains(action_type, 'left') THEN 'left'
                 WHEN contains(action_type, 'right') THEN 'right' ELSE 'both' END AS arm,
            CASE WHEN action_type IS NULL THEN NULL WHEN contains(action_type, 'pos') THEN 'pos' ELSE 'joint' END AS mode
  FROM frames
), v2 AS (
  SELECT *,
    CASE WHEN mode = 'pos' THEN list_append(left_pose, left_gripper) ELSE list_append(left_joint, left_gripper) END AS lv,
    CASE WHEN mode = 'pos' THEN list_append(right_pose, right_gripper) ELSE list_append(right_joint, right_gripper) END AS rv,
    CASE WHEN action_type IS NULL THEN 'size_none'
         WHEN (CASE WHEN arm = 'left' THEN left_enabled WHEN arm = 'right' THEN right_enabled
                    ELSE left_enabled AND right_enabled END) THEN 'normal' ELSE 'abnormal' END AS state
  FROM v
), v3 AS (
  SELECT *, CASE WHEN state <> 'normal' THEN NULL WHEN arm = 'left' THEN lv WHEN arm = 'right' THEN rv
                 WHEN arm = 'both' THEN list_concat(lv, rv) END AS vector
  FROM v2
)
SELECT episode, frame_idx, action_type, arm, mode, state, CAST(len(vector) AS INTEGER) AS vec_len,
       """ + _SUM.format(x="vector") + """ AS vec_sum
FROM v3
"""

ORACLE["positional_zip"] = _with(_STREAMS) + """
SELECT episode, frame_idx, left_turn, right_turn FROM frames
"""

ORACLE["cyclic_align"] = _with(_STREAMS) + """
, lens AS (SELECT episode, arm, count(*) AS n FROM streams GROUP BY episode, arm),
ticks AS (SELECT episode, max(n) AS n_ticks FROM lens GROUP BY episode),
grid AS (
  SELECT l.episode, l.arm, l.n, unnest(range(t.n_ticks)) AS tick FROM lens l JOIN ticks t USING (episode)
)
SELECT g.episode, CAST(g.tick AS BIGINT) AS tick, g.arm, s.frame_idx, s.turn
FROM grid g JOIN streams s ON s.episode = g.episode AND s.arm = g.arm AND s.frame_idx = g.tick % g.n
"""

ORACLE["frame_timestamps"] = _with(_STREAMS) + """
, m AS (SELECT episode, CAST(round(start_time * 1000000.0::DOUBLE) AS BIGINT) AS s,
               CAST(round(end_time * 1000000.0::DOUBLE) AS BIGINT) AS e, frames FROM meta)
SELECT st.episode, st.arm, st.frame_idx,
       m.s + CAST(round(CAST(st.frame_idx AS DOUBLE) * 1e6::DOUBLE / 30.0::DOUBLE) AS BIGINT) AS nominal_us,
       m.s + CAST(round(CAST(st.frame_idx AS DOUBLE) * CAST(m.e - m.s AS DOUBLE) / CAST(m.frames AS DOUBLE)) AS BIGINT)
         AS measured_us
FROM streams st JOIN m USING (episode)
"""

_STATS = """
stats AS (
  SELECT *, end_time - start_time AS duration_s,
         CAST(frames AS DOUBLE) / (end_time - start_time) AS fps,
         CAST(frames AS DOUBLE) / (end_time - start_time) - 30.0::DOUBLE AS fps_drift,
         greatest(frames - 1, 0) AS replay_frames
  FROM meta
)
"""

ORACLE["episode_stats"] = _with(_STREAMS, _STATS) + """
SELECT task, episode, frames, round(duration_s, 6) AS duration_s, round(fps, 6) AS fps,
       round(fps_drift, 6) AS fps_drift, replay_frames
FROM stats
"""

ORACLE["episode_task_rollup"] = _with(_STREAMS, _STATS) + """
SELECT task, count(*) AS n_episodes, CAST(sum(frames) AS BIGINT) AS frames, round(sum(duration_s), 6) AS duration_s,
       round(avg(fps), 6) AS avg_fps, round(min(fps), 6) AS min_fps, round(max(fps), 6) AS max_fps
FROM stats GROUP BY task
"""

_CLOCK = """
evk2 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
samples AS (
  SELECT CAST(user_id AS VARCHAR) AS session, epoch_us(ts) AS t1,
         epoch_us(ts) + k * 500 + CAST(round(value * 100) AS BIGINT) AS t2, epoch_us(ts) + k * 1000 AS t3
  FROM evk2
),
offsets AS (
  SELECT session, count(*) AS n_samples, avg(((t2 - t1) + (t2 - t3)) / 2) AS offset_us, min(t3 - t1) AS min_rtt_us
  FROM samples GROUP BY session
),
lat_obs AS (
  SELECT CAST(user_id AS VARCHAR) AS job_id, epoch_us(ts) AS state_ts_us, epoch_us(ts) + k * 1000 + 2000 AS recv_us
  FROM evk2 WHERE k % 10 <> 0
)
"""

ORACLE["clock_offset"] = _with(_CLOCK) + """
SELECT session, n_samples, round(offset_us, 3) AS offset_us, min_rtt_us FROM offsets
"""

ORACLE["observation_latency"] = _with(_CLOCK) + """
SELECT job_id, count(*) AS n_obs, round(avg(CAST(recv_us - state_ts_us AS DOUBLE)), 3) AS avg_latency_us,
       round(max(CAST(recv_us - state_ts_us AS DOUBLE)), 3) AS max_latency_us
FROM lat_obs GROUP BY job_id
"""

ORACLE["observation_latency_offset"] = _with(_CLOCK) + """
, l AS (SELECT o.job_id, CAST(o.recv_us - o.state_ts_us AS DOUBLE) + coalesce(f.offset_us, 0.0) AS lat
        FROM lat_obs o LEFT JOIN offsets f ON f.session = o.job_id)
SELECT job_id, count(*) AS n_obs, round(avg(lat), 3) AS avg_latency_us, round(max(lat), 3) AS max_latency_us
FROM l GROUP BY job_id
"""

ORACLE["select_cameras"] = _with(_STREAMS) + """
, req AS (
  SELECT episode, frame_idx, left_text, right_text,
         [['left_hand','right_hand','high'], ['high'], ['left_hand','right_hand'], ['high','depth']][episode % 4 + 1] AS types
  FROM frames
), slots AS (
  SELECT episode, frame_idx, 'left_hand' AS slot, strlen(left_text) AS n FROM req WHERE list_contains(types, 'left_hand')
  UNION ALL
  SELECT episode, frame_idx, 'right_hand', strlen(right_text) FROM req WHERE list_contains(types, 'right_hand')
  UNION ALL
  SELECT episode, frame_idx, 'high', strlen(left_text) + strlen(right_text) FROM req WHERE list_contains(types, 'high')
)
SELECT episode, frame_idx, slot, CAST(n AS INTEGER) AS n_bytes FROM slots
"""

ORACLE["letterbox_geometry"] = """
WITH s AS (
  SELECT doc_id, CAST(1 + n_chars % 1920 AS INTEGER) AS src_w, CAST(1 + (doc_id * 37) % 1080 AS INTEGER) AS src_h,
         CASE WHEN doc_id % 2 = 0 THEN 'padding' ELSE 'stretch' END AS resize_name
  FROM documents
), g AS (
  SELECT *, resize_name = 'padding' AS pad, src_w = 224 AND src_h = 224 AS same,
         greatest(CAST(src_w AS DOUBLE) / 224.0::DOUBLE, CAST(src_h AS DOUBLE) / 224.0::DOUBLE) AS ratio
  FROM s
), g2 AS (
  SELECT *, CAST(trunc(CAST(src_w AS DOUBLE) / ratio) AS INTEGER) AS rw,
            CAST(trunc(CAST(src_h AS DOUBLE) / ratio) AS INTEGER) AS rh, pad AND NOT same AS fit
  FROM g
), g3 AS (
  SELECT doc_id, src_w, src_h, resize_name,
         CASE WHEN fit THEN rw WHEN pad THEN src_w ELSE 224 END AS resized_w,
         CASE WHEN fit THEN rh WHEN pad THEN src_h ELSE 224 END AS resized_h,
         CASE WHEN fit THEN greatest(0, CAST(trunc((224.0::DOUBLE - rw) / 2) AS INTEGER)) ELSE 0 END AS pad_x,
         CASE WHEN fit THEN greatest(0, CAST(trunc((224.0::DOUBLE - rh) / 2) AS INTEGER)) ELSE 0 END AS pad_y,
         pad AND same AS identity
  FROM g2
)
SELECT *, resized_w = 0 OR resized_h = 0 AS degenerate FROM g3
"""

ORACLE["parse_run_log"] = """
WITH e AS (
  SELECT event_id, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         'job-' || CAST(user_id AS VARCHAR) AS job,
         CASE event_type WHEN 'signup' THEN 'assigned' WHEN 'view' THEN 'prepare' WHEN 'click' THEN 'ready'
                         WHEN 'purchase' THEN 'running' WHEN 'error' THEN 'failed' END AS st,
         event_type
  FROM events
), m AS (
  SELECT *, k % 9 AS kd,
         CASE k % 9
           WHEN 0 THEN printf('Processing job_id: %s, status: %s', job, st)
           WHEN 1 THEN printf('Started robot: b''{"job_id": "%s"}''', job)
           WHEN 2 THEN printf('get_robot_state time: %.2f', value)
           WHEN 3 THEN printf('Inference result: [[%.2f]]', value)
           WHEN 4 THEN printf('Job %s exceeded max wait time.', job)
           WHEN 5 THEN printf('Error processing job %s: %s', job, event_type)
           WHEN 6 THEN printf('No active jobs, poll count: %d', k % 10 + 1)
           WHEN 7 THEN 'No new jobs after multiple checks, exiting.'
           ELSE printf('Job id: %s, status: %s, remaining jobs: %d', job, st, k % 5 + 1) END AS message
  FROM e
)
SELECT event_id AS line_no, (epoch_us(ts) // 1000) * 1000 AS ts_us,
       CASE WHEN kd = 4 THEN 'WARNING' WHEN kd = 5 THEN 'ERROR' ELSE 'INFO' END AS level,
       ['processing_job','started','state_latency','inference_result','max_wait','error','no_active_poll','exit',
        'job_status'][kd + 1] AS kind,
       CASE WHEN kd IN (0, 4, 5, 8) THEN job END AS job_id,
       CASE WHEN kd IN (0, 8) THEN st END AS status,
       CASE WHEN kd = 2 THEN round(value, 2) END AS latency_s,
       message
FROM m
"""

ORACLE["job_runs_from_log"] = """
WITH e AS (
  SELECT user_id % 10 AS worker, event_id AS line_no, (epoch_us(ts) // 1000) * 1000 AS us, round(value, 2) AS lat,
         'job-' || CAST(user_id % 10 AS VARCHAR) || '-' || CAST(event_id // 500 AS VARCHAR) AS job,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), l AS (
  SELECT *, k < 10 AS calls, k < 12 OR k BETWEEN 88 AND 97 AS closes, k BETWEEN 12 AND 29 AS starts FROM e WHERE k < 98
), closing AS (
  SELECT worker, line_no, us, job, k, calls,
         lead(line_no) OVER w AS end_line, lead(us) OVER w AS end_us, lead(job) OVER w AS end_job, lead(k) OVER w AS end_k
  FROM l WHERE closes WINDOW w AS (PARTITION BY worker ORDER BY line_no)
), started AS (
  SELECT c.worker, c.line_no, min(s.line_no) AS start_line, arg_min(s.us, s.line_no) AS start_us
  FROM closing c JOIN l s ON s.worker = c.worker AND s.starts AND s.line_no > c.line_no AND (c.end_line IS NULL OR s.line_no < c.end_line)
  WHERE c.calls GROUP BY c.worker, c.line_no
)
SELECT c.worker, c.line_no AS first_line, c.job AS job_id, c.us AS called_us, s.start_us, c.end_us,
       count(x.k) FILTER (WHERE x.k < 60) AS n_states, count(x.k) FILTER (WHERE x.k >= 60) AS n_inferences,
       round(sum(x.lat) FILTER (WHERE x.k < 60), 6) AS latency_s, max(x.lat) FILTER (WHERE x.k < 60) AS max_latency_s,
       CASE WHEN c.end_line IS NULL THEN NULL WHEN c.end_job = c.job AND c.end_k BETWEEN 88 AND 89 THEN 'max_wait'
            WHEN c.end_job = c.job AND c.end_k BETWEEN 90 AND 91 THEN 'exception' ELSE 'not_running' END AS end_reason
FROM closing c JOIN started s USING (worker, line_no)
LEFT JOIN l x ON x.worker = c.worker AND x.k BETWEEN 30 AND 87 AND x.line_no > s.start_line AND (c.end_line IS NULL OR x.line_no < c.end_line)
GROUP BY ALL
"""

ORACLE["serialize_observation"] = """
WITH o AS (
  SELECT vec_id AS obs_id,
         list_transform(range(1, CAST([14,7,7,8][label % 4 + 1] AS BIGINT) + 1), lambda i: list_sum(list_transform(range(i, len(embedding) + 1, CAST([14,7,7,8][label % 4 + 1] AS BIGINT)), lambda j: CAST(embedding[j] AS DOUBLE)))) AS action
  FROM embeddings
)
SELECT obs_id, 'normal' AS state, 0 AS pending_actions, CAST(len(action) AS INTEGER) AS action_len,
       """ + _SUM.format(x="action") + """ AS action_sum
FROM o
"""

ORACLE["score_policy"] = """
WITH o AS (
  SELECT vec_id AS obs_id, ['aloha','arx5','ur5','franka'][label % 4 + 1] AS robot,
         list_transform(range(1, CAST([14,7,7,8][label % 4 + 1] AS BIGINT) + 1), lambda i: list_sum(list_transform(range(i, len(embedding) + 1, CAST([14,7,7,8][label % 4 + 1] AS BIGINT)), lambda j: CAST(embedding[j] AS DOUBLE)))) AS action
  FROM embeddings
)
SELECT obs_id, robot, 2 AS n_actions,
       """ + _SUM.format(x="list_transform(action, lambda x: x * 0.5::DOUBLE)") + """ AS a0_sum,
       """ + _SUM.format(x="list_transform(action, lambda x: x * 0.25::DOUBLE)") + """ AS a1_sum
FROM o
"""

_POLICY_REQUESTS = """
pobs AS (
  SELECT vec_id AS obs_id, ['aloha','arx5','ur5','franka'][label % 4 + 1] AS robot,
         ['joint','leftjoint','leftpos','leftjoint'][label % 4 + 1] AS action_type,
         list_transform(range(1, CAST([14,7,7,8][label % 4 + 1] AS BIGINT) + 1), lambda i: list_sum(list_transform(range(i, len(embedding) + 1, CAST([14,7,7,8][label % 4 + 1] AS BIGINT)), lambda j: CAST(embedding[j] AS DOUBLE)))) AS action
  FROM embeddings
),
requests AS (
  SELECT 'p-' || CAST(obs_id AS VARCHAR) AS request_id, robot, CAST(obs_id * 45000 AS BIGINT) AS ts_us, action_type,
         [list_transform(action, lambda x: x * 0.5::DOUBLE), list_transform(action, lambda x: x * 0.25::DOUBLE)]
           AS actions,
         CAST(50000 AS BIGINT) AS duration_us
  FROM pobs
),
"""

# the client clears the queue at every turn, before it posts
ORACLE["policy_execution_summary"] = _executed(_POLICY_REQUESTS.rstrip() + _CHAIN, """
clears AS (
  SELECT DISTINCT robot, ts_us FROM requests
)
""") + """
SELECT robot, count(*) FILTER (WHERE NOT dropped) AS n_actions, count(*) FILTER (WHERE dropped) AS n_dropped,
       round(max(max_abs) FILTER (WHERE NOT dropped), 6) AS max_velocity, count(*) FILTER (WHERE retimed AND NOT dropped) AS n_retimed,
       round(sum(busy_us) FILTER (WHERE NOT dropped) / 1e6, 6) AS busy_s, round(sum(gap_us) FILTER (WHERE NOT dropped) / 1e6, 6) AS idle_s
FROM executed GROUP BY robot
"""

# --- recorded episodes (documents): what the files say, without writing or parsing them ---
_EPISODES = """
WITH eps AS (
  SELECT *, '/rec/2025-0' || CAST(1 + doc_id % 9 AS VARCHAR) || '/task ' || CAST(doc_id % 7 AS VARCHAR) || '+a%20/data/episode_E'
            || CAST(doc_id AS VARCHAR) AS episode_dir,
         ['aloha','arx5','ur5','franka','gen9'][doc_id % 5 + 1] AS robot
  FROM documents
),
spec(robot, arms, dof_num, pos_num, gripper_key, pose_key) AS (VALUES
  ('aloha', 2, 6, 16, 'gripper', 'ee_pose_rpy'), ('arx5', 1, 6, 6, 'gripper_width', 'end_effector_pose'),
  ('ur5', 1, 6, 6, 'gripper', 'ee_positions'), ('franka', 1, 7, 7, 'gripper_width', 'ee_positions'))
"""
_STATE_ROWS = _EPISODES + """,
words AS (
  SELECT episode_dir, robot, doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS frame_idx,
         len(string_split(text, ' ')) AS n_words
  FROM eps WHERE text IS NOT NULL
),
lines AS (
  SELECT episode_dir, robot, doc_id, frame_idx, length(w) AS n, length(w) = 0 OR length(w) % 13 = 12 AS corrupt,
         CASE WHEN robot <> 'aloha' THEN 'states.jsonl' WHEN doc_id % 2 = 0 THEN 'left_states.jsonl' ELSE 'right_states.jsonl' END AS file,
         CAST(6 + length(w) % 2 AS INTEGER) AS joints,
         CAST(CASE WHEN length(w) % 3 = 0 THEN 16 ELSE 6 + length(w) % 2 END AS INTEGER) AS poses,
         CASE WHEN length(w) % 7 = 3 THEN NULL ELSE CAST(length(w) AS DOUBLE) END AS grip
  FROM words WHERE NOT (frame_idx = n_words - 1 AND length(w) = 0 AND doc_id % 2 = 1)
)
"""

ORACLE["episode_catalog"] = _EPISODES + """
SELECT episode_dir, '2025-0' || CAST(1 + doc_id % 9 AS VARCHAR) AS date, 'task ' || CAST(doc_id % 7 AS VARCHAR) || '+a%20' AS task,
       'E' || CAST(doc_id AS VARCHAR) AS episode_id,
       CASE WHEN doc_id % 11 <> 4 AND n_chars IS NOT NULL THEN doc_id * 3 END AS episode_index,
       CASE WHEN doc_id % 11 <> 4 AND n_chars IS NOT NULL THEN CAST(doc_id AS DOUBLE) + 0.25::DOUBLE END AS start_time,
       CASE WHEN doc_id % 11 <> 4 THEN CAST(doc_id + n_chars AS DOUBLE) + 0.5::DOUBLE END AS end_time,
       CASE WHEN doc_id % 11 <> 4 THEN n_chars END AS frames
FROM eps
"""

ORACLE["read_states"] = _STATE_ROWS + """
SELECT episode_dir, file, frame_idx, corrupt,
       CASE WHEN NOT corrupt THEN joints END AS joint_len,
       CASE WHEN NOT corrupt THEN CAST(joints * n AS DOUBLE) END AS joint_sum,
       CASE WHEN NOT corrupt AND robot IN ('aloha', 'ur5', 'gen9') THEN grip END AS gripper,
       CASE WHEN NOT corrupt AND robot IN ('arx5', 'franka') THEN grip END AS gripper_width,
       CASE WHEN NOT corrupt AND robot = 'aloha' THEN poses END AS rpy_len,
       CASE WHEN NOT corrupt AND robot = 'arx5' THEN poses END AS effector_len,
       CASE WHEN NOT corrupt AND robot IN ('ur5', 'franka', 'gen9') THEN poses END AS positions_len
FROM lines
"""

ORACLE["normalize_states"] = _STATE_ROWS + """
SELECT episode_dir, frame_idx, robot, CASE WHEN starts_with(file, 'right_') THEN 'right' ELSE 'left' END AS arm,
       joints AS joint_len, CASE WHEN dof_num IS NOT NULL THEN grip END AS gripper,
       CASE WHEN dof_num IS NOT NULL THEN poses END AS pose_len, joints = dof_num AS joint_len_ok, poses = pos_num AS pose_len_ok
FROM lines LEFT JOIN spec USING (robot) WHERE NOT corrupt
"""

ORACLE["camera_manifest"] = _EPISODES + """,
slots(robot, i, slot, file) AS (VALUES
  ('aloha', 0, 'left_hand', 'cam_wrist_left_rgb.mp4'), ('aloha', 1, 'right_hand', 'cam_wrist_right_rgb.mp4'), ('aloha', 2, 'high', 'cam_high_rgb.mp4'),
  ('arx5', 0, 'left_hand', 'arm_realsense_rgb.mp4'), ('arx5', 1, 'right_hand', 'global_realsense_rgb.mp4'), ('arx5', 2, 'high', 'right_realsense_rgb.mp4'),
  ('ur5', 0, 'left_hand', 'handeye_realsense_rgb.mp4'), ('ur5', 1, 'right_hand', 'global_realsense_rgb.mp4'),
  ('franka', 0, 'left_hand', 'handeye_realsense_rgb.mp4'), ('franka', 1, 'right_hand', 'main_realsense_rgb.mp4'),
  ('franka', 2, 'high', 'side_realsense_rgb.mp4'))
SELECT episode_dir, file, robot, slot,
       CASE WHEN (doc_id + i) % 4 <> 3 THEN 'file:' || episode_dir || '/videos/' || file END AS path,
       CASE WHEN (doc_id + i) % 4 <> 3 THEN doc_id * 10 + i END AS length,
       CASE WHEN (doc_id + i) % 4 <> 3 THEN doc_id END AS modified
FROM eps JOIN slots USING (robot)
"""

ORACLE["enrich_with_spec"] = _EPISODES + """
SELECT episode_dir, robot, arms, dof_num, pos_num, gripper_key, pose_key, dof_num IS NULL AS unknown_robot
FROM eps LEFT JOIN spec USING (robot)
"""

ORACLE["unknown_robots"] = _EPISODES + """
SELECT episode_dir, robot FROM eps WHERE robot = 'gen9'
"""

ORACLE["replay_observations"] = _STATE_ROWS + """
, st AS (
  SELECT CASE WHEN robot = 'aloha' THEN doc_id - doc_id % 10 ELSE doc_id END AS rec,
         CASE WHEN starts_with(file, 'right_') THEN 'right' ELSE 'left' END AS arm, frame_idx, NOT corrupt AS enabled,
         joints + 1 AS joint_len, CAST(joints * n AS DOUBLE) + grip AS joint_sum, poses + 1 AS pose_len, CAST(poses * n AS DOUBLE) + grip AS pose_sum
  FROM lines WHERE robot <> 'gen9'
), lens AS (SELECT rec, arm, count(*) AS len FROM st GROUP BY rec, arm),
longest AS (SELECT rec, max(len) AS n_ticks FROM lens GROUP BY rec),
grid AS (SELECT rec, unnest(range(n_ticks)) AS tick FROM longest),
o AS (
  SELECT e.episode_dir, e.robot, e.doc_id, g.tick,
         ['joint', 'pos', 'leftjoint', 'leftpos', 'rightjoint', 'rightpos', NULL][(doc_id // 5) % 7 + 1] AS action_type,
         CASE WHEN doc_id % 31 <> 3 THEN [['left_hand', 'right_hand', 'high'], ['high'], ['left_hand', 'right_hand'], ['high', 'depth']][doc_id % 4 + 1] END AS asked,
         l.enabled AS l_on, r.enabled AS r_on, l.joint_len AS lj, r.joint_len AS rj, l.pose_len AS lp, r.pose_len AS rp,
         l.joint_sum AS ljs, r.joint_sum AS rjs, l.pose_sum AS lps, r.pose_sum AS rps
  FROM grid g JOIN eps e ON e.doc_id = g.rec
  LEFT JOIN lens ll ON ll.rec = g.rec AND ll.arm = 'left' LEFT JOIN st l ON l.rec = g.rec AND l.arm = 'left' AND l.frame_idx = g.tick % ll.len
  LEFT JOIN lens lr ON lr.rec = g.rec AND lr.arm = 'right' LEFT JOIN st r ON r.rec = g.rec AND r.arm = 'right' AND r.frame_idx = g.tick % lr.len
), p AS (
  SELECT *, CASE WHEN action_type IS NULL THEN NULL WHEN contains(action_type, 'left') THEN 'left' WHEN contains(action_type, 'right') THEN 'right'
                 ELSE 'both' END AS arm,
            CASE WHEN action_type IS NULL THEN NULL WHEN contains(action_type, 'pos') THEN 'pos' ELSE 'joint' END AS mode
  FROM o
), s AS (
  SELECT *, CASE WHEN action_type IS NULL OR asked IS NULL THEN 'size_none'
                 WHEN coalesce(CASE arm WHEN 'left' THEN l_on WHEN 'right' THEN r_on ELSE l_on AND r_on END, false) THEN 'normal' ELSE 'abnormal' END AS state
  FROM p
), cams(robot, i, slot) AS (VALUES ('aloha', 0, 'left_hand'), ('aloha', 1, 'right_hand'), ('aloha', 2, 'high'), ('arx5', 0, 'left_hand'),
  ('arx5', 1, 'right_hand'), ('arx5', 2, 'high'), ('ur5', 0, 'left_hand'), ('ur5', 1, 'right_hand'), ('franka', 0, 'left_hand'),
  ('franka', 1, 'right_hand'), ('franka', 2, 'high')),
shown AS (
  SELECT s.doc_id, s.tick, count(*) AS n, sum(s.tick % (1 + (s.doc_id * 10 + c.i) % 97)) AS f
  FROM s JOIN cams c ON c.robot = s.robot AND (s.doc_id + c.i) % 4 <> 3 AND list_contains(s.asked, c.slot) GROUP BY s.doc_id, s.tick
)
SELECT s.episode_dir AS episode, CAST(s.tick AS BIGINT) AS tick, s.robot, s.action_type, s.arm, s.mode, s.state,
       CAST(CASE WHEN state = 'normal' THEN CASE arm WHEN 'left' THEN CASE mode WHEN 'pos' THEN lp ELSE lj END
         WHEN 'right' THEN CASE mode WHEN 'pos' THEN rp ELSE rj END ELSE CASE mode WHEN 'pos' THEN lp + rp ELSE lj + rj END END END AS INTEGER) AS vec_len,
       CASE WHEN state = 'normal' THEN CASE arm WHEN 'left' THEN CASE mode WHEN 'pos' THEN lps ELSE ljs END
         WHEN 'right' THEN CASE mode WHEN 'pos' THEN rps ELSE rjs END ELSE CASE mode WHEN 'pos' THEN lps + rps ELSE ljs + rjs END END END AS vec_sum,
       CASE WHEN state <> 'size_none' THEN CAST(coalesce(h.n, 0) AS INTEGER) END AS n_images,
       CASE WHEN state <> 'size_none' THEN CAST(coalesce(h.f, 0) AS BIGINT) END AS frames_sum
FROM s LEFT JOIN shown h ON h.doc_id = s.doc_id AND h.tick = s.tick
"""
