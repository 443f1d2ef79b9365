"""SQL for each registered query, written in another form than the Spark plans.

Replay is told row by row with correlated subqueries, features with windows over whole partitions.
"""

from __future__ import annotations

_USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS name, n_name AS city,
         (SELECT CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS last_login
  FROM customer JOIN nation ON n_nationkey = c_nationkey
)"""

_GAPS = f"""{_USERS},
gaps AS (
  SELECT user_id, name,
         CASE WHEN user_id % 11 = 0 THEN NULL
              WHEN city = 'NATION_3' AND user_id % 2 = 0 THEN 'NATION_3-Metro' ELSE city END AS city,
         CASE WHEN user_id % 13 = 0 THEN NULL ELSE last_login END AS last_login
  FROM users
),
plain AS (
  SELECT user_id, name, CASE city WHEN 'NATION_3-Metro' THEN 'NATION_3' ELSE city END AS city, last_login FROM gaps
)"""

_LOG = """
log AS (
  SELECT event_id AS seq,
         CASE WHEN event_type = 'error' AND value >= 150 THEN 'D'
              WHEN event_type = 'signup' AND value >= 100 THEN 'I'
              WHEN event_type IN ('click', 'purchase') AND value >= 50 THEN 'U'
              ELSE upper(event_type) END AS action,
         CASE WHEN k = 99 THEN NULL ELSE user_id * 11 END AS user_id,
         'user-' || event_id AS name,
         CASE WHEN k < 90 THEN 'NATION_' || (k % 25) END AS city,
         CASE WHEN k BETWEEN 85 AND 94 THEN NULL ELSE CAST(ts AS DATE) END AS last_login,
         strftime(ts, '%Y%m%d') || '-000000000' AS delivery
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
)"""

_REPLAY = """
births AS (
  SELECT user_id, name, city, last_login, -1 AS born FROM users
  UNION ALL
  SELECT user_id, name, city, last_login, seq FROM log WHERE action = 'I' AND user_id IS NOT NULL
),
alive AS (
  SELECT b.*, (SELECT max(u.seq) FROM log u WHERE u.action = 'U' AND u.user_id = b.user_id AND u.seq > b.born) AS upd
  FROM births b
  WHERE NOT EXISTS (SELECT 1 FROM log d WHERE d.action = 'D' AND d.user_id = b.user_id AND d.seq > b.born)
),
replayed AS (
  SELECT a.user_id,
         CASE WHEN a.upd IS NULL THEN a.name ELSE u.name END AS name,
         CASE WHEN a.upd IS NULL THEN a.city ELSE u.city END AS city,
         CASE WHEN a.upd IS NULL THEN a.last_login ELSE u.last_login END AS last_login
  FROM alive a LEFT JOIN log u ON u.seq = a.upd
)"""

_REPLAYED = f"{_USERS}, {_LOG}, {_REPLAY}"

# The files of the even changes come before those of the odd ones.
_REORDERED = f"""{_USERS}, {_LOG.replace("log AS", "plain_log AS", 1)},
log AS (SELECT * REPLACE (seq % 2 * 1000000000000 + seq AS seq) FROM plain_log), {_REPLAY}"""

_RELOADED = f"""{_USERS.replace("users AS", "plain_users AS", 1)}, {_LOG.replace("log AS", "plain_log AS", 1)},
users AS (SELECT * REPLACE (CAST(NULL AS DATE) AS last_login) FROM plain_users),
log AS (SELECT * FROM plain_log WHERE delivery >= '20240116'), {_REPLAY}"""

_DIM = """
dim AS (
  SELECT n_name AS city, r_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'
)"""

_RATE = """CAST(sum(CASE WHEN date_diff('day', last_login, DATE '2001-08-01') <= 90 THEN 1 ELSE 0 END)
  OVER (PARTITION BY city) AS DOUBLE) / count(*) OVER (PARTITION BY city)"""
_RANK = "CAST(dense_rank() OVER (PARTITION BY city ORDER BY last_login DESC NULLS LAST) AS INTEGER)"
_DISTINCT = "CAST(count(DISTINCT user_id) OVER (PARTITION BY city) AS INTEGER)"


def _features(rows: str) -> str:
    return f"""
features AS (
  SELECT r.user_id, r.name, r.city, r.last_login, dim.state, r.last_login_rank_by_city,
         r.login_rate_last_3_months_by_city, r.users_by_city
  FROM (SELECT *, {_RANK} AS last_login_rank_by_city, {_RATE} AS login_rate_last_3_months_by_city,
               {_DISTINCT} AS users_by_city FROM {rows}) r
  LEFT JOIN dim ON dim.city = r.city
)"""


def _summary(group: str) -> str:
    return f"""
SELECT {group}, count(*) AS n_rows, CAST(count(DISTINCT user_id) AS INTEGER) AS users,
       CAST(count(*) FILTER (last_login >= DATE '2001-08-01' - 90) AS DOUBLE) / count(*) AS login_rate,
       max(last_login) AS latest_login"""


_FEATURES = f"WITH {_REPLAYED}, {_DIM}, {_features('replayed')} SELECT * FROM features"
_FEATURES_GAPS = f"WITH {_GAPS}, {_DIM}, {_features('plain')} SELECT * FROM features"
_STATE = f"WITH {_REPLAYED} SELECT * FROM replayed"
_ALL_USERS = f"WITH {_USERS} SELECT * FROM users"
_ALL_CHANGES = f"WITH {_LOG} SELECT action, user_id, name, city, last_login FROM log"

_ORDERS = """
WITH log AS (
  SELECT l_orderkey AS k, l_shipdate AS d1, l_linenumber AS d2, l_partkey AS d3, l_linestatus AS s,
         l_extendedprice AS p, l_shipdate AS d,
         CASE WHEN l_returnflag = 'R' AND l_quantity >= 40 THEN 'D'
              WHEN l_quantity <= 10 THEN 'I' ELSE 'U' END AS action
  FROM lineitem
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY d1, d2, d3) AS pos FROM log
),
net AS (
  SELECT k, max(pos) FILTER (action = 'D') AS gone, max(pos) FILTER (action = 'U') AS upd,
         arg_max(s, pos) FILTER (action = 'U') AS s, arg_max(p, pos) FILTER (action = 'U') AS p,
         arg_max(d, pos) FILTER (action = 'U') AS d
  FROM numbered GROUP BY k
),
alive AS (
  SELECT o_orderkey AS k, 0 AS pos, o_orderstatus AS s, o_totalprice AS p, o_orderdate AS d FROM orders
  UNION ALL
  SELECT k, pos, s, p, d FROM numbered WHERE action = 'I'
)
SELECT a.k AS o_orderkey,
       CASE WHEN n.upd > a.pos THEN n.s ELSE a.s END AS o_orderstatus,
       CASE WHEN n.upd > a.pos THEN n.p ELSE a.p END AS o_totalprice,
       CASE WHEN n.upd > a.pos THEN n.d ELSE a.d END AS o_orderdate
FROM alive a LEFT JOIN net n ON n.k = a.k
WHERE n.gone IS NULL OR n.gone < a.pos"""

ORACLES: dict[str, str] = {
    "scan_snapshot": _ALL_USERS,
    "scan_log": f"WITH {_LOG} SELECT action, user_id, name, city, last_login, delivery FROM log",
    "route_files": f"""WITH {_LOG}
SELECT 'LOAD9' AS name, TRUE AS is_snapshot, '9' AS version UNION ALL
SELECT 'LOAD10', TRUE, '10' UNION ALL
SELECT DISTINCT delivery, FALSE, CAST(NULL AS VARCHAR) FROM log""",
    "latest_snapshot": _ALL_USERS,
    "union_logs": _ALL_CHANGES,
    "union_logs_same_names": f"WITH {_REORDERED} SELECT * FROM replayed",
    "cdc_update": f"""WITH {_USERS}, {_LOG},
last AS (SELECT user_id AS k, arg_max(seq, seq) AS at FROM log WHERE action = 'U' AND user_id IS NOT NULL GROUP BY 1)
SELECT users.user_id,
       CASE WHEN log.seq IS NULL THEN users.name ELSE log.name END AS name,
       CASE WHEN log.seq IS NULL THEN users.city ELSE log.city END AS city,
       CASE WHEN log.seq IS NULL THEN users.last_login ELSE log.last_login END AS last_login
FROM users LEFT JOIN last ON last.k = users.user_id LEFT JOIN log ON log.seq = last.at""",
    "cdc_delete": f"""WITH {_USERS}, {_LOG}
SELECT * FROM users WHERE NOT EXISTS (SELECT 1 FROM log WHERE action = 'D' AND log.user_id = users.user_id)""",
    "cdc_insert": f"""WITH {_USERS}, {_LOG}
SELECT * FROM users UNION ALL
SELECT user_id, name, city, last_login FROM log WHERE action = 'I' AND user_id IS NOT NULL""",
    "cdc_replay": _STATE,
    "cdc_replay_orders": _ORDERS,
    "cdc_rejects": f"""WITH {_LOG}
SELECT action, CASE WHEN action IN ('I', 'U', 'D') THEN 'null key' ELSE 'unknown action' END AS reason, count(*) AS n
FROM log WHERE action NOT IN ('I', 'U', 'D') OR user_id IS NULL GROUP BY 1, 2""",
    "cdc_incremental": _STATE,
    "cdc_initial_load": _ALL_USERS,
    "replay_files": _STATE,
    "duplicate_keys": f"""WITH {_REPLAYED}
SELECT user_id, count(*) AS copies FROM replayed GROUP BY user_id HAVING count(*) > 1""",
    "normalize_city": f"WITH {_GAPS} SELECT * FROM plain",
    "lookup_state": f"""WITH {_GAPS}, {_DIM}
SELECT gaps.*, (SELECT state FROM dim WHERE dim.city = gaps.city) AS state FROM gaps""",
    "filter_not_equal": f"WITH {_GAPS} SELECT * FROM gaps WHERE city <> 'NATION_7'",
    "rank_by_city": f"WITH {_GAPS} SELECT *, {_RANK} AS last_login_rank_by_city FROM gaps",
    "login_rate_by_city": f"WITH {_GAPS} SELECT *, {_RATE} AS login_rate_last_3_months_by_city FROM gaps",
    "users_by_city": f"WITH {_GAPS} SELECT *, {_DISTINCT} AS users_by_city FROM gaps",
    "city_features": _FEATURES,
    "city_features_gaps": _FEATURES_GAPS,
    "summary_by_city": f"""WITH {_REPLAYED}, {_DIM}, summary AS ({_summary('city')} FROM replayed GROUP BY city)
SELECT summary.*, dim.state FROM summary LEFT JOIN dim USING (city)""",
    "summary_by_state": f"""WITH {_REPLAYED}, {_DIM},
placed AS (SELECT replayed.*, dim.state FROM replayed LEFT JOIN dim ON dim.city = replayed.city)
{_summary('state')} FROM placed GROUP BY state""",
    "features_sorted": f"""{_FEATURES_GAPS}
ORDER BY city NULLS FIRST, last_login_rank_by_city DESC, user_id, name""",
    "features_top10": f"""{_FEATURES}
ORDER BY city NULLS FIRST, last_login_rank_by_city DESC, user_id, name LIMIT 10""",
    "sink_roundtrip_state": _STATE,
    "sink_roundtrip_features": _FEATURES_GAPS,
    "stream_apply": _STATE,
    "stream_features": _FEATURES,
    "stream_late_files": f"""WITH {_LOG}
SELECT action, user_id, name, city, last_login FROM log WHERE delivery LIKE '20240110%'""",
    "stream_late_repair": _STATE,
    "stream_late_after_repair": f"""WITH {_LOG}
SELECT action, user_id, name, city, last_login FROM log WHERE starts_with(delivery, '20240112')""",
    "stream_reload": f"WITH {_RELOADED} SELECT * FROM replayed",
}
ORACLES["stream_late_repair_by_key"] = _STATE
_BROKEN = """
broken_users AS (
  SELECT CASE WHEN user_id % 29 = 3 THEN NULL ELSE user_id END AS user_id, name, city,
         CASE WHEN user_id % 29 IN (5, 7, 11) THEN NULL ELSE last_login END AS last_login
  FROM plain_users
), users AS (SELECT * FROM broken_users),
log AS (
  SELECT * REPLACE (CASE WHEN seq % 29 = 3 THEN NULL ELSE user_id END AS user_id,
                    CASE WHEN seq % 29 IN (5, 7, 11) THEN NULL ELSE last_login END AS last_login)
  FROM plain_log
)"""
_PLAIN = f"""{_USERS.replace("users AS", "plain_users AS", 1)}, {_LOG.replace("log AS", "plain_log AS", 1)}"""
ORACLES["replay_broken_files"] = f"WITH {_PLAIN}, {_BROKEN}, {_REPLAY} SELECT * FROM replayed"
ORACLES["unreadable_lines"] = f"""WITH {_PLAIN}, lines AS (
  SELECT 'LOAD1' AS name, user_id % 29 AS kind, user_id FROM plain_users
  UNION ALL SELECT delivery, seq % 29, user_id FROM plain_log
), reasons AS (
  SELECT name, CASE WHEN kind = 3 THEN 'unreadable user_id' WHEN kind IN (5, 7) THEN 'unreadable last_login'
                    WHEN kind IN (11, 13) THEN 'number of columns' END AS reason
  FROM lines WHERE kind <> 3 OR user_id IS NOT NULL
)
SELECT name, reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY name, reason"""
ORACLES["rank_by_city_seconds"] = """SELECT event_id, event_type, ts,
  CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY ts DESC NULLS LAST) AS INTEGER) AS last_login_rank_by_city
FROM events"""
ORACLES["features_positions"] = f"""SELECT *, row_number() OVER (
  ORDER BY city NULLS FIRST, last_login_rank_by_city DESC, user_id, name) AS position FROM ({_FEATURES_GAPS})"""


def _version(name: str, log: str) -> str:
    """The replayed table as ``name``, after the changes that ``log`` selects."""
    replay = _REPLAY.replace("births", f"{name}_births").replace("alive", f"{name}_alive")
    return replay.replace("replayed AS", f"{name} AS").replace("FROM log", f"FROM {log}").replace("JOIN log", f"JOIN {log}")


def _churn(region: str, state: bool) -> str:
    place = "(SELECT state FROM dim WHERE dim.city = r.city)" if state else "r.city"
    seen = f"SELECT user_id AS u, {place} AS place, bool_or(coalesce(last_login >= DATE '{{day}}' - 90, FALSE)) AS recent FROM {{rows}} r WHERE user_id IS NOT NULL GROUP BY 1, 2"
    return f"""WITH {_USERS}, {_LOG}, {_DIM},
first_log AS (SELECT * FROM log WHERE delivery < '20240116'),
{_version('early', 'first_log')}, {_version('late', 'log')},
b AS ({seen.format(day='2024-01-15', rows='early')}),
a AS ({seen.format(day='2024-04-20', rows='late')}),
places AS (SELECT place FROM b UNION SELECT place FROM a),
counted AS (SELECT p.place AS {region},
  (SELECT count(*) FROM b WHERE b.place IS NOT DISTINCT FROM p.place) AS users_before,
  (SELECT count(*) FROM a WHERE a.place IS NOT DISTINCT FROM p.place) AS users_after,
  (SELECT count(*) FROM a WHERE a.place IS NOT DISTINCT FROM p.place AND u NOT IN (SELECT u FROM b)) AS gained,
  (SELECT count(*) FROM a WHERE a.place IS NOT DISTINCT FROM p.place AND u IN (SELECT u FROM b)
     AND NOT EXISTS (SELECT 1 FROM b x WHERE x.u = a.u AND x.place IS NOT DISTINCT FROM p.place)) AS moved_in,
  (SELECT count(*) FROM b WHERE b.place IS NOT DISTINCT FROM p.place AND u NOT IN (SELECT u FROM a)) AS lost,
  (SELECT count(*) FROM b WHERE b.place IS NOT DISTINCT FROM p.place AND u IN (SELECT u FROM a)
     AND NOT EXISTS (SELECT 1 FROM a x WHERE x.u = b.u AND x.place IS NOT DISTINCT FROM p.place)) AS moved_out,
  (SELECT count(*) FROM b JOIN a ON a.u = b.u AND a.place IS NOT DISTINCT FROM b.place
     WHERE b.place IS NOT DISTINCT FROM p.place AND b.recent AND NOT a.recent) AS lapsed,
  (SELECT count(*) FROM b JOIN a ON a.u = b.u AND a.place IS NOT DISTINCT FROM b.place
     WHERE b.place IS NOT DISTINCT FROM p.place AND a.recent AND NOT b.recent) AS returned
FROM places p)
SELECT *, CASE WHEN users_before > 0 THEN CAST(lost + moved_out AS DOUBLE) / users_before END AS churn_rate FROM counted"""


ORACLES["churn_by_city"] = _churn("city", False)
ORACLES["churn_by_state"] = _churn("state", True)
ORACLES["stream_city_stats"] = f"""SELECT DISTINCT city, last_login, state, last_login_rank_by_city,
  login_rate_last_3_months_by_city, users_by_city FROM ({_FEATURES})"""
ORACLES["stream_rejects"] = ORACLES["cdc_rejects"]
