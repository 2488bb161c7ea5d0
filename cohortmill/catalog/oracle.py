"""The same results in plain SQL: separate summaries, distinct counts and a range join."""

from __future__ import annotations

from dataclasses import replace

from . import bindings as b

# ---- shared parts, each a common table expression ---------------------------------------

USERS = """users AS (
  SELECT c_custkey AS id,
    CASE WHEN c_custkey % 31 = 0 THEN NULL
         ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'auto' WHEN 'BUILDING' THEN 'build' WHEN 'FURNITURE' THEN 'furn'
              WHEN 'HOUSEHOLD' THEN 'house' WHEN 'MACHINERY' THEN 'mach' ELSE 'other' END END AS gender,
    CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_nationkey END AS group_id,
    CAST(round(c_acctbal * 100) AS BIGINT) * 105 AS point,
    CAST(c_custkey % 50 = 0 AS INT) AS is_staff,
    CAST(c_custkey % 53 = 0 AS INT) AS is_superuser,
    CAST(floor(c_acctbal) AS INT) AS pending_chat,
    CASE WHEN c_custkey % 29 = 0 THEN NULL
         ELSE '[' || array_to_string(range(c_custkey % 6), ', ') || ']' END AS friend_id_list,
    TIMESTAMP '2023-12-25' + to_days(CAST((c_custkey * 7) % 40 AS INT))
      + to_hours(CAST(c_custkey % 24 AS INT)) AS created_at
  FROM customer)"""

LOADED_USERS = """loaded_users AS (
  SELECT * FROM users
  WHERE gender IS NOT NULL AND group_id IS NOT NULL AND point <= 100000000 AND pending_chat >= 0)"""

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
    CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events)"""

VOTES = """votes AS (
  SELECT event_id AS id, user_id, ts AS created_at FROM ev WHERE event_type = 'click')"""

BLOCKS = """blocks AS (
  SELECT event_id AS id, user_id, ts AS created_at FROM ev WHERE event_type = 'error')"""

PAYMENTS = """payments AS (
  SELECT event_id AS id, user_id, ts AS created_at,
    CASE k % 5 WHEN 0 THEN 'heart.200' WHEN 1 THEN 'heart.777' WHEN 2 THEN 'heart.1000'
               WHEN 3 THEN 'heart.4000' ELSE 'other' END AS "productId"
  FROM ev WHERE event_type = 'purchase')"""

POINTS = """points AS (
  SELECT event_id AS id, user_id, ts AS created_at,
    CAST(CASE WHEN event_type IN ('error', 'purchase') THEN -value ELSE value END AS DECIMAL(18,2)) AS delta_point,
    CASE WHEN k % 10 = 0 THEN NULL ELSE event_id END AS user_question_record_id
  FROM ev)"""

LINKED_POINTS = """linked_points AS (
  SELECT * FROM points WHERE user_question_record_id IS NOT NULL)"""

ATTENDANCE = """attendance AS (
  SELECT user_id AS id, user_id,
    '[' || string_agg('"' || strftime(day, '%Y-%m-%d') || '"', ', ' ORDER BY day) || ']' AS attendance_date_list
  FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM ev WHERE event_type = 'view') AS d
  GROUP BY user_id)"""

DAYS = """days AS (
  SELECT user_id, CAST(unnest(from_json(attendance_date_list, '["VARCHAR"]')) AS TIMESTAMP) AS attendance_date
  FROM attendance)"""


def _clean(source: str = "users") -> str:
    return f"""clean AS (
  SELECT id AS user_id, gender, point, is_staff, is_superuser, pending_chat, friend_id_list, created_at,
    CAST(CASE WHEN friend_id_list LIKE '[%' THEN json_array_length(friend_id_list) ELSE 0 END AS INT) AS friend_cnt
  FROM {source}
  WHERE is_staff = 0 AND is_superuser = 0 AND point < 100000000 AND pending_chat >= 0
    AND gender IS NOT NULL AND friend_id_list IS NOT NULL AND created_at IS NOT NULL AND id IS NOT NULL)"""


def _between(column: str, cfg) -> str:
    return f"{column} BETWEEN TIMESTAMP '{cfg.window.start}' AND TIMESTAMP '{cfg.window.end}'"


def _summaries(cfg, points: str = "points", suffix: str = "") -> str:
    inside = _between("created_at", cfg)
    return f"""vote_sum{suffix} AS (
  SELECT user_id, date_sub('day', max(created_at), TIMESTAMP '{cfg.window.end}') AS recency,
    count(created_at) AS frequency
  FROM votes WHERE {inside} GROUP BY user_id),
pay_sum{suffix} AS (
  SELECT user_id, count(*) AS monetary FROM payments WHERE {inside} GROUP BY user_id),
block_sum{suffix} AS (
  SELECT user_id, count(*) AS block_cnt FROM blocks WHERE {inside} GROUP BY user_id),
point_sum{suffix} AS (
  SELECT user_id, CAST(sum(delta_point) AS DECIMAL(28,2)) AS point_flow
  FROM {points} WHERE {inside} GROUP BY user_id)"""


def _profile(cfg, suffix: str = "") -> str:
    return f"""profile{suffix} AS (
  SELECT c.user_id,
    CASE WHEN coalesce(v.frequency, 0) >= {cfg.super_votes} THEN 'Super' ELSE 'General' END AS user_type,
    c.gender, c.friend_cnt,
    coalesce(p.point_flow, CAST(0 AS DECIMAL(28,2))) AS point_flow,
    greatest(coalesce(v.recency,
      least(date_sub('day', c.created_at, TIMESTAMP '{cfg.window.end}'), {cfg.window.max_days})), 0) AS recency,
    coalesce(v.frequency, 0) AS frequency,
    coalesce(m.monetary, 0) AS monetary,
    coalesce(k.block_cnt, 0) AS block_cnt
  FROM clean AS c
  LEFT JOIN vote_sum{suffix} AS v ON v.user_id = c.user_id
  LEFT JOIN pay_sum{suffix} AS m ON m.user_id = c.user_id
  LEFT JOIN block_sum{suffix} AS k ON k.user_id = c.user_id
  LEFT JOIN point_sum{suffix} AS p ON p.user_id = c.user_id)"""


SUPER_COLUMNS = """user_id, user_type, gender, friend_cnt, CAST(point_flow AS DOUBLE) AS point,
  CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency,
  CAST(monetary AS DOUBLE) AS monetary, CAST(block_cnt AS INT) AS block_cnt"""

FEATURES = """features AS (
  SELECT user_id, friend_cnt, frequency, monetary, block_cnt,
    CAST(recency AS DOUBLE) AS recency,
    ln(1 + CAST(friend_cnt AS DOUBLE)) AS friend_cnt_log,
    ln(1 + CAST(frequency AS DOUBLE)) AS frequency_log,
    ln(1 + CAST(monetary AS DOUBLE)) AS monetary_log,
    ln(1 + CAST(block_cnt AS DOUBLE)) AS block_cnt_log
  FROM profile WHERE user_type = 'General')"""

FEATURE_NAMES = ("recency", "friend_cnt_log", "frequency_log", "monetary_log", "block_cnt_log")


def _labels() -> str:
    centers = ",\n    ".join(f"({i}, {', '.join(map(str, c))})" for i, c in enumerate(b.MODEL.centers))
    distance = " + ".join(
        f"pow((f.{name} - {m}) / {s} - m.c{j}, 2)"
        for j, (name, m, s) in enumerate(zip(FEATURE_NAMES, b.MODEL.means, b.MODEL.deviations))
    )
    return f"""model(cluster, c0, c1, c2, c3, c4) AS (VALUES
    {centers}),
labels AS (
  SELECT f.user_id, arg_min(m.cluster, {distance}) AS cluster
  FROM features AS f CROSS JOIN model AS m GROUP BY f.user_id),
target AS (
  SELECT user_id, cluster FROM labels WHERE cluster IN ({', '.join(map(str, b.CONFIG.targets))}))"""


def _frame(cfg, suffix: str = "") -> str:
    first, end = cfg.frame_window.first_monday, cfg.window.end
    targets = ", ".join(f"({t})" for t in cfg.targets)
    return f"""frame{suffix} AS (
  SELECT CAST(w AS DATE) AS week_start, t.cluster,
    strftime(w, '%Y-%m-%d') || ' (W' || (date_diff('day', DATE '{first}', CAST(w AS DATE)) // 7 + 1) || ')' AS week_label
  FROM generate_series(TIMESTAMP '{first}', TIMESTAMP '{end}', INTERVAL 7 DAY) AS g(w)
  CROSS JOIN (VALUES {targets}) AS t(cluster))"""


def _cum(suffix: str = "") -> str:
    return f"""cum{suffix} AS (
  SELECT f.week_start, f.cluster, count(DISTINCT c.user_id) AS cum_users
  FROM frame{suffix} AS f
  LEFT JOIN (SELECT clean.user_id, clean.created_at, target.cluster
             FROM clean JOIN target ON target.user_id = clean.user_id) AS c
    ON c.cluster = f.cluster AND c.created_at <= CAST(f.week_start AS TIMESTAMP) + INTERVAL 6 DAY
  GROUP BY f.week_start, f.cluster)"""


def _mapped(name: str, table: str, ts: str, cfg, extra: str = "") -> str:
    return f"""{name} AS (
  SELECT x.user_id, t.cluster, CAST(date_trunc('week', x.{ts}) AS DATE) AS week_start, x.{ts} AS act{extra}
  FROM {table} AS x JOIN target AS t ON t.user_id = x.user_id
  WHERE {_between(f'x.{ts}', cfg)})"""


def _weekly(cfg, points: str = "points", suffix: str = "") -> str:
    s = suffix
    price = (
        """, CASE x."productId" WHEN 'heart.200' THEN 900 WHEN 'heart.777' THEN 1900 """
        """WHEN 'heart.1000' THEN 2900 WHEN 'heart.4000' THEN 9900 ELSE 0 END AS price"""
    )
    return ",\n".join([
        _mapped(f"pay_m{s}", "payments", "created_at", cfg, price),
        _mapped(f"vote_m{s}", "votes", "created_at", cfg),
        _mapped(f"point_m{s}", points, "created_at", cfg, ", x.delta_point"),
        _mapped(f"att_m{s}", "days", "attendance_date", cfg),
        f"""revenue{s} AS (
  SELECT week_start, cluster, CAST(sum(price) AS BIGINT) AS revenue FROM pay_m{s} GROUP BY ALL)""",
        f"""per_user{s} AS (
  SELECT week_start, cluster, user_id, count(*) AS n FROM vote_m{s} GROUP BY ALL)""",
        f"""votes_raw{s} AS (
  SELECT week_start, cluster, CAST(sum(n) AS BIGINT) AS vote_cnt_raw FROM per_user{s} GROUP BY ALL)""",
        f"""votes_cut{s} AS (
  SELECT week_start, cluster, CAST(sum(n) AS BIGINT) AS vote_cnt, count(DISTINCT user_id) AS vote_user_cnt
  FROM per_user{s} WHERE n < {cfg.outlier_votes} GROUP BY ALL)""",
        f"""flow{s} AS (
  SELECT week_start, cluster,
    CAST(sum(CASE WHEN delta_point < 0 THEN abs(delta_point) ELSE 0 END) AS DECIMAL(28,2)) AS point_burn,
    CAST(sum(delta_point) AS DECIMAL(28,2)) AS net_flow
  FROM point_m{s} GROUP BY ALL)""",
        f"""acts{s} AS (
  SELECT week_start, cluster, user_id, act FROM att_m{s}
  UNION ALL SELECT week_start, cluster, user_id, act FROM vote_m{s})""",
        f"""active{s} AS (
  SELECT week_start, cluster, count(DISTINCT user_id) AS active_users, max(act) AS last_act
  FROM acts{s} GROUP BY ALL)""",
    ])


def _tier(value: str, bounds) -> str:
    return f"CASE WHEN {value} >= {bounds.safe} THEN 'Safe' WHEN {value} >= {bounds.warning} THEN 'Warning' ELSE 'Exit' END"


def _series(cfg, suffix: str = "") -> str:
    s = suffix

    def ratio(part: str, whole: str, scale: int = 1) -> str:
        return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} * {scale} ELSE 0 END"

    running = "OVER (PARTITION BY cluster ORDER BY week_start ROWS UNBOUNDED PRECEDING)"
    return f"""filled{s} AS (
  SELECT f.week_start, f.cluster, f.week_label,
    coalesce(revenue, 0) AS revenue, coalesce(active_users, 0) AS active_users,
    coalesce(cum_users, 0) AS cum_users,
    coalesce(point_burn, 0) AS point_burn, coalesce(net_flow, 0) AS net_flow, last_act,
    coalesce(vote_cnt, 0) AS vote_cnt, coalesce(vote_user_cnt, 0) AS vote_user_cnt,
    coalesce(vote_cnt_raw, 0) AS vote_cnt_raw
  FROM frame{s} AS f
  LEFT JOIN revenue{s} USING (week_start, cluster)
  LEFT JOIN votes_cut{s} USING (week_start, cluster)
  LEFT JOIN votes_raw{s} USING (week_start, cluster)
  LEFT JOIN flow{s} USING (week_start, cluster)
  LEFT JOIN active{s} USING (week_start, cluster)
  LEFT JOIN cum{s} USING (week_start, cluster)),
rated{s} AS (
  SELECT *,
    {ratio('active_users', 'cum_users', 100)} AS war,
    {ratio('revenue', 'active_users')} AS arpu,
    {ratio('vote_cnt', 'active_users')} AS votes_per_user,
    {ratio('vote_cnt_raw', 'active_users')} AS vpu,
    {ratio('vote_user_cnt', 'active_users', 100)} AS vote_conversion_rate,
    active_users - vote_user_cnt AS pure_attendance_cnt,
    {ratio('(active_users - vote_user_cnt)', 'active_users', 100)} AS pure_attendance_rate,
    sum(net_flow) {running} AS cumulative_net_flow,
    sum(point_burn) {running} AS cumulative_burn
  FROM filled{s}),
series{s} AS (
  SELECT week_start, CAST(cluster AS TINYINT) AS cluster, week_label, revenue,
    CAST(active_users AS INT) AS active_users, CAST(cum_users AS INT) AS cum_users,
    round(CAST(point_burn AS DOUBLE), 6) AS point_burn, round(CAST(net_flow AS DOUBLE), 6) AS net_flow, last_act,
    CAST(vote_cnt AS INT) AS vote_cnt, CAST(vote_user_cnt AS INT) AS vote_user_cnt,
    round(war, 6) AS war, round(arpu, 6) AS arpu, round(votes_per_user, 6) AS votes_per_user,
    round(vote_conversion_rate, 6) AS vote_conversion_rate,
    {_tier('war', cfg.war)} AS war_status,
    {_tier('arpu', cfg.arpu)} AS arpu_status,
    {_tier('votes_per_user', cfg.vpu)} AS vpu_status,
    CAST(pure_attendance_cnt AS INT) AS pure_attendance_cnt,
    round(pure_attendance_rate, 6) AS pure_attendance_rate,
    round(CAST(cumulative_net_flow AS DOUBLE), 6) AS cumulative_net_flow,
    round(CAST(cumulative_burn AS DOUBLE), 6) AS cumulative_burn,
    round(vpu, 6) AS vpu
  FROM rated{s})"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


# ---- queries ------------------------------------------------------------------------------

FACTS = (EV, VOTES, BLOCKS, PAYMENTS, POINTS)


SESSIONS = """marked AS (
  SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 30 MINUTE, TRUE)::INT AS begins
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS number FROM marked),
sessions AS (
  SELECT user_id, min(ts) AS started_at, max(ts) AS ended_at,
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS seconds,
    count(*) AS n_events, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS votes
  FROM numbered GROUP BY user_id, number)"""


def _over_time(people: tuple, labelled: tuple, weekly: tuple) -> dict[str, str]:
    """Sessions, last votes, spans, cube, rankings and statuses, by range joins and distinct counts."""
    cfg = b.CONFIG
    first, end = cfg.frame_window.first_monday, cfg.window.end
    series = (*weekly, _frame(cfg), _cum(), _series(cfg))
    tiny = "CAST(cluster AS TINYINT) AS cluster"
    stays = """statuses AS (
  SELECT cluster, week_start, unnest(['war', 'arpu', 'vpu']) AS kpi, unnest([war_status, arpu_status, vpu_status]) AS status
  FROM series),
changes AS (
  SELECT *, lag(status) OVER w AS before, coalesce(status <> lag(status) OVER w, TRUE)::INT AS begins
  FROM statuses WINDOW w AS (PARTITION BY cluster, kpi ORDER BY week_start)),
counted AS (
  SELECT *, sum(begins) OVER (PARTITION BY cluster, kpi ORDER BY week_start ROWS UNBOUNDED PRECEDING) AS number FROM changes),
stays AS (
  SELECT cluster, kpi, CAST(number AS BIGINT) AS number, min(status) AS status, arg_min_null(before, week_start) AS came_from,
    min(week_start) AS since, CAST(max(week_start) + INTERVAL 7 DAY AS DATE) AS until, count(*) AS weeks
  FROM counted GROUP BY cluster, kpi, number)"""
    change = ", ".join(
        f"{m}, {m} - lag({m}) OVER w AS {m}_change,"
        f" round(CASE WHEN lag({m}) OVER w IS NULL THEN NULL WHEN lag({m}) OVER w > 0"
        f" THEN CAST({m} - lag({m}) OVER w AS DOUBLE) / lag({m}) OVER w * 100 ELSE 0 END, 6) AS {m}_change_pct"
        for m in ("active_users", "vote_cnt", "revenue"))
    members = """members AS (SELECT DISTINCT week_start, cluster, user_id FROM acts)"""

    # Any fact of a user-week; people without any are in no cell.
    facts = f"""facts AS (
  SELECT user_id, CAST(date_trunc('week', act) AS DATE) AS week_start, kind, price FROM (
    SELECT user_id, created_at AS act, 'vote' AS kind, 0 AS price FROM votes
    UNION ALL SELECT user_id, attendance_date, 'view', 0 FROM days
    UNION ALL SELECT user_id, created_at, 'pay', CASE "productId" WHEN 'heart.200' THEN 900 WHEN 'heart.777' THEN 1900
      WHEN 'heart.1000' THEN 2900 WHEN 'heart.4000' THEN 9900 ELSE 0 END FROM payments) AS x
  WHERE {_between('act', cfg)}),
known AS (
  SELECT f.*, t.cluster, c.gender FROM facts AS f JOIN target AS t USING (user_id) JOIN clean AS c USING (user_id)
  WHERE week_start BETWEEN DATE '{first}' AND DATE '{end}')"""
    cube = f"""SELECT week_start, grouping(week_start) = 1 AS all_weeks, {tiny}, gender, grouping(cluster) = 1 AS all_clusters,
  grouping(gender) = 1 AS all_genders,
  CAST(count(DISTINCT user_id) FILTER (kind <> 'pay') AS BIGINT) AS active_users,
  CAST(count(DISTINCT user_id) FILTER (kind = 'vote') AS BIGINT) AS voters,
  CAST(count(*) FILTER (kind = 'vote') AS BIGINT) AS votes, CAST(sum(price) AS BIGINT) AS revenue
FROM known GROUP BY CUBE (week_start, cluster, gender)"""
    return {
        "user_sessions": f"WITH {SESSIONS} SELECT * REPLACE (round(seconds, 6) AS seconds) FROM sessions",
        "daily_sessions": f"""WITH {SESSIONS}
SELECT CAST(started_at AS DATE) AS day, count(*) AS sessions, count(DISTINCT user_id) AS users,
  CAST(sum(n_events) AS BIGINT) AS events, round(sum(seconds), 3) AS seconds,
  CAST(count(*) FILTER (CAST(ended_at AS DATE) > CAST(started_at AS DATE)) AS BIGINT) AS over_midnight
FROM sessions GROUP BY ALL""",
        "payments_after_votes": _with(*FACTS, select="""SELECT p.id AS payment_id, p.user_id, p.created_at AS paid_at,
  v.id AS vote_id, v.created_at AS voted_at,
  round((epoch_us(p.created_at) - epoch_us(v.created_at)) / 1000000, 6) AS seconds
FROM payments AS p ASOF LEFT JOIN votes AS v ON p.user_id = v.user_id AND p.created_at > v.created_at"""),
        "stream_weekly_votes": _with(*weekly, select=f"SELECT week_start, {tiny}, vote_cnt, vote_user_cnt FROM votes_cut"),
        "status_stays": _with(*series, stays, select="SELECT * FROM stays"),
        "time_in_status": _with(*series, stays, select="""SELECT cluster, kpi, status, count(*) AS stays,
  CAST(sum(weeks) AS BIGINT) AS weeks, max(weeks) AS longest FROM stays GROUP BY ALL"""),
        "active_users_spans": _with(*weekly, _frame(cfg), members, """mondays AS (SELECT DISTINCT week_start AS w FROM frame)""",
                                    select=f"""SELECT a.w AS span_start, z.w AS span_end, {tiny},
  count(DISTINCT user_id) AS active_users, TRUE AS close
FROM mondays AS a JOIN mondays AS z ON a.w <= z.w JOIN members AS m ON m.week_start BETWEEN a.w AND z.w
GROUP BY a.w, z.w, cluster"""),
        "kpi_cube": _with(*labelled, ATTENDANCE, DAYS, facts, select=cube),
        "top_voters": _with(*weekly, select=f"""SELECT week_start, {tiny}, user_id, n AS votes,
  CAST(row_number() OVER (PARTITION BY week_start, cluster ORDER BY n DESC, user_id) AS INT) AS place,
  CAST(rank() OVER (PARTITION BY week_start, cluster ORDER BY n DESC) AS INT) AS rank
FROM per_user QUALIFY place <= 10"""),
        "week_over_week": _with(*series, select=f"""SELECT week_start, cluster, {change}
FROM series WINDOW w AS (PARTITION BY cluster ORDER BY week_start)"""),
        "retention": _with(*weekly, members, select=f"""SELECT m.week_start, CAST(m.cluster AS TINYINT) AS cluster, count(*) AS active,
  CAST(count(*) FILTER (EXISTS (SELECT 1 FROM members AS x
    WHERE x.user_id = m.user_id AND x.week_start = m.week_start - INTERVAL 7 DAY)) AS BIGINT) AS returned,
  CAST(count(*) FILTER (EXISTS (SELECT 1 FROM members AS x
    WHERE x.user_id = m.user_id AND x.week_start = m.week_start + INTERVAL 7 DAY)) AS BIGINT) AS retained,
  CAST(count(*) FILTER (NOT EXISTS (SELECT 1 FROM members AS x
    WHERE x.user_id = m.user_id AND x.week_start < m.week_start)) AS BIGINT) AS new,
  round(CAST(count(*) FILTER (EXISTS (SELECT 1 FROM members AS x
    WHERE x.user_id = m.user_id AND x.week_start = m.week_start + INTERVAL 7 DAY)) AS DOUBLE) / count(*) * 100, 6) AS retained_pct
FROM members AS m GROUP BY ALL"""),
    }


def oracle_sql() -> dict[str, str]:
    cfg, mark, following = b.CONFIG, b.MARK, b.NEXT_MARK
    people = (USERS, *FACTS, _clean(), _summaries(cfg), _profile(cfg))
    labelled = (*people, FEATURES, _labels())
    weekly = (*labelled, ATTENDANCE, DAYS, _weekly(cfg))
    super_runs = (
        USERS, *FACTS, _clean(),
        _summaries(b.EARLY, suffix="_early"), _profile(b.EARLY, suffix="_early"),
        _summaries(b.LATE, suffix="_late"), _profile(b.LATE, suffix="_late"),
    )
    super_state = f"""SELECT {SUPER_COLUMNS} FROM profile_early WHERE user_type = 'Super'
UNION ALL
SELECT {SUPER_COLUMNS} FROM profile_late WHERE user_type = 'Super'
  AND user_id NOT IN (SELECT user_id FROM profile_early WHERE user_type = 'Super')"""
    scaled = ", ".join(
        f"round(({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER (), 6) AS {f}_scaled" for f in FEATURE_NAMES
    )
    wide = replace(cfg, include_partial_first_week=True)

    def counts(*, between: bool) -> str:
        """Rows of the last run per loaded table: whole tables, and facts in (mark, next]."""
        plain = [(f"raw_{t}", t, None) for t in ("region", "nation", "supplier", "part", "orders")]
        facts = [
            ("raw_accounts_user", "loaded_users", "created_at"),
            ("raw_accounts_userquestionrecord", "votes", "created_at"),
            ("raw_accounts_blockrecord", "blocks", "created_at"),
            ("raw_accounts_paymenthistory", "payments", "created_at"),
            ("raw_accounts_pointhistory", "linked_points", "created_at"),
            ("raw_accounts_attendance", "attendance", None),
            ("raw_hackle_events", "ev", "ts"),
        ]
        rows = []
        for target, table, ts in plain + facts:
            where = ""
            if between and ts:
                where = f" WHERE {ts} > TIMESTAMP '{mark}' AND {ts} <= TIMESTAMP '{following}'"
            synced = f"TIMESTAMP '{following}' AS last_synced_at, " if between else ""
            rows.append(f"SELECT '{target}' AS table_name, {synced}count(*) AS row_count FROM {table}{where}")
        return _with(USERS, LOADED_USERS, *FACTS, LINKED_POINTS, ATTENDANCE, select="\nUNION ALL\n".join(rows))

    weekly_select = {
        "weekly_revenue": "SELECT week_start, CAST(cluster AS TINYINT) AS cluster, revenue FROM revenue",
        "weekly_votes": "SELECT week_start, CAST(cluster AS TINYINT) AS cluster, vote_cnt, vote_user_cnt FROM votes_cut",
        "weekly_votes_raw": "SELECT week_start, CAST(cluster AS TINYINT) AS cluster, vote_cnt_raw FROM votes_raw",
        "weekly_points": "SELECT week_start, CAST(cluster AS TINYINT) AS cluster, point_burn, net_flow FROM flow",
        "weekly_active_users": "SELECT week_start, CAST(cluster AS TINYINT) AS cluster, active_users FROM active",
        "weekly_last_activity": "SELECT week_start, CAST(cluster AS TINYINT) AS cluster, last_act FROM active",
    }
    return {
        "preprocess_user": _with(USERS, LOADED_USERS, select="SELECT * FROM loaded_users"),
        "preprocess_point": _with(
            EV, POINTS, LINKED_POINTS, select="SELECT *, CAST(created_at AS DATE) AS dt FROM linked_points"),
        "clean_users": _with(USERS, _clean(), select="SELECT * FROM clean"),
        "attendance_days": _with(EV, ATTENDANCE, DAYS, select="SELECT * FROM days"),
        "broken_text_counts": _with(
            USERS, EV, ATTENDANCE,
            select="""SELECT 'accounts_user' AS source, 'list' AS fault, count(*) AS n_values FROM users
  WHERE friend_id_list IS NOT NULL AND (id % 41 = 0 OR id % 43 = 0 OR id % 47 = 0)
UNION ALL SELECT 'accounts_attendance', 'list', count(*) FROM attendance WHERE user_id % 11 = 0
UNION ALL SELECT 'accounts_attendance', 'date', 2 * count(*) FROM attendance
  WHERE user_id % 7 = 0 AND user_id % 11 <> 0"""),
        "vote_summary": _with(*FACTS, _summaries(cfg), select="SELECT * FROM vote_sum"),
        "payment_summary": _with(*FACTS, _summaries(cfg), select="SELECT * FROM pay_sum"),
        "block_summary": _with(*FACTS, _summaries(cfg), select="SELECT * FROM block_sum"),
        "point_summary": _with(*FACTS, _summaries(cfg), select="SELECT * FROM point_sum"),
        "user_profile": _with(*people, select="SELECT * FROM profile"),
        "super_users": _with(*people, select=f"SELECT {SUPER_COLUMNS} FROM profile WHERE user_type = 'Super'"),
        "general_users": _with(
            *people,
            select="SELECT user_id, friend_cnt, recency, frequency, monetary, block_cnt"
                   " FROM profile WHERE user_type = 'General'"),
        "user_type_counts": _with(
            *people, select="SELECT user_type, count(*) AS users FROM profile GROUP BY user_type"),
        "log_features": _with(
            *people, FEATURES,
            select="SELECT user_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in FEATURE_NAMES) + " FROM features"),
        "scaled_features": _with(*people, FEATURES, select=f"SELECT user_id, {scaled} FROM features"),
        "score_clusters": _with(
            *labelled,
            select="""SELECT f.user_id, f.friend_cnt, f.recency, CAST(f.frequency AS DOUBLE) AS frequency,
  CAST(f.monetary AS DOUBLE) AS monetary, CAST(f.block_cnt AS INT) AS block_cnt,
  CAST(l.cluster AS TINYINT) AS cluster
FROM features AS f JOIN labels AS l ON l.user_id = f.user_id"""),
        "cluster_users": _with(
            *people,
            select="""SELECT user_id, CAST(10 * (user_id % 6) AS INT) AS friend_cnt,
  CAST(40 * (user_id % 6) + (user_id // 6) % 4 AS DOUBLE) AS recency, CAST(user_id % 2 AS DOUBLE) AS frequency,
  CAST(100 * (user_id % 6) + (user_id // 24) % 5 * (user_id % 6) AS DOUBLE) AS monetary,
  CAST(CASE WHEN user_id % 6 = 3 THEN 50 ELSE 0 END AS INT) AS block_cnt, CAST(user_id % 6 AS TINYINT) AS cluster
FROM profile WHERE user_type = 'General'"""),
        "mart_refit": _with(
            *people, select="SELECT user_id, CAST(user_id % 6 AS TINYINT) AS cluster FROM profile WHERE user_type = 'General'"),
        "mart_refresh": _with(*super_runs, select=f"SELECT {SUPER_COLUMNS} FROM profile_late WHERE user_type = 'Super'"),
        "bucketed_upsert": _with(USERS, _clean(), select="""SELECT user_id, CAST(point AS BIGINT)
  + CASE WHEN user_id % 101 = 0 AND user_id % 14 <> 0 THEN 1 ELSE 0 END AS point
FROM clean WHERE user_id % 14 = 0 OR (user_id % 103 <> 0 AND (user_id % 7 <> 0 OR user_id % 101 = 0))"""),
        "replica_reconciled": _with(USERS, _clean(), select="""SELECT user_id, CASE WHEN user_id % 101 = 0 THEN 'lost'
    WHEN user_id % 107 = 0 THEN 'doubled' ELSE 'changed' END AS fault, 1::BIGINT AS source_rows,
  CASE WHEN user_id % 101 = 0 THEN 0 WHEN user_id % 107 = 0 THEN 2 ELSE 1 END::BIGINT AS copy_rows
FROM clean WHERE user_id % 101 = 0 OR user_id % 103 = 0 OR user_id % 107 = 0
UNION ALL SELECT user_id + 1000000000, 'extra', 0, 1 FROM clean WHERE user_id % 109 = 0"""),
        "typed_props": """SELECT event_id, CASE WHEN fault IS NULL THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, fault
FROM (SELECT *, CASE WHEN event_id % 41 = 0 THEN 'broken' WHEN event_id % 43 = 0 THEN 'missing'
    WHEN event_id % 47 = 0 THEN 'null' WHEN event_id % 53 = 0 THEN 'wrong type' WHEN event_id % 59 = 0 THEN 'no text'
    WHEN event_id % 61 = 0 THEN 'missing' END AS fault FROM events) AS e""",
        "cluster_profiles": _with(
            *people, select="SELECT user_id, TRUE AS labelled FROM profile WHERE user_type = 'General'"),
        "week_frame": f"""WITH span AS (SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS z FROM events),
mondays AS (
  SELECT d, row_number() OVER (ORDER BY d) AS n
  FROM (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
        FROM span) AS x
  WHERE isodow(d) = 1)
SELECT d AS week_start, CAST(t.cluster AS TINYINT) AS cluster,
  strftime(d, '%Y-%m-%d') || ' (W' || n || ')' AS week_label
FROM mondays CROSS JOIN (VALUES {', '.join(f'({t})' for t in cfg.targets)}) AS t(cluster)""",
        "cumulative_users": _with(
            *labelled, _frame(cfg), _cum(),
            select="SELECT week_start, CAST(cluster AS TINYINT) AS cluster, cum_users FROM cum"),
        **{name: _with(*weekly, select=sql) for name, sql in weekly_select.items()},
        "activity_timeseries": _with(*weekly, _frame(cfg), _cum(), _series(cfg), select="SELECT * FROM series"),
        "dashboard_extract": _with(
            *weekly, _frame(wide), _cum(), _series(wide),
            select=f"SELECT * FROM series WHERE week_start >= DATE '{cfg.window.start}'"),
        **_over_time(people, labelled, weekly),
        "incremental_scan": f"SELECT * FROM events WHERE ts > TIMESTAMP '{mark}'",
        "incremental_new_rows": f"""SELECT * FROM events
WHERE ts > TIMESTAMP '{mark}' - INTERVAL 5 DAY
  AND event_id NOT IN (SELECT event_id FROM events WHERE ts <= TIMESTAMP '{mark}')""",
        "full_load": _with(USERS, LOADED_USERS, select="SELECT * FROM loaded_users"),
        "keyed_reload": "SELECT * FROM events",
        "keyless_reload": f"""SELECT event_id, ts AS event_datetime, user_id, event_type, value, props FROM events
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts > TIMESTAMP '{mark}'""",
        "load_all": counts(between=False),
        "sync_state": counts(between=True),
        "append_new_keys": _with(*super_runs, select=super_state),
        "replica_sync": _with(*super_runs, select=super_state),
        "timeseries_append": _with(
            *labelled, ATTENDANCE, DAYS,
            _frame(b.EARLY, "_early"), _cum("_early"), _weekly(b.EARLY, suffix="_early"), _series(b.EARLY, "_early"),
            _frame(b.LATE, "_late"), _cum("_late"), _weekly(b.LATE, suffix="_late"), _series(b.LATE, "_late"),
            select="""SELECT * FROM series_early
UNION ALL
SELECT * FROM series_late WHERE week_start NOT IN (SELECT week_start FROM series_early)"""),
        "activity_mart_run": _with(
            USERS, LOADED_USERS, *FACTS, LINKED_POINTS, _clean("loaded_users"),
            _summaries(cfg, "linked_points"), _profile(cfg), FEATURES, _labels(), ATTENDANCE, DAYS,
            _weekly(cfg, "linked_points"), _frame(cfg), _cum(), _series(cfg), select="SELECT * FROM series"),
    }
