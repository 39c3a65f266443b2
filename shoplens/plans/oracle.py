"""Independent DuckDB SQL for every registered query.

Each statement starts from the driver's raw tables and re-states the binding
of ``shoplens.sources.binding`` as CTEs, so the oracle shares no code with the
Spark plans. Rounding uses exact integer arithmetic (``//``) because DuckDB's
``round`` is not HALF_UP on every double.
"""

from __future__ import annotations

from shoplens.plans.defaults import FLOOR_SAMPLE_SIZE, QUERY_PARAMS as P

START, END = P.start_date, P.end_date


def _actions_cte(mode: str = "B1", name: str = "actions") -> str:
    session = {
        "B1": "CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d')",
        "B2": "CAST(event_id // 2 AS VARCHAR)",
    }[mode]
    return f"""
{name}_ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
{name} AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         CAST(user_id AS BIGINT) AS user_id,
         {session} AS session_id,
         k % 10 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CAST(CASE WHEN event_type = 'click' THEN k ELSE -1 END AS BIGINT) AS click_category_id,
         CAST(CASE WHEN event_type = 'click' THEN (event_id * 7 + k) % 100 ELSE -1 END AS BIGINT) AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) || ',' || CAST((k + 7) % 100 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) || ',' || CAST((k + 7) % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         CAST(user_id % 25 AS BIGINT) AS city_id,
         event_id
  FROM {name}_ev
)"""


USERS = """
users AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS user_id, c.c_name AS username, c.c_name AS name,
         CAST((c.c_custkey * 7) % 60 AS INTEGER) AS age, c.c_mktsegment AS professional,
         n.n_name AS city, CASE WHEN c.c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}' AS extend_info
  FROM part
)"""

CITIES = """
cities AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS city_id, n.n_name AS city_name, r.r_name AS area
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _half_up(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN CAST((({num}) * 200 + ({den})) // (2 * ({den})) AS DOUBLE) / 100 END"


# ------------------------------------------------------------------ area
_AREA_COUNTS = f"""
clicks AS (
  SELECT city_id, click_product_id FROM actions
  WHERE date BETWEEN '{START}' AND '{END}' AND click_product_id <> -1
),
area_clicks AS (
  SELECT c.city_id, ci.city_name, ci.area, c.click_product_id AS pid
  FROM clicks c JOIN cities ci ON c.city_id = ci.city_id
),
area_counts AS (
  SELECT area, pid, CAST(count(*) AS BIGINT) AS click_count,
         array_to_string(list_sort(list_distinct(list(CAST(city_id AS VARCHAR) || ':' || city_name))), ',') AS city_infos
  FROM area_clicks GROUP BY area, pid
),
area_info AS (
  SELECT t.area, t.city_infos, t.pid, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END AS product_status,
         t.click_count
  FROM area_counts t JOIN products p ON t.pid = p.product_id
)"""

AREA_LEVEL_SQL = """CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A_Level'
            WHEN area IN ('ASIA', 'EUROPE') THEN 'B_Level'
            WHEN area IN ('MIDDLE EAST') THEN 'C_Level' ELSE 'D_Level' END"""

SQL: dict[str, str] = {}

SQL["product_clicks"] = with_(_actions_cte()) + f"""
SELECT city_id, click_product_id FROM actions
WHERE date BETWEEN '{START}' AND '{END}' AND click_product_id <> -1"""

SQL["area_clicks"] = with_(_actions_cte(), CITIES, _AREA_COUNTS) + """
SELECT city_id, city_name, area, pid FROM area_clicks"""

SQL["area_product_click_count"] = with_(_actions_cte(), CITIES, _AREA_COUNTS) + """
SELECT area, pid, click_count, city_infos FROM area_counts"""

SQL["area_product_info"] = with_(_actions_cte(), CITIES, PRODUCTS, _AREA_COUNTS) + """
SELECT area, city_infos, pid, product_name, product_status, click_count FROM area_info"""

SQL["area_top3_product"] = with_(_actions_cte(), CITIES, PRODUCTS, _AREA_COUNTS) + f"""
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid ASC) AS rn FROM area_info
)
SELECT '{P.task_id}' AS taskid, area, {AREA_LEVEL_SQL} AS areaLevel, pid AS productid,
       city_infos AS cityInfos, click_count AS clickCount, product_name AS productName,
       product_status AS productStatus
FROM ranked WHERE rn <= {P.top_products}"""


# ------------------------------------------------------------------ sessions
def _profile_cte(src: str = "actions_r", name: str = "profile") -> str:
    t = "strptime(action_time, '%Y-%m-%d %H:%M:%S')"
    kw = "CASE WHEN search_keyword <> '' THEN search_keyword END"
    cat = "CASE WHEN click_category_id <> -1 THEN click_category_id END"
    return f"""
{name} AS (
  SELECT session_id, min(user_id) AS user_id,
         array_to_string(list_sort(list_distinct(list({kw}))), ',') AS search_keywords,
         array_to_string(list_sort(list_distinct(list({cat}))), ',') AS click_category_ids,
         CAST(epoch(max({t})) - epoch(min({t})) AS BIGINT) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length,
         strftime(min({t}), '%Y-%m-%d %H:%M:%S') AS start_time,
         list_distinct(list({kw})) AS kw_list,
         list_distinct(list({cat})) AS cat_list
  FROM {src} GROUP BY session_id
)"""


_RANGE = f"""
actions_r AS (SELECT * FROM actions WHERE date BETWEEN '{START}' AND '{END}')"""

_FULL = """
full_info AS (
  SELECT p.*, u.age, u.professional, u.sex, u.city FROM profile p JOIN users u ON p.user_id = u.user_id
)"""

PROFILE_COLS = "session_id, user_id, search_keywords, click_category_ids, visit_length, step_length, start_time"
FULL_COLS = PROFILE_COLS + ", age, professional, sex, city"
ACTION_COLS = ("date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, "
               "click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id")


def _sessions(mode: str = "B1", where: str = "age BETWEEN 20 AND 50") -> str:
    """CTEs up to ``fs`` (filtered sessions) for one binding mode."""
    return with_(_actions_cte(mode), USERS, _RANGE, _profile_cte(), _FULL) + f""",
fs AS (SELECT * FROM full_info WHERE {where})"""


SQL["actions_by_date"] = with_(_actions_cte(), _RANGE) + f"\nSELECT {ACTION_COLS} FROM actions_r"
SQL["session_profile"] = with_(_actions_cte(), _RANGE, _profile_cte()) + f"\nSELECT {PROFILE_COLS} FROM profile"
SQL["session_full_info"] = with_(_actions_cte(), USERS, _RANGE, _profile_cte(), _FULL) + f"\nSELECT {FULL_COLS} FROM full_info"
SQL["session_filter"] = _sessions() + f"\nSELECT {FULL_COLS} FROM fs"
SQL["session_filter_age"] = _sessions() + "\nSELECT session_id, age FROM fs"
SQL["session_filter_members"] = _sessions(
    "B1", "professional IN ('AUTOMOBILE', 'MACHINERY') AND city IN ('NATION_1', 'NATION_3', 'NATION_5', 'NATION_7')"
) + "\nSELECT session_id, professional, city FROM fs"
SQL["session_filter_sex"] = _sessions("B1", "sex = 'female'") + "\nSELECT session_id, sex FROM fs"
SQL["session_filter_keywords"] = _sessions("B1", "list_has_any(kw_list, ['kw1', 'kw4'])") + \
    "\nSELECT session_id, search_keywords FROM fs"
SQL["session_filter_categories"] = _sessions("B1", "list_has_any(cat_list, [3, 17, 44, 48, 57, 90]::BIGINT[])") + \
    "\nSELECT session_id, click_category_ids FROM fs"
SQL["filtered_actions"] = _sessions() + f"""
SELECT {ACTION_COLS} FROM actions_r WHERE session_id IN (SELECT session_id FROM fs)"""

# visit buckets (seconds) and step buckets (actions), restated for the oracle
_VISIT = [("1s_3s", "BETWEEN 1 AND 3"), ("4s_6s", "BETWEEN 4 AND 6"), ("7s_9s", "BETWEEN 7 AND 9"),
          ("10s_30s", "BETWEEN 10 AND 30"), ("30s_60s", "BETWEEN 31 AND 60"), ("1m_3m", "BETWEEN 61 AND 180"),
          ("3m_10m", "BETWEEN 181 AND 600"), ("10m_30m", "BETWEEN 601 AND 1800"), ("30m", ">= 1801")]
_STEP = [("1_3", "BETWEEN 1 AND 3"), ("4_6", "BETWEEN 4 AND 6"), ("7_9", "BETWEEN 7 AND 9"),
         ("10_30", "BETWEEN 10 AND 30"), ("30_60", "BETWEEN 31 AND 60"), ("60", ">= 61")]


def _bucket_union(col: str, buckets) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS bucket, CAST(count(*) FILTER (WHERE {col} {cond}) AS BIGINT) AS session_count FROM fs"
        for label, cond in buckets
    )


SQL["session_visit_buckets"] = _sessions("B2") + "\n" + _bucket_union("visit_length", _VISIT)
SQL["session_step_buckets"] = _sessions("B1") + "\n" + _bucket_union("step_length", _STEP)
SQL["session_aggr_stat"] = _sessions("B2") + f""",
c AS (SELECT CAST(count(*) AS BIGINT) AS n,
  {", ".join(f"count(*) FILTER (WHERE visit_length {cond}) AS v_{label}" for label, cond in _VISIT)},
  {", ".join(f"count(*) FILTER (WHERE step_length {cond}) AS s_{label}" for label, cond in _STEP)}
  FROM fs)
SELECT '{P.task_id}' AS taskid, n AS session_count,
  {", ".join(f"{_half_up(f'v_{label}', 'n')} AS visit_length_{label}_ratio" for label, _ in _VISIT)},
  {", ".join(f"{_half_up(f's_{label}', 'n')} AS step_length_{label}_ratio" for label, _ in _STEP)}
FROM c"""

# ------------------------------------------------------------------ sampling
_HOURLY = """,
sh AS (SELECT *, substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour FROM fs),
hourly AS (SELECT date, hour, CAST(count(*) AS BIGINT) AS session_count FROM sh GROUP BY date, hour)"""


def _quota(allocation: str, size: int = P.sample_size) -> str:
    days = "(SELECT count(DISTINCT date) FROM hourly)"
    per_day = f"floor({size} / {days})"
    if allocation != "floor":
        day = "dense_rank() OVER (ORDER BY date)"
        per_day = f"floor({day} * {size} / {days}) - floor(({day} - 1) * {size} / {days})"
    q = f""",
q0 AS (
  SELECT date, hour, session_count,
         CAST({per_day} AS BIGINT) AS per_day,
         CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_total
  FROM hourly),
q1 AS (SELECT *, (session_count / day_total) * per_day AS exact FROM q0),
q2 AS (SELECT *, CAST(floor(exact) AS BIGINT) AS base FROM q1)"""
    if allocation == "floor":
        return q + """,
quota AS (SELECT date, hour, session_count, CAST(least(base, session_count) AS BIGINT) AS quota FROM q2)"""
    return q + """,
q3 AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY exact - base DESC, hour ASC) AS rk,
              per_day - sum(base) OVER (PARTITION BY date) AS short FROM q2),
quota AS (SELECT date, hour, session_count,
                 CAST(least(base + CASE WHEN rk <= short THEN 1 ELSE 0 END, session_count) AS BIGINT) AS quota FROM q3)"""


def _extract(allocation: str, size: int = P.sample_size) -> str:
    return _sessions() + _HOURLY + _quota(allocation, size) + f""",
ranked AS (
  SELECT sh.*, row_number() OVER (PARTITION BY date, hour ORDER BY md5('{P.sample_seed}' || session_id), session_id) AS rn
  FROM sh),
extract AS (
  SELECT '{P.task_id}' AS taskid, r.session_id AS sessionid, r.start_time AS startTime,
         r.search_keywords AS searchKeywords, r.click_category_ids AS clickCategoryIds
  FROM ranked r JOIN quota q ON r.date = q.date AND r.hour = q.hour WHERE r.rn <= q.quota)"""


SQL["session_hourly_count"] = _sessions() + _HOURLY + "\nSELECT date, hour, session_count FROM hourly"
SQL["session_sample_quota"] = _sessions() + _HOURLY + _quota("floor") + \
    "\nSELECT date, hour, session_count, quota FROM quota"
SQL["session_sample_quota_lr"] = _sessions() + _HOURLY + _quota("largest_remainder") + \
    "\nSELECT date, hour, session_count, quota FROM quota"
SQL["session_random_extract"] = _extract("floor", FLOOR_SAMPLE_SIZE) + "\nSELECT * FROM extract"
SQL["session_random_extract_lr"] = _extract("largest_remainder") + "\nSELECT * FROM extract"
SQL["session_detail"] = _extract("largest_remainder") + f"""
SELECT '{P.task_id}' AS taskid, user_id AS userid, session_id AS sessionid, page_id AS pageid,
       action_time AS actionTime, search_keyword AS searchKeyword, click_category_id AS clickCategoryId,
       click_product_id AS clickProductId, order_category_ids AS orderCategoryIds,
       order_product_ids AS orderProductIds, pay_category_ids AS payCategoryIds, pay_product_ids AS payProductIds
FROM actions_r WHERE session_id IN (SELECT sessionid FROM extract)"""

# ------------------------------------------------------------------ categories
_CATS = """,
fa AS (SELECT * FROM actions_r WHERE session_id IN (SELECT session_id FROM fs)),
cev AS (
  SELECT click_category_id AS category_id, 0 AS kind FROM fa WHERE click_category_id <> -1
  UNION ALL
  SELECT CAST(x AS BIGINT), 1 FROM (
    SELECT unnest(string_split(order_category_ids, ',')) AS x FROM fa
    WHERE order_category_ids IS NOT NULL AND trim(order_category_ids) <> '')
  UNION ALL
  SELECT CAST(x AS BIGINT), 2 FROM (
    SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM fa
    WHERE pay_category_ids IS NOT NULL AND trim(pay_category_ids) <> '')
),
full_count AS (
  SELECT category_id,
         CAST(count(*) FILTER (WHERE kind = 0) AS BIGINT) AS click_count,
         CAST(count(*) FILTER (WHERE kind = 1) AS BIGINT) AS order_count,
         CAST(count(*) FILTER (WHERE kind = 2) AS BIGINT) AS pay_count
  FROM cev GROUP BY category_id
),
top AS (
  SELECT * FROM full_count
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC LIMIT """ + str(P.top_categories) + ")"

SQL["category_ids"] = _sessions() + _CATS + "\nSELECT DISTINCT category_id FROM cev"
for _kind, _code in (("click", 0), ("order", 1), ("pay", 2)):
    SQL[f"category_{_kind}_count"] = _sessions() + _CATS + \
        f"\nSELECT category_id, CAST(count(*) AS BIGINT) AS n FROM cev WHERE kind = {_code} GROUP BY category_id"
SQL["category_full_count"] = _sessions() + _CATS + \
    "\nSELECT category_id, click_count, order_count, pay_count FROM full_count"
SQL["top10_category"] = _sessions() + _CATS + f"""
SELECT '{P.task_id}' AS taskid, category_id AS categoryid, click_count AS clickCount,
       order_count AS orderCount, pay_count AS payCount FROM top"""
SQL["top10_session"] = _sessions() + _CATS + f""",
sc AS (
  SELECT click_category_id AS category_id, session_id, CAST(count(*) AS BIGINT) AS click_count FROM fa
  WHERE click_category_id IN (SELECT category_id FROM top) GROUP BY click_category_id, session_id),
r AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id ASC) AS rn FROM sc)
SELECT '{P.task_id}' AS taskid, category_id AS categoryid, session_id AS sessionid, click_count AS clickCount
FROM r WHERE rn <= {P.top_sessions}"""

# ------------------------------------------------------------------ funnel
_FLOW = list(P.target_page_flow)
_STEPS_VALUES = ", ".join(
    f"({i + 1}, {a}, {b}, '{a}_{b}')" for i, (a, b) in enumerate(zip(_FLOW, _FLOW[1:]))
)
_FUNNEL = with_(_actions_cte(), _RANGE) + f""",
ordered AS (
  SELECT session_id, page_id,
         lead(page_id) OVER (PARTITION BY session_id
                             ORDER BY epoch(strptime(action_time, '%Y-%m-%d %H:%M:%S')), event_id) AS to_page
  FROM actions_r),
pairs AS (SELECT session_id, page_id AS from_page, to_page FROM ordered WHERE to_page IS NOT NULL),
steps(step_no, from_page, to_page, step) AS (VALUES {_STEPS_VALUES}),
pc AS (
  SELECT s.step, CAST(count(*) AS BIGINT) AS n FROM pairs p
  JOIN (SELECT DISTINCT from_page, to_page, step FROM steps) s
    ON p.from_page = s.from_page AND p.to_page = s.to_page
  GROUP BY s.step),
start_n AS (SELECT CAST(count(*) FILTER (WHERE page_id = {_FLOW[0]}) AS BIGINT) AS n FROM actions_r),
per_step AS (
  SELECT CAST(s.step_no AS BIGINT) AS step_no, s.step, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM steps s LEFT JOIN pc c ON s.step = c.step),
chain AS (SELECT step_no, step, n FROM per_step UNION ALL SELECT CAST(0 AS BIGINT), NULL, n FROM start_n),
lagged AS (SELECT step_no, step, n, lag(n) OVER (ORDER BY step_no) AS prev FROM chain),
rates AS (SELECT step_no, step, n, {_half_up('n', 'prev')} AS rate FROM lagged WHERE step_no > 0)"""

SQL["page_pairs"] = _FUNNEL + "\nSELECT session_id, from_page, to_page FROM pairs"
SQL["page_pair_count"] = _FUNNEL + "\nSELECT step, n FROM pc"
SQL["page_start_count"] = _FUNNEL + "\nSELECT n FROM start_n"
SQL["page_convert_rate"] = _FUNNEL + "\nSELECT step_no, step, n, rate FROM rates"
SQL["page_convert_rate_packed"] = _FUNNEL + f"""
SELECT '{P.task_id}' AS taskid,
       string_agg(step || '=' || coalesce(printf('%.2f', rate), 'null'), '|' ORDER BY step_no) AS convertRate
FROM rates"""

# ------------------------------------------------------------------ ads
_ADS = with_(CITIES) + f""",
ad_lines AS (
  SELECT CAST(epoch_us(e.ts) // 1000 AS VARCHAR) || ' ' || replace(ci.area, ' ', '_') || ' ' || ci.city_name || ' ' ||
         CAST(e.user_id AS VARCHAR) || ' ' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 20 AS VARCHAR) AS value
  FROM events e JOIN cities ci ON e.user_id % 25 = ci.city_id
  WHERE e.event_type = 'click'),
parsed AS (SELECT string_split(value, ' ') AS p FROM ad_lines),
clicks AS (
  SELECT TRY_CAST(p[1] AS BIGINT) AS ts_ms, p[2] AS province, p[3] AS city,
         TRY_CAST(p[4] AS BIGINT) AS userid, TRY_CAST(p[5] AS BIGINT) AS adid
  FROM parsed WHERE len(p) = 5),
clicks_t AS (
  SELECT *, strftime(epoch_ms(ts_ms), '%Y%m%d') AS date, strftime(epoch_ms(ts_ms), '%H') AS hour,
         strftime(epoch_ms(ts_ms), '%M') AS minute
  FROM clicks WHERE ts_ms IS NOT NULL AND userid IS NOT NULL AND adid IS NOT NULL),
user_counts AS (
  SELECT date, userid, adid, CAST(count(*) AS BIGINT) AS clickCount FROM clicks_t GROUP BY date, userid, adid),
black AS (SELECT DISTINCT userid FROM user_counts WHERE clickCount >= {P.blacklist_threshold}),
clean AS (SELECT * FROM clicks_t WHERE userid NOT IN (SELECT userid FROM black)),
stat AS (
  SELECT date, province, city, adid, CAST(count(*) AS BIGINT) AS clickCount FROM clean
  GROUP BY date, province, city, adid),
prov AS (
  SELECT date, province, adid, CAST(sum(clickCount) AS BIGINT) AS clickCount FROM stat GROUP BY date, province, adid),
prov_r AS (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY clickCount DESC, adid ASC) AS rn FROM prov),
trend AS (
  SELECT date, hour, minute, adid, CAST(count(*) AS BIGINT) AS clickCount FROM clean GROUP BY date, hour, minute, adid)"""

SQL["ad_log_parse"] = _ADS + "\nSELECT ts_ms, province, city, userid, adid FROM clicks_t"
SQL["ad_user_click_count"] = _ADS + "\nSELECT date, userid, adid, clickCount FROM user_counts"
SQL["ad_blacklist"] = _ADS + "\nSELECT userid FROM black"
SQL["ad_clean_clicks"] = _ADS + "\nSELECT ts_ms, province, city, userid, adid FROM clean"
SQL["ad_stat"] = _ADS + "\nSELECT date, province, city, adid, clickCount FROM stat"
SQL["ad_province_top3"] = _ADS + f"\nSELECT date, province, adid, clickCount FROM prov_r WHERE rn <= {P.top_ads}"
SQL["ad_click_trend"] = _ADS + "\nSELECT date, hour, minute, adid, clickCount FROM trend"
# the streaming job, run to completion, must equal the batch tables
for _k in ("ad_user_click_count", "ad_blacklist", "ad_stat", "ad_province_top3", "ad_click_trend"):
    SQL[f"{_k}_stream"] = SQL[_k]

# ------------------------------------------------------------------ scalars, packed records, SQL surface, sinks
_TS = "strptime(action_time, '%Y-%m-%d %H:%M:%S')"
SQL["time_scalars"] = with_(_actions_cte(), _RANGE) + f"""
SELECT event_id,
       strftime({_TS}, '%Y-%m-%d') AS date_str,
       strftime({_TS}, '%Y-%m-%d_%H') AS date_hour,
       strftime({_TS}, '%Y%m%d') AS date_key,
       strftime(strptime(strftime({_TS}, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS date_key_parsed,
       strftime({_TS}, '%Y%m%d%H%M') AS minute_key,
       strftime({_TS}, '%Y-%m-%d %H:%M:%S') AS time_str,
       {_TS} < TIMESTAMP '2024-01-15 12:00:00' AS before_ref,
       {_TS} > TIMESTAMP '2024-01-15 12:00:00' AS after_ref,
       CAST(epoch({_TS}) - epoch(TIMESTAMP '2024-01-01 00:00:00') AS BIGINT) AS seconds_since_start
FROM actions_r"""

SQL["string_scalars"] = with_(_actions_cte(), _RANGE) + """
SELECT event_id,
       (order_category_ids IS NULL OR order_category_ids = '') AS order_blank,
       NOT (search_keyword IS NULL OR search_keyword = '') AS keyword_set,
       regexp_replace(',' || coalesce(order_category_ids, '') || ',', '^,|,$', '', 'g') AS order_trimmed,
       regexp_replace(coalesce(order_category_ids, ''), '^,|,$', '', 'g') AS order_trimmed_plain,
       lpad(CAST(page_id AS VARCHAR), 2, '0') AS page_padded,
       CAST(CASE WHEN order_category_ids IS NULL OR trim(order_category_ids) = '' THEN 0
                 ELSE len(string_split(order_category_ids, ',')) END AS BIGINT) AS order_id_count
FROM actions_r"""

_PACKED = with_(_actions_cte(), _RANGE, _profile_cte()) + """,
packed AS (
  SELECT session_id AS id,
         'sessionid=' || session_id || '|searchKeywords=' || search_keywords ||
         '|clickCategoryIds=' || click_category_ids || '|visitLength=' || CAST(visit_length AS VARCHAR) ||
         '|stepLength=' || CAST(step_length AS VARCHAR) || '|startTime=' || start_time AS packed
  FROM profile)"""
SQL["packed_field_read"] = _PACKED + """
SELECT id, list_filter(list_transform(string_split(packed, '|'), lambda x: string_split(x, '=')),
                       lambda kv: len(kv) = 2 AND kv[1] = 'searchKeywords' AND kv[2] <> '')[1][2] AS value
FROM packed"""
SQL["packed_field_write"] = _PACKED + """
SELECT id, array_to_string(list_transform(string_split(packed, '|'),
         lambda x: CASE WHEN string_split(x, '=')[1] = 'clickCategoryIds' THEN 'clickCategoryIds=none' ELSE x END), '|')
       AS value
FROM packed"""
SQL["area_top3_product_sql"] = SQL["area_top3_product"]
SQL["sink_roundtrip"] = SQL["top10_category"]
