"""DuckDB oracle SQL for the queries registered in ``__spark_entry__``.

Each query is written independently of the Spark code, against the raw
driver views (``events``, ``customer``, ``part``, ...).  The adapter of
``shoplens.sources.adapters`` is restated here as SQL views (CTEs).
Millisecond values are derived as ``epoch_us // 1000`` (truncation), the
way Spark does it.
"""

from __future__ import annotations

from query_params import (
    AD_THRESHOLD,
    DEFAULT_PARAMS,
    FILTER_PARAMS,
    LEVEL_OF_AREA,
    SAMPLE_SEED,
    SAMPLE_TOTAL,
    STREAM_LATE_DIGIT,
    STREAM_ROUNDS,
    STREAM_SLICE_MS,
    STREAM_START_MS,
    TABLE_PARAMS,
    TABLE_TASK,
)


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _in_list(vals) -> str:
    return "(" + ", ".join(_lit(v) for v in vals) + ")"


ACTIONS = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         strftime(ts, '%Y-%m-%d') AS d,
         CAST(floor((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 40) AS INTEGER) AS sec
  FROM events
),
actions AS (
  SELECT d AS date,
         CAST(user_id AS BIGINT) AS user_id,
         CAST(user_id AS VARCHAR) || '_' || d AS session_id,
         k % 10 AS page_id,
         printf('%s %d:%02d:%02d', d, sec // 3600, (sec % 3600) // 60, sec % 60) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) || ',' || CAST((k + 7) % 100 AS VARCHAR) END
           AS order_category_ids,
         CASE WHEN event_type = 'purchase'
              THEN CAST(event_id % 100 AS VARCHAR) || ',' || CAST((event_id + 7) % 100 AS VARCHAR) END
           AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         CAST(user_id % 10 AS BIGINT) AS city_id,
         event_id AS tie,
         CAST(d AS TIMESTAMP) + to_seconds(sec) AS action_ts
  FROM ev
)"""

USERS = """
users AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS username, c_name AS name,
         CAST((c_custkey * 37) % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
)"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name,
         printf('{"product_status": %d}', CAST(p_size % 2 AS INTEGER)) AS extend_info
  FROM part
)"""


def _range(p, col="date") -> str:
    return f"{col} BETWEEN {_lit(p.start_date)} AND {_lit(p.end_date)}"


def _rollup(p, distinct: bool = False) -> str:
    """Session roll-up over the date-ranged actions (A1); lists with repeats unless ``distinct``."""
    which = "rn = 1" if distinct else "TRUE"
    return f"""
ranged AS (SELECT * FROM actions WHERE {_range(p)}),
sess AS (
  SELECT session_id, min(user_id) AS user_id, min(action_ts) AS start_ts, max(action_ts) AS end_ts,
         count(*) AS step_length
  FROM ranged GROUP BY session_id
),
kw_first AS (
  SELECT session_id, search_keyword AS kw, action_ts, tie,
         row_number() OVER (PARTITION BY session_id, search_keyword ORDER BY action_ts, tie) AS rn
  FROM ranged WHERE search_keyword IS NOT NULL AND search_keyword <> ''
),
kws AS (
  SELECT session_id, string_agg(kw, ',' ORDER BY action_ts, tie) AS search_keywords,
         list(kw ORDER BY action_ts, tie) AS kw_list
  FROM kw_first WHERE {which} GROUP BY session_id
),
cat_first AS (
  SELECT session_id, click_category_id AS cat, action_ts, tie,
         row_number() OVER (PARTITION BY session_id, click_category_id ORDER BY action_ts, tie) AS rn
  FROM ranged WHERE click_category_id IS NOT NULL AND click_category_id <> -1
),
cats AS (
  SELECT session_id, string_agg(CAST(cat AS VARCHAR), ',' ORDER BY action_ts, tie) AS click_category_ids,
         list(cat ORDER BY action_ts, tie) AS cat_list
  FROM cat_first WHERE {which} GROUP BY session_id
),
rollup AS (
  SELECT s.session_id, s.user_id, s.start_ts, s.end_ts,
         strftime(s.start_ts, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(s.end_ts, '%Y-%m-%d %H:%M:%S') AS end_time,
         CAST((epoch_us(s.end_ts) - epoch_us(s.start_ts)) // 1000000 AS BIGINT) AS visit_length,
         s.step_length,
         coalesce(k.search_keywords, '') AS search_keywords,
         coalesce(c.click_category_ids, '') AS click_category_ids,
         coalesce(k.kw_list, []) AS kw_list,
         coalesce(c.cat_list, []) AS cat_list
  FROM sess s LEFT JOIN kws k USING (session_id) LEFT JOIN cats c USING (session_id)
)"""


def _filter(p) -> str:
    preds = ["TRUE"]
    if p.start_age is not None and p.end_age is not None:
        preds.append(f"coalesce(age BETWEEN {p.start_age} AND {p.end_age}, FALSE)")
    if p.professionals:
        preds.append(f"coalesce(professional IN {_in_list(p.professionals)}, FALSE)")
    if p.cities:
        preds.append(f"coalesce(city IN {_in_list(p.cities)}, FALSE)")
    if p.sex is not None:
        preds.append(f"coalesce(sex = {_lit(p.sex)}, FALSE)")
    if p.keywords:
        preds.append("list_has_any(kw_list, [" + ", ".join(_lit(k) for k in p.keywords) + "])")
    if p.category_ids:
        preds.append("list_has_any(cat_list, [" + ", ".join(f"CAST({c} AS BIGINT)" for c in p.category_ids) + "])")
    return f"""
profile AS (
  SELECT r.*, u.age, u.professional, u.city, u.sex
  FROM rollup r JOIN users u USING (user_id)
),
filtered AS (SELECT * FROM profile WHERE {' AND '.join(preds)})"""


def _with(*parts) -> str:
    return "WITH " + ",".join(parts)


def _session_base(p) -> str:
    return _with(ACTIONS, USERS, _rollup(p), _filter(p))


ROLLUP_COLS = (
    "session_id, user_id, start_time, end_time, visit_length, step_length, search_keywords, click_category_ids"
)

VISIT = [
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
]
STEP = [
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
]


def _aggr_stat(p) -> str:
    cols = []
    for name, lo, hi in [(n, lo, hi) for n, lo, hi in VISIT] + [(n, lo, hi) for n, lo, hi in STEP]:
        field = "visit_length" if name.startswith("visit") else "step_length"
        cond = f"{field} >= {lo}" if hi is None else f"{field} BETWEEN {lo} AND {hi}"
        cols.append(f"count(*) FILTER (WHERE {cond}) AS {name}")
    ratios = [
        f"CAST((200 * {n} + greatest(session_count, 1)) // (2 * greatest(session_count, 1)) AS DOUBLE) / 100.0"
        f" AS {n}_ratio"
        for n, _, _ in VISIT + STEP
    ]
    return (
        _session_base(p)
        + f", counts AS (SELECT count(*) AS session_count, {', '.join(cols)} FROM filtered)\n"
        + f"SELECT session_count, {', '.join(ratios)} FROM counts"
    )


DETAIL_COLS = (
    "user_id AS userid, session_id AS sessionid, page_id AS pageid, action_time AS actionTime, "
    "search_keyword AS searchKeyword, click_category_id AS clickCategoryId, click_product_id AS clickProductId, "
    "order_category_ids AS orderCategoryIds, order_product_ids AS orderProductIds, "
    "pay_category_ids AS payCategoryIds, pay_product_ids AS payProductIds"
)


def _sample(p) -> str:
    return f"""
sample_base AS (
  SELECT *, strftime(start_ts, '%Y-%m-%d') AS sdate, strftime(start_ts, '%H') AS shour FROM filtered
),
hours AS (SELECT sdate, shour, count(*) AS hour_count FROM sample_base GROUP BY sdate, shour),
days AS (SELECT sdate, CAST(sum(hour_count) AS BIGINT) AS day_count FROM hours GROUP BY sdate),
turns AS (SELECT sdate, day_count, unnest(range(1, least(day_count, {SAMPLE_TOTAL}) + 1)) AS turn FROM days),
placed AS (
  SELECT *, row_number() OVER (ORDER BY turn, md5(sdate || {_lit(SAMPLE_SEED)}), sdate) AS place FROM turns
),
day_quotas AS (
  SELECT sdate, day_count, count(*) AS day_quota FROM placed WHERE place <= {SAMPLE_TOTAL} GROUP BY ALL
),
shares AS (
  SELECT sdate, shour, day_quota, (day_quota * hour_count) // day_count AS base,
         (day_quota * hour_count) % day_count AS rest
  FROM hours JOIN day_quotas USING (sdate)
),
quota AS (
  SELECT sdate, shour,
         base + CASE WHEN row_number() OVER (PARTITION BY sdate
                                             ORDER BY rest DESC, md5(sdate || shour || {_lit(SAMPLE_SEED)}), shour)
                          <= day_quota - sum(base) OVER (PARTITION BY sdate) THEN 1 ELSE 0 END AS hour_quota
  FROM shares
),
ranked_s AS (
  SELECT b.*, row_number() OVER (PARTITION BY sdate, shour ORDER BY md5(session_id || {_lit(SAMPLE_SEED)}), session_id)
         AS rn
  FROM sample_base b
),
sampled AS (SELECT r.* FROM ranked_s r JOIN quota USING (sdate, shour) WHERE rn <= hour_quota)"""


def _categories() -> str:
    return """
fa AS (SELECT * FROM ranged WHERE session_id IN (SELECT session_id FROM filtered)),
items AS (
  SELECT click_category_id AS categoryid, 1 AS kind FROM fa
   WHERE click_category_id IS NOT NULL AND click_category_id <> -1
  UNION ALL
  SELECT TRY_CAST(trim(x) AS BIGINT), 2 FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM fa
   WHERE order_category_ids IS NOT NULL) WHERE trim(x) <> ''
  UNION ALL
  SELECT TRY_CAST(trim(x) AS BIGINT), 3 FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM fa
   WHERE pay_category_ids IS NOT NULL) WHERE trim(x) <> ''
),
ccounts AS (
  SELECT categoryid, count(*) FILTER (WHERE kind = 1) AS clickCount, count(*) FILTER (WHERE kind = 2) AS orderCount,
         count(*) FILTER (WHERE kind = 3) AS payCount
  FROM items WHERE categoryid IS NOT NULL GROUP BY categoryid
),
top10 AS (SELECT * FROM ccounts ORDER BY clickCount DESC, orderCount DESC, payCount DESC, categoryid LIMIT 10),
per_cs AS (
  SELECT click_category_id AS categoryid, session_id AS sessionid, count(*) AS clickCount FROM fa
  WHERE click_category_id IN (SELECT categoryid FROM top10) GROUP BY click_category_id, session_id
),
top10s AS (
  SELECT categoryid, sessionid, clickCount FROM (
    SELECT *, row_number() OVER (PARTITION BY categoryid ORDER BY clickCount DESC, sessionid) AS rn FROM per_cs
  ) WHERE rn <= 10
)"""


def _pairs(p) -> str:
    flow = p.page_pairs()
    values = ", ".join(f"({s}, CAST({a} AS BIGINT), CAST({b} AS BIGINT))" for s, a, b in flow)
    return f"""
pseq AS (
  SELECT page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_ts NULLS FIRST, tie) AS to_page
  FROM ranged
),
pc AS (SELECT from_page, to_page, count(*) AS pair_count FROM pseq WHERE to_page IS NOT NULL GROUP BY ALL),
flow(step, from_page, to_page) AS (VALUES {values}),
sv AS (SELECT count(*) FILTER (WHERE page_id = {p.target_page_flow[0]}) AS n FROM ranged),
st AS (
  SELECT f.step, f.from_page, f.to_page, coalesce(pc.pair_count, 0) AS pair_count
  FROM flow f LEFT JOIN pc USING (from_page, to_page)
  UNION ALL SELECT 0, {p.target_page_flow[0]}, NULL, n FROM sv
),
rates AS (SELECT *, lag(pair_count) OVER (ORDER BY step) AS prev_count FROM st)"""


LINEITEM_CLICKS = """
buyer AS (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey),
li_clicks AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, CAST(c_nationkey AS BIGINT) AS city_id,
         CAST(l_partkey AS BIGINT) AS product_id
  FROM lineitem JOIN buyer ON l_orderkey = o_orderkey
),
nat_cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

INLINE_CITIES = """
inline_cities(city_id, city_name, area) AS (VALUES
  (CAST(0 AS BIGINT), '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
  (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'), (8, '成都', '西南'),
  (9, '哈尔滨', '东北'))"""


def _area(clicks: str, cities: str, levels: dict) -> str:
    cases = " ".join(
        f"WHEN area IN {_in_list(names)} THEN {_lit(level)}" for level, names in levels.items()
    )
    return f"""
apc AS (
  SELECT area, product_id, count(*) AS click_count,
         array_to_string(list_sort(list_distinct(list(CAST(c.city_id AS VARCHAR) || '=' || city_name))), ',')
           AS city_infos
  FROM {clicks} k JOIN {cities} c USING (city_id) GROUP BY area, product_id
),
pinfo AS (
  SELECT product_id, product_name,
         CASE WHEN trim(json_extract_string(extend_info, '$.product_status')) = '0' THEN 'SELF'
              ELSE 'Third Party' END AS product_status
  FROM products
),
atop AS (
  SELECT area, CASE {cases} ELSE 'D' END AS areaLevel, product_id AS productid, city_infos AS cityInfos,
         click_count AS clickCount, product_name AS productName, product_status AS productStatus
  FROM (
    SELECT a.*, i.product_name, i.product_status,
           row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn
    FROM apc a JOIN pinfo i USING (product_id)
  ) WHERE rn <= 3
)"""


AD_CLICKS = """
ad_lines AS (
  SELECT CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp_ms, CAST(user_id % 10 AS VARCHAR) AS province,
         CAST(user_id % 10 AS VARCHAR) AS city, CAST(user_id AS BIGINT) AS userid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS adid
  FROM events WHERE event_type = 'click'
),
clicks AS (
  SELECT *, epoch_ms(timestamp_ms) AS ts, strftime(epoch_ms(timestamp_ms), '%Y-%m-%d') AS date FROM ad_lines
),
ucount AS (SELECT date, userid, adid, count(*) AS clickCount FROM clicks GROUP BY date, userid, adid),
blacklist AS (SELECT DISTINCT userid FROM ucount WHERE clickCount > {th}),
fclicks AS (SELECT * FROM clicks WHERE userid NOT IN (SELECT userid FROM blacklist)),
astat AS (SELECT date, province, city, adid, count(*) AS clickCount FROM fclicks GROUP BY ALL),
ptop AS (
  SELECT date, province, adid, clickCount FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY clickCount DESC, adid) AS rn
    FROM (SELECT date, province, adid, CAST(sum(clickCount) AS BIGINT) AS clickCount FROM astat GROUP BY ALL)
  ) WHERE rn <= 3
),
pminute AS (SELECT date_trunc('minute', ts) AS minute_ts, adid, count(*) AS clickCount FROM clicks GROUP BY ALL)"""


def oracle_queries() -> dict[str, str]:
    d, f = DEFAULT_PARAMS, FILTER_PARAMS
    q: dict[str, str] = {}
    q["session_rollup"] = _with(ACTIONS, _rollup(d)) + f"\nSELECT {ROLLUP_COLS} FROM rollup"
    q["session_rollup_distinct"] = _with(ACTIONS, _rollup(d, distinct=True)) + f"\nSELECT {ROLLUP_COLS} FROM rollup"
    q["session_user_profile"] = (
        _with(ACTIONS, USERS, _rollup(d), _filter(d.__class__(start_date=d.start_date, end_date=d.end_date)))
        + f"\nSELECT {ROLLUP_COLS}, age, professional, city, sex FROM profile"
    )
    q["session_task_filter"] = _session_base(f) + f"\nSELECT {ROLLUP_COLS}, age, professional, city, sex FROM filtered"
    q["session_aggr_stat"] = _aggr_stat(d)
    q["session_aggr_stat_filtered"] = _aggr_stat(f)
    q["session_random_extract"] = (
        _with(ACTIONS, USERS, _rollup(d), _filter(d), _sample(d))
        + "\nSELECT session_id AS sessionid, start_time AS startTime, search_keywords AS searchKeywords, "
        "click_category_ids AS clickCategoryIds FROM sampled"
    )
    q["session_sample_detail"] = (
        _with(ACTIONS, USERS, _rollup(d), _filter(d), _sample(d))
        + f"\nSELECT {DETAIL_COLS} FROM ranged WHERE session_id IN (SELECT session_id FROM sampled)"
    )
    # sessions at their own time of day
    day = _with(ACTIONS.replace("/ 40)", "/ 1)"), USERS, _rollup(d), _filter(d), _sample(d))
    q["session_random_extract_day"] = day + (
        "\nSELECT session_id AS sessionid, start_time AS startTime, search_keywords AS searchKeywords, "
        "click_category_ids AS clickCategoryIds FROM sampled"
    )
    q["session_sample_detail_day"] = (
        day + f"\nSELECT {DETAIL_COLS} FROM ranged WHERE session_id IN (SELECT session_id FROM sampled)"
    )
    q["session_detail_semi"] = (
        _session_base(d) + f"\nSELECT {DETAIL_COLS} FROM ranged WHERE session_id IN (SELECT session_id FROM filtered)"
    )
    cat_base = _with(ACTIONS, USERS, _rollup(d), _filter(d), _categories())
    q["category_counts"] = cat_base + "\nSELECT * FROM ccounts"
    q["category_counts_strict"] = cat_base + """,
gated AS (SELECT * FROM fa WHERE click_category_id > 0),
members AS (
  SELECT click_category_id AS c FROM gated
  UNION SELECT TRY_CAST(x AS BIGINT) FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM gated)
  UNION SELECT TRY_CAST(x AS BIGINT) FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM gated)
)
SELECT * FROM ccounts WHERE categoryid IN (SELECT c FROM members WHERE c IS NOT NULL)"""
    q["top10_category"] = cat_base + "\nSELECT * FROM top10"
    q["top10_session"] = cat_base + "\nSELECT * FROM top10s"
    q["top10_session_detail"] = cat_base + (
        f"\nSELECT {DETAIL_COLS.replace('user_id AS', 'fa.user_id AS')} FROM fa JOIN top10s ON fa.session_id = top10s.sessionid"
    )
    q["top10_session_detail_dedupe"] = cat_base + (
        f"\nSELECT {DETAIL_COLS} FROM fa WHERE session_id IN (SELECT sessionid FROM top10s)"
    )
    q["action_keys"] = _with(ACTIONS, f"\nranged AS (SELECT * FROM actions WHERE {_range(d)})") + """
SELECT tie, strftime(action_ts, '%Y-%m-%d_%H') AS date_hour, strftime(action_ts, '%Y%m%d') AS day_key, date AS day,
       strftime(action_ts, '%Y%m%d%H%M') AS minute_key,
       action_ts < CAST(date AS TIMESTAMP) + INTERVAL 18 MINUTE AS is_before,
       action_ts > CAST(date AS TIMESTAMP) + INTERVAL 18 MINUTE AS is_after,
       coalesce(search_keyword, '') = '' AS no_keyword, order_category_ids AS ordered,
       lpad(CAST(page_id AS VARCHAR), 2, '0') AS page2,
       CASE WHEN page_id BETWEEN 0 AND 3 THEN 'low' WHEN page_id BETWEEN 4 AND 6 THEN 'mid' WHEN page_id >= 7 THEN 'high' END
         AS page_band,
       CAST(city_id AS VARCHAR) AS city,
       'page=' || CAST(page_id + 1 AS VARCHAR) || '|session=' || session_id || '|city=' || CAST(city_id AS VARCHAR)
         AS next_page
FROM ranged"""
    page_base = _with(ACTIONS, f"\nranged AS (SELECT * FROM actions WHERE {_range(d)})", _pairs(d))
    q["page_pairs"] = page_base + "\nSELECT from_page, to_page, pair_count FROM pc"
    q["page_convert_rate"] = page_base + (
        "\nSELECT step, CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) AS page_split, pair_count, "
        "prev_count, CASE WHEN prev_count = 0 THEN NULL ELSE pair_count / prev_count END AS convert_rate "
        "FROM rates WHERE step > 0"
    )
    # Spark and DuckDB print doubles alike here except 0 and 1, which both write with ".0"
    q["page_convert_rate_packed"] = page_base + (
        "\nSELECT string_agg(CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) || '=' || "
        "coalesce(CAST(CASE WHEN prev_count = 0 THEN NULL ELSE pair_count / prev_count END AS VARCHAR), 'null'), '|' "
        "ORDER BY step) AS convertRate FROM rates WHERE step > 0"
    )
    area_li = _with(
        PRODUCTS, LINEITEM_CLICKS,
        f"\nranged_li AS (SELECT * FROM li_clicks WHERE {_range(d)})",
        _area("ranged_li", "nat_cities", LEVEL_OF_AREA),
    )
    q["area_product_count"] = area_li + "\nSELECT * FROM apc"
    q["area_top3_product"] = area_li + "\nSELECT * FROM atop"
    q["area_top3_product_inline_cities"] = _with(
        ACTIONS, PRODUCTS, INLINE_CITIES,
        f"\nev_clicks AS (SELECT city_id, click_product_id AS product_id FROM actions WHERE {_range(d)} "
        "AND click_product_id IS NOT NULL AND click_product_id <> -1)",
        _area("ev_clicks", "inline_cities", {"A": ["华北", "华东"], "B": ["华南", "华中"], "C": ["西北", "西南"]}),
    ) + "\nSELECT * FROM atop"
    # the Spark SQL form of the same job must give the same rows
    q["area_top3_product_sql"] = q["area_top3_product_inline_cities"]
    ads = "WITH " + AD_CLICKS.format(th=AD_THRESHOLD)
    q["ad_user_click_count"] = ads + "\nSELECT date, userid, adid, clickCount FROM ucount"
    q["ad_blacklist"] = ads + "\nSELECT userid FROM blacklist"
    q["ad_blacklist_filtered"] = ads + "\nSELECT timestamp_ms, province, city, userid, adid, date FROM fclicks"
    q["ad_stat"] = ads + "\nSELECT * FROM astat"
    q["ad_province_top3"] = ads + "\nSELECT * FROM ptop"
    q["ad_click_trend"] = ads + (
        "\nSELECT strftime(minute_ts, '%Y-%m-%d') AS date, strftime(minute_ts, '%H') AS hour, "
        "strftime(minute_ts, '%M') AS minute, adid, clickCount FROM pminute"
    )
    q["ad_trailing_hour"] = ads + (
        "\nSELECT strftime(minute_ts, '%Y-%m-%d %H:%M') AS minute, adid, CAST(sum(clickCount) OVER (PARTITION BY adid "
        "ORDER BY CAST(epoch(minute_ts) AS BIGINT) RANGE BETWEEN 3540 PRECEDING AND CURRENT ROW) AS BIGINT) "
        "AS windowCount FROM pminute"
    )
    # merges of a stored part and a new part equal the whole-log results
    q["upsert_merge"] = ads + "\nSELECT date, province, city, adid, count(*) AS clickCount FROM clicks GROUP BY ALL"
    q["upsert_overwrite"] = ads + (
        "\nSELECT date, province, city, adid, count(*) AS clickCount FROM clicks WHERE day(ts) > 10 OR hour(ts) < 12 GROUP BY ALL"
    )
    q["replace_groups"] = ads + """
, allstat AS (SELECT date, province, adid, count(*) AS clickCount FROM clicks GROUP BY ALL)
SELECT date, province, adid, clickCount FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY clickCount DESC, adid) AS rn FROM allstat
) WHERE rn <= 3"""
    q["append_new"] = q["ad_blacklist"]
    # the streaming twins must equal the batch results
    q["stream_ad_stat"] = q["ad_stat"]
    q["stream_province_top3"] = q["ad_province_top3"]
    q["stream_user_click_count"] = q["ad_user_click_count"]
    q["stream_ad_trend"] = q["ad_click_trend"]
    q["stream_blacklist"] = q["ad_blacklist"]
    q["stream_ad_trailing_hour"] = q["ad_trailing_hour"]
    q["stream_ad_trend_filtered"] = ads + (
        "\nSELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid, "
        "count(*) AS clickCount FROM fclicks GROUP BY ALL"
    )
    # the list as of each round: users over the threshold in the rounds before
    q["stream_ad_stat_refreshed"] = ads + f"""
, rounds AS (
  SELECT *, CASE WHEN userid % 10 = {STREAM_LATE_DIGIT} THEN {STREAM_ROUNDS - 1} ELSE greatest(0, least({STREAM_ROUNDS - 1},
         CAST(floor((timestamp_ms - {STREAM_START_MS}) / {STREAM_SLICE_MS}) AS BIGINT))) END AS round
  FROM clicks
),
listed AS (
  SELECT DISTINCT r.range AS round, c.userid FROM range({STREAM_ROUNDS}) r JOIN rounds c ON c.round < r.range
  GROUP BY r.range, c.date, c.userid, c.adid HAVING count(*) > {AD_THRESHOLD}
)
SELECT date, province, city, adid, count(*) AS clickCount FROM rounds
WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.round = rounds.round AND l.userid = rounds.userid) GROUP BY ALL"""
    q["replace_groups_written"] = q["replace_groups"]
    q["stored_count_lookup"] = ads + """
, halves AS (SELECT date, userid, adid, count(*) FILTER (WHERE hour(ts) >= 12) AS newCount,
                    count(*) FILTER (WHERE hour(ts) < 12) AS storedCount, count(*) AS clickCount FROM clicks GROUP BY ALL)
SELECT * FROM halves WHERE newCount > 0"""
    q["table_round_trip"] = _with(ACTIONS) + f"""
SELECT {_lit(TABLE_TASK)} AS taskid, tie, date, user_id, session_id, page_id, action_time, click_category_id
FROM actions WHERE {_range(TABLE_PARAMS)}"""
    return q
