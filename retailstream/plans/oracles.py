"""DuckDB SQL twins of the registered queries (the correctness oracle).

They re-state each rule directly in SQL over the supplied tables (plain window
functions instead of the bucketed Spark forms), so they are an independent
check of the Spark plans.  Column names equal the Spark outputs.
"""

from __future__ import annotations

# -- the click-log adapter, in SQL ------------------------------------------------
PAGE_LOG = """
page_log AS (
  SELECT event_id AS seq,
         epoch_us(ts) // 1000 AS ts,
         CAST(user_id AS VARCHAR) AS mid,
         CAST(user_id % 3 AS VARCHAR) AS vc,
         CAST(user_id % 4 AS VARCHAR) AS ch,
         CAST(user_id % 7 AS VARCHAR) AS ar,
         CASE WHEN event_type IN ('signup','view') THEN '1' ELSE '0' END AS is_new,
         CASE WHEN event_type = 'click' THEN 'good_detail' ELSE event_type END AS page_id,
         CASE WHEN event_type IN ('signup','view','error') THEN NULL ELSE 'home' END AS last_page_id,
         CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS item,
         CASE WHEN event_type = 'click' THEN 'sku_id' END AS item_type,
         CAST(round(value * 1000) AS BIGINT) AS during_time,
         json_extract_string(props, '$.k') AS k,
         event_type
  FROM events
)"""

VISITS = PAGE_LOG + """,
entries AS (
  SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt,
         lag(strftime(make_timestamp(ts * 1000), '%Y-%m-%d')) OVER (PARTITION BY mid ORDER BY seq) AS prev_dt
  FROM page_log WHERE last_page_id IS NULL
),
uv AS (SELECT * FROM entries WHERE prev_dt IS NULL OR prev_dt <> dt),
nxt AS (
  SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, seq) AS next_ts,
            lead(last_page_id) OVER (PARTITION BY mid ORDER BY ts, seq) AS next_lp
  FROM page_log
),
uj AS (
  SELECT * FROM nxt
  WHERE last_page_id IS NULL
    AND NOT (next_ts IS NOT NULL AND next_lp IS NOT NULL AND next_ts - ts < {within})
)"""

BOUNCE_WITHIN_MS = 6 * 3_600_000


def _visits(body: str) -> str:
    return "WITH " + VISITS.format(within=BOUNCE_WITHIN_MS) + body


VISITOR_STATS = """,
rows_ AS (
  SELECT vc, ch, ar, is_new, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum, ts FROM uv
  UNION ALL
  SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM uj
  UNION ALL
  SELECT vc, ch, ar, is_new, 0, 1, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END,
         0, coalesce(during_time, 0), ts FROM page_log
),
vstats AS (
  SELECT strftime(time_bucket(INTERVAL 1 HOUR, make_timestamp(ts * 1000)), '%Y-%m-%d %H:%M:%S') AS stt,
         strftime(time_bucket(INTERVAL 1 HOUR, make_timestamp(ts * 1000)) + INTERVAL 1 HOUR,
                  '%Y-%m-%d %H:%M:%S') AS edt,
         vc, ch, ar, is_new,
         CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
         CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
         CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
  FROM rows_ GROUP BY ALL
)"""

# exact half-up ratio in hundredths / tenths, turned into DECIMAL(38,2)
_DEC = "CAST(({u}) AS DECIMAL(38,2)) / {f}"


def _ratio(n: str, d: str, scale: int) -> str:
    f = 10 ** scale
    return (f"CASE WHEN uv_ct = 0 OR {d} = 0 THEN CAST(0 AS DECIMAL(38,2)) ELSE "
            f"CAST(CAST((({n}) * {2 * f} + {d}) // (2 * {d}) AS DECIMAL(38,2)) / {f} AS DECIMAL(38,2)) END")


ORACLES: dict[str, str] = {}

ORACLES["new_visitor_repair"] = "WITH " + PAGE_LOG + """
SELECT seq, mid, is_new AS is_new_raw,
       CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY seq) > 1
            THEN '0' ELSE is_new END AS is_new
FROM page_log"""

ORACLES["daily_unique_visit"] = _visits("\nSELECT seq, mid, ts FROM uv")

ORACLES["bounce_detect"] = _visits("\nSELECT seq, mid, ts FROM uj")

ORACLES["visitor_stats"] = _visits(VISITOR_STATS + "\nSELECT * FROM vstats")

ORACLES["visitor_by_hour"] = _visits(VISITOR_STATS + """,
days AS (SELECT DISTINCT substr(stt, 1, 10) AS dt FROM vstats),
hours AS (SELECT dt, h AS hour FROM days, range(24) t(h)),
agg AS (
  SELECT substr(stt, 1, 10) AS dt, CAST(substr(stt, 12, 2) AS INTEGER) AS hour,
         CAST(sum(CASE WHEN is_new = '1' THEN uv_ct ELSE 0 END) AS BIGINT) AS new_uv,
         CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
         CAST(sum(uj_ct) AS BIGINT) AS uj_ct
  FROM vstats GROUP BY ALL
)
SELECT h.dt, lpad(CAST(h.hour AS VARCHAR), 2, '0') AS hr,
       coalesce(new_uv, 0) AS new_uv, coalesce(uv_ct, 0) AS uv_ct,
       coalesce(pv_ct, 0) AS pv_ct, coalesce(uj_ct, 0) AS uj_ct
FROM hours h LEFT JOIN agg a ON a.dt = h.dt AND a.hour = h.hour""")

ORACLES["visitor_by_flag"] = _visits(VISITOR_STATS + """
SELECT substr(stt, 1, 10) AS dt, is_new,
       CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
       CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
       CAST(sum(dur_sum) AS BIGINT) AS dur_sum
FROM vstats GROUP BY ALL""")

ORACLES["visitor_flag_table"] = _visits(VISITOR_STATS + f""",
flags AS (
  SELECT substr(stt, 1, 10) AS dt, CASE WHEN is_new = '1' THEN 'new' ELSE 'old' END AS flag,
         sum(uv_ct) AS uv_ct, sum(pv_ct) AS pv_ct, sum(sv_ct) AS sv_ct,
         sum(uj_ct) AS uj_ct, sum(dur_sum) AS dur_sum
  FROM vstats GROUP BY ALL
),
m AS (
  SELECT dt, flag,
         CAST(uv_ct AS DECIMAL(38,2)) AS uv_ct, CAST(pv_ct AS DECIMAL(38,2)) AS pv_ct,
         {_ratio('uj_ct * 100', 'sv_ct', 2)} AS uj_rate,
         CASE WHEN uv_ct = 0 OR sv_ct = 0 THEN CAST(0 AS DECIMAL(38,2)) ELSE
           CAST(CAST(((((dur_sum * 2 + sv_ct) // (2 * sv_ct)) * 20 + 1000) // 2000) AS DECIMAL(38,2)) / 10
                AS DECIMAL(38,2)) END AS dur_per_sv,
         {_ratio('pv_ct', 'sv_ct', 2)} AS pv_per_sv
  FROM flags
),
long AS (UNPIVOT m ON uv_ct, pv_ct, uj_rate, dur_per_sv, pv_per_sv INTO NAME metric VALUE value)
SELECT dt, metric,
       coalesce(max(CASE WHEN flag = 'new' THEN value END), CAST(0 AS DECIMAL(38,2))) AS new,
       coalesce(max(CASE WHEN flag = 'old' THEN value END), CAST(0 AS DECIMAL(38,2))) AS old
FROM long GROUP BY dt, metric""")

# -- raw click-log lines, in SQL (same template as the Spark adapter) ------------
RAW_LOG = PAGE_LOG + """,
lines AS (
  SELECT seq, event_type, mid, is_new, page_id, last_page_id, ts, k,
         '{"common":{"mid":"' || mid || '","is_new":"' || is_new || '","vc":"' || vc || '","ch":"' || ch
           || '","ar":"' || ar || '"}' AS common_txt,
         during_time, item, item_type
  FROM page_log
),
raw AS (
  SELECT seq, event_type, mid, is_new, page_id, last_page_id, ts, k,
    CASE WHEN event_type = 'signup' THEN
           common_txt || ',"start":{"entry":"icon","loading_time":' || CAST(during_time AS VARCHAR)
           || ',"open_ad_id":"' || k || '"},"ts":' || CAST(ts AS VARCHAR) || '}'
         ELSE
           common_txt || ',"page":{"page_id":"' || page_id || '","last_page_id":'
           || coalesce('"' || last_page_id || '"', 'null') || ',"item":' || coalesce('"' || item || '"', 'null')
           || ',"item_type":' || coalesce('"' || item_type || '"', 'null')
           || ',"during_time":' || CASE WHEN event_type = 'purchase' THEN '"' || CAST(during_time AS VARCHAR) || '"'
                                        ELSE CAST(during_time AS VARCHAR) END || '},"displays":'
           || CASE WHEN event_type = 'view' THEN '[{"item":"' || k || '","item_type":"sku_id"},{"item":"'
                                                || mid || '","item_type":"activity"}]'
                   WHEN event_type = 'click' THEN '[]' ELSE 'null' END
           || ',"ts":' || CAST(ts AS VARCHAR)
           || CASE WHEN event_type = 'purchase' THEN '.0}' WHEN event_type <> 'error' THEN '}'
                   WHEN seq % 2 = 0 THEN '} garbage' ELSE '' END
    END AS value
  FROM lines
),
clean AS (
  SELECT *, CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY seq) > 1
                 THEN '0' ELSE is_new END AS is_new_fixed
  FROM raw WHERE json_valid(value)
)"""

ORACLES["dirty_split"] = "WITH " + RAW_LOG + "\nSELECT seq, value FROM raw WHERE NOT json_valid(value)"

ORACLES["start_page_split"] = "WITH " + RAW_LOG + """
SELECT seq, CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS route, mid,
       is_new_fixed AS is_new,
       CASE WHEN event_type = 'signup' THEN NULL ELSE page_id END AS page_id,
       CASE WHEN event_type = 'signup' THEN NULL ELSE last_page_id END AS last_page_id,
       CASE WHEN event_type = 'signup' THEN 'icon' END AS start_entry, ts
FROM clean"""

ORACLES["display_explode"] = "WITH " + RAW_LOG + """
SELECT seq, mid, page_id, k AS item, 'sku_id' AS item_type, ts FROM clean WHERE event_type = 'view'
UNION ALL
SELECT seq, mid, page_id, mid AS item, 'activity' AS item_type, ts FROM clean WHERE event_type = 'view'"""

# -- orders, payments, dimensions ------------------------------------------------
DAY = 86_400_000
AS_OF_SQL = "TIMESTAMP '2024-06-01 00:00:00'"
AS_OF_S = 1_717_200_000

SHOP = """
oi AS (
  SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id, o.o_custkey AS user_id,
         o.o_orderstatus AS order_status, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2))
           AS activity_reduce_amount,
         CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS coupon_reduce_amount,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS original_total_amount, CAST(0 AS DECIMAL(18,2)) AS feight_fee,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o.o_orderdate, '%Y-%m-%d') AS create_date, strftime(o.o_orderdate, '%H') AS create_hour,
         epoch_us(o.o_orderdate) // 1000 AS create_ts
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
od AS (
  SELECT CAST(l_linenumber AS BIGINT) AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(l_quantity AS BIGINT) AS sku_num, CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))
           AS split_total_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))
           AS split_activity_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))
           AS split_coupon_amount,
         epoch_us(l_shipdate) // 1000 AS d_ts
  FROM lineitem
),
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST((epoch_us(""" + AS_OF_SQL + """) // 1000
               - epoch_us(CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS TIMESTAMP)) // 1000)
              // 31536000000 AS INTEGER) AS age
  FROM customer
),
prov AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, r_name AS area_code,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_code,
         substr(r_name, 1, 2) || '-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_3166_2
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
sku AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
         p_name AS spu_id, p_brand AS tm_id, p_type AS category3_id
  FROM part
),
spu AS (SELECT DISTINCT p_name AS id, p_name AS spu_name FROM part),
tm AS (SELECT DISTINCT p_brand AS id, p_brand AS tm_name FROM part),
cat3 AS (SELECT DISTINCT p_type AS id, p_type AS name FROM part),
ow AS (
  SELECT d.id AS detail_id, o.id AS order_id, o.province_id, o.order_status, o.user_id, o.total_amount,
         o.activity_reduce_amount, o.coupon_reduce_amount, o.original_total_amount, o.feight_fee, o.create_time, o.create_date, o.create_hour, o.create_ts,
         d.sku_id, s.sku_name, d.order_price, d.sku_num, d.split_total_amount,
         d.split_activity_amount, d.split_coupon_amount,
         u.gender AS user_gender, u.age AS user_age,
         p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
         p.iso_3166_2 AS province_3166_2_code,
         s.category3_id, s.spu_id, s.tm_id, sp.spu_name, c3.name AS category3_name, t.tm_name
  FROM oi o JOIN od d ON o.id = d.order_id
       AND d.d_ts BETWEEN o.create_ts - """ + str(5 * DAY) + """ AND o.create_ts + """ + str(5 * DAY) + """
  LEFT JOIN users u ON CAST(o.user_id AS VARCHAR) = u.id
  LEFT JOIN prov p ON CAST(o.province_id AS VARCHAR) = p.id
  LEFT JOIN sku s ON CAST(d.sku_id AS VARCHAR) = s.id
  LEFT JOIN spu sp ON s.spu_id = sp.id
  LEFT JOIN cat3 c3 ON s.category3_id = c3.id
  LEFT JOIN tm t ON s.tm_id = t.id
),
pi AS (
  SELECT CAST(l.l_linenumber AS BIGINT) AS id, l.l_orderkey AS order_id, o.o_custkey AS user_id,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_amount,
         'line ' || CAST(l.l_linenumber AS VARCHAR) AS subject,
         '11' || lpad(CAST(l.l_suppkey % 3 + 1 AS VARCHAR), 2, '0') AS payment_type,
         strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(l.l_shipdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS callback_time,
         epoch_us(l.l_shipdate) // 1000 AS payment_ts
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_linestatus = 'F'
),
pw AS (
  SELECT p.id AS payment_id, p.order_id, p.user_id, p.total_amount, p.payment_type, p.subject, p.callback_time,
         p.create_time AS payment_create_time, p.payment_ts, w.create_time AS order_create_time,
         w.* EXCLUDE (order_id, user_id, total_amount, create_time)
  FROM pi p JOIN ow w ON p.order_id = w.order_id
       AND w.create_ts BETWEEN p.payment_ts - """ + str(15 * DAY) + """ AND p.payment_ts + """ + str(2 * DAY) + """
)"""

ORACLES["order_wide"] = "WITH " + SHOP + "\nSELECT * FROM ow"
ORACLES["payment_wide"] = "WITH " + SHOP + "\nSELECT * FROM pw"
ORACLES["dim_user_age"] = "WITH " + SHOP + """
SELECT o_orderkey AS order_id, o_custkey AS user_id, u.gender AS user_gender, u.age AS user_age
FROM orders LEFT JOIN users u ON CAST(o_custkey AS VARCHAR) = u.id"""


def _bucket(ts: str, interval: str) -> str:
    return f"time_bucket(INTERVAL {interval}, make_timestamp(({ts}) * 1000))"


def _stt_edt(ts: str, interval: str) -> str:
    b = _bucket(ts, interval)
    return (f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime({b} + INTERVAL {interval}, '%Y-%m-%d %H:%M:%S') AS edt")


PRODUCT = "WITH " + PAGE_LOG + "," + SHOP + """,
prow AS (
  SELECT CAST(item AS BIGINT) AS sku_id, 1 AS click_ct, ts FROM page_log
  WHERE page_id = 'good_detail' AND item_type = 'sku_id'
  UNION ALL BY NAME
  SELECT CAST(k AS BIGINT) AS sku_id, 1 AS display_ct, ts FROM page_log WHERE event_type = 'view'
  UNION ALL BY NAME
  SELECT CAST(k AS BIGINT) AS sku_id, 1 AS favor_ct, ts FROM page_log WHERE event_type = 'view'
  UNION ALL BY NAME
  SELECT CAST(k AS BIGINT) AS sku_id, 1 AS cart_ct, ts FROM page_log WHERE event_type = 'purchase'
  UNION ALL BY NAME
  SELECT sku_id, sku_num AS order_sku_num, CAST(total_amount AS DECIMAL(38,2)) AS order_amount,
         order_id AS order_oid, create_ts AS ts FROM ow
  UNION ALL BY NAME
  SELECT sku_id, CAST(total_amount AS DECIMAL(38,2)) AS payment_amount, order_id AS paid_oid,
         payment_ts AS ts FROM pw
  UNION ALL BY NAME
  SELECT l_partkey AS sku_id, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS refund_amount,
         l_orderkey AS refund_oid, epoch_us(l_shipdate) // 1000 AS ts FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL BY NAME
  SELECT l_partkey AS sku_id, 1 AS comment_ct, CASE WHEN l_discount < 0.05 THEN 1 ELSE 0 END AS good_comment_ct,
         epoch_us(l_shipdate) // 1000 AS ts FROM lineitem WHERE l_linestatus = 'F'
),
pagg AS (
  SELECT """ + _stt_edt("ts", "1 DAY") + """, sku_id,
         CAST(coalesce(sum(display_ct), 0) AS BIGINT) AS display_ct,
         CAST(coalesce(sum(click_ct), 0) AS BIGINT) AS click_ct,
         CAST(coalesce(sum(favor_ct), 0) AS BIGINT) AS favor_ct,
         CAST(coalesce(sum(cart_ct), 0) AS BIGINT) AS cart_ct,
         CAST(coalesce(sum(order_sku_num), 0) AS BIGINT) AS order_sku_num,
         CAST(coalesce(sum(comment_ct), 0) AS BIGINT) AS comment_ct,
         CAST(coalesce(sum(good_comment_ct), 0) AS BIGINT) AS good_comment_ct,
         CAST(coalesce(sum(order_amount), 0) AS DECIMAL(38,2)) AS order_amount,
         CAST(coalesce(sum(payment_amount), 0) AS DECIMAL(38,2)) AS payment_amount,
         CAST(coalesce(sum(refund_amount), 0) AS DECIMAL(38,2)) AS refund_amount,
         count(DISTINCT order_oid) AS order_ct, count(DISTINCT paid_oid) AS paid_order_ct,
         count(DISTINCT refund_oid) AS refund_order_ct, min(ts) AS ts
  FROM prow GROUP BY ALL
),
ps AS (
  SELECT a.*, s.sku_name, CAST(s.price AS DECIMAL(18,2)) AS sku_price, s.spu_id, s.tm_id, s.category3_id,
         sp.spu_name, c3.name AS category3_name, t.tm_name
  FROM pagg a LEFT JOIN sku s ON CAST(a.sku_id AS VARCHAR) = s.id
  LEFT JOIN spu sp ON s.spu_id = sp.id
  LEFT JOIN cat3 c3 ON s.category3_id = c3.id
  LEFT JOIN tm t ON s.tm_id = t.id
)"""

ORACLES["product_stats"] = PRODUCT + "\nSELECT * FROM ps"
ORACLES["gmv"] = PRODUCT + """
SELECT substr(stt, 1, 10) AS dt, CAST(sum(order_amount) AS DECIMAL(38,2)) AS gmv FROM ps GROUP BY 1"""


def _topn(keys: list[str], extra: str = "") -> str:
    k = ", ".join(keys)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in keys)
    return PRODUCT + f"""
SELECT * FROM (
  SELECT substr(stt, 1, 10) AS dt, {k}, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount{extra}
  FROM ps GROUP BY ALL HAVING sum(order_amount) > 0
) QUALIFY row_number() OVER (PARTITION BY dt ORDER BY order_amount DESC, {order}) <= 10"""


ORACLES["brand_topn"] = _topn(["tm_id", "tm_name"])
ORACLES["category_topn"] = _topn(["category3_id", "category3_name"])
ORACLES["spu_topn"] = _topn(["spu_id", "spu_name"], ", CAST(sum(order_ct) AS BIGINT) AS order_ct")

PROVINCE = "WITH " + SHOP + """,
pstat AS (
  SELECT """ + _stt_edt("create_ts", "1 DAY") + """, province_id, province_name, province_area_code,
         province_iso_code, province_3166_2_code,
         CAST(sum(total_amount) AS DECIMAL(38,2)) AS order_amount, count(DISTINCT order_id) AS order_count,
         CAST(""" + str(AS_OF_S) + """ AS BIGINT) AS ts
  FROM ow GROUP BY ALL
)"""
ORACLES["province_stats"] = PROVINCE + "\nSELECT * FROM pstat"
ORACLES["province_totals"] = PROVINCE + """
SELECT substr(stt, 1, 10) AS dt, province_id, province_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount
FROM pstat GROUP BY ALL"""

# RE2 twin of the tokenizer: a Han run, or a run of (non-Han letter | digit)
TOKEN_RE2 = r"\p{Han}+|(?:[^\P{L}\p{Han}]|\p{N})+"


def _kw(rows: str, text: str, source: str) -> str:
    return f"""
  SELECT keyword, CAST(count(*) AS BIGINT) AS ct, '{source}' AS source, {_stt_edt("ts", "1 HOUR")},
         CAST({AS_OF_S} AS BIGINT) AS ts
  FROM (SELECT unnest(regexp_extract_all(lower({text}), '{TOKEN_RE2}')) AS keyword, ts FROM {rows})
  GROUP BY ALL"""


KEYWORD = """
search AS (
  SELECT text, 1704067200000 + conv_id * 60000 + turn * 1000 AS ts FROM conversations WHERE role = 'user'
),
kstat AS (""" + _kw("search", "text", "SEARCH") + """
)"""
ORACLES["keyword_stats"] = "WITH " + KEYWORD + "\nSELECT * FROM kstat"
ORACLES["keyword_score"] = "WITH " + PAGE_LOG + "," + SHOP + "," + KEYWORD + """,
ord_words AS (SELECT sku_name, create_ts AS ts FROM ow),
cart_words AS (SELECT s.sku_name, p.ts FROM page_log p LEFT JOIN sku s ON p.k = s.id
               WHERE p.event_type = 'purchase'),
click_words AS (SELECT s.sku_name, p.ts FROM page_log p LEFT JOIN sku s ON p.item = s.id
                WHERE p.page_id = 'good_detail' AND p.item_type = 'sku_id'),
allk AS (
  SELECT * FROM kstat
  UNION ALL""" + _kw("ord_words", "sku_name", "ORDER") + """
  UNION ALL""" + _kw("cart_words", "sku_name", "CART") + """
  UNION ALL""" + _kw("click_words", "sku_name", "CLICK") + """
)
SELECT dt, keyword, ct FROM (
  SELECT substr(stt, 1, 10) AS dt, keyword,
         CAST(sum(ct * CASE source WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 3 WHEN 'CART' THEN 2
                                   WHEN 'CLICK' THEN 1 ELSE 0 END) AS BIGINT) AS ct,
         sum(ct) AS raw_ct
  FROM allk GROUP BY ALL
) QUALIFY row_number() OVER (PARTITION BY dt ORDER BY raw_ct DESC, keyword ASC) <= 20"""

# -- change data capture -----------------------------------------------------------
CHANGES = """
och AS (
  SELECT 'order_info' AS table_name, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'r' ELSE 'c' END AS op,
         o_orderkey * 4 AS seq, CAST(o_orderkey AS VARCHAR) AS id, NULL AS before_status, '1001' AS data_status,
         0 AS n_before, 5 AS n_data FROM orders
  UNION ALL
  SELECT 'order_info', 'u', o_orderkey * 4 + 1, CAST(o_orderkey AS VARCHAR), '1001',
         CASE WHEN o_orderstatus = 'F' THEN '1004' ELSE '1002' END, 5, 5
  FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT 'order_info', 'd', o_orderkey * 4 + 2, NULL, '1002', NULL, 5, 0
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
),
uch AS (
  SELECT 'user_info' AS table_name, 'r' AS op, c_custkey * 4 AS seq, CAST(c_custkey AS VARCHAR) AS id,
         NULL AS before_status, NULL AS data_status, 0 AS n_before, 5 AS n_data FROM customer
  UNION ALL
  SELECT 'user_info', 'u', c_custkey * 4 + 1, CAST(c_custkey AS VARCHAR), NULL, NULL, 5, 5
  FROM customer WHERE c_mktsegment = 'BUILDING'
),
ch AS (
  SELECT *, CASE op WHEN 'c' THEN 'insert' WHEN 'r' THEN 'insert' WHEN 'u' THEN 'update'
                    WHEN 'd' THEN 'delete' END AS type
  FROM (SELECT * FROM och UNION ALL SELECT * FROM uch)
)"""

ORACLES["cdc_flatten"] = "WITH " + CHANGES + """
SELECT seq, 'shop' AS database, table_name, type, id AS data_id, data_status, before_status,
       n_data, n_before FROM ch"""

ORACLES["cdc_route"] = "WITH " + CHANGES + """,
cfg(src, op, sink_type, sink_table, sink_columns) AS (VALUES
  ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id,user_id,total_amount,order_status'),
  ('order_info', 'update', 'clickhouse', 'order_status_stats', 'id,order_status'),
  ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name,nation,acctbal'),
  ('user_info', 'update', 'hbase', 'dim_user_info', 'id,name,nation,acctbal')),
keys_(table_name, ks) AS (VALUES
  ('order_info', ['id', 'user_id', 'order_status', 'total_amount', 'create_time']),
  ('user_info', ['id', 'name', 'nation', 'acctbal', 'segment']))
SELECT ch.seq, ch.table_name, ch.type,
       CASE WHEN cfg.src IS NULL THEN 'no_config' WHEN cfg.sink_type = 'kafka' THEN 'fact'
            WHEN cfg.sink_type = 'hbase' THEN 'dim' ELSE 'unknown_sink' END AS route,
       cfg.sink_type, cfg.sink_table,
       array_to_string(list_sort(list_filter(k.ks, lambda x: list_contains(string_split(cfg.sink_columns, ','), x))), ',')
         AS cols,
       ch.id AS data_id
FROM ch LEFT JOIN cfg ON ch.table_name = cfg.src AND ch.type = cfg.op
JOIN keys_ k ON k.table_name = ch.table_name
WHERE ch.type IS NULL OR ch.type <> 'delete'"""

ORACLES["dim_upsert"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
       CAST(CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS DECIMAL(18,2))
            AS VARCHAR) AS acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey * 4 + 1 ELSE c_custkey * 4 END AS seq
FROM customer"""

ORACLES["changelog_state"] = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderstatus = 'F' THEN '1004' WHEN o_orderstatus = 'P' THEN '1002' ELSE '1001' END AS order_status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
       CAST(o_custkey AS VARCHAR) AS user_id,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderkey * 4 + 1 ELSE o_orderkey * 4 END AS seq
FROM orders
WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"""

# -- partial upserts, snapshots, zones, one-day reports ------------------------------
ORACLES["dim_upsert_partial"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(c_acctbal + 100 AS DECIMAL(18,2)) AS VARCHAR) END AS acctbal,
       4 * c_custkey + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS seq, c_mktsegment AS segment
FROM customer"""

ORACLES["user_snapshot_state"] = """
SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE 'old' END AS name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(c_acctbal + 100 AS DECIMAL(18,2)) AS VARCHAR) END AS acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 4 * c_custkey + 1 ELSE -1 END AS seq
FROM customer"""

ORACLES["order_current_view"] = """
SELECT CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'P' THEN '1002' ELSE '1001' END AS order_status, count(*) AS n
FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') GROUP BY 1"""

ORACLES["daily_unique_visit_zone"] = "WITH " + PAGE_LOG + """,
e AS (SELECT *, strftime(make_timestamp((ts + 28800000) * 1000), '%Y-%m-%d') AS dt FROM page_log
      WHERE last_page_id IS NULL),
p AS (SELECT *, lag(dt) OVER (PARTITION BY mid ORDER BY seq) AS prev_dt FROM e)
SELECT seq, mid, ts FROM p WHERE prev_dt IS NULL OR prev_dt <> dt"""

ORACLES["visitor_day"] = ("SELECT hr, new_uv, uv_ct, pv_ct, uj_ct FROM (" + ORACLES["visitor_by_hour"]
                          + ") WHERE dt = '2024-01-05'")

ORACLES["search_times"] = """
WITH s AS (SELECT conv_id * 1000 + turn AS seq, 1704067200000 + conv_id * 60000 + turn * 1000 + 1234 AS ts
           FROM conversations)
SELECT seq, strftime(make_timestamp((ts + 28800000) * 1000), '%Y-%m-%d %H:%M:%S') AS local,
       ts // 1000 * 1000 AS back, strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') AS utc
FROM s"""

ORACLES["order_wide_merge"] = "WITH " + SHOP + """
SELECT order_id, detail_id, order_status, province_id, 'unnamed' AS sku_name, split_coupon_amount FROM ow"""

# -- dimension store, config over time, retractions ----------------------------------
ORACLES["dim_upsert_batches"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(c_acctbal + 100 AS DECIMAL(18,2)) AS VARCHAR) END AS acctbal,
       4 * c_custkey + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS seq
FROM customer"""

ORACLES["cdc_route_as_of"] = "WITH " + CHANGES + """,
cfg(src, op, since, gone, sink_type, sink_table, sink_columns) AS (VALUES
  ('user_info', 'insert', -1, false, 'hbase', 'dim_user_info', 'id,name,nation'),
  ('order_info', 'insert', 400, false, 'kafka', 'dwd_order_info', 'id,user_id,total_amount,order_status'),
  ('user_info', 'update', 800, false, 'hbase', 'dim_user_info', 'id,acctbal'),
  ('order_info', 'update', 1000, false, 'clickhouse', 'order_status_stats', 'id,order_status'),
  ('order_info', 'insert', 2400, false, 'kafka', 'dwd_order_info', 'id,order_status'),
  ('order_info', 'update', 3000, false, 'kafka', 'order_status_stats', 'id,order_status'),
  ('order_info', 'insert', 4000, true, NULL, NULL, NULL),
  ('order_info', 'insert', 5000, false, 'kafka', 'dwd_order_new', 'id,total_amount')),
keys_(table_name, ks) AS (VALUES
  ('order_info', ['id', 'user_id', 'order_status', 'total_amount', 'create_time']),
  ('user_info', ['id', 'name', 'nation', 'acctbal', 'segment'])),
m AS (SELECT ch.*, coalesce(NOT cfg.gone, false) AS known, sink_type, sink_table, sink_columns
      FROM ch ASOF LEFT JOIN cfg ON ch.table_name = cfg.src AND ch.type = cfg.op AND ch.seq >= cfg.since
      WHERE ch.type IS NULL OR ch.type <> 'delete')
SELECT m.seq, m.table_name, m.type,
       CASE WHEN NOT known THEN 'no_config' WHEN sink_type = 'kafka' THEN 'fact'
            WHEN sink_type = 'hbase' THEN 'dim' ELSE 'unknown_sink' END AS route,
       sink_type, sink_table,
       array_to_string(list_sort(list_filter(k.ks, lambda x: NOT known OR list_contains(string_split(sink_columns, ','), x))),
                       ',') AS cols,
       m.id AS data_id
FROM m JOIN keys_ k ON k.table_name = m.table_name"""

ORACLES["changelog_retractions"] = """
WITH img AS (
  SELECT 'order_info' AS table_name, CAST(o_orderkey AS VARCHAR) AS pk, o_orderkey * 4 AS seq, '1001' AS order_status,
         NULL AS acctbal, 5 AS n_data FROM orders
  UNION ALL
  SELECT 'order_info', CAST(o_orderkey AS VARCHAR), o_orderkey * 4 + 1,
         CASE WHEN o_orderstatus = 'F' THEN '1004' ELSE '1002' END, NULL, 5 FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT 'order_info', CAST(o_orderkey AS VARCHAR), o_orderkey * 4 + 2, NULL, NULL, NULL
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT 'user_info', CAST(c_custkey AS VARCHAR), c_custkey * 4, NULL, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), 5
  FROM customer
  UNION ALL
  SELECT 'user_info', CAST(c_custkey AS VARCHAR), c_custkey * 4 + 1, NULL,
         CAST(CAST(c_acctbal + 100 AS DECIMAL(18,2)) AS VARCHAR), 5 FROM customer WHERE c_mktsegment = 'BUILDING'),
pair AS (
  SELECT *, lag(n_data) OVER w AS was, lag(order_status) OVER w AS was_status, lag(acctbal) OVER w AS was_acctbal
  FROM img WINDOW w AS (PARTITION BY table_name, pk ORDER BY seq))
SELECT table_name, pk, seq, CASE WHEN n_data IS NULL THEN '-D' ELSE '-U' END AS kind, was_status AS order_status,
       was_acctbal AS acctbal, was AS n_data FROM pair WHERE was IS NOT NULL
UNION ALL
SELECT table_name, pk, seq, CASE WHEN was IS NULL THEN '+I' ELSE '+U' END, order_status, acctbal, n_data
FROM pair WHERE n_data IS NOT NULL"""

ORACLES["bounce_outcomes"] = _visits(f"""
SELECT seq, mid, ts, CASE WHEN next_ts - ts < {BOUNCE_WITHIN_MS} THEN 'match' ELSE 'timeout' END AS outcome,
       CASE WHEN next_ts - ts < {BOUNCE_WITHIN_MS} THEN next_ts ELSE ts + {BOUNCE_WITHIN_MS} END AS decided_at
FROM uj""")


# -- pattern rules, mergeable distinct counts, dictionary words ---------------------
FUNNEL_WITHIN_MS = 2 * DAY

ORACLES["session_funnel"] = "WITH " + PAGE_LOG + f""",
later AS (
  SELECT seq, mid, ts, last_page_id,
         first_value(CASE WHEN page_id = 'good_detail' THEN seq END IGNORE NULLS) OVER w AS click_seq,
         first_value(CASE WHEN page_id = 'purchase' THEN seq END IGNORE NULLS) OVER w AS purchase_seq
  FROM page_log
  WINDOW w AS (PARTITION BY mid ORDER BY ts, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
),
steps AS (
  SELECT s.seq, s.mid, s.ts, c.seq AS click_seq, p.seq AS purchase_seq, p.ts AS purchase_ts
  FROM later s
  LEFT JOIN later c ON c.seq = s.click_seq AND c.ts - s.ts < {FUNNEL_WITHIN_MS}
  LEFT JOIN page_log p ON p.seq = c.purchase_seq AND p.ts - s.ts < {FUNNEL_WITHIN_MS}
  WHERE s.last_page_id IS NULL
)
SELECT seq, mid, ts, CASE WHEN purchase_seq IS NULL THEN 'timeout' ELSE 'match' END AS outcome,
       coalesce(purchase_ts, ts + {FUNNEL_WITHIN_MS}) AS decided_at,
       CAST(1 + (click_seq IS NOT NULL)::INT + (purchase_seq IS NOT NULL)::INT AS INTEGER) AS reached,
       click_seq, purchase_seq
FROM steps"""

ORACLES["brand_paid_orders"] = "WITH " + SHOP + """
SELECT substr(payment_create_time, 1, 7) AS month, tm_id, count(DISTINCT order_id) AS paid_order_ct
FROM pw WHERE tm_id IS NOT NULL GROUP BY ALL"""

ORACLES["dictionary_keywords"] = f"""
WITH RECURSIVE dict AS (
  SELECT DISTINCT w FROM (
    SELECT unnest(regexp_extract_all(lower(text), '{TOKEN_RE2}')) AS w FROM conversations WHERE role IS DISTINCT FROM 'user')
  WHERE length(w) BETWEEN 2 AND 5
),
runs AS (
  SELECT run, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(lower(text), '{TOKEN_RE2}')) AS run FROM conversations WHERE role = 'user')
  GROUP BY run
),
best AS (
  SELECT run, pos, max(len) AS len
  FROM (SELECT run, unnest(range(1, length(run) + 1)) AS pos FROM runs), range(2, 6) l(len)
  WHERE pos + len - 1 <= length(run) AND substr(run, pos, len) IN (SELECT w FROM dict)
  GROUP BY run, pos
),
walk(run, pos, len) AS (
  SELECT r.run, CAST(1 AS BIGINT), b.len FROM runs r LEFT JOIN best b ON b.run = r.run AND b.pos = 1
  UNION ALL
  SELECT w.run, w.pos + coalesce(w.len, 1), b.len
  FROM walk w LEFT JOIN best b ON b.run = w.run AND b.pos = w.pos + coalesce(w.len, 1)
  WHERE w.pos + coalesce(w.len, 1) <= length(w.run)
),
placed AS (
  SELECT run, pos, len, count(len) OVER (PARTITION BY run ORDER BY pos) AS before FROM walk
),
words AS (
  SELECT run, substr(run, pos, len) AS keyword, true AS known FROM placed WHERE len IS NOT NULL
  UNION ALL
  SELECT run, substr(run, min(pos), count(*)), false FROM placed WHERE len IS NULL GROUP BY run, before
)
SELECT keyword, known, CAST(sum(n) AS BIGINT) AS ct FROM words JOIN runs USING (run) GROUP BY ALL"""
