"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Every statement starts from the same CTE chain as the Spark side: the adapter
(``canon``, ``dirty``) and the cleaned layer (``clean``). Means are plain ``avg``. Doubles are
rounded to nine and then to six decimals on both sides: the first step takes away the noise of
the summation order, which could otherwise tip a value that lies between two six-digit ones.
"""

from __future__ import annotations

CANON_CTE = """
src AS (
  SELECT event_id, ts, user_id AS src_user, event_type AS src_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), typed AS (
  SELECT *, lpad(CAST(src_user * 10 + (day(ts) - 1) // 7 AS VARCHAR), 32, '0') AS user_id,
         CASE WHEN src_type = 'view' THEN 'page_view'
              WHEN src_type = 'error' AND k >= 25 THEN 'page_view'
              WHEN src_type = 'error' THEN 'search'
              WHEN src_type = 'signup' THEN 'product_view'
              WHEN src_type = 'purchase' THEN 'cart_event'
              WHEN src_type = 'click' THEN 'click' END AS event_type
  FROM src
), canon AS (
  SELECT event_id, user_id,
         'S' || user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
         ts AS "timestamp", event_type,
         CASE WHEN event_type IN ('page_view', 'click') THEN
           CASE k % 5 WHEN 0 THEN '/'
                      WHEN 1 THEN '/category/category_' || lpad(CAST(k % 10 AS VARCHAR), 2, '0')
                      WHEN 2 THEN '/product/PROD-' || lpad(CAST(k AS VARCHAR), 4, '0')
                      WHEN 3 THEN '/cart' ELSE '/checkout' END END AS page_url,
         CASE WHEN event_type = 'page_view'
              THEN ['home', 'category', 'product', 'cart', 'checkout'][k % 5 + 1] END AS page_type,
         CASE WHEN event_type IN ('page_view', 'product_view') AND k % 17 <> 0 THEN value END
           AS time_on_page_seconds,
         CASE WHEN event_type = 'page_view'
              THEN ['mobile', 'desktop', 'tablet'][event_id % 3 + 1] END AS device_type,
         CASE WHEN event_type = 'page_view'
              THEN ['Colombia', 'Mexico', 'Argentina', 'Chile', 'Peru', 'Ecuador', 'Uruguay'][src_user % 7 + 1]
              END AS country,
         CASE WHEN event_type IN ('product_view', 'cart_event')
              THEN 'PROD-' || lpad(CAST(k AS VARCHAR), 4, '0') END AS product_id,
         CASE WHEN event_type = 'product_view'
              THEN 'category_' || lpad(CAST(k % 10 AS VARCHAR), 2, '0') END AS category,
         CASE WHEN event_type = 'product_view' AND k % 13 <> 0 THEN value END AS price,
         CASE WHEN event_type = 'cart_event' THEN CASE WHEN k % 5 = 0 THEN 'remove' ELSE 'add' END END
           AS action,
         CASE WHEN event_type = 'click' THEN CAST(event_id % 1921 AS DOUBLE) END AS x_position,
         CASE WHEN event_type = 'click' THEN CAST(event_id % 1081 AS DOUBLE) END AS y_position
  FROM typed
)"""

CLEAN_CTE = CANON_CTE + """, dedup AS (
  SELECT * FROM canon
  QUALIFY row_number() OVER (PARTITION BY user_id, session_id, "timestamp", event_type ORDER BY event_id) = 1
), pv_med AS (
  SELECT page_type, quantile_disc(time_on_page_seconds, 0.5) AS med
  FROM dedup WHERE event_type = 'page_view' GROUP BY page_type
), imp1 AS (
  SELECT d.* REPLACE (coalesce(d.time_on_page_seconds, m.med) AS time_on_page_seconds)
  FROM dedup d LEFT JOIN pv_med m ON d.page_type = m.page_type
), pr_med AS (
  SELECT category, quantile_disc(price, 0.5) AS med
  FROM imp1 WHERE event_type = 'product_view' GROUP BY category
), clean AS (
  SELECT i.* REPLACE (coalesce(i.price, m.med) AS price)
  FROM imp1 i LEFT JOIN pr_med m ON i.category = m.category
)"""

TOP_PAGES = """
SELECT page_url, round(round(avg(time_on_page_seconds), 9), 6) AS avg_time_on_page_seconds,
       count(*) AS event_count
FROM clean WHERE event_type = 'page_view' AND page_url IS NOT NULL
GROUP BY page_url
ORDER BY round(avg(time_on_page_seconds), 9) DESC, page_url LIMIT 20"""

SESSIONS = """
sess AS (
  SELECT session_id, count(*) AS page_view_count,
         arg_min(page_type, "timestamp") FILTER (WHERE page_type IS NOT NULL) AS entry_page_type,
         coalesce(string_agg(page_type, '→' ORDER BY "timestamp" NULLS FIRST, page_type NULLS FIRST), '')
           AS path
  FROM clean WHERE event_type = 'page_view' GROUP BY session_id
)"""

BOUNCE = """
bounce AS (
  SELECT entry_page_type AS page_type,
         CAST(sum(CASE WHEN page_view_count = 1 THEN 1 ELSE 0 END) AS BIGINT) AS bounced_sessions,
         count(session_id) AS total_sessions
  FROM sess GROUP BY entry_page_type
), bounce_rate AS (
  SELECT page_type, bounced_sessions, total_sessions,
         round(round(CASE WHEN total_sessions > 0
                    THEN CAST(bounced_sessions AS DOUBLE) / total_sessions * 100 END, 9), 6) AS bounce_rate
  FROM bounce
)"""

FUNNEL = """
pu AS (
  SELECT user_id,
         bool_or(event_type = 'page_view') AS s1,
         bool_or(event_type = 'product_view') AS s2,
         bool_or(event_type = 'cart_event' AND action = 'add') AS s3,
         bool_or(event_type = 'page_view' AND page_type = 'checkout') AS s4
  FROM clean WHERE event_type IN ('page_view', 'product_view', 'cart_event') GROUP BY user_id
), fc AS (
  SELECT count(*) FILTER (WHERE s1) AS stage1_page_view_users,
         count(*) FILTER (WHERE s2) AS stage2_product_view_users,
         count(*) FILTER (WHERE s3) AS stage3_cart_add_users,
         count(*) FILTER (WHERE s4) AS stage4_checkout_users
  FROM pu
), funnel AS (
  SELECT *,
    round(round(CASE WHEN stage1_page_view_users > 0
          THEN CAST(stage2_product_view_users AS DOUBLE) / stage1_page_view_users * 100 END, 9), 6)
          AS stage2_over_stage1_pct,
    round(round(CASE WHEN stage2_product_view_users > 0
          THEN CAST(stage3_cart_add_users AS DOUBLE) / stage2_product_view_users * 100 END, 9), 6)
          AS stage3_over_stage2_pct,
    round(round(CASE WHEN stage3_cart_add_users > 0
          THEN CAST(stage4_checkout_users AS DOUBLE) / stage3_cart_add_users * 100 END, 9), 6)
          AS stage4_over_stage3_pct
  FROM fc
)"""

PRODUCTS = """
pm AS (
  SELECT product_id,
         min(CASE WHEN event_type = 'product_view' THEN category END) AS category,
         avg(CASE WHEN event_type = 'product_view' THEN price END) AS avg_price,
         count(*) FILTER (WHERE event_type = 'product_view') AS view_count,
         count(*) FILTER (WHERE event_type = 'cart_event' AND action = 'add') AS cart_add_count
  FROM clean
  WHERE (event_type = 'product_view' OR (event_type = 'cart_event' AND action = 'add'))
    AND product_id IS NOT NULL
  GROUP BY product_id HAVING count(*) FILTER (WHERE event_type = 'product_view') > 0
), hvlc AS (
  SELECT product_id, category, round(round(avg_price, 9), 6) AS avg_price, view_count, cart_add_count,
         round(round(CAST(cart_add_count AS DOUBLE) / view_count, 9), 6) AS conversion_rate
  FROM pm
  WHERE view_count > coalesce((SELECT quantile_disc(view_count, 0.75) FROM pm), 0)
    AND cart_add_count < coalesce((SELECT quantile_disc(cart_add_count, 0.25) FROM pm), 0)
)"""

PATHS = """
paths AS (
  SELECT path, count(*) AS session_count FROM sess GROUP BY path
  ORDER BY session_count DESC, path LIMIT 10
)"""

DEVICE = """
dct AS (
  SELECT device_type, country, round(round(avg(time_on_page_seconds), 9), 6) AS avg_time_on_page_seconds,
         count(DISTINCT session_id) AS distinct_sessions
  FROM clean WHERE event_type = 'page_view' GROUP BY device_type, country
)"""

ANOMALY = """
st AS (
  SELECT page_type, avg(time_on_page_seconds) AS mean_time, stddev_samp(time_on_page_seconds) AS std_time,
         quantile_disc(time_on_page_seconds, 0.25) AS q1, quantile_disc(time_on_page_seconds, 0.75) AS q3
  FROM clean WHERE event_type = 'page_view' GROUP BY page_type
), zj AS (
  SELECT c.session_id, c.user_id, c.page_type, c.time_on_page_seconds,
         CASE WHEN st.std_time > 0 THEN (c.time_on_page_seconds - st.mean_time) / st.std_time ELSE 0.0 END AS z,
         (c.time_on_page_seconds < CASE WHEN st.page_type IS NOT NULL THEN st.q1 - 1.5 * (st.q3 - st.q1) END)
         OR (c.time_on_page_seconds > CASE WHEN st.page_type IS NOT NULL THEN st.q3 + 1.5 * (st.q3 - st.q1) END)
           AS iqr
  FROM clean c LEFT JOIN st ON c.page_type IS NOT DISTINCT FROM st.page_type
  WHERE c.event_type = 'page_view'
), anomalies AS (
  SELECT session_id, user_id, page_type, time_on_page_seconds, round(round(z, 9), 6) AS z_score,
         iqr AS is_iqr_outlier,
         CASE WHEN abs(z) > 2 AND iqr THEN 'z_score_and_iqr'
              WHEN abs(z) > 2 THEN 'z_score'
              WHEN iqr THEN 'iqr' END AS anomaly_type
  FROM zj WHERE abs(z) > 2 OR iqr
)"""


def with_clean(*ctes: str, select: str) -> str:
    parts = [CLEAN_CTE] + [", " + c.strip() for c in ctes]
    return "WITH " + "".join(parts) + "\n" + select


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    q["top_pages"] = "WITH " + CLEAN_CTE + TOP_PAGES
    q["bounce_rate"] = with_clean(SESSIONS, BOUNCE, select="SELECT * FROM bounce_rate")
    q["conversion_funnel"] = with_clean(FUNNEL, select="SELECT * FROM funnel")
    q["high_view_low_cart"] = with_clean(PRODUCTS, select="SELECT * FROM hvlc")
    q["navigation_paths"] = with_clean(SESSIONS, PATHS, select="SELECT * FROM paths")
    q["device_country_time"] = with_clean(DEVICE, select="SELECT * FROM dct")
    q["anomalies"] = with_clean(ANOMALY, select="SELECT * FROM anomalies")
    q["zscore_by_page_type"] = with_clean(
        ANOMALY,
        select="SELECT page_type, round(round(mean_time, 9), 6) AS mean_time, round(round(std_time, 9), 6) AS std_time FROM st",
    )
    q["iqr_fences"] = with_clean(
        ANOMALY,
        select="""SELECT page_type, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
                  q3 + 1.5 * (q3 - q1) AS upper_bound FROM st""",
    )
    q["dedup_events"] = "WITH " + CANON_CTE + """
SELECT event_id, user_id, session_id, date_trunc('hour', "timestamp") AS timestamp_hour, event_type
FROM canon
QUALIFY row_number() OVER (
  PARTITION BY user_id, session_id, date_trunc('hour', "timestamp"), event_type ORDER BY event_id) = 1"""
    q["union_events"] = "WITH " + CANON_CTE + "\nSELECT * FROM canon"
    q["impute_time_on_page"] = "WITH " + CLEAN_CTE + """
SELECT event_id, event_type, page_type, time_on_page_seconds FROM imp1"""
    q["impute_price"] = "WITH " + CLEAN_CTE + """
SELECT event_id, event_type, category, price FROM clean"""
    q.update(validation_statements())
    q.update(warehouse_statements())
    q["stream_file_verdicts"] = ("WITH " + DIRTY_CTE + "\nSELECT file_id, event_type, status, failed_fields, "
                                 "invalid_rows, total_rows FROM verdicts")
    q["csv_file_verdicts"] = "WITH " + DIRTY_CTE + CSV_VERDICTS_CTE + """
SELECT file_id, event_type, status, failed_fields, invalid_rows, total_rows FROM csv_verdicts"""
    q["load_from_metrics"] = ("WITH " + CLEAN_CTE + ", " + SESSIONS.strip() + ", " + BOUNCE.strip() + ", "
                              + FUNNEL.strip() + FACT_COUNTS)
    q["csv_quoted_cells"] = "WITH " + DIRTY_CTE + CSV_VERDICTS_CTE + """
SELECT file_id, event_type, status, failed_fields, invalid_rows, total_rows FROM csv_verdicts
WHERE event_type = 'cart_event'"""
    q["pipeline_facts_valid_only"] = pipeline_statement()
    return q


_NUM_RE = r"(?i)\s*[+-]?(inf|infinity|((\d+\.?\d*|\.\d+)(e[+-]?\d+)?))\s*"


def _num(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{_NUM_RE}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


DIRTY_CTE = CANON_CTE + """, dirty AS (
  SELECT event_id, event_id AS row_pos, event_type,
         event_type || '/' || strftime("timestamp", '%Y-%m-%d') AS file_id,
         'events/year=' || strftime("timestamp", '%Y') || '/month=' || strftime("timestamp", '%m')
           || '/day=' || strftime("timestamp", '%d') || '/' || event_type || '.csv' AS file_key,
         CASE WHEN dd AND event_id % 97 = 0 THEN 'bad-' || CAST(event_id AS VARCHAR)
              WHEN dd AND event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN dd AND event_id % 89 = 0 THEN '  ' ELSE session_id END AS session_id,
         CASE WHEN dd AND event_id % 83 = 0 THEN 'not-a-date'
              ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S') END AS ts_text,
         CASE WHEN event_type = 'page_view' AND dd AND event_id % 41 = 0 THEN 'unknown' ELSE page_type END
           AS page_type,
         CAST(CASE WHEN event_type = 'page_view' AND NOT dd
                   THEN greatest(coalesce(time_on_page_seconds, 1.0), 1.0)
                   ELSE time_on_page_seconds END AS VARCHAR) AS time_on_page_seconds,
         CASE WHEN event_type = 'product_view' THEN
           CASE WHEN dd AND event_id % 29 = 0 THEN '-1' ELSE CAST(coalesce(price, 9.5) AS VARCHAR) END END
           AS price,
         CASE WHEN event_type = 'product_view' AND dd AND event_id % 43 = 0 THEN '' ELSE product_id END
           AS product_id,
         CASE WHEN event_type = 'cart_event' AND dd AND event_id % 47 = 0 THEN 'hold' ELSE action END AS action,
         CASE WHEN event_type = 'click' THEN
           CASE WHEN dd AND event_id % 31 = 0 THEN '-5' ELSE CAST(event_id % 1921 AS VARCHAR) END END
           AS x_position,
         CASE WHEN event_type = 'click' THEN
           CASE WHEN dd AND event_id % 37 = 0 THEN '1.5' ELSE CAST(event_id % 1081 AS VARCHAR) END END
           AS y_position
  FROM (SELECT *, day("timestamp") % 3 = 0 AS dd FROM canon)
), flags AS (
  SELECT *,
    NOT coalesce(regexp_full_match(replace(regexp_replace(regexp_replace(
        replace(replace(user_id, 'urn:', ''), 'uuid:', ''), '^[{}]+', ''), '[{}]+$', ''), '-', ''),
        '[0-9a-fA-F]{32}'), false) AS invalid_user_id,
    (session_id IS NULL OR regexp_full_match(session_id, '\\s*')) AS invalid_session_id,
    TRY_CAST(ts_text AS TIMESTAMP) IS NULL AS invalid_timestamp,
    CASE WHEN event_type = 'page_view'
         THEN NOT coalesce(page_type IN ('home', 'category', 'product', 'cart', 'checkout'), false)
         ELSE false END AS invalid_page_type,
    CASE WHEN event_type = 'page_view'
         THEN NOT coalesce((""" + _num("time_on_page_seconds") + """) BETWEEN 1 AND 3600, false)
         ELSE false END AS invalid_time_on_page_seconds,
    CASE WHEN event_type = 'product_view'
         THEN NOT coalesce((""" + _num("price") + """) > 0, false) ELSE false END AS invalid_price,
    CASE WHEN event_type = 'product_view'
         THEN (product_id IS NULL OR regexp_full_match(product_id, '\\s*')) ELSE false END AS invalid_product_id,
    CASE WHEN event_type = 'cart_event' THEN NOT coalesce(action IN ('add', 'remove'), false)
         ELSE false END AS invalid_action,
    CASE WHEN event_type = 'click' THEN coalesce((""" + _num("x_position") + """) < 0
         OR isnan((""" + _num("x_position") + """) % 1) OR (""" + _num("x_position") + """) % 1 <> 0, true)
         ELSE false END AS invalid_x_position,
    CASE WHEN event_type = 'click' THEN coalesce((""" + _num("y_position") + """) < 0
         OR isnan((""" + _num("y_position") + """) % 1) OR (""" + _num("y_position") + """) % 1 <> 0, true)
         ELSE false END AS invalid_y_position,
    strlen(concat_ws(',', user_id, session_id, ts_text, page_type, time_on_page_seconds, price, product_id,
                     action, x_position, y_position)) + 1 AS row_bytes
  FROM dirty
), chk AS (
  SELECT *, (invalid_user_id OR invalid_session_id OR invalid_timestamp OR invalid_page_type
             OR invalid_time_on_page_seconds OR invalid_price OR invalid_product_id OR invalid_action
             OR invalid_x_position OR invalid_y_position) AS row_invalid
  FROM flags
), fv AS (
  SELECT file_id, event_type, count(*) AS total_rows, count(*) FILTER (WHERE row_invalid) AS invalid_rows,
         CAST(sum(row_bytes) AS BIGINT) AS file_bytes,
         list_sort(list_filter([
           CASE WHEN bool_or(invalid_user_id) THEN 'user_id' END,
           CASE WHEN bool_or(invalid_session_id) THEN 'session_id' END,
           CASE WHEN bool_or(invalid_timestamp) THEN 'timestamp' END,
           CASE WHEN bool_or(invalid_page_type) THEN 'page_type' END,
           CASE WHEN bool_or(invalid_time_on_page_seconds) THEN 'time_on_page_seconds' END,
           CASE WHEN bool_or(invalid_price) THEN 'price' END,
           CASE WHEN bool_or(invalid_product_id) THEN 'product_id' END,
           CASE WHEN bool_or(invalid_action) THEN 'action' END,
           CASE WHEN bool_or(invalid_x_position) THEN 'x_position' END,
           CASE WHEN bool_or(invalid_y_position) THEN 'y_position' END], lambda x: x IS NOT NULL)) AS ff
  FROM chk GROUP BY file_id, event_type
), verdicts AS (
  SELECT file_id, event_type,
         CASE WHEN invalid_rows > 0 OR len(ff) > 0 THEN 'invalid' ELSE 'valid' END AS status,
         array_to_string(ff, ',') AS failed_fields, invalid_rows, total_rows, file_bytes
  FROM fv
), samples AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY row_pos) AS sample_rank
  FROM chk WHERE row_invalid
  QUALIFY sample_rank <= 3
)"""

#: Product views of day 5 lack the price column: all rows fail, for that reason alone.
CSV_VERDICTS_CTE = """, csv_verdicts AS (
  SELECT file_id, event_type,
         CASE WHEN lacks THEN 'invalid' ELSE status END AS status,
         CASE WHEN lacks THEN array_to_string(list_sort(list_concat(
                list_filter(string_split(failed_fields, ','),
                            lambda x: x IN ('user_id', 'session_id', 'timestamp')),
                ['missing_column:price'])), ',')
              ELSE failed_fields END AS failed_fields,
         CASE WHEN lacks THEN total_rows ELSE invalid_rows END AS invalid_rows, total_rows
  FROM (SELECT *, event_type = 'product_view' AND right(file_id, 2) = '05' AS lacks FROM verdicts)
)"""


FACT_COUNTS = """
SELECT 'bounce_rate' AS fact, page_type AS name, total_sessions AS n, bounced_sessions AS m FROM bounce
UNION ALL SELECT 'conversion_funnel', stage, n, NULL FROM (
  SELECT unnest(['page_view', 'product_view', 'cart_add', 'checkout']) AS stage,
         unnest([stage1_page_view_users, stage2_product_view_users, stage3_cart_add_users,
                 stage4_checkout_users]) AS n FROM fc)"""


def pipeline_statement() -> str:
    """Facts from the rows of valid files only, cleaned as everywhere."""
    rows = DIRTY_CTE + CSV_VERDICTS_CTE + """, good AS (
  SELECT event_id, user_id, session_id, CAST(ts_text AS TIMESTAMP) AS "timestamp", event_type, page_type,
         TRY_CAST(time_on_page_seconds AS DOUBLE) AS time_on_page_seconds, product_id,
         CAST(NULL AS VARCHAR) AS category, TRY_CAST(price AS DOUBLE) AS price, action
  FROM dirty WHERE file_id IN (SELECT file_id FROM csv_verdicts WHERE status = 'valid')
), """
    clean = CLEAN_CTE[len(CANON_CTE) + 2:].replace("FROM canon", "FROM good", 1)
    return ("WITH " + rows + clean + ", " + SESSIONS.strip() + ", " + BOUNCE.strip() + ", " + FUNNEL.strip()
            + FACT_COUNTS + """
UNION ALL SELECT 'dim_product', product_id, CAST(""" + _dec("avg(price)", 10, 2) + """ * 100 AS BIGINT), NULL
FROM clean WHERE event_type = 'product_view' AND product_id IS NOT NULL GROUP BY product_id""")


RAW_SELECT = ("user_id, session_id, ts_text, page_type, time_on_page_seconds, price, product_id, "
              "action, x_position, y_position")


def validation_statements() -> dict[str, str]:
    w = "WITH " + DIRTY_CTE + "\n"
    return {
        "infer_event_type": w + """SELECT DISTINCT file_key,
            coalesce(regexp_extract(regexp_extract(file_key, '([^/]*)$', 1),
                     '^(page_view|click|search|product_view|cart_event)', 1), '') AS inferred_event_type
            FROM dirty""",
        "validate_common": w + """SELECT event_id, file_id, invalid_user_id, invalid_session_id,
            invalid_timestamp FROM chk""",
        "validate_page_view": w + """SELECT event_id, file_id, invalid_page_type,
            invalid_time_on_page_seconds, row_invalid FROM chk WHERE event_type = 'page_view'""",
        "validate_product_view": w + """SELECT event_id, file_id, invalid_price, invalid_product_id,
            row_invalid FROM chk WHERE event_type = 'product_view'""",
        "validate_cart_event": w + """SELECT event_id, file_id, invalid_action, row_invalid
            FROM chk WHERE event_type = 'cart_event'""",
        "validate_click": w + """SELECT event_id, file_id, invalid_x_position, invalid_y_position,
            row_invalid FROM chk WHERE event_type = 'click'""",
        "file_verdicts": w + "SELECT * FROM verdicts",
        "ingest_metrics": w + """SELECT count(*) FILTER (WHERE status = 'valid') AS files_processed,
            CAST(coalesce(sum(total_rows) FILTER (WHERE status = 'valid'), 0) AS BIGINT) AS valid_records,
            round(round(coalesce(sum(file_bytes) FILTER (WHERE status = 'valid'), 0) / 1048576.0, 9), 6) AS size_mb,
            count(*) FILTER (WHERE status = 'invalid') AS invalid_files
            FROM verdicts""",
        "route_valid": w + """SELECT event_id, file_id, event_type FROM dirty
            WHERE file_id IN (SELECT file_id FROM verdicts WHERE status = 'valid')""",
        "route_quarantine": w + """SELECT event_id, file_id, event_type FROM dirty
            WHERE file_id IN (SELECT file_id FROM verdicts WHERE status = 'invalid')""",
        "error_report": w + f"""SELECT v.file_id, 'validation_error' AS error_type, v.failed_fields,
            s.sample_rank, s.event_id, {', '.join('s.' + c for c in RAW_SELECT.split(', '))}
            FROM verdicts v JOIN samples s ON v.file_id = s.file_id WHERE v.status = 'invalid'""",
    }


RUN_DATE = "DATE '2024-01-30'"


def _dec(expr: str, p: int, s: int) -> str:
    """Spark's double -> DECIMAL cast: half-up on the value's shortest decimal text."""
    return f"TRY_CAST(CAST(round({expr}, 9) AS VARCHAR) AS DECIMAL({p},{s}))"


WAREHOUSE_CTE = CLEAN_CTE + ", " + SESSIONS.strip() + ", " + BOUNCE.strip() + ", " + FUNNEL.strip() + ", " + \
    PRODUCTS.strip() + ", " + PATHS.strip() + ", " + ANOMALY.strip() + f""", tp_raw AS (
  SELECT page_url, avg(time_on_page_seconds) AS avg_t, count(*) AS event_count
  FROM clean WHERE event_type = 'page_view' AND page_url IS NOT NULL
  GROUP BY page_url ORDER BY round(avg_t, 9) DESC, page_url LIMIT 20
), f_top_pages AS (
  SELECT {RUN_DATE} AS date, page_url, {_dec("avg_t", 8, 2)} AS avg_time_seconds,
         CAST(event_count AS INTEGER) AS session_count,
         CAST(row_number() OVER (ORDER BY round(avg_t, 9) DESC, page_url) AS INTEGER) AS rank
  FROM tp_raw
), br_raw AS (
  SELECT page_type, bounced_sessions, total_sessions,
         CASE WHEN total_sessions > 0 THEN CAST(bounced_sessions AS DOUBLE) / total_sessions * 100 END AS br
  FROM bounce
), f_bounce_rate AS (
  SELECT {RUN_DATE} AS date, page_type, {_dec("br", 5, 2)} AS bounce_rate,
         CAST(total_sessions AS INTEGER) AS total_sessions, CAST(bounced_sessions AS INTEGER) AS bounced_sessions
  FROM br_raw
), fn_raw AS (
  SELECT s1 AS c1, s2 AS c2, s3 AS c3, s4 AS c4 FROM (
    SELECT count(*) FILTER (WHERE s1) AS s1, count(*) FILTER (WHERE s2) AS s2,
           count(*) FILTER (WHERE s3) AS s3, count(*) FILTER (WHERE s4) AS s4 FROM pu)
), fn_long AS (
  SELECT 'page_view' AS stage, c1 AS user_count, CAST(NULL AS DOUBLE) AS rate FROM fn_raw
  UNION ALL SELECT 'product_view', c2, CASE WHEN c1 > 0 THEN CAST(c2 AS DOUBLE) / c1 * 100 / 100.0 END FROM fn_raw
  UNION ALL SELECT 'cart_add', c3, CASE WHEN c2 > 0 THEN CAST(c3 AS DOUBLE) / c2 * 100 / 100.0 END FROM fn_raw
  UNION ALL SELECT 'checkout', c4, CASE WHEN c3 > 0 THEN CAST(c4 AS DOUBLE) / c3 * 100 / 100.0 END FROM fn_raw
), f_conversion_funnel AS (
  SELECT {RUN_DATE} AS date, stage, CAST(user_count AS INTEGER) AS user_count,
         {_dec("rate", 5, 4)} AS conversion_rate
  FROM fn_long
), f_high_view_low_cart AS (
  SELECT {RUN_DATE} AS date, product_id, category, {_dec("avg_price", 10, 2)} AS avg_price,
         CAST(view_count AS INTEGER) AS view_count, CAST(cart_add_count AS INTEGER) AS cart_add_count,
         {_dec("CAST(cart_add_count AS DOUBLE) / view_count", 5, 4)} AS conversion_rate
  FROM pm
  WHERE view_count > coalesce((SELECT quantile_disc(view_count, 0.75) FROM pm), 0)
    AND cart_add_count < coalesce((SELECT quantile_disc(cart_add_count, 0.25) FROM pm), 0)
), f_navigation_paths AS (
  SELECT {RUN_DATE} AS date, path, CAST(session_count AS INTEGER) AS session_count,
         CAST(row_number() OVER (ORDER BY session_count DESC, path) AS INTEGER) AS rank
  FROM paths
), f_device_country_time AS (
  SELECT {RUN_DATE} AS date, device_type, country, {_dec("avg(time_on_page_seconds)", 8, 2)} AS avg_time_seconds,
         CAST(count(DISTINCT session_id) AS INTEGER) AS session_count
  FROM clean WHERE event_type = 'page_view' GROUP BY device_type, country
), f_anomalies AS (
  SELECT {RUN_DATE} AS date, session_id, user_id, page_type, {_dec("time_on_page_seconds", 8, 2)} AS time_on_page,
         {_dec("z", 6, 3)} AS z_score, iqr AS is_iqr_outlier,
         CASE WHEN abs(z) > 2 AND iqr THEN 'z_score_and_iqr' WHEN abs(z) > 2 THEN 'z_score'
              WHEN iqr THEN 'iqr' END AS anomaly_type
  FROM zj WHERE abs(z) > 2 OR iqr
), d_product AS (
  SELECT product_id, min(category) AS category, {_dec("avg(price)", 10, 2)} AS avg_price
  FROM clean WHERE event_type = 'product_view' AND product_id IS NOT NULL GROUP BY product_id
), d_page AS (
  SELECT page_url, min(page_type) AS page_type
  FROM clean WHERE event_type = 'page_view' AND page_url IS NOT NULL GROUP BY page_url
), d_date AS (
  SELECT CAST(d AS DATE) AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week
  FROM (SELECT unnest(generate_series(min(CAST("timestamp" AS DATE)), max(CAST("timestamp" AS DATE)),
                                      INTERVAL 1 DAY)) AS d FROM clean)
)"""

FACT_CTES = {
    "fact_top_pages": "f_top_pages", "fact_bounce_rate": "f_bounce_rate",
    "fact_conversion_funnel": "f_conversion_funnel", "fact_high_view_low_cart": "f_high_view_low_cart",
    "fact_navigation_paths": "f_navigation_paths", "fact_device_country_time": "f_device_country_time",
    "fact_anomalies": "f_anomalies", "dim_product": "d_product", "dim_page": "d_page", "dim_date": "d_date",
}
TABLE_COLUMNS = {
    "fact_top_pages": ["date", "page_url", "avg_time_seconds", "session_count", "rank"],
    "fact_bounce_rate": ["date", "page_type", "bounce_rate", "total_sessions", "bounced_sessions"],
    "fact_conversion_funnel": ["date", "stage", "user_count", "conversion_rate"],
    "fact_high_view_low_cart": ["date", "product_id", "category", "avg_price", "view_count",
                                "cart_add_count", "conversion_rate"],
    "fact_navigation_paths": ["date", "path", "session_count", "rank"],
    "fact_device_country_time": ["date", "device_type", "country", "avg_time_seconds", "session_count"],
    "fact_anomalies": ["date", "session_id", "user_id", "page_type", "time_on_page", "z_score",
                       "is_iqr_outlier", "anomaly_type"],
    "dim_product": ["product_id", "category", "avg_price"],
    "dim_page": ["page_url", "page_type"],
    "dim_date": ["date_id", "year", "month", "day", "day_of_week"],
}
DIM_KEYS = {"dim_product": "product_id", "dim_page": "page_url", "dim_date": "date_id"}


def _scorecard_sql() -> str:
    parts = []
    for table, cte in FACT_CTES.items():
        cols = TABLE_COLUMNS[table]
        rules = []
        if table not in DIM_KEYS:
            rules.append(('ColumnExists "date"', "0" if "date" in cols else "count(*)"))
        for c in ("date", "session_id", "user_id"):
            if c in cols:
                rules.append((f'ColumnValues "{c}" IS NOT NULL', f"count(*) FILTER (WHERE {c} IS NULL)"))
        for c in ("time_on_page", "avg_time_seconds"):
            if c in cols:
                rules.append((f'ColumnValues "{c}" BETWEEN 0 AND 3600',
                              f"count(*) FILTER (WHERE NOT coalesce({c} BETWEEN 0 AND 3600, false))"))
        if table in DIM_KEYS:
            k = DIM_KEYS[table]
            rules.append((f'IsPrimaryKey "{k}"', f"count(*) - count(DISTINCT {k})"))
        for name, expr in rules:
            parts.append(
                f"SELECT '{table}' AS table_name, '{name}' AS rule, count(*) AS rows_checked, "
                f"CAST({expr} AS BIGINT) AS failed_rows FROM {cte}"
            )
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT table_name, rule, rows_checked, failed_rows, "
            f"CASE WHEN failed_rows = 0 THEN 'pass' ELSE 'fail' END AS outcome FROM ({body})")


def warehouse_statements() -> dict[str, str]:
    w = "WITH " + WAREHOUSE_CTE + "\n"
    q = {table: w + f"SELECT * FROM {cte}" for table, cte in FACT_CTES.items()}
    q["valid_records"] = w + """SELECT * FROM f_anomalies WHERE date IS NOT NULL AND session_id IS NOT NULL
        AND user_id IS NOT NULL AND coalesce(time_on_page BETWEEN 0 AND 3600, false)"""
    q["dq_scorecard"] = w + _scorecard_sql()
    q["report_pages_time"] = w + f"""SELECT page_url, CAST(avg_time_seconds AS DOUBLE) AS avg_time_seconds,
        session_count, rank FROM f_top_pages WHERE date = {RUN_DATE} ORDER BY rank, page_url LIMIT 10"""
    q["report_pages_bounce"] = w + f"""SELECT page_type, CAST(bounce_rate AS DOUBLE) AS bounce_rate,
        total_sessions, bounced_sessions FROM f_bounce_rate WHERE date = {RUN_DATE}
        ORDER BY bounce_rate DESC NULLS LAST, page_type LIMIT 10"""
    q["report_sessions"] = w + f"""SELECT device_type, country, CAST(avg_time_seconds AS DOUBLE) AS avg_time_seconds,
        session_count FROM f_device_country_time WHERE date = {RUN_DATE} AND device_type = 'mobile'
        ORDER BY session_count DESC, device_type, country"""
    q["report_anomalies"] = w + f"""SELECT session_id, user_id, page_type, CAST(z_score AS DOUBLE) AS z_score,
        anomaly_type FROM f_anomalies WHERE date = {RUN_DATE}
        ORDER BY abs(z_score) DESC, session_id, user_id, page_type, anomaly_type, z_score LIMIT 100"""
    q["report_anomaly_total"] = w + f"""SELECT {RUN_DATE} AS date, count(*) AS total
        FROM f_anomalies WHERE date = {RUN_DATE}"""
    return q
