"""Independent DuckDB SQL for every checked query.

Written directly in DuckDB's dialect (try_strptime, regexp_extract, md5,
QUALIFY, FULL JOIN) from the semantics, never generated from the Spark code.
Only the fixture derivation (FIXTURES.md §2) is shared text, because it
defines the input rather than an operator.
"""

from __future__ import annotations

STORES_RAW = """
stores_raw AS (
  SELECT CASE WHEN n_nationkey % 5 = 4 THEN 'false' WHEN n_nationkey % 5 = 3 THEN 'TRUE' ELSE 'true' END AS active,
         'store' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS store_id,
         n_name AS store_name,
         CASE WHEN n_nationkey = 7 THEN '' ELSE 'user' END AS rb_username,
         CASE WHEN n_nationkey = 8 THEN '' ELSE 'x' END AS rb_password,
         CASE WHEN n_nationkey = 22 THEN '99999999999' WHEN n_nationkey % 3 = 0 THEN '' WHEN n_nationkey % 3 = 1 THEN '300' ELSE '0' END AS days_back,
         CASE WHEN n_nationkey = 16 THEN '1996/01/01' WHEN n_nationkey % 4 = 0 THEN '1996-01-01' ELSE '' END AS from_date,
         CASE WHEN n_nationkey % 8 = 0 THEN '1998-12-31' ELSE '' END AS to_date,
         '' AS note
  FROM nation
)"""

ACTIVE_STORES = """
active_stores AS (
  SELECT store_id, store_name,
         CAST(COALESCE(NULLIF(TRY_CAST(NULLIF(regexp_extract(days_back, '^\\s*([+-]?[0-9]+)', 1), '') AS INTEGER), 0), 7)
              AS INTEGER) AS days_back,
         from_date, to_date, note
  FROM stores_raw
  WHERE lower(active) = 'true' AND store_id <> '' AND rb_username <> '' AND rb_password <> ''
)"""

RES_RAW = """
res_base AS (
  SELECT o_orderkey AS k, o_orderpriority AS pr, o_orderstatus AS st,
         'store' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS store_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d,
         CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 30 AS INT) AS VARCHAR) AS b,
         CAST(11 + o_orderkey % 15 AS VARCHAR) AS h,
         lpad(CAST((o_orderkey % 4) * 15 AS VARCHAR), 2, '0') AS m
  FROM orders JOIN customer ON o_custkey = c_custkey
),
res_raw AS (
  SELECT store_id, k AS src_key,
         CASE WHEN k % 7 = 0 THEN '' ELSE CAST(k AS VARCHAR) END AS reservation_id,
         CASE WHEN k % 50 = 0 THEN '' WHEN k % 50 = 1 THEN 'not-a-date'
              WHEN k % 8 = 1 THEN replace(d, '-', '/')
              WHEN k % 8 = 2 THEN substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4)
              WHEN k % 8 = 3 THEN substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || substr(d, 1, 4)
              WHEN k % 8 = 4 THEN substr(d, 1, 4) || '年' || substr(d, 6, 2) || '月' || substr(d, 9, 2) || '日'
              ELSE d END AS reserve_date_raw,
         CASE WHEN k % 9 = 0 THEN '' ELSE b END AS booking_date_raw,
         CASE WHEN k % 23 = 0 THEN 'なし' ELSE h || ':' || m END AS start_time_raw,
         CASE WHEN k % 19 = 0 THEN '' ELSE h || ':' || m || ':30' END AS end_time_raw,
         CASE WHEN k % 6 = 0 THEN '' ELSE 'コース' || CAST(k % 6 AS VARCHAR) END AS course_name,
         CASE WHEN k % 11 = 0 THEN '' WHEN k % 11 = 1 THEN '多数'
              WHEN k % 11 = 2 THEN CAST(k % 10 AS VARCHAR) || '名' ELSE CAST(k % 10 AS VARCHAR) END AS headcount_raw,
         CASE pr WHEN '1-URGENT' THEN 'ホットペッパー' WHEN '2-HIGH' THEN '食べログ' WHEN '3-MEDIUM' THEN '電話'
                 WHEN '5-LOW' THEN 'ぐるなび' ELSE 'Walk  In' END AS channel_raw,
         CASE WHEN k % 13 = 0 THEN 'キャンセル' WHEN k % 17 = 0 THEN 'ノーショー' WHEN k % 29 = 0 THEN ''
              WHEN st = 'F' THEN '来店済み' WHEN st = 'O' THEN '確定' ELSE '仮予約' END AS status_raw
  FROM res_base
)"""

_TIME_RE = "^([0-9]{1,2}):([0-9]{2})(:([0-9]{2}))?"


def _date(col: str, extended: bool) -> str:
    fmts = ["%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y"] + (["%Y年%m月%d日"] if extended else [])
    tries = ", ".join(f"CAST(try_strptime({col}, '{f}') AS DATE)" for f in fmts)
    return f"CASE WHEN {col} <> '' THEN COALESCE({tries}) END"


def _time(col: str) -> str:
    return (
        f"CASE WHEN regexp_matches({col}, '{_TIME_RE}') THEN "
        f"lpad(regexp_extract({col}, '{_TIME_RE}', 1), 2, '0') || ':' || regexp_extract({col}, '{_TIME_RE}', 2)"
        f" || ':' || COALESCE(NULLIF(regexp_extract({col}, '{_TIME_RE}', 4), ''), '00') END"
    )


def _int(col: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({col}, '^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT)"


CHANNELS = {
    False: [("ホットペッパー", "hotpepper"), ("食べログ", "tabelog"), ("電話", "phone"), ("店頭", "walk_in"),
            ("ネット", "web")],
    True: [("ホットペッパー", "hotpepper"), ("食べログ", "tabelog"), ("ぐるなび", "gurunavi"), ("一休", "ikyu"),
           ("電話", "phone"), ("店頭", "walk_in"), ("ネット", "web"), ("その他", "other")],
}
STATUSES = {
    False: [("確定", "confirmed"), ("キャンセル", "cancelled"), ("仮予約", "tentative"), ("来店済み", "completed")],
    True: [("確定", "confirmed"), ("キャンセル", "cancelled"), ("仮予約", "tentative"), ("来店済み", "completed"),
           ("ノーショー", "no_show")],
}


def _std(col: str, pairs) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs)
    return (
        f"CASE WHEN {col} IS NULL OR {col} = '' THEN NULL "
        f"ELSE CASE {col} {whens} ELSE regexp_replace(lower({col}), '[\\s\\x{{3000}}\\x{{00a0}}]+', '_', 'g') END END"
    )


def _jstr(expr: str) -> str:
    return "'\"' || replace(replace(" + expr + ", '\\', '\\\\'), '\"', '\\\"') || '\"'"


def typed_cte(name: str, src: str, extended: bool = False, adjust_b: bool = False) -> str:
    hc = _int("headcount_raw")
    rd = _date("reserve_date_raw", extended)
    if adjust_b:
        hc = f"CASE WHEN src_key % 10 = 0 THEN ({hc}) + 1 ELSE {hc} END"
        rd = f"CASE WHEN src_key % 70 = 10 THEN CAST(({rd}) + INTERVAL 1 MONTH AS DATE) ELSE {rd} END"
    return f"""
{name} AS (
  SELECT *,
         {rd} AS reserve_date,
         {_date('booking_date_raw', extended)} AS booking_date,
         {_time('start_time_raw')} AS start_time,
         {_time('end_time_raw')} AS end_time,
         {hc} AS headcount
  FROM {src}
)"""


def normalized_cte(name: str, typed: str, run_id: str, ts: str, extended: bool = False) -> str:
    ch = _std("t.channel_raw", CHANNELS[extended])
    stt = _std("t.status_raw", STATUSES[extended])

    def frag(key, val, raw=None):
        f = f"'\"{key}\":' || COALESCE({val}, 'null')"
        return f"CASE WHEN {raw} <> '' THEN {f} END" if raw else f

    body = ", ".join(
        [
            frag("booking_date", _jstr("CAST(booking_date AS VARCHAR)"), "booking_date_raw"),
            frag("channel", _jstr("channel")),
            frag("course_name", _jstr("course_name")),
            frag("end_time", _jstr("end_time"), "end_time_raw"),
            frag("headcount", "CAST(headcount AS VARCHAR)", "headcount_raw"),
            frag("reserve_date", _jstr("CAST(reserve_date AS VARCHAR)"), "reserve_date_raw"),
            frag("start_time", _jstr("start_time"), "start_time_raw"),
            frag("status", _jstr("status")),
            frag("store_id", _jstr("store_id")),
        ]
    )
    tod = "'^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$'"
    return f"""
{name}_std AS (
  SELECT t.src_key, t.store_id, s.store_name, t.reserve_date, t.booking_date, t.start_time, t.end_time,
         NULLIF(t.course_name, '') AS course_name, t.headcount,
         {ch} AS channel, {stt} AS status,
         'restaurant_board' AS vendor, TIMESTAMP '{ts}' AS ingestion_ts, '{run_id}' AS run_id,
         CASE WHEN t.reservation_id <> '' THEN t.store_id || '_' || t.reservation_id
              ELSE concat_ws('|', t.store_id, COALESCE(CAST(t.reserve_date AS VARCHAR), 'no_date'),
                             COALESCE(t.start_time, 'no_time'), COALESCE(NULLIF(t.course_name, ''), 'no_course'),
                             COALESCE(CAST(t.headcount AS VARCHAR), '0'), COALESCE(NULLIF(t.channel_raw, ''), 'no_channel'))
         END AS record_key,
         t.reserve_date_raw, t.booking_date_raw, t.start_time_raw, t.end_time_raw, t.headcount_raw
  FROM {typed} t JOIN active_stores s ON t.store_id = s.store_id
),
{name} AS (
  SELECT src_key, store_id, store_name, reserve_date, booking_date, start_time, end_time, course_name, headcount,
         channel, status, vendor, ingestion_ts, run_id, record_key,
         md5('{{' || concat_ws(',', {body}) || '}}') AS record_hash,
         concat_ws(',',
           CASE WHEN store_id IS NULL OR store_id = '' THEN 'missing_store_id' END,
           CASE WHEN reserve_date IS NULL THEN 'missing_reserve_date' END,
           CASE WHEN start_time IS NOT NULL AND NOT regexp_matches(start_time, {tod}) THEN 'bad_start_time' END,
           CASE WHEN end_time IS NOT NULL AND NOT regexp_matches(end_time, {tod}) THEN 'bad_end_time' END) AS reject_reason
  FROM {name}_std
)"""


COLS15 = ("store_id, store_name, reserve_date, booking_date, start_time, end_time, course_name, headcount, "
          "channel, status, vendor, ingestion_ts, run_id, record_key, record_hash")

RUN_A = ("rb_19980801_011500", "1998-07-31 16:15:00")
RUN_B = ("rb_19980802_011500", "1998-08-01 16:15:00")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def base_ctes(extended: bool = False) -> list[str]:
    return [STORES_RAW, ACTIVE_STORES, RES_RAW]


def run_a_ctes(extended: bool = False) -> list[str]:
    return base_ctes() + [
        typed_cte("typed_a", "(SELECT * FROM res_raw WHERE src_key % 3 <> 0)", extended),
        normalized_cte("norm_a", "typed_a", RUN_A[0], RUN_A[1], extended),
    ]


def full_run_ctes(extended: bool = False) -> list[str]:
    return base_ctes() + [
        typed_cte("typed_a", "res_raw", extended),
        normalized_cte("norm_a", "typed_a", RUN_A[0], RUN_A[1], extended),
    ]


def scenario_ctes() -> list[str]:
    return run_a_ctes() + [
        typed_cte("typed_b", "(SELECT * FROM res_raw WHERE src_key % 3 <> 2)", adjust_b=True),
        normalized_cte("norm_b", "typed_b", RUN_B[0], RUN_B[1]),
        f"""
stage AS (
  SELECT {COLS15}, CAST(ingestion_ts AS DATE) AS ingestion_date FROM norm_a WHERE reject_reason = ''
  UNION ALL
  SELECT {COLS15}, CAST(ingestion_ts AS DATE) AS ingestion_date FROM norm_b WHERE reject_reason = ''
  UNION ALL
  SELECT store_id, store_name, reserve_date, booking_date, start_time, end_time, course_name, headcount,
         channel, status, vendor, ingestion_ts + INTERVAL 1 HOUR, run_id, record_key, record_hash,
         CAST(ingestion_ts + INTERVAL 1 HOUR AS DATE) AS ingestion_date
  FROM norm_b WHERE reject_reason = '' AND src_key % 20 = 0
)""",
        f"""
tgt AS (
  SELECT {COLS15} FROM stage WHERE run_id = '{RUN_A[0]}'
  QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY ingestion_ts DESC, record_hash, store_id) = 1
)""",
        f"""
src AS (
  SELECT {COLS15} FROM stage WHERE run_id = '{RUN_B[0]}'
  QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY ingestion_ts DESC, record_hash, store_id) = 1
)""",
        """
acts AS (
  SELECT s.store_id, s.record_key, s.reserve_date, t.reserve_date AS old_reserve_date,
         CASE WHEN t.record_key IS NULL THEN 'insert'
              WHEN t.record_hash <> s.record_hash THEN 'update' ELSE 'unchanged' END AS action
  FROM src s LEFT JOIN tgt t
    ON t.record_key = s.record_key AND t.vendor = s.vendor AND t.store_id = s.store_id
)""",
        """
merged AS (
  SELECT t.* FROM tgt t
  WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.record_key = t.record_key AND s.vendor = t.vendor
                    AND s.store_id = t.store_id AND s.record_hash <> t.record_hash)
  UNION ALL
  SELECT s.* FROM src s
  WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE s.record_key = t.record_key AND s.vendor = t.vendor
                    AND s.store_id = t.store_id AND s.record_hash = t.record_hash)
)""",
    ]


def _kpi(src: str) -> str:
    return f"""
SELECT store_id, store_name, reserve_date, channel, status,
       COUNT(*) AS reservation_count,
       CAST(SUM(headcount) AS BIGINT) AS total_headcount,
       AVG(headcount) AS avg_party_size,
       COUNT(CASE WHEN status = 'confirmed' THEN 1 END) AS confirmed_count,
       COUNT(CASE WHEN status = 'cancelled' THEN 1 END) AS cancelled_count,
       COUNT(CASE WHEN status = 'completed' THEN 1 END) AS completed_count
FROM {src}
GROUP BY store_id, store_name, reserve_date, channel, status"""


REPORT_COLS = ("store_id, store_name, reserve_date, booking_date, start_time, end_time, course_name, headcount, "
               "channel, status, vendor, ingestion_ts")
REPORT_BASIC_COLS = ("store_id, store_name, reserve_date, booking_date, start_time, end_time, course_name, "
                     "headcount, channel, status")
ORDER_REPORT = ("ORDER BY reserve_date DESC NULLS LAST, store_id ASC NULLS FIRST, start_time ASC NULLS FIRST, "
                "record_key ASC NULLS FIRST")


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_(*base_ctes())
    q["store_master"] = with_(STORES_RAW) + " SELECT * FROM stores_raw"
    q["active_stores"] = with_(STORES_RAW, ACTIVE_STORES) + " SELECT * FROM active_stores"
    q["store_missing_fields"] = with_(STORES_RAW) + """
SELECT COALESCE(NULLIF(store_id, ''), 'unknown') AS store_id,
       concat_ws(', ', CASE WHEN store_id = '' THEN 'store_id' END, CASE WHEN store_name = '' THEN 'store_name' END,
                 CASE WHEN rb_username = '' THEN 'rb_username' END,
                 CASE WHEN rb_password = '' THEN 'rb_password' END) AS missing_fields,
       (store_id <> '' AND store_name <> '' AND rb_username <> '' AND rb_password <> '') AS is_valid
FROM stores_raw"""
    q["store_windows"] = with_(STORES_RAW, ACTIVE_STORES) + """
SELECT store_id,
       CASE WHEN from_date <> '' AND to_date <> '' THEN TRY_CAST(replace(from_date, '/', '-') AS DATE)
            ELSE CAST(DATE '1998-08-02' - (days_back + 1) AS DATE) END AS window_from,
       CASE WHEN from_date <> '' AND to_date <> '' THEN TRY_CAST(to_date AS DATE)
            ELSE CAST(DATE '1998-08-02' - 1 AS DATE) END AS window_to
FROM active_stores"""
    q["map_columns"] = base + """
SELECT store_id, src_key, reservation_id, NULL::VARCHAR AS store_name_rb, reserve_date_raw, booking_date_raw,
       start_time_raw, end_time_raw, course_name, headcount_raw, channel_raw, status_raw
FROM res_raw"""
    typed_all = with_(*base_ctes(), typed_cte("typed", "res_raw"))
    q["typed_reservations"] = typed_all + """
SELECT store_id, src_key, reserve_date, booking_date, start_time, end_time, headcount FROM typed"""
    q["parse_dates"] = with_(*base_ctes(), typed_cte("typed", "res_raw", extended=True)) + """
SELECT src_key, reserve_date_raw, reserve_date, booking_date_raw, booking_date FROM typed"""
    q["parse_times"] = typed_all + """
SELECT src_key, start_time_raw, start_time, end_time_raw, end_time FROM typed"""
    q["parse_ints"] = typed_all + """
SELECT src_key, headcount_raw, headcount FROM typed"""
    q["channels"] = base + f"""
SELECT DISTINCT channel_raw, {_std('channel_raw', CHANNELS[False])} AS channel,
       {_std('channel_raw', CHANNELS[True])} AS channel_extended
FROM res_raw"""
    q["statuses"] = base + f"""
SELECT DISTINCT status_raw, {_std('status_raw', STATUSES[False])} AS status,
       {_std('status_raw', STATUSES[True])} AS status_extended
FROM res_raw"""
    run_a = with_(*full_run_ctes())
    q["record_keys"] = run_a + " SELECT src_key, store_id, record_key FROM norm_a"
    q["record_hashes"] = run_a + " SELECT src_key, record_hash FROM norm_a"
    q["normalize"] = run_a + f" SELECT {COLS15}, reject_reason FROM norm_a"
    q["normalize_extended"] = with_(*full_run_ctes(extended=True)) + f" SELECT {COLS15}, reject_reason FROM norm_a"
    q["valid_rows"] = run_a + f" SELECT {COLS15} FROM norm_a WHERE reject_reason = ''"
    q["rejected_rows"] = run_a + f" SELECT {COLS15}, reject_reason FROM norm_a WHERE reject_reason <> ''"
    q["windowed_reservations"] = run_a + f"""
, win AS (
  SELECT store_id,
         CASE WHEN from_date <> '' AND to_date <> '' THEN TRY_CAST(replace(from_date, '/', '-') AS DATE)
              ELSE CAST(DATE '1998-08-02' - (days_back + 1) AS DATE) END AS wf,
         CASE WHEN from_date <> '' AND to_date <> '' THEN TRY_CAST(to_date AS DATE)
              ELSE CAST(DATE '1998-08-02' - 1 AS DATE) END AS wt
  FROM active_stores)
SELECT {', '.join('n.' + c.strip() for c in COLS15.split(','))}
FROM norm_a n JOIN win w ON n.store_id = w.store_id AND n.reserve_date BETWEEN w.wf AND w.wt
WHERE n.reject_reason = ''"""
    q["transform_yield"] = run_a + """
SELECT store_id, COUNT(*) AS parsed_rows, COUNT(*) FILTER (WHERE reject_reason = '') AS valid_rows,
       COUNT(*) FILTER (WHERE reject_reason <> '') AS rejected_rows
FROM norm_a GROUP BY store_id"""
    q["run_summary"] = run_a + """
, cnt AS (SELECT store_id, COUNT(*) AS p, COUNT(*) FILTER (WHERE reject_reason = '') AS v FROM norm_a GROUP BY store_id)
SELECT s.store_id, s.store_name,
       CASE WHEN COALESCE(c.p, 0) = 0 OR COALESCE(c.v, 0) = 0 THEN 'skipped' ELSE 'success' END AS status,
       CAST(CASE WHEN COALESCE(c.p, 0) = 0 OR COALESCE(c.v, 0) = 0 THEN 0 ELSE c.v END AS BIGINT) AS records,
       NULL::VARCHAR AS error
FROM active_stores s LEFT JOIN cnt c ON s.store_id = c.store_id"""

    scen = with_(*scenario_ctes())
    q["stage_load"] = scen + f" SELECT {COLS15}, ingestion_date FROM stage WHERE run_id = '{RUN_B[0]}'"
    q["stage_union"] = scen + f" SELECT {COLS15}, ingestion_date FROM stage"
    q["stage_dedup"] = scen + " SELECT * FROM src"
    q["stage_retention"] = scen + f"""
SELECT {COLS15}, ingestion_date FROM stage WHERE ingestion_date >= DATE '1998-08-15' - 14"""
    q["merge_actions"] = scen + " SELECT * FROM acts"
    q["merge_stats"] = scen + """
SELECT COUNT(*) FILTER (WHERE action = 'insert') AS inserted_rows,
       COUNT(*) FILTER (WHERE action = 'update') AS updated_rows,
       (SELECT COUNT(*) FROM src) - COUNT(*) FILTER (WHERE action = 'insert')
         - COUNT(*) FILTER (WHERE action = 'update') AS unchanged_rows
FROM acts"""
    q["merge_result"] = scen + " SELECT * FROM merged"
    q["merge_apply"] = q["merge_result"]
    q["daily_kpi"] = scen + _kpi("merged")
    q["report"] = scen + f"""
SELECT {REPORT_COLS} FROM merged
WHERE reserve_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND channel = 'phone'
{ORDER_REPORT} LIMIT 10000"""
    q["report_basic"] = scen + f"""
SELECT {REPORT_BASIC_COLS} FROM merged
WHERE reserve_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
{ORDER_REPORT} LIMIT 10000"""
    q["report_limited"] = scen + f"""
SELECT {REPORT_COLS} FROM merged
WHERE reserve_date BETWEEN DATE '1992-01-01' AND DATE '2001-12-31'
{ORDER_REPORT} LIMIT 500"""
    q["param_query"] = scen + """
SELECT reserve_date, channel, COUNT(*) AS parties, CAST(SUM(headcount) AS BIGINT) AS guests FROM merged
WHERE store_id = 'store001' AND reserve_date >= DATE '1997-01-01' AND headcount >= 4
GROUP BY reserve_date, channel"""
    q["landing_manifest"] = scen + """
SELECT store_id, run_id, COUNT(*) AS record_count, MIN(ingestion_ts) AS upload_ts, 'restaurant_board' AS vendor,
       'landing/restaurant_board/' || strftime(MIN(ingestion_ts) + INTERVAL 9 HOUR, '%Y/%m/%d') || '/run_' || run_id
         || '/rb_' || store_id || '_' || strftime(MIN(ingestion_ts) + INTERVAL 9 HOUR, '%Y%m%d') || '.csv' AS object_path
FROM stage GROUP BY store_id, run_id"""
    q["run_labels"] = scen + """
SELECT DISTINCT run_id, lower(regexp_replace(run_id, '[^a-zA-Z0-9_-]', '_', 'g')) AS run_label FROM stage"""
    q["run_ids"] = scen + """
SELECT run_id, MIN(ingestion_ts) AS run_started,
       'rb_' || strftime(MIN(ingestion_ts) + INTERVAL 9 HOUR, '%Y%m%d_%H%M%S') AS derived_run_id
FROM stage GROUP BY run_id"""
    all_lines = with_(*base_ctes(), typed_cte("typed_all", "res_raw"),
                      normalized_cte("norm_all", "typed_all", RUN_A[0], RUN_A[1]))
    q["daily_run_production"] = all_lines + f"""
SELECT {COLS15} FROM norm_all WHERE reject_reason = ''
QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY ingestion_ts DESC, record_hash, store_id) = 1"""
    q["daily_run_summary"] = all_lines + """
, cnt AS (SELECT store_id, COUNT(*) AS p, COUNT(*) FILTER (WHERE reject_reason = '') AS v FROM norm_all GROUP BY store_id)
SELECT s.store_id, s.store_name,
       CASE WHEN COALESCE(c.p, 0) = 0 OR COALESCE(c.v, 0) = 0 THEN 'skipped' ELSE 'success' END AS status,
       CAST(CASE WHEN COALESCE(c.p, 0) = 0 OR COALESCE(c.v, 0) = 0 THEN 0 ELSE c.v END AS BIGINT) AS records,
       NULL::VARCHAR AS error
FROM active_stores s LEFT JOIN cnt c ON s.store_id = c.store_id"""
    q["kpi_view"] = q["daily_kpi"]
    q["run_totals"] = q["run_summary"].replace(
        "SELECT s.store_id, s.store_name,",
        "SELECT status, COUNT(*) AS stores, CAST(SUM(records) AS BIGINT) AS total_records FROM (\n"
        "SELECT s.store_id, s.store_name,", 1) + "\n) GROUP BY status"
    q["csv_scan"] = base + """
SELECT store_id, src_key, reservation_id, NULL::VARCHAR AS store_name_rb, reserve_date_raw, booking_date_raw,
       start_time_raw, CASE WHEN CAST(substr(store_id, 6) AS INTEGER) % 3 <> 2 THEN end_time_raw END AS end_time_raw,
       course_name || CASE src_key % 4 WHEN 1 THEN '"特別", A' WHEN 2 THEN '表' ELSE '' END AS course_name,
       headcount_raw, channel_raw, status_raw
FROM res_raw"""
    landed = scen + """
SELECT strftime(MIN(ingestion_ts) + INTERVAL 9 HOUR, '%Y-%m-%d') AS ingest_date, run_id, store_id,
       COUNT(*) AS record_count, MIN(ingestion_ts) AS upload_ts, 'restaurant_board' AS vendor,
       'scheduled' AS upload_type
FROM stage GROUP BY run_id, store_id"""
    q["landing_inventory"] = landed
    q["landing_top_n"] = landed + " ORDER BY ingest_date, run_id, store_id LIMIT 7"
    q["landing_expired"] = f"SELECT * FROM ({landed}) WHERE upload_ts < TIMESTAMP '1998-08-31 16:15:00' - INTERVAL 30 DAY"
    q["manual_landing"] = f"SELECT * REPLACE ('manual' AS upload_type) FROM ({landed}) WHERE run_id = '{RUN_B[0]}'"
    q["table_profile"] = scen + """
SELECT 'stage_reservations' AS table_name, COUNT(*) AS num_rows, 16 AS num_columns, COUNT(*) > 0 AS has_files FROM stage
UNION ALL SELECT 'reservations', COUNT(*), 15, COUNT(*) > 0 FROM tgt"""
    q["merge_apply_kpi"] = q["daily_kpi"]
    odd = ("CASE headcount % 5 WHEN 1 THEN course_name || '\"特別\", A' WHEN 2 THEN course_name || chr(10) || 'B, ' "
           "ELSE course_name END AS course_name")
    q["manual_load"] = run_a.replace(f"'{RUN_A[0]}'", "'manual_19980801_120000'", 1) + f"""
SELECT {COLS15.replace('course_name', odd)} FROM norm_a WHERE reject_reason = ''"""
    q["store_master_file"] = q["store_master"]
    q["csv_scan_multiline"] = base + """
SELECT store_id, src_key, reservation_id, NULL::VARCHAR AS store_name_rb, reserve_date_raw, booking_date_raw, start_time_raw, end_time_raw,
       CASE WHEN CAST(substr(store_id, 6) AS INTEGER) % 2 = 1 AND src_key % 3 = 1 THEN course_name || chr(10) || '2行目, "表"'
            ELSE course_name END AS course_name,
       headcount_raw, channel_raw, status_raw
FROM res_raw"""
    q["landing_removed"] = q["landing_expired"]
    q["landing_after_expiry"] = f"SELECT * FROM ({landed}) WHERE upload_ts >= TIMESTAMP '1998-08-31 16:15:00' - INTERVAL 30 DAY"
    q["load_stats"] = all_lines + f"""
SELECT '{RUN_A[0]}' AS run_id, store_id, 'daily' AS source, COUNT(*) AS output_rows, TRUE AS has_files, TRUE AS has_bytes
FROM norm_all WHERE reject_reason = '' GROUP BY store_id"""
    q["compacted_files"] = scen + """
SELECT ingestion_date AS day, TRUE AS had_many, 1 AS files_after, COUNT(*) AS num_rows, COUNT(*) AS rows_left FROM stage GROUP BY ingestion_date"""
    q["daily_run_windowed"] = run_a + """
, win AS (
  SELECT store_id,
         CASE WHEN from_date <> '' AND to_date <> '' THEN TRY_CAST(replace(from_date, '/', '-') AS DATE)
              ELSE CAST(DATE '1998-08-02' - (days_back + 1) AS DATE) END AS wf,
         CASE WHEN from_date <> '' AND to_date <> '' THEN TRY_CAST(to_date AS DATE)
              ELSE CAST(DATE '1998-08-02' - 1 AS DATE) END AS wt
  FROM active_stores)
SELECT n.store_id, COUNT(*) AS parsed_rows,
       COUNT(*) FILTER (WHERE reject_reason = '' AND reserve_date BETWEEN wf AND wt) AS valid_rows,
       COUNT(*) FILTER (WHERE reject_reason <> '') AS rejected_rows,
       COUNT(*) FILTER (WHERE reject_reason = '' AND NOT (reserve_date BETWEEN wf AND wt)) AS outside_rows
FROM norm_a n JOIN win w ON n.store_id = w.store_id GROUP BY n.store_id"""
    q["landing_roundtrip"] = q["valid_rows"]
    q["stream_stage"] = scen + f" SELECT {COLS15.replace('course_name', odd)}, ingestion_date FROM stage"
    return q
