"""DuckDB text of the same input tables, as named sub-queries for the oracle statements."""

import re

_USER_ATTRS = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
       CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'M' ELSE 'F' END AS gender,
       CAST(c_nationkey + 18 AS VARCHAR) AS age,
       CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) AS mod_price,
       n_name AS fre_city,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '乡村' WHEN 'FURNITURE' THEN '镇区'
            WHEN 'HOUSEHOLD' THEN 'unknown' ELSE '城区' END AS fre_community_type,
       CASE n_regionkey WHEN 0 THEN '一线城市' WHEN 1 THEN '新一线城市' WHEN 2 THEN '二线城市'
            WHEN 3 THEN '三线城市' ELSE 'unknown' END AS fre_city_level
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

_FANOUT = """
SELECT u.user_id, CAST(o_orderkey AS VARCHAR) AS pid, CAST(l_suppkey AS VARCHAR) AS author_id,
       CAST(n_nationkey AS VARCHAR) AS category_id, CAST(1 + n_nationkey % 3 AS VARCHAR) AS category_level,
       CAST(n_regionkey AS VARCHAR) AS parent_id, CAST(n_regionkey AS VARCHAR) AS root_id,
       CAST(CAST(floor(epoch_us(o_orderdate) / 1000000) AS BIGINT) + o_orderkey % 86400 AS VARCHAR) AS exposed_time,
       CAST(l_suppkey * 10 + 5 AS VARCHAR) AS author_fans_count,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS watch_time,
       CAST(8 + l_linenumber * 4 AS VARCHAR) || '.0' AS duration,
       CASE WHEN l_returnflag = 'A' THEN 'True' ELSE 'False' END AS cvm_like,
       CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'False' END AS click,
       CASE WHEN l_discount > 0.055 THEN 'True' ELSE 'False' END AS comment,
       CASE WHEN l_tax > 0.055 THEN 'True' ELSE 'False' END AS follow,
       CASE WHEN l_tax < 0.015 THEN 'True' ELSE 'False' END AS "collect",
       CASE WHEN o_orderstatus = 'P' THEN 'True' ELSE 'False' END AS forward,
       CASE WHEN l_discount < 0.005 THEN 'True' ELSE 'False' END AS hate,
       p_name AS tag_name, p_type AS title,
       CAST((o_orderkey + l_linenumber % 2) % 24 AS VARCHAR) AS p_hour,
       CAST(year(o_orderdate) AS VARCHAR) || '0101' AS p_date,
       u.gender, u.age, u.mod_price, u.fre_city, u.fre_community_type, u.fre_city_level,
       l_returnflag, l_linestatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN nation ON n_nationkey = CAST(regexp_extract(p_brand, '[0-9]+') AS INT) - 1
JOIN user_attrs u ON CAST(o_custkey AS VARCHAR) = u.user_id
"""

_DROP = "EXCLUDE (l_returnflag, l_linestatus)"

_RAW = f"""
SELECT * {_DROP} FROM fanout
UNION ALL SELECT * {_DROP} FROM fanout WHERE l_returnflag = 'A'
UNION ALL SELECT * {_DROP} REPLACE (CAST(CAST(substr(p_date, 1, 4) AS INT) + 1 AS VARCHAR) || '0101' AS p_date)
FROM fanout WHERE l_returnflag = 'R' AND l_linestatus = 'F'
"""

_DEFECTS = """
SELECT * REPLACE (
  CASE WHEN starts_with(tag_name,'red') AND p_date='19960101' THEN '24' ELSE p_hour END AS p_hour,
  CASE WHEN starts_with(tag_name,'blue') AND p_date='19960101' THEN '201' ELSE age END AS age,
  CASE WHEN starts_with(tag_name,'red') AND p_date='19970101' THEN '-1'
       WHEN starts_with(tag_name,'red') AND p_date='19990101' THEN 'ten' ELSE watch_time END AS watch_time,
  CASE WHEN starts_with(tag_name,'blue') AND p_date='19970101' THEN '0'
       WHEN starts_with(tag_name,'blue') AND p_date='19990101' THEN '1.0d' ELSE duration END AS duration,
  CASE WHEN starts_with(tag_name,'red') AND p_date='19960101' THEN '-5' ELSE mod_price END AS mod_price,
  CASE WHEN starts_with(tag_name,'blue') AND p_date='19970101' THEN '0' ELSE exposed_time END AS exposed_time,
  CASE WHEN starts_with(tag_name,'blue') AND p_date='19990101' THEN 'maybe' ELSE hate END AS hate,
  CASE WHEN starts_with(tag_name,'red') AND p_date='19960101' THEN 'X'
       WHEN starts_with(tag_name,'red') AND p_date='20000101' THEN ' ' ELSE gender END AS gender,
  CASE WHEN starts_with(tag_name,'red') AND p_date='19970101' THEN 'suburb' ELSE fre_community_type END AS fre_community_type,
  CASE WHEN starts_with(tag_name,'red') AND p_date='19970101' THEN '六线城市' ELSE fre_city_level END AS fre_city_level,
  CASE WHEN starts_with(tag_name,'red') AND p_date='19980101' THEN '999' ELSE category_id END AS category_id,
  CASE WHEN starts_with(tag_name,'blue') AND p_date='19980101' THEN '19980102' ELSE p_date END AS p_date
), p_date AS part_date FROM raw
"""

_CATS = """
SELECT CAST(1 + n_nationkey % 3 AS VARCHAR) AS category_level, CAST(n_nationkey AS VARCHAR) AS category_id,
       n_name AS category_name_cn, CAST(n_regionkey AS VARCHAR) AS parent_id, CAST(n_regionkey AS VARCHAR) AS root_id,
       ' ' || n_name AS category_name_en, CAST(n_nationkey AS BIGINT) AS _file_seq FROM nation
UNION ALL
SELECT CAST(1 + n_nationkey % 3 AS VARCHAR), CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR),
       CAST(n_regionkey AS VARCHAR), ' ' || n_name || '_alt', CAST(n_nationkey + 100 AS BIGINT)
FROM nation WHERE n_regionkey = 0
"""

_PART_CATS = """
SELECT CAST(1 + p_partkey % 3 AS VARCHAR) AS category_level, CAST(p_partkey AS VARCHAR) AS category_id,
       chr(12288) || p_name || ' ' AS category_name_cn, CAST(p_size AS VARCHAR) AS parent_id,
       CAST(p_size AS VARCHAR) AS root_id,
       CASE WHEN p_type = 'PROMO' THEN '  ' ELSE ' ' || p_name END AS category_name_en, p_partkey * 2 AS _file_seq
FROM part
UNION ALL
SELECT CAST(1 + p_partkey % 3 AS VARCHAR), CAST(p_partkey AS VARCHAR), chr(12288) || p_name || ' ',
       CAST(p_size AS VARCHAR), CAST(p_size AS VARCHAR), p_type, p_partkey * 2 + 1
FROM part WHERE p_type = 'LARGE'
"""

_TRANSCRIPTS = """
SELECT CASE WHEN source = 'src7' THEN 'note-' || CAST(doc_id AS VARCHAR) || '.txt'
            ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS file_name, text AS value
FROM documents
"""

_EVENTS = """
SELECT user_id, pid, pid * 7 + 11 AS author_id, exposed_time, user_id * 10 + pid AS author_fans_count,
       watch_time, duration, kind = 'purchase' AS cvm_like, kind = 'click' AS click, kind = 'view' AS comment,
       kind = 'signup' AS follow, kind = 'purchase' AND watch_time > 20 AS "collect", watch_time > 50 AS forward,
       kind = 'error' AS hate, kind || '-' || CAST(pid AS VARCHAR) AS title, p_hour, p_date,
       1 + pid % 4 AS tag_count, watch_time / duration AS watch_ratio, watch_time > duration AS is_rewatch_flagged,
       'batch-' || strftime(p_date, '%Y%m%d') AS ingest_batch_id
FROM (SELECT user_id, pid, exposed_time, watch_time, p_date, p_hour, kind,
             CAST(20 + pid % 60 AS DOUBLE) AS duration
      FROM (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pid,
                   CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS exposed_time,
                   CAST(floor(value) AS BIGINT) AS watch_time, CAST(ts AS DATE) AS p_date,
                   CAST(hour(ts) AS BIGINT) AS p_hour, event_type AS kind FROM events))
"""

_EVENTS2 = "SELECT * FROM ev UNION ALL SELECT * REPLACE (p_date + 1 AS p_date) FROM ev WHERE follow"

_BRIDGE = """
SELECT DISTINCT pid, category_id FROM (
  SELECT pid, pid % 25 AS category_id FROM ev UNION ALL SELECT pid, (pid * 3 + 1) % 25 FROM ev)
"""

_USERS = """
SELECT CAST(user_id AS BIGINT) AS user_id, gender, CAST(age AS BIGINT) AS age, CAST(mod_price AS BIGINT) AS mod_price,
       fre_city, fre_community_type, fre_city_level FROM user_attrs
"""

_LOG = """
SELECT 'batch-' || CAST(o_orderkey AS VARCHAR) AS batch_id, o_orderpriority AS source,
       CASE o_orderstatus WHEN 'O' THEN 'OK' WHEN 'P' THEN 'OK_WITH_WARNINGS' ELSE 'ERROR' END AS status,
       strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+00:00' AS logged_at, o_orderkey
FROM orders
"""

# ---- layers ---------------------------------------------------------------------------------

_TYPED = """
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(pid AS BIGINT) AS pid, CAST(author_id AS BIGINT) AS author_id,
       CAST(category_id AS BIGINT) AS category_id, CAST(exposed_time AS BIGINT) AS exposed_time,
       CAST(author_fans_count AS BIGINT) AS author_fans_count, CAST(watch_time AS BIGINT) AS watch_time,
       CAST(duration AS DOUBLE) AS duration, cvm_like = 'True' AS cvm_like, click = 'True' AS click,
       comment = 'True' AS comment, follow = 'True' AS follow, "collect" = 'True' AS "collect",
       forward = 'True' AS forward, hate = 'True' AS hate, tag_name, title, CAST(p_hour AS BIGINT) AS p_hour,
       CAST(strptime(p_date, '%Y%m%d') AS DATE) AS p_date, gender, CAST(age AS BIGINT) AS age,
       CAST(mod_price AS BIGINT) AS mod_price, fre_city, fre_community_type, fre_city_level,
       min(p_date) OVER (PARTITION BY user_id, pid, exposed_time) AS owner
FROM (SELECT DISTINCT * FROM raw)
"""

_STAGED = """
SELECT * EXCLUDE (rn, owner, tag_name, category_id), watch_time / duration AS watch_ratio,
       watch_time > duration AS is_rewatch_flagged
FROM (SELECT *, count(DISTINCT tag_name) OVER (PARTITION BY user_id, pid, exposed_time) AS tag_count,
        row_number() OVER (PARTITION BY user_id, pid, exposed_time
          ORDER BY p_hour, title, author_id, author_fans_count, watch_time, duration, cvm_like, click, comment,
                   follow, "collect", forward, hate, gender, age, mod_price, fre_city, fre_community_type,
                   fre_city_level) AS rn
      FROM typed WHERE strftime(p_date, '%Y%m%d') = owner)
WHERE rn = 1
"""

_PAIRS = "SELECT DISTINCT p_date, pid, category_id FROM typed WHERE strftime(p_date, '%Y%m%d') = owner"


def features(events: str) -> str:
    """Daily features of a sub-query with the event columns."""
    return f"""
SELECT user_id, p_date AS feature_date, CAST(sum(n) AS BIGINT) AS n_events, CAST(sum(w) AS BIGINT) AS total_watch_seconds,
       CAST(sum(le) AS BIGINT) AS late_night_events, CAST(sum(lw) AS BIGINT) AS late_night_watch_seconds,
       CASE WHEN sum(w) > 0 THEN CAST(sum(lw) AS DOUBLE) / CAST(sum(w) AS DOUBLE) END AS late_night_share,
       count(*) AS n_sessions, CAST(max(w) AS BIGINT) AS max_session_seconds,
       CAST(sum(w) AS DOUBLE) / count(*) AS avg_session_seconds, CAST(sum(h) AS BIGINT) AS hate_events,
       CAST(sum(h) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS hate_rate, CAST(sum(r) AS BIGINT) AS rewatch_events,
       CAST(sum(r) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS rewatch_rate
FROM (SELECT user_id, p_date, session_id, count(*) AS n, sum(watch_time) AS w,
             sum(CASE WHEN p_hour BETWEEN 2 AND 4 THEN 1 ELSE 0 END) AS le,
             sum(CASE WHEN p_hour BETWEEN 2 AND 4 THEN watch_time ELSE 0 END) AS lw,
             sum(CAST(hate AS INT)) AS h, sum(CAST(is_rewatch_flagged AS INT)) AS r
      FROM ({sessions(events)}) GROUP BY ALL)
GROUP BY user_id, p_date
"""


def sessions(events: str) -> str:
    return f"""
SELECT * EXCLUDE (prev_end, is_new), CAST(sum(is_new) OVER (PARTITION BY user_id, p_date ORDER BY exposed_time, pid
                                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
FROM (SELECT *, CASE WHEN prev_end IS NULL OR exposed_time - prev_end > 900 THEN 1 ELSE 0 END AS is_new
      FROM (SELECT *, max(exposed_time + watch_time) OVER (PARTITION BY user_id, p_date ORDER BY exposed_time, pid
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM {events}))
"""


_DIM_USERS = """
SELECT user_id, gender, age, mod_price, fre_city, fre_community_type, fre_city_level FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p_date DESC, exposed_time DESC, pid DESC) AS rn FROM staged)
WHERE rn = 1
"""

_DIM_VIDEOS = """
SELECT pid, author_id, title, duration FROM (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY title, author_id, duration, user_id, exposed_time) AS rn FROM staged)
WHERE rn = 1
"""

_DIM_CATS = """
SELECT CAST(category_level AS BIGINT) AS category_level, CAST(category_id AS BIGINT) AS category_id,
       regexp_replace(regexp_replace(category_name_cn, '^[\\s\\x{3000}]+', ''), '[\\s\\x{3000}]+$', '') AS category_name_cn,
       CAST(parent_id AS BIGINT) AS parent_id, CAST(root_id AS BIGINT) AS root_id,
       regexp_replace(regexp_replace(category_name_en, '^[\\s\\x{3000}]+', ''), '[\\s\\x{3000}]+$', '') AS category_name_en,
       n > 1 AS en_label_ambiguous
FROM (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY _file_seq) AS rn,
             count(*) OVER (PARTITION BY category_id) AS n FROM {lookup}) WHERE rn = 1
"""

_DIM_TRANSCRIPTS = """
SELECT CAST(regexp_extract(file_name, '^([0-9]+)\\.txt$', 1) AS BIGINT) AS pid, true AS has_transcript,
       CAST(len(regexp_extract_all(value, '[^\\s]+')) AS BIGINT) AS transcript_word_count
FROM transcripts WHERE regexp_matches(file_name, '^[0-9]+\\.txt$')
"""

_VIDEOS_FULL = """
SELECT v.*, t.pid IS NOT NULL AS has_transcript, t.transcript_word_count
FROM dim_videos v LEFT JOIN dim_transcripts t ON v.pid = t.pid
"""

PARTS = {
    "user_attrs": _USER_ATTRS, "fanout": _FANOUT, "raw": _RAW, "defects": _DEFECTS, "cats": _CATS,
    "part_cats": _PART_CATS, "transcripts": _TRANSCRIPTS, "ev": _EVENTS, "ev2": _EVENTS2, "bridge": _BRIDGE,
    "users_typed": _USERS, "log": _LOG, "typed": _TYPED, "staged": _STAGED, "pairs": _PAIRS,
    "feat": features("ev"), "staged_feat": features("staged"), "dim_users": _DIM_USERS, "dim_videos": _DIM_VIDEOS,
    "dim_cats": _DIM_CATS.replace("{lookup}", "cats"), "dim_part_cats": _DIM_CATS.replace("{lookup}", "part_cats"),
    "dim_transcripts": _DIM_TRANSCRIPTS, "videos_full": _VIDEOS_FULL,
    "dim_bridge": "SELECT DISTINCT pid, category_id FROM pairs",
}


def _needs(text):
    return [p for p in PARTS if re.search(rf"\b{p}\b", text)]


def with_inputs(query: str) -> str:
    """Prefix a statement with the input sub-queries it mentions, in dependency order."""
    order, open_names = [], []

    def visit(name):
        if name in order or name in open_names:
            return
        open_names.append(name)
        for dep in _needs(PARTS[name]):
            if dep != name:
                visit(dep)
        open_names.remove(name)
        order.append(name)

    for name in _needs(query):
        visit(name)
    if not order:
        return query.strip()
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n].strip()})" for n in order)
    return f"WITH {ctes}\n{query.strip()}"
