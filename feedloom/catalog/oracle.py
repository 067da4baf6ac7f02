"""The same queries as plain SQL for an independent engine.

Feed tables are common table expressions over the generated tables. Where the
Spark side folds steps together, the SQL keeps them literal: two separate joins
for a metric and its baseline, windows for first and last occurrence.
"""

from __future__ import annotations

from feedloom.catalog import queries as q
from feedloom.operators.facets import DIMENSIONS
from feedloom.plans import engage
from feedloom.plans.tabs import HOT_TAB_NAMES, METRIC_TAB_NAMES, SHORT_EXPIRY_TABS, TAB_METRICS
from feedloom.sources.testdata import CHANNEL_NAMES, CONTENT_HOST, REASONS, TAB_IDS, TITLE_PATTERN


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _names(column: str, names: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE {arms} END"


def _ctr(clicks: str, checks: str) -> str:
    """Half-up rounding to four places in integers."""
    return f"CAST(({clicks} * 20000 + {checks}) // (2 * {checks}) AS DOUBLE) / 10000"


def _outcomes(lines: str) -> str:
    """The runs one after another: by day, the control arm first, then by name."""
    return f"""
        SELECT day, arm, line_no, docid,
               CASE WHEN width < 2 THEN 'skip'
                    WHEN docid IN (SELECT docid FROM ledger) THEN 'dup'
                    WHEN docid IN (SELECT _id FROM reviews) THEN CASE WHEN in_run = 1 THEN 'exist' ELSE 'dup' END
                    WHEN over_all = 1 THEN 'succ' ELSE 'dup' END AS outcome, in_run
        FROM (SELECT *, row_number() OVER (PARTITION BY day, arm, width < 2, docid ORDER BY line_no) AS in_run,
                row_number() OVER (PARTITION BY width < 2, docid ORDER BY day, arm <> 'online', arm, line_no) AS over_all
              FROM {lines})"""


TABLES = {
    "ev": f"""
        SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS day,
               json_extract_string(props, '$.k') AS doc_id,
               CASE WHEN event_id % 10 < 5 THEN 'local_pop' WHEN event_id % 10 < 7 THEN 'evergreen'
                    WHEN event_id % 10 < 9 THEN 'global' END AS nr_condition
        FROM events""",
    "interactions": f"""
        SELECT e.user_id, doc_id, CAST(c_nationkey AS VARCHAR) AS nr_zip, day AS pdate,
               CAST(floor(epoch(ts)) AS BIGINT) AS sec,
               {_list(CHANNEL_NAMES)}[1 + event_id % 4] AS channel_name,
               {_list(TAB_IDS)}[1 + event_id % 25] AS channel_id,
               nr_condition,
               CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS joined,
               CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS checked,
               CASE WHEN NOT (event_id % 4 = 2 AND CAST(doc_id AS INT) % 25 = 12) THEN
                    CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END END AS clicked,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS shared,
               CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS thumbed_up,
               CAST(floor(value * 100) AS BIGINT) AS cv_time,
               CASE WHEN e.user_id % 50 <> 49 THEN
                    CASE WHEN e.user_id % 2 = 0 THEN 'ios' ELSE 'android' END END AS os,
               CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value) AS BIGINT) END AS cmt,
               CASE WHEN NOT (event_id % 13 = 0 OR CAST(doc_id AS INT) % 10 = 3)
                    THEN CAST(floor(value / 2) AS BIGINT) END AS likes
        FROM ev e JOIN customer ON c_custkey = e.user_id""",
    "zip_geo": """
        SELECT CAST(n_nationkey AS VARCHAR) AS id, CAST(n_regionkey AS VARCHAR) AS city_id FROM nation""",
    "docs": """
        SELECT doc_id AS d, CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, n_chars,
               TIMESTAMP '2024-01-31 00:00:00' - to_hours(doc_id % 48) AS publish_time
        FROM documents""",
    "snapshots": """
        SELECT *, unnest(CASE WHEN d % 6 = 1 THEN [0, 1] ELSE [0] END) AS back FROM docs""",
    "snapshots_latest": "SELECT * FROM snapshots WHERE back = 0",
    "local_facts": f"""
        SELECT * FROM interactions
        WHERE joined = 1 AND checked = 1 AND pdate >= DATE '2024-01-01'
          AND channel_name IN ('foryou', 'local') AND nr_condition LIKE '%local%'""",
    "page_urls": "SELECT page_id AS d, url FROM pages",
    "doc_static": """
        SELECT docs.doc_id AS _id, lang AS first_cat, source AS second_cat,
               CASE WHEN docs.d % 10 = 1 THEN lang ELSE 'len' || CAST(n_chars % 4 AS VARCHAR) END AS third_cat,
               CASE WHEN docs.d % 31 <> 4 THEN CAST(epoch(publish_time) AS BIGINT) END AS sec, url,
               CASE docs.d % 4 WHEN 0 THEN 'current' WHEN 1 THEN 'evergreen' WHEN 2 THEN 'short' END
                 AS timeliness_type,
               CASE WHEN docs.d % 6 <> 5 THEN '2024-0' || CAST(docs.d % 9 + 1 AS VARCHAR) || '-01' END
                 AS expire_time
        FROM docs LEFT JOIN page_urls ON page_urls.d = docs.d""",
    "doc_static_daily": """
        SELECT doc_id, publish_time,
               CASE d % 4 WHEN 0 THEN 'current' WHEN 1 THEN 'evergreen' WHEN 2 THEN 'short' END AS timeliness_type,
               (d % 10) / 10.0 AS is_news_score
        FROM docs""",
    "doc_profile": """
        SELECT doc_id, channel_id,
               coalesce(sum(CASE WHEN pdate >= DATE '2024-01-30' THEN checked END), 0) AS v1,
               coalesce(sum(CASE WHEN pdate >= DATE '2024-01-30' THEN clicked END), 0) AS c1,
               sum(checked) AS v2, sum(clicked) AS c2
        FROM interactions WHERE pdate >= DATE '2024-01-29' GROUP BY doc_id, channel_id""",
    "reviews": f"""
        SELECT CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 19 = 3 THEN '' ELSE '_from_foryou' END AS _id,
               doc_id % 37 <> 5 AS has_review,
               CASE WHEN doc_id % 37 <> 5 AND doc_id % 17 <> 0 THEN
                 CASE WHEN toxic = 1 THEN 'detrimental' WHEN quality = 1 THEN 'ok' ELSE 'poor' END END AS status,
               CASE WHEN doc_id % 37 = 5 THEN NULL WHEN doc_id % 9 = 4 THEN ''
                    WHEN doc_id % 5 <> 2 THEN {_list(REASONS)}[1 + doc_id % 3] END AS reason,
               CASE WHEN doc_id % 37 <> 5 AND doc_id % 5 <> 4
                    THEN 'editor' || CAST(doc_id % 5 AS VARCHAR) END AS editor
        FROM labels""",
    "lines": """
        SELECT event_id AS line_no, CAST(day AS VARCHAR) AS day,
               CASE WHEN event_id % 2 = 0 THEN 'online' ELSE 'exp' END AS arm,
               CASE WHEN event_id % 58 = 0 THEN 1 WHEN event_id % 29 = 0 THEN 8 ELSE 10 END AS width,
               CAST(user_id AS VARCHAR) AS uid,
               CASE WHEN event_id % 58 <> 0 THEN doc_id END AS docid,
               CAST(event_id % 25 AS VARCHAR) AS pos,
               CASE WHEN nr_condition LIKE 'local%' THEN 'True' ELSE 'False' END AS is_local,
               coalesce(nr_condition, 'null') AS condition,
               'https://example.com/' || doc_id AS url, 'example.com' AS domain, 'title ' || doc_id AS title,
               CAST(day AS VARCHAR) AS pub_time, '2024-01-31' AS run_date
        FROM ev""",
    "feed_dump": """
        SELECT event_id AS line_no, CAST(day AS VARCHAR) AS day, CAST(user_id AS VARCHAR) AS uid,
               CASE WHEN event_id % 2 = 0 THEN 'online' ELSE 'exp' END AS arm,
               CASE WHEN event_id % 41 = 0 THEN '{"documents":['
               ELSE '{"documents":[' || list_aggregate(list_transform([0, 1, 2], lambda s:
                   '{"docid":"' || CAST((CAST(doc_id AS INT) + s) % 100 AS VARCHAR) || '",' ||
                   CASE WHEN event_id % 37 = 5 THEN '"pos":"' || CAST(s AS VARCHAR) || '",'
                        WHEN event_id % 37 = 6 THEN '"pos":' || CAST(s AS VARCHAR) || '.5,'
                        WHEN event_id % 37 = 7 THEN '"pos":null,' WHEN event_id % 43 = 9 THEN ''
                        ELSE '"pos":' || CAST(s AS VARCHAR) || ',' END || '"contextMeta":' ||
                   CASE WHEN event_id % 10 = 9 THEN '{}'
                        WHEN (event_id + s) % 3 = 0 THEN '{"condition":"' || nr_condition || '"}'
                        ELSE '{"condition":"trending"}' END || '}'), 'string_agg', ',') || ']}' END AS body
        FROM ev""",
    "feed_docs": """
        SELECT * FROM (SELECT day, line_no, uid, arm, json_extract(body, '$.documents[*]') AS docs
                       FROM feed_dump WHERE json_valid(body))
        WHERE len(list_filter(docs, lambda x: NOT list_contains(json_keys(x), 'pos'))) = 0""",
    "items": """
        SELECT day, line_no AS dump_no, CAST(item_no AS INT) AS item_no, uid, arm,
               json_extract_string(d, '$.docid') AS docid,
               coalesce(json_extract_string(d, '$.pos'), 'None') AS pos,
               coalesce(json_extract_string(d, '$.contextMeta.condition') LIKE 'local%', false) AS is_local,
               coalesce(json_extract_string(d, '$.contextMeta.condition'), 'null') AS condition
        FROM (SELECT day, line_no, uid, arm, unnest(docs) AS d, unnest(range(len(docs))) AS item_no FROM feed_docs)
        WHERE coalesce(json_extract_string(d, '$.contextMeta.condition') LIKE 'local%', false) = false""",
    "doc_meta_json": f"""
        SELECT docid, CASE WHEN page_id % 43 = 11 THEN '{{' ELSE CAST(json_object('data',
                 CASE WHEN page_id % 19 = 7 THEN json_object(docid, rec, 'other', rec)
                      ELSE json_object(docid, rec) END) AS VARCHAR) END AS body
        FROM (SELECT page_id, CAST(page_id AS VARCHAR) AS docid,
                CASE WHEN page_id % 13 = 5 THEN json_object() ELSE json_object('static_feature', json_object(
                  'url', url, 'domain', CASE WHEN page_id % 17 <> 3 THEN split_part(url, '/', 3) END,
                  'stitle', regexp_extract(html, '{TITLE_PATTERN}', 1) || chr(9) || CAST(page_id AS VARCHAR),
                  'date', '2024-01-30 00:00:00')) END AS rec
              FROM pages)""",
    "metadata": """
        SELECT docid, meta_status,
               CASE meta_status WHEN 'ok' THEN json_extract_string(f, '$.url') WHEN 'null' THEN 'null' END AS url,
               CASE meta_status WHEN 'ok' THEN json_extract_string(f, '$.domain') WHEN 'null' THEN 'null' END
                 AS domain,
               CASE meta_status WHEN 'ok' THEN replace(json_extract_string(f, '$.stitle'), chr(9), ' ')
                 WHEN 'null' THEN 'null' END AS title,
               CASE meta_status WHEN 'ok' THEN json_extract_string(f, '$.date') WHEN 'null' THEN 'null' END
                 AS pub_time,
               CASE meta_status WHEN 'ok' THEN '2024-01-31' WHEN 'null' THEN 'null' END AS run_date
        FROM (SELECT docid, f, CASE WHEN body IS NULL THEN 'broken' WHEN f IS NULL THEN 'null'
                WHEN json_extract_string(f, '$.url') IS NULL OR json_extract_string(f, '$.domain') IS NULL
                  OR json_extract_string(f, '$.stitle') IS NULL OR json_extract_string(f, '$.date') IS NULL
                THEN 'broken' ELSE 'ok' END AS meta_status
              FROM (SELECT docid, body, CASE WHEN len(json_keys(body, '$.data')) = 1
                      THEN json_extract(body, '$.data.*.static_feature')[1] END AS f
                    FROM (SELECT docid, CASE WHEN json_valid(body) THEN body END AS body FROM doc_meta_json)))""",
    "display_doc": f"""
        SELECT docs.doc_id AS _id, CASE WHEN docs.d % 5 <> 0 THEN docs.d % 5 = 1 END AS mp_full_article,
               CASE WHEN docs.d % 7 <> 0 THEN strftime(publish_time, '%Y-%m-%d %H:%M:%S') END AS date,
               CASE WHEN docs.d % 6 <> 0 THEN 'title ' || docs.doc_id END AS title, url,
               CASE WHEN docs.d % 4 <> 0 THEN ['http://img.example.com/' || docs.doc_id || '/1.jpg',
                    'http://img.example.com/' || docs.doc_id || '/2.jpg'] END AS image_urls,
               CASE WHEN docs.d % 9 <> 0 THEN '{CONTENT_HOST}/a.png ' || text END AS content
        FROM docs LEFT JOIN page_urls ON page_urls.d = docs.d""",
    "ledger": "SELECT doc_id AS docid FROM docs WHERE d % 7 = 0",
    "update_lines": """
        SELECT d * 3 AS line_no, doc_id || chr(1) || 'short ' AS line FROM docs
        UNION ALL
        SELECT d * 3 + 1, doc_id || chr(1) || CASE WHEN d % 4 = 0 THEN 'evergreen' ELSE 'current' END FROM docs
        UNION ALL
        SELECT d * 3 + 2, doc_id || CASE WHEN d % 11 = 4 THEN chr(1) || 'short' || chr(1) || 'x' ELSE '' END
        FROM docs WHERE d % 11 IN (3, 4)""",
    "updates": """
        SELECT line_no, trim(f[1]) AS docid, trim(f[2]) AS timeliness
        FROM (SELECT line_no, string_split(trim(line), chr(1)) AS f FROM update_lines) WHERE len(f) = 2""",
    "ids": """
        SELECT doc_id AS id FROM docs UNION ALL SELECT 'gone' || doc_id FROM docs WHERE d % 10 = 0""",
    "search_index": "SELECT doc_id AS docid, 'old' AS timeliness_type FROM docs WHERE d % 3 <> 0",
    # Results several queries build on.
    "outcomes": _outcomes("lines"),
    "crawled": """
        SELECT day, arm, row_number() OVER (PARTITION BY day, arm ORDER BY dump_no, item_no) AS line_no, uid, i.docid,
               pos, CASE WHEN is_local THEN 'True' ELSE 'False' END AS is_local, condition,
               CASE WHEN m.docid IS NULL THEN i.docid ELSE url END AS url,
               CASE WHEN m.docid IS NULL THEN 'nullTitle' ELSE domain END AS domain,
               CASE WHEN m.docid IS NULL THEN 'nullPubTime' ELSE title END AS title, pub_time, run_date,
               CASE WHEN m.docid IS NULL THEN 8 WHEN meta_status = 'broken' THEN 5 ELSE 10 END AS width
        FROM items i LEFT JOIN metadata m ON m.docid = i.docid""",
    "crawl_outcomes": _outcomes("crawled"),
    "looked": """
        SELECT day, arm, line_no, CASE WHEN status IS NOT NULL THEN 'succ' ELSE 'error' END AS ret, docid,
               coalesce(status, 'null') AS status,
               CASE WHEN _id IS NULL THEN 'not_in_mongo' WHEN NOT has_review THEN 'no_review'
                    WHEN status IS NULL THEN 'no_status' ELSE coalesce(reason, 'null') END AS reason,
               coalesce(editor, 'null') AS editor
        FROM lines LEFT JOIN reviews ON _id = docid || '_from_foryou' WHERE width > 2""",
    "gate": """
        SELECT day, arm, count(*) AS line_cnt, count(*) FILTER (ret = 'succ') AS succ_cnt,
               count(*) FILTER (width <= 2) AS wrong_cnt, count(*) FILTER (width > 2 AND ret = 'error') AS empty_cnt,
               count(*) FILTER (width = 10) AS complete_cnt,
               count(*) FILTER (width <= 2 OR ret = 'error') / count(*) AS fail_ratio,
               count(*) FILTER (width <= 2 OR ret = 'error') / count(*) <= 0.8 AS passed
        FROM lines LEFT JOIN looked USING (day, arm, line_no) GROUP BY day, arm""",
    "labeled": """
        SELECT line_no, day, arm, uid, docid, pos, is_local, condition, url, domain, title, pub_time, run_date,
               coalesce(status, 'not_reviewed') AS status,
               CASE WHEN status IS NULL THEN '' ELSE coalesce(reason, 'null') END AS reason
        FROM lines LEFT JOIN reviews ON _id = docid || '_from_foryou' AND status IS NOT NULL
        WHERE width = 10 AND (day, arm) IN (SELECT (day, arm) FROM gate WHERE passed)""",
    "run_days": "SELECT day, arm FROM gate WHERE passed",
    "window1": "SELECT day AS win, day AS seen, * EXCLUDE (day) FROM labeled",
    "window7": """
        SELECT r.day AS win, l.day AS seen, l.* EXCLUDE (day)
        FROM run_days r JOIN labeled l ON l.arm = r.arm
          AND CAST(l.day AS DATE) BETWEEN CAST(r.day AS DATE) - 6 AND CAST(r.day AS DATE)""",
    "tab_docs": f"""
        SELECT {_names('channel_id', HOT_TAB_NAMES)} AS tab, doc_id, channel_id,
               sum(clicked) / nullif(sum(checked), 0) AS ctr,
               CAST(sum(checked) AS BIGINT) AS checks, CAST(sum(clicked) AS BIGINT) AS clicks
        FROM interactions
        WHERE pdate BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND channel_name = 'channelnew'
          AND joined = 1 AND checked = 1
        GROUP BY 1, 2, 3 HAVING sum(clicked) IS NOT NULL""",
    "smoothed": """
        SELECT t.*, coalesce(c1, 0) + coalesce(c1, 0) * CAST(0.5 AS DOUBLE) + 1 AS acc_click,
               coalesce(v1, 0) + coalesce(v2, 0) * CAST(0.5 AS DOUBLE) + 30 AS acc_check,
               (coalesce(c1, 0) + coalesce(c1, 0) * CAST(0.5 AS DOUBLE) + 1)
                 / (coalesce(v1, 0) + coalesce(v2, 0) * CAST(0.5 AS DOUBLE) + 30) AS acc_ctr
        FROM tab_docs t LEFT JOIN doc_profile p ON p.doc_id = t.doc_id AND p.channel_id = t.channel_id""",
    "users": """
        SELECT DISTINCT user_id, nr_zip FROM interactions
        WHERE pdate BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND channel_name = 'foryou'""",
    "sample": f"""
        SELECT user_id, nr_zip FROM users
        ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR), coalesce(nr_zip, ''), '{q.SAMPLE_SEED}')), user_id, nr_zip
        LIMIT {q.SAMPLE}""",
    "last_updates": """
        SELECT docid, timeliness FROM updates
        QUALIFY row_number() OVER (PARTITION BY docid ORDER BY line_no DESC) = 1""",
    "synced": """
        SELECT docid, timeliness,
               CASE WHEN docid IN (SELECT docid FROM search_index) THEN 'succ_update_es' ELSE 'none' END AS msg
        FROM last_updates""",
}

_CATEGORIES = {
    "channel": "unnest(CASE WHEN d % 29 = 3 THEN [] ELSE [lang, source] END)",
    "first_cat": "lang",
    "second_cat": "source",
}
for _s in ("", "_latest"):
    TABLES[f"doc_geo{_s}"] = f"""
        SELECT doc_id, back, publish_time, 'city' AS type,
               CASE WHEN d % 23 <> 7 THEN 'p' || CAST((d + back) % 5 AS VARCHAR)
                    || CASE WHEN d % 97 = 13 THEN chr(9) ELSE '' END END AS pid
        FROM snapshots{_s} WHERE d % 17 NOT IN (2, 9)
        UNION ALL
        SELECT doc_id, back, publish_time, CASE WHEN d % 3 = 0 THEN 'state' ELSE 'county' END,
               'q' || CAST(d % 7 AS VARCHAR) FROM snapshots{_s} WHERE d % 17 NOT IN (2, 9)"""
for _name, _s in [(d, s) for d in DIMENSIONS for s in ("", "_latest")]:
    _d = _name + _s
    TABLES[f"doc_cat_{_d}"] = f"SELECT doc_id, back, {_CATEGORIES[_name]} AS category FROM snapshots{_s}"
    TABLES[f"keys_{_d}"] = f"""
        SELECT category || '@' || type || '@' || pid AS list_key, g.doc_id, publish_time
        FROM doc_geo{_s} g JOIN doc_cat_{_d} c ON c.doc_id = g.doc_id AND c.back = g.back
        WHERE type <> 'state' AND pid IS NOT NULL AND category IS NOT NULL"""
    TABLES[f"top_{_d}"] = f"""
        SELECT t.list_key, t.doc_id, t.ctr, t.checks, t.clicks, b.list_key AS base_key, b.ctr AS base_ctr,
               b.checks AS base_checks, b.clicks AS base_clicks
        FROM (SELECT list_key, f.doc_id, {_ctr('sum(clicked)', 'sum(checked)')} AS ctr,
                     CAST(sum(checked) AS BIGINT) AS checks, CAST(sum(clicked) AS BIGINT) AS clicks
              FROM local_facts f LEFT JOIN keys_{_d} k ON k.doc_id = f.doc_id
              WHERE list_key IS NOT NULL GROUP BY list_key, f.doc_id) t
        LEFT JOIN (SELECT list_key, {_ctr('sum(clicked)', 'sum(checked)')} AS ctr,
                     CAST(sum(checked) AS BIGINT) AS checks, CAST(sum(clicked) AS BIGINT) AS clicks
              FROM local_facts f LEFT JOIN keys_{_d} k ON k.doc_id = f.doc_id
              WHERE list_key IS NOT NULL GROUP BY list_key) b ON b.list_key = t.list_key
        WHERE t.checks >= {q.MIN_CHECK} AND t.ctr >= b.ctr
"""
    TABLES[f"top_kv_{_d}"] = f"""
        SELECT list_key AS key, CAST(count(*) AS INT) AS size, string_agg(doc_id, '#' ORDER BY rk) AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY list_key ORDER BY ctr DESC, doc_id) AS rk FROM top_{_d})
        WHERE rk <= {q.TOP_LIST_SIZE} GROUP BY list_key"""
    TABLES[f"new_{_d}"] = f"""
        SELECT list_key AS key, CAST(count(DISTINCT doc_id) AS INT) AS size,
               string_agg(DISTINCT doc_id, '#' ORDER BY doc_id) AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY list_key ORDER BY publish_time DESC, doc_id) AS rk
              FROM keys_{_d}
              WHERE CAST(publish_time AS DATE) >= DATE '2024-01-28'
                AND publish_time >= TIMESTAMP '2024-01-29 00:00:00')
        WHERE rk < 20 GROUP BY list_key"""
    _sums = f"""{_ctr('sum(clicked)', 'sum(checked)')} AS ctr,
               CAST(sum(checked) AS BIGINT) AS checks, CAST(sum(clicked) AS BIGINT) AS clicks,
               count(DISTINCT f.doc_id) AS docs, count(DISTINCT user_id) AS users"""
    TABLES[f"city_{_d}"] = f"""
        SELECT city_id, category, {_sums}
        FROM local_facts f LEFT JOIN doc_cat_{_d} c ON c.doc_id = f.doc_id LEFT JOIN zip_geo z ON z.id = f.nr_zip
        WHERE city_id IS NOT NULL GROUP BY city_id, category"""
    TABLES[f"cross_{_d}"] = f"""
        SELECT t.*, b.ctr AS base_ctr, b.checks AS base_checks, b.clicks AS base_clicks, b.docs AS base_docs,
               b.users AS base_users
        FROM (SELECT city_id, category, type_pid, {_sums}
              FROM local_facts f
              LEFT JOIN (SELECT g.doc_id, category, CASE WHEN pid IS NOT NULL THEN type || '@' || pid END AS type_pid
                         FROM doc_geo{_s} g JOIN doc_cat_{_d} c ON c.doc_id = g.doc_id AND c.back = g.back
                         WHERE type <> 'state') k
                ON k.doc_id = f.doc_id
              LEFT JOIN zip_geo z ON z.id = f.nr_zip
              WHERE city_id IS NOT NULL GROUP BY city_id, category, type_pid) t
        LEFT JOIN city_{_d} b ON b.city_id = t.city_id AND b.category = t.category
        WHERE b.users >= {q.MIN_USERS} AND t.ctr > b.ctr AND t.checks >= {q.MIN_CHECK}
"""
    TABLES[f"cross_kv_{_d}"] = f"""
        SELECT key, (rk - 1) // 1000 AS part, (any_value(n) + 999) // 1000 AS n_parts, CAST(count(*) AS INT) AS size,
               string_agg(coalesce(type_pid, '\\N'), '#' ORDER BY rk) AS value
        FROM (SELECT *, city_id || '@' || category AS key, count(*) OVER (PARTITION BY city_id, category) AS n,
                row_number() OVER (PARTITION BY city_id, category ORDER BY ctr DESC, type_pid NULLS FIRST) AS rk
              FROM cross_{_d}) GROUP BY key, (rk - 1) // 1000"""


def _engaged(scope: str) -> str:
    if scope == "local":
        return """
            SELECT doc_id, CAST(coalesce(max(cmt), 0) AS DOUBLE) AS cmts,
                   CAST(coalesce(max(likes), 0) AS DOUBLE) AS likes
            FROM interactions
            WHERE pdate BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND joined = 1
              AND channel_name IN ('foryou', 'local') AND nr_condition LIKE 'local%' GROUP BY doc_id"""
    return """
        SELECT doc_id, CAST(max(cmt) AS DOUBLE) AS cmts, CAST(max(likes) AS DOUBLE) AS likes
        FROM interactions
        WHERE pdate BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND joined = 1
          AND channel_name = 'foryou' AND nr_condition NOT LIKE 'local%'
        GROUP BY doc_id HAVING max(cmt) > 10 AND max(likes) IS NOT NULL"""


for _scope, _size in (("local", engage.LOCAL_LIST_SIZE), ("nonlocal", engage.NONLOCAL_LIST_SIZE)):
    TABLES[f"listed_{_scope}"] = f"""
        SELECT unnest([first_cat, second_cat, third_cat]) AS category, doc_id, cmts, likes
        FROM ({_engaged(_scope)}) e JOIN doc_static ON _id = doc_id"""
    for _by in ("cmts", "likes"):
        TABLES[f"engaged_{_scope}_{_by}"] = f"""
            SELECT category, doc_id, cmts, likes, CAST(rk AS INT) AS rk
            FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {_by} DESC, doc_id) AS rk
                  FROM listed_{_scope}) WHERE rk <= {_size}"""


def _metrics(keys: str, source: str) -> str:
    return f"""
        SELECT CAST(pdate AS VARCHAR) AS pdate, {keys}, count(DISTINCT user_id) AS dau,
               CAST(sum(clicked) AS BIGINT) AS clicks, CAST(sum(checked) AS BIGINT) AS checks,
               CAST(sum(shared) AS BIGINT) AS shares,
               sum(clicked) / nullif(sum(checked), 0) AS ctr, sum(shared) / nullif(sum(clicked), 0) AS str1,
               sum(shared) / nullif(sum(checked), 0) AS str2,
               sum(clicked) / nullif(count(DISTINCT user_id), 0) AS click_pu,
               sum(checked) / nullif(count(DISTINCT user_id), 0) AS check_pu,
               sum(shared) / nullif(count(DISTINCT user_id), 0) AS share_pu,
               sum(thumbed_up) / nullif(count(DISTINCT user_id), 0) AS up_pu
        FROM ({source}) GROUP BY ALL"""


_CHECKED = """FROM interactions
    WHERE pdate BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND joined = 1 AND checked = 1"""
TABLES["tab_metrics"] = _metrics(
    "tab, os",
    f"""SELECT * FROM (SELECT *, {_names('channel_id', METRIC_TAB_NAMES)} AS tab {_CHECKED}
        AND (channel_name = 'channelnew' OR (channel_name = 'channel' AND channel_id = 'k26164')))
        WHERE tab IS NOT NULL""",
)
TABLES["tab_totals"] = _metrics("'tot' AS tab, os", f"SELECT * {_CHECKED} AND channel_name = 'channelnew'")

_USABLE = "status <> 'not_reviewed' AND trim(reason) <> ''"


def _summary(window: str) -> str:
    return f"""
        SELECT win AS day, arm, count(*) AS total_cnt, count(*) FILTER ({_USABLE}) AS succ_cnt,
               count(*) FILTER (NOT ({_USABLE})) AS wrong_cnt,
               count(DISTINCT docid) FILTER ({_USABLE}) AS uniq_doc_cnt,
               count(*) FILTER ({_USABLE}) / count(*) AS succ_rate
        FROM {window} GROUP BY win, arm"""


def _share(counts: str, whole: str) -> str:
    return f"SELECT *, cnt / sum(cnt) OVER (PARTITION BY {whole}) AS rate FROM ({counts})"


def _status(window: str) -> str:
    return _share(
        f"SELECT win AS day, arm, status, count(*) AS cnt FROM {window} WHERE {_USABLE} GROUP BY ALL", "day, arm"
    )


def _status_reason(window: str) -> str:
    return _share(
        f"SELECT win AS day, arm, status, reason, count(*) AS cnt FROM {window} WHERE {_USABLE} GROUP BY ALL",
        "day, arm, status",
    )


def _unique_status(window: str) -> str:
    return _share(
        f"""SELECT win AS day, arm, status, count(*) AS cnt
            FROM (SELECT * FROM {window} WHERE {_USABLE}
                  QUALIFY row_number() OVER (PARTITION BY win, arm, docid ORDER BY seen DESC, line_no) = 1)
            GROUP BY ALL""",
        "day, arm",
    )


for _r in (1, 7):
    TABLES[f"summary{_r}"] = _summary(f"window{_r}")
    TABLES[f"status{_r}"] = _status(f"window{_r}")
    TABLES[f"unique{_r}"] = _unique_status(f"window{_r}")


def _review_points(days: int) -> str:
    prefix = "feed_quanlity_check_" + ("" if days == 1 else f"{days}d_")
    cells = [
        (f"summary{days}", "'_count_total'", "total_cnt"),
        (f"summary{days}", "'_count_succ'", "succ_cnt"),
        (f"summary{days}", "'_count_wrong'", "wrong_cnt"),
        (f"summary{days}", "'_count_succ_uniq_doc'", "uniq_doc_cnt"),
        (f"summary{days}", "'_rate_succ'", "succ_rate"),
    ]
    for table, infix in ((f"status{days}", "status_"), (f"unique{days}", "uniqdoc_status_")):
        known = f"(SELECT * FROM {table} WHERE status IN ('ok', 'poor', 'detrimental'))"
        cells += [(known, f"'_count_{infix}' || status", "cnt"), (known, f"'_rate_{infix}' || status", "rate")]
    return " UNION ALL ".join(
        f"""SELECT '{prefix}' || arm || {what} AS metric, CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) AS ts,
                   CAST({value} AS DOUBLE) AS value, 'batch' AS client FROM {table}"""
        for table, what, value in cells
    )


def _metric_points() -> str:
    points = " UNION ALL ".join(
        f"""SELECT 'tabmetric.{m}.' || os || '.' || tab AS metric,
                   CAST(epoch(CAST(pdate AS TIMESTAMP)) AS BIGINT) AS ts, CAST({m} AS DOUBLE) AS value,
                   '{q.METRIC_HOST}' AS host FROM complete"""
        for m in TAB_METRICS
    )
    present = " AND ".join(f"{c} IS NOT NULL" for c in ("os", *TAB_METRICS))
    return f"""
        SELECT * FROM (WITH complete AS (SELECT * FROM (SELECT * FROM tab_metrics UNION ALL SELECT * FROM tab_totals)
                                         WHERE {present}) {points})"""


def _merged(kind: str, prefix: str) -> str:
    variants = " UNION ALL ".join(
        f"SELECT key, value, {turn} AS turn FROM {kind}_{d}" for turn, d in enumerate(q.VARIANT_ORDER)
    )
    return f"""
        SELECT '{prefix}@' || f[1] AS key, f[2] AS value, 86400 AS ttl_sec
        FROM (SELECT string_split(trim(key || chr(9) || value, ' ' || chr(9)), chr(9)) AS f FROM ({variants})
              QUALIFY row_number() OVER (PARTITION BY key ORDER BY turn DESC) = 1)
        WHERE len(f) = 2"""


def _editor(source: str, doc_type: str) -> str:
    count = "count(*) FILTER (status = '{0}')"
    cells = ", ".join(f"{count.format(s)} AS {s}" for s in ("ok", "poor", "detrimental"))
    rates = ", ".join(f"{count.format(s)} / count(*) AS {s}_rate" for s in ("ok", "poor", "detrimental"))
    return f"""
        SELECT day, arm, '{doc_type}' AS type, editor, count(*) AS total, {cells}, {rates}
        FROM ({source}) GROUP BY day, arm, editor"""


def _hash_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS key, category || '#0/1' AS field,
                   '[' || string_agg('{{"docId":"' || doc_id || '","likes":' || CAST(likes AS VARCHAR)
                        || ',"cmts":' || CAST(cmts AS VARCHAR) || '}}', ',' ORDER BY rk) || ']' AS value,
                   15552000 AS ttl_sec
            FROM engaged_{scope}_{by} GROUP BY category"""
        for (scope, by), name in engage.HASH_NAMES.items()
    )


_SHORT = ", ".join(f"'{t}'" for t in SHORT_EXPIRY_TABS)
_RANKED = f"""row_number() OVER (PARTITION BY channel_id
    ORDER BY checks < {q.LOW_CHECK}, acc_ctr DESC, doc_id) AS rk"""

BODIES: dict[str, str] = {
    "city_category_ctr": "SELECT * FROM city_channel",
    "cross_geo_kv": "SELECT * FROM cross_kv_channel",
    "geo_top_docs_kv": "SELECT * FROM top_kv_channel",
    "kv_size_stats": """
        SELECT count(*) AS keys, CAST(sum(size) AS BIGINT) AS total_size, CAST(max(size) AS BIGINT) AS max_size,
               (SELECT key FROM top_kv_channel ORDER BY size DESC, key LIMIT 1) AS max_key, avg(size) AS avg_size
        FROM top_kv_channel""",
    "geo_kv_merged": _merged("top_kv", q.TOP_PREFIX),
    "geo_new_kv_merged": _merged("new", q.NEW_PREFIX),
    "publish_gate": " UNION ALL ".join(
        f"""SELECT 'geo_{kind}_docs_{d}' AS list_name, count(*) AS result_rows, count(*) >= 100 AS publish
            FROM {kind}_{d}"""
        for kind in ("new", "top")
        for d in DIMENSIONS
    ),
    "kv_publish": f"""
        SELECT '{q.CROSS_PREFIX["first_cat"]}@' || f[1] AS key, f[2] AS value, 86400 AS ttl_sec
        FROM (SELECT string_split(trim(key || '#' || CAST(part AS VARCHAR) || '/' || CAST(n_parts AS VARCHAR)
                || chr(9) || value, ' ' || chr(9)), chr(9)) AS f FROM cross_kv_first_cat) WHERE len(f) = 2""",
    "local_top_comments": "SELECT * FROM engaged_local_cmts",
    "local_top_likes": "SELECT * FROM engaged_local_likes",
    "nonlocal_top_comments": "SELECT * FROM engaged_nonlocal_cmts",
    "nonlocal_top_likes": "SELECT * FROM engaged_nonlocal_likes",
    "hash_publish": _hash_rows(),
    "tab_doc_ctr": "SELECT * FROM tab_docs",
    "tab_smoothed_ctr": "SELECT * FROM smoothed",
    "hot_tab_docs": f"SELECT *, {_RANKED} FROM smoothed",
    "hot_tab_docs_fresh": f"""
        SELECT *, {_RANKED} FROM (
          SELECT s.*, (1706659200 - coalesce(sec, 0)) / 86400.0 AS age_days
          FROM smoothed s LEFT JOIN doc_static ON _id = s.doc_id)
        WHERE age_days <= CASE WHEN channel_id IN ({_SHORT}) THEN 0.5 ELSE 1.5 END""",
    "hot_tab_publish": f"""
        SELECT 'tabHotDocs#2d' AS key,
               channel_id || '#' || CAST((rk - 1) // 1000 AS VARCHAR) || '/'
                 || CAST((any_value(n) + 999) // 1000 AS VARCHAR) AS field,
               '[' || string_agg('{{"docId":"' || doc_id || '","tabId":"' || channel_id || '","ctr":'
                 || CAST(acc_ctr AS VARCHAR) || ',"click":' || CAST(acc_click AS VARCHAR) || ',"check":'
                 || CAST(acc_check AS VARCHAR) || '}}', ',' ORDER BY rk) || ']' AS value, 15552000 AS ttl_sec
        FROM (SELECT *, count(*) OVER (PARTITION BY channel_id) AS n, {_RANKED} FROM smoothed)
        GROUP BY channel_id, (rk - 1) // 1000""",
    "tab_metrics": "SELECT * FROM tab_metrics",
    "tab_metrics_total": "SELECT * FROM tab_totals",
    "tab_metric_points": _metric_points(),
    "user_sample_hashed": "SELECT * FROM sample",
    "sample_arm_grid": """
        SELECT user_id, nr_zip, arm, bucket FROM sample,
          (VALUES ('online', ''), """
    + ", ".join(f"('{a}', '{b}')" for a, b in zip(q.ARM_LABELS, q.ARM_BUCKETS))
    + ") AS arms(arm, bucket)",
    "feed_items": "SELECT * FROM items",
    "doc_metadata": "SELECT * FROM metadata",
    "crawl_rows": "SELECT * FROM crawled",
    "crawl_enqueue": """
        SELECT day, arm, docid, line_no, outcome FROM crawl_outcomes WHERE outcome <> 'skip' AND in_run = 1""",
    "user_sample": f"""
        SELECT least(count(*), {q.SAMPLE}) AS users, least(count(*), {q.SAMPLE}) AS distinct_users,
               least(count(*), {q.SAMPLE}) AS in_pool FROM users""",
    "index_sync_lines": """
        SELECT count(*) AS lines, count(*) FILTER (len(string_split(trim(line), chr(1))) <> 2) AS left_out
        FROM update_lines""",
    "assess_dedupe": f"""
        SELECT * FROM lines WHERE width >= 2 QUALIFY row_number() OVER (PARTITION BY docid ORDER BY line_no) = 1
        ORDER BY line_no LIMIT {q.ASSESS_DOCS + 1}""",
    "review_enqueue": "SELECT day, arm, line_no, docid, outcome FROM outcomes",
    "review_enqueue_counts": """
        SELECT day, arm, count(*) FILTER (outcome = 'succ') AS succ_num, count(*) FILTER (outcome = 'exist') AS exist_num,
               count(*) FILTER (outcome = 'dup') AS dup_num, count(*) FILTER (outcome = 'skip') AS skip_num
        FROM outcomes GROUP BY day, arm""",
    "review_messages": """
        SELECT docid AS key,
               '{"docid":"' || docid || '","queue":"quality_check","tag":["from_foryou"]}' AS value
        FROM outcomes WHERE outcome = 'succ'""",
    "review_ledger_rows": """
        SELECT docid, 'from=' || day || '.' || arm AS source FROM outcomes WHERE outcome = 'succ'""",
    "review_run_ledger": """
        SELECT docid, 'from=' || day || '.' || arm AS source,
               'r' || CAST(least((CAST(day[9:10] AS INT) - 1) // 10, 2) AS VARCHAR) AS run
        FROM outcomes WHERE outcome = 'succ'""",
    "review_payload": f"""
        SELECT _id, 'quality_check' AS type, coalesce(mp_full_article, false) AS mp_full_article,
               coalesce(date, '') AS date, coalesce(title, '') AS title,
               CASE WHEN mp_full_article THEN replace('{q.ARTICLE_URL}', '{{}}', _id) ELSE coalesce(url, '') END AS url,
               coalesce(array_to_string(list_transform(image_urls, lambda u: '{q.IMAGE_PROXY}' || u), ' '), '') AS image_urls,
               replace(coalesce(content, ''), '{CONTENT_HOST}', '{q.NEW_HOST}') AS content,
               '2024-01-31 00:00:00' AS insert_time
        FROM display_doc""",
    "review_lookup": "SELECT * FROM looked",
    "review_gate": "SELECT * FROM gate",
    "review_labeled": "SELECT * FROM labeled",
    "editor_weighted": _editor("SELECT * FROM looked WHERE ret = 'succ'", "weighted_doc"),
    "editor_unique": _editor(
        "SELECT DISTINCT day, arm, editor, status, docid FROM looked WHERE ret = 'succ'", "uniq_doc"
    ),
    "review_summary": _summary("window1"),
    "review_status": _status("window1"),
    "review_status_reason": _status_reason("window1"),
    "review_unique_status": _unique_status("window1"),
    "review_7d": _summary("window7"),
    "review_7d_status": _status("window7"),
    "review_7d_status_reason": _status_reason("window7"),
    "review_7d_unique_status": _unique_status("window7"),
    "review_metric_points": _review_points(1) + " UNION ALL " + _review_points(7),
    "user_history": """
        SELECT user_id, CAST(0 AS BIGINT) AS part, CAST(1 AS BIGINT) AS n_parts, string_agg(item, chr(9) ORDER BY item) AS doc_items
        FROM (SELECT DISTINCT user_id, f.doc_id || '|' || CAST(sec AS VARCHAR) AS item
              FROM interactions f LEFT JOIN doc_static_daily s ON s.doc_id = f.doc_id
              WHERE joined = 1 AND checked = 1 AND cv_time >= 2000 AND channel_name IN ('foryou', 'local')
                AND user_id > 0 AND pdate BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
                AND (timeliness_type IN ('current', 'evergreen') OR is_news_score < 0.5
                     OR nr_condition LIKE '%evergreen%')
                AND CAST(publish_time AS DATE) BETWEEN DATE '2023-08-01' AND DATE '2024-01-31')
        GROUP BY user_id""",
    "index_sync_outcome": "SELECT * FROM synced",
    "index_sync_counts": """
        SELECT count(*) AS total, count(*) FILTER (msg <> 'none') AS in_es,
               count(*) FILTER (msg <> 'none') AS succ_update_es FROM synced""",
    "index_sync_snapshot": """
        SELECT i.docid, coalesce(timeliness, timeliness_type) AS timeliness_type
        FROM search_index i LEFT JOIN last_updates u ON u.docid = i.docid""",
    "index_snapshot_merged": """
        SELECT i.docid, coalesce(CASE WHEN CAST(i.docid AS BIGINT) % 3 = 1 THEN 'again ' ELSE '' END || timeliness,
                                 timeliness_type) AS timeliness_type
        FROM search_index i LEFT JOIN last_updates u ON u.docid = i.docid""",
    "reindex_messages": """
        SELECT docid AS key, '{"docId":"' || docid || '","url":"' || coalesce(url, '') || '"}' AS value
        FROM synced LEFT JOIN doc_static ON _id = docid WHERE msg = 'none'""",
    "timeliness_lookup": """
        SELECT id AS _id, CASE WHEN _id IS NULL THEN 'failed' ELSE 'success' END AS status,
               coalesce(timeliness_type, '') AS timeliness_type, coalesce(expire_time, '') AS expire_time
        FROM ids LEFT JOIN (SELECT * FROM doc_static
          WHERE timeliness_type IS NOT NULL AND expire_time IS NOT NULL) ON _id = id""",
}
BODIES["user_history_by_days"] = BODIES["user_history"]
BODIES["index_sync_text"] = BODIES["index_sync_outcome"]
BODIES["feed_items_json"] = BODIES["feed_items"]
BODIES["reindex_messages_from_log"] = BODIES["reindex_messages"]
BODIES["crawl_paste"] = """
    SELECT row_number() OVER (ORDER BY line_no) AS line_no,
           uid || chr(9) || pos || chr(9)
             || CASE WHEN line_no <= 0.9 * max(line_no) OVER () THEN title || chr(9) || url ELSE '' END AS value,
           line_no <= 0.9 * max(line_no) OVER () AS paired
    FROM lines"""
BODIES["kv_store_alive"] = f"""
    SELECT key, '' AS field, value, CAST(1000 + ttl_sec AS BIGINT) AS expires_at FROM ({BODIES["geo_kv_merged"]})
    UNION ALL
    SELECT key, field, value, CAST(ttl_sec AS BIGINT) FROM ({BODIES["hot_tab_publish"]})"""
BODIES["publish_gate_observed"] = BODIES["publish_gate"]
BODIES["geo_top_docs_channel_bucketed"] = "SELECT * FROM top_channel"
for _d in DIMENSIONS:
    BODIES[f"cross_geo_{_d}"] = f"SELECT * FROM cross_{_d}"
    BODIES[f"cross_geo_{_d}_states"] = f"SELECT * FROM cross_{_d}"
    BODIES[f"geo_top_docs_{_d}"] = f"SELECT * FROM top_{_d}"
    BODIES[f"geo_new_docs_{_d}"] = f"SELECT * FROM new_{_d}"
    for _kind, _table in (("cross_geo", "cross"), ("geo_top_docs", "top"), ("geo_new_docs", "new")):
        BODIES[f"{_kind}_{_d}_latest"] = f"SELECT * FROM {_table}_{_d}_latest"


def _mentions(sql: str, table: str) -> bool:
    padded = sql.replace("(", " ").replace(")", " ").replace(",", " ").replace("\n", " ")
    words = padded.split()
    return any(w == table and words[i - 1].upper() in ("FROM", "JOIN") for i, w in enumerate(words))


def _statement(body: str) -> str:
    """Prefix the body with the tables it needs, dependencies first."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name, text in TABLES.items():
            if name not in ordered and _mentions(sql, name):
                visit(text)
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    ctes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body


ORACLE_SQL: dict[str, str] = {name: _statement(body) for name, body in BODIES.items()}
