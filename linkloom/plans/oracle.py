"""DuckDB SQL that computes what each registered query computes.

Views ``pages``, ``part``, ``conversations`` ... are registered by the caller.
The page anchors in the driver's tables are all plain ``<a href="..">text</a>``
with root-relative hrefs and no entities, so a regex extraction and a
scheme://host + path resolution are exact for them (the Spark side runs the
full parser and resolver).  Rule patterns are the same strings as the Spark
side's; only the regex flag syntax differs.
"""

from __future__ import annotations

from ..config import TAXONOMY, TRACKING_PARAM_PREFIXES, rule_pack
from .catalog import PAGES_ROOT, SHOP, SHOP_ROOT
from .forms import PATH_RULES, forms_sql, implied_sql, markup_sql

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_NETLOC = r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://([^/?#]*))?"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(url: str, rules, force_i: bool = False) -> str:
    parts = []
    for label, pat, flags in rules:
        opt = "'i'" if (force_i or "IGNORECASE" in {f.upper() for f in flags}) else "''"
        parts.append(f"WHEN regexp_matches({url}, {_q(pat)}, {opt}) THEN {_q(label)}")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


ANCHORS = f"""
a0 AS (
  SELECT page_id, url AS page_url,
         regexp_extract_all(html, '<a href="([^"]*)">', 1) AS h,
         regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS t
  FROM pages),
anchors AS (
  SELECT page_id, page_url, CAST(unnest(generate_series(1, len(h))) AS INTEGER) AS pos,
         unnest(h) AS href, unnest(t) AS txt
  FROM a0),
resolved AS (
  SELECT page_id, page_url, pos, href,
         NULLIF(trim(regexp_replace(txt, '[ \\t\\r\\n]+', ' ', 'g')), '') AS anchor_text,
         CAST(NULL AS VARCHAR) AS rel,
         CASE WHEN href IS NULL OR href = '' THEN NULL
              ELSE lower(regexp_extract(page_url, {_q(_SCHEME)}, 1)) || '://'
                   || lower(regexp_extract(page_url, {_q(_HOST)}, 1))
                   || regexp_replace(href, '/{{2,}}', '/', 'g') END AS normalized_url
  FROM anchors),
per_page AS (
  SELECT * FROM resolved WHERE normalized_url IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY page_id, normalized_url ORDER BY pos) = 1),
run AS (
  SELECT * FROM per_page
  QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id, pos) = 1)
"""


def _shop_cte() -> str:
    k = "CAST(p_partkey AS VARCHAR)"
    n = "replace(p_name, ' ', '-')"
    shapes = [
        f"{_q(SHOP + '/')} || {n} || '-p-HBV' || {k}",
        f"{_q(SHOP + '/')} || {n} || '-c-' || {k}",
        f"{_q(SHOP + '/kampanyalar/')} || {k}",
        f"{_q(SHOP + '/magaza/')} || {n}",
        f"{_q(SHOP + '/marka/')} || {n} || '?k=' || {k}",
        _q(SHOP + "/yardim"),
        f"{_q(SHOP + '/kargo-')} || {k}",
        f"{_q(SHOP + '/ara?q=')} || {n}",
        _q(SHOP + "/giris"),
        _q(SHOP + "/"),
        f"'/' || {n} || '-p-HBV' || {k}",
    ]
    whens = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(shapes))
    return f"""
shop0 AS (
  SELECT p_partkey AS id, p_name, p_size,
         CASE p_partkey % 12 {whens} ELSE NULL END AS url
  FROM part),
shop AS (
  SELECT id, url, p_name AS anchor_text, p_size,
         CASE WHEN p_size > 40 THEN 'nofollow' END AS rel,
         coalesce(NOT ends_with(regexp_extract(url, {_q(_NETLOC)}, 1), {_q(SHOP_ROOT)}), false) AS is_external
  FROM shop0),
classified AS (
  SELECT *, CASE WHEN url IS NULL THEN NULL ELSE {_case('url', rule_pack(SHOP_ROOT))} END AS pred_category
  FROM shop)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


def _tracking_filter(var: str) -> str:
    return " OR ".join(f"starts_with({var}.k, {_q(p)})" for p in TRACKING_PARAM_PREFIXES)


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


LINKS_NORMALIZE = f"""
WITH p AS (
  SELECT page_id, url,
         lower(regexp_extract(url, {_q(_SCHEME)}, 1)) AS s,
         lower(regexp_extract(url, {_q(_HOST)}, 1)) AS n,
         regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1),
                        ';[^/]*$', ''), '/{{2,}}', '/', 'g') AS path,
         regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q
  FROM pages),
q AS (
  SELECT *, array_to_string(list_transform(list_filter(list_transform(
            list_filter(string_split(q, '&'), lambda x: x <> ''),
            lambda x: {{'k': {_dec("split_part(x, '=', 1)")},
                        'v': {_dec("CASE WHEN strpos(x, '=') > 0 THEN substr(x, strpos(x, '=') + 1) ELSE '' END")}}}),
            lambda p: NOT ({_tracking_filter('p')})),
            lambda p: {_enc('p.k')} || '=' || {_enc('p.v')}), '&') AS q2
  FROM p)
SELECT page_id, url,
       s || '://' || n || CASE WHEN path = '' THEN '/' ELSE path END
         || CASE WHEN coalesce(q2, '') <> '' THEN '?' || q2 ELSE '' END AS normalized_url
FROM q
"""


def _answer_sql() -> str:
    tax = ", ".join(_q(t) for t in TAXONOMY)
    js = """'{"label":"' || lbl || '"}'"""
    return f"""
WITH c AS (
  SELECT conv_id, turn, text,
         CASE WHEN role = 'user' THEN 'product' WHEN role = 'assistant' THEN 'brand' ELSE 'Policy' END AS lbl
  FROM conversations),
r AS (
  SELECT conv_id, turn,
         CASE turn % 6
           WHEN 0 THEN {js}
           WHEN 1 THEN '  ```json' || chr(10) || {js} || chr(10) || '```'
           WHEN 2 THEN 'Answer: ' || {js} || ' end'
           WHEN 3 THEN {js} || ' {{"x":1}}'
           WHEN 4 THEN text
           ELSE '{{"label":' || CAST(length(text) AS VARCHAR) || '}}' END AS raw
  FROM c),
s1 AS (SELECT conv_id, turn, trim(coalesce(raw, ''), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS t FROM r),
s2 AS (
  SELECT conv_id, turn,
         CASE WHEN starts_with(t, '```') THEN
           (CASE WHEN ends_with(t2, '```') THEN trim(left(t2, length(t2) - 3), ' ' || chr(9) || chr(10) || chr(13)) ELSE t2 END)
         ELSE t END AS t
  FROM (SELECT *, CASE WHEN strpos(t, chr(10)) > 0 THEN substr(t, strpos(t, chr(10)) + 1) ELSE t END AS t2 FROM s1)),
s3 AS (
  SELECT conv_id, turn,
         CASE WHEN json_valid(t) THEN t
              WHEN strpos(t, '{{') > 0 AND strpos(t, '}}') > 0 AND length(t) - strpos(reverse(t), '}}') + 1 > strpos(t, '{{')
                   AND json_valid(substr(t, strpos(t, '{{'), length(t) - strpos(reverse(t), '}}') + 1 - strpos(t, '{{') + 1))
                THEN substr(t, strpos(t, '{{'), length(t) - strpos(reverse(t), '}}') + 1 - strpos(t, '{{') + 1)
              ELSE NULL END AS j
  FROM s2)
SELECT conv_id, turn,
       CASE WHEN j IS NOT NULL AND json_type(j) = 'OBJECT' AND json_type(j, '$.label') = 'VARCHAR'
                 AND json_extract_string(j, '$.label') IN ({tax})
            THEN json_extract_string(j, '$.label') ELSE 'other' END AS label
FROM s3
"""


def _stub_label(url: str) -> str:
    line = f"('URL: ' || coalesce({url}, 'None'))"
    return (f"CASE WHEN {line} LIKE '%-p-%' THEN 'product' WHEN {line} LIKE '%/marka/%' THEN 'brand' "
            f"WHEN {line} LIKE '%/' THEN 'homepage' ELSE 'other' END")


def oracle_sql() -> dict[str, str]:
    shop = _shop_cte()
    page_rules = rule_pack(PAGES_ROOT)
    shop_rules = rule_pack(SHOP_ROOT)
    profile_cols = """count(*) AS n_links,
       CAST(sum(CASE WHEN coalesce(is_external, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_external,
       CAST(sum(CASE WHEN coalesce(is_external, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_internal"""
    ext = f"NOT ends_with(regexp_extract(normalized_url, {_q(_NETLOC)}, 1), {_q(PAGES_ROOT)})"
    host = f"regexp_extract(regexp_extract(normalized_url, {_q(_NETLOC)}, 1), '^(?:.*@)?(\\[[^\\]]*\\]|[^:]*)', 1)"
    strict = f"NOT ({host} = {_q(PAGES_ROOT)} OR ends_with({host}, {_q('.' + PAGES_ROOT)}))"
    return {
        "links_extract": _with(ANCHORS) + "SELECT page_id, pos, href, anchor_text, rel FROM resolved",
        "links_normalize": LINKS_NORMALIZE,
        "links_resolve": _with(ANCHORS) + "SELECT page_id, pos, href AS url, normalized_url FROM resolved WHERE normalized_url IS NOT NULL",
        "links_dedupe_page": _with(ANCHORS) + "SELECT page_id, pos, href AS url, normalized_url, anchor_text, rel FROM per_page",
        "links_dedupe_run": _with(ANCHORS) + "SELECT normalized_url, page_id, pos, href AS url, anchor_text FROM run",
        "links_external": _with(ANCHORS) + f"SELECT page_id, pos, normalized_url, {ext} AS is_external, {strict} AS is_external_strict FROM per_page",
        "links_category_profile": _with(ANCHORS, f"""lp AS (SELECT *, {ext} AS is_external,
              CASE WHEN normalized_url IS NULL THEN NULL ELSE {_case('normalized_url', page_rules)} END AS pred_category FROM run)""")
            + f"SELECT pred_category, {profile_cols} FROM lp GROUP BY pred_category",
        "classify_first_match": _with(shop) + "SELECT id, url, pred_category FROM classified",
        "classify_only_nulls": _with(shop) + f"""SELECT id, url,
            CASE WHEN url IS NOT NULL AND pre IS NULL THEN {_case('url', shop_rules)} ELSE pre END AS pred_category
            FROM (SELECT *, CASE WHEN p_size > 25 THEN 'kept' END AS pre FROM shop)""",
        "classify_force_ignorecase": _with(shop) + f"""SELECT id, upper(url) AS url,
            CASE WHEN url IS NULL THEN NULL ELSE {_case('upper(url)', [(l, p, []) for l, p, _ in shop_rules], force_i=True)} END AS pred_category
            FROM shop""",
        "classify_row": _with(shop) + f"""SELECT id, padded AS url, {_case("coalesce(trim(padded), '')", shop_rules)} AS category
            FROM (SELECT *, CASE WHEN p_size < 10 THEN '  ' || url || ' ' ELSE url END AS padded FROM shop)""",
        "category_profile": _with(shop) + f"SELECT pred_category, {profile_cols}, count(DISTINCT url) AS n_distinct "
        "FROM classified GROUP BY pred_category",
        "insert_ignore": _with(ANCHORS, """tgt AS (
              SELECT normalized_url, row_number() OVER (ORDER BY page_id, pos) AS id FROM (
                SELECT * FROM per_page WHERE page_url LIKE '%#top'
                QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id, pos) = 1))""")
            + """SELECT (SELECT coalesce(max(id), 0) FROM tgt) + row_number() OVER (ORDER BY page_id, pos) AS id,
                      normalized_url, page_id, pos, href AS url
               FROM run WHERE normalized_url NOT IN (SELECT normalized_url FROM tgt)""",
        "links_store": _with(ANCHORS) + f"""SELECT row_number() OVER (ORDER BY page_id, pos) AS id,
            href AS url, normalized_url, anchor_text, rel, coalesce({ext}, false) AS is_external,
            '2024-02-01 00:00:00' AS discovered_at FROM run""",
        "crawl_classify_crawl": _with(ANCHORS, """tgt AS (
              SELECT normalized_url, href, row_number() OVER (ORDER BY page_id, pos) AS id FROM (
                SELECT * FROM per_page WHERE page_url LIKE '%#top'
                QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id, pos) = 1))""")
            + """SELECT id, normalized_url, href AS url,
                      CASE WHEN regexp_matches(normalized_url, '[02468]/?$') THEN 'even'
                           WHEN regexp_matches(normalized_url, '[13579]/?$') THEN 'odd' ELSE 'other' END AS pred_category
               FROM tgt
               UNION ALL
               SELECT (SELECT coalesce(max(id), 0) FROM tgt) + row_number() OVER (ORDER BY page_id, pos) AS id,
                      normalized_url, href AS url, CAST(NULL AS VARCHAR) AS pred_category
               FROM run WHERE normalized_url NOT IN (SELECT normalized_url FROM tgt)""",
        "crawl_category_layout": _with(ANCHORS, """tgt AS (
              SELECT normalized_url, href, row_number() OVER (ORDER BY page_id, pos) AS id FROM (
                SELECT * FROM per_page WHERE page_url LIKE '%#top'
                QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id, pos) = 1))""")
            + """SELECT id, normalized_url, href AS url,
                      CASE WHEN regexp_matches(normalized_url, '[02468]/?$') THEN 'even'
                           WHEN regexp_matches(normalized_url, '[13579]/?$') THEN 'odd' ELSE 'other' END AS pred_category
               FROM tgt
               UNION ALL
               SELECT (SELECT coalesce(max(id), 0) FROM tgt) + row_number() OVER (ORDER BY page_id, pos) AS id,
                      normalized_url, href AS url, CAST(NULL AS VARCHAR) AS pred_category
               FROM run WHERE normalized_url NOT IN (SELECT normalized_url FROM tgt)""",
        "surrogate_keys": "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name NULLS LAST, p_partkey) AS rn FROM part",
        "upsert_pages": """
WITH t AS (
  SELECT row_number() OVER (ORDER BY page_id) AS id, url, 200 AS status_code, 'old' AS title, 'meta' AS meta_description,
         html AS html_content, CAST(length(html) AS INTEGER) AS content_length, 0 AS link_depth, '2024-01-01' AS fetched_day,
         sha256(coalesce(html, '')) AS content_hash
  FROM pages WHERE url NOT LIKE '%?%'),
b0 AS (
  SELECT url, page_id AS seq, 'first' AS title, html, 1 AS link_depth FROM pages WHERE url LIKE '%?%' OR url LIKE '%#top'
  UNION ALL
  SELECT url, page_id + 1000000000 AS seq, 'second' AS title, html, 2 AS link_depth FROM pages WHERE url LIKE '%?page=%'),
b AS (
  SELECT url, seq, 200 AS status_code, title, coalesce(html, '') AS html_content,
         CAST(length(html) AS INTEGER) AS content_length, link_depth,
         '2024-02-01' AS fetched_day, sha256(coalesce(html, '')) AS content_hash
  FROM b0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1)
SELECT t.id, t.url,
       CASE WHEN b.url IS NOT NULL THEN b.status_code ELSE t.status_code END AS status_code,
       CASE WHEN b.url IS NOT NULL THEN b.title ELSE t.title END AS title,
       t.meta_description,
       CASE WHEN b.url IS NOT NULL THEN b.html_content ELSE t.html_content END AS html_content,
       CASE WHEN b.url IS NOT NULL THEN b.content_length ELSE t.content_length END AS content_length,
       CASE WHEN b.url IS NOT NULL THEN b.link_depth ELSE t.link_depth END AS link_depth,
       CASE WHEN b.url IS NOT NULL THEN b.fetched_day ELSE t.fetched_day END AS fetched_day,
       CASE WHEN b.url IS NOT NULL THEN b.content_hash ELSE t.content_hash END AS content_hash
FROM t LEFT JOIN b ON t.url = b.url
UNION ALL
SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY b.seq) AS id, b.url, b.status_code, b.title,
       CAST(NULL AS VARCHAR) AS meta_description, b.html_content, b.content_length, b.link_depth, b.fetched_day, b.content_hash
FROM b WHERE b.url NOT IN (SELECT url FROM t)
""",
        "column_map": _with(ANCHORS) + """SELECT normalized_url AS link, href AS source_href, anchor_text AS text,
            false AS is_external, '2024-02-01 00:00:00' AS discovered_at, CAST(NULL AS VARCHAR) AS pred_category
            FROM per_page""",
        "ensure_defaults": _with(ANCHORS) + f"""SELECT normalized_url,
            coalesce(CASE WHEN anchor_text LIKE '%e%' THEN NULL ELSE {ext} END, false) AS is_external,
            CASE WHEN pos % 2 = 0 THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS discovered_at,
            CAST(NULL AS VARCHAR) AS pred_category FROM per_page""",
        "page_hash": "SELECT page_id, url, sha256(coalesce(html, '')) AS content_hash FROM pages",
        "page_changes": """
WITH o AS (SELECT url, max(sha256(coalesce(html, ''))) AS h FROM pages WHERE url NOT LIKE '%#top' GROUP BY url),
     n AS (SELECT url, max(sha256(coalesce(CASE WHEN url LIKE '%?page=%' THEN html || '<!-- v2 -->' ELSE html END, ''))) AS h
           FROM pages WHERE url NOT LIKE '%utm_source%' GROUP BY url)
SELECT coalesce(o.url, n.url) AS url,
       CASE WHEN o.h IS NULL THEN 'new' WHEN n.h IS NULL THEN 'gone' WHEN o.h = n.h THEN 'same' ELSE 'changed' END AS change
FROM o FULL OUTER JOIN n ON o.url = n.url
""",
        "page_history": """
WITH s AS (
  SELECT url, crawl, max(sha256(CASE WHEN page_id % 5 = 1 AND crawl >= 2 THEN html || '<!-- changed -->'
                                     WHEN page_id % 5 = 2 AND crawl = 2 THEN html || '<!-- for a while -->'
                                     ELSE coalesce(html, '') END)) AS h
  FROM pages, (VALUES (1), (2), (3), (4)) c(crawl)
  WHERE NOT (page_id % 5 = 3 AND crawl = 2) AND NOT (page_id % 5 = 4 AND crawl = 1) AND url IS NOT NULL
  GROUP BY url, crawl),
f AS (SELECT *, coalesce(h <> lag(h) OVER (PARTITION BY url ORDER BY crawl), true) AS starts FROM s),
v AS (SELECT *, CAST(count(*) FILTER (starts) OVER (PARTITION BY url ORDER BY crawl) AS INTEGER) AS version FROM f),
g AS (SELECT url, version, min(h) AS content_hash, min(crawl) AS first_seen, max(crawl) AS last_seen, count(*) AS n_seen
      FROM v GROUP BY url, version)
SELECT *, lead(first_seen) OVER (PARTITION BY url ORDER BY version) AS replaced_in FROM g
""",
        "residue_topk": _with(shop) + """SELECT id, url, anchor_text, rel, is_external FROM classified
            WHERE (pred_category IS NULL OR pred_category = 'other') AND anchor_text LIKE '%a%'
            ORDER BY id LIMIT 100""",
        "relabel_where": _with(shop) + "SELECT id, url, pred_category FROM classified WHERE pred_category = 'help'",
        "prompt_build": _with(shop) + """SELECT id,
            'URL: ' || coalesce(url, 'None') || chr(10) || 'Anchor: ' || coalesce(anchor_text, '') || chr(10)
            || 'Rel: ' || coalesce(rel, '') || chr(10) || 'External: '
            || CASE WHEN coalesce(is_external, false) THEN 'True' ELSE 'False' END || chr(10) AS prompt
            FROM shop""",
        "answer_parse": _answer_sql(),
        "relabel_apply": _with(shop) + f"""SELECT id, url,
            CASE WHEN pred_category IS NULL OR pred_category = 'other' THEN {_stub_label('url')} ELSE pred_category END AS pred_category
            FROM classified""",
        "relabel_capped": _with(shop) + f"""SELECT id, url,
            CASE WHEN rn <= 200 THEN {_stub_label('url')} ELSE pred_category END AS pred_category
            FROM (SELECT *, CASE WHEN pred_category IS NULL OR pred_category = 'other'
                                 THEN row_number() OVER (PARTITION BY (pred_category IS NULL OR pred_category = 'other') ORDER BY id) END AS rn
                  FROM classified)""",
        "relabel_counts": _with(shop) + """SELECT CAST(floor((rn - 1) / 100) + 1 AS INTEGER) AS batch_no, count(*) AS n_updated
            FROM (SELECT row_number() OVER (ORDER BY id) AS rn FROM classified
                  WHERE pred_category IS NULL OR pred_category = 'other') GROUP BY 1""",
        "relabel_asks": _with(shop) + f"""SELECT label, count(*) AS n_rows, count(DISTINCT prompt) AS n_asked FROM (
              SELECT {_stub_label('u')} AS label, concat_ws(chr(10), coalesce(u, 'None'), coalesce(rel, ''), coalesce(is_external, false)) AS prompt
              FROM (SELECT *, CASE WHEN pred_category = 'other' THEN regexp_replace(regexp_replace(url, '[0-9]+$', CAST(id % 8 AS VARCHAR)),
                                                                                    '/[a-z-]+-p-HBV', '/x-p-') END AS u
                    FROM classified WHERE pred_category IS NULL OR pred_category = 'other')) GROUP BY label""",
        "relabel_passes": _with(shop) + """SELECT CAST(floor((rn - 1) / cap) + 1 AS INTEGER) AS pass, count(*) AS n_rows,
              min(id) AS first_id, max(id) AS last_id, any_value(n) - max(rn) AS n_unasked
            FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n, CAST(ceil(count(*) OVER () / 3.0) AS BIGINT) AS cap
                  FROM classified WHERE pred_category IS NULL OR pred_category = 'other') GROUP BY 1""",
        "classify_many_rules": _with(shop) + """SELECT id, url, CASE WHEN url IS NULL THEN NULL
              WHEN regexp_matches(url, '^https://www[.]shop[.]example/.+-p-HBV[0-9]+$') AND CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) BETWEEN 1 AND 2000
              THEN 'group' || (CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) % 7) ELSE 'other' END AS pred_category FROM shop""",
        "profile_merged": _with(shop) + f"""SELECT pred_category, {profile_cols}, true AS distinct_is_close FROM classified GROUP BY pred_category""",
        "export_rows": _with(shop) + "SELECT url, pred_category FROM classified",
        "stream_dedupe": _with(ANCHORS) + f"""SELECT normalized_url, href AS url, anchor_text,
            coalesce({ext}, false) AS is_external FROM run""",
        "stream_compare": _with(ANCHORS) + f"""SELECT normalized_url, href AS url, anchor_text,
            coalesce({ext}, false) AS is_external FROM run""",
        "stream_retry": _with(ANCHORS) + f"""SELECT normalized_url, href AS url, anchor_text,
            coalesce({ext}, false) AS is_external FROM run""",
        "links_forms": forms_sql(),
        "links_markup": markup_sql(),
        "links_implied": implied_sql(),
        "rules_from_config": _with(ANCHORS, f"""lp AS (SELECT *, {ext} AS is_external,
              {_case('normalized_url', PATH_RULES)} AS pred_category FROM run)""")
            + f"SELECT pred_category, {profile_cols}, count(DISTINCT normalized_url) AS n_distinct FROM lp GROUP BY pred_category",
        "stream_distinct": _with(ANCHORS) + "SELECT normalized_url FROM run",
    }
