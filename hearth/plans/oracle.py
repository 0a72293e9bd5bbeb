"""Oracle SQL (DuckDB dialect) for every catalog query that plain SQL can express.

Written apart from the Spark code: it has patterns, grammars and tables of its own, and
where a query parses markup that it built from table rows, the SQL states the
expected values of those rows and parses nothing.  Only texts that must be the same to
the letter (prompt texts, thresholds, the stub's rule) are taken from the code.
"""

from __future__ import annotations

from hearth.operators import prompt as P
from hearth.operators import score as S
from hearth.plans import catalog as C

BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
NUMBER = "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
IMAGE_STARTS = {"jpeg": "/9j/", "png": "iVBORw0KGgo", "gif": "R0lGODlh", "bmp": "Qk2", "tiff": "SUkq"}


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"trim({e}, {q(BLANKS)})"


def first_match(e: str, p: str, default: str | None = "'-'") -> str:
    d = default if default is not None else "NULL"
    return f"(CASE WHEN regexp_matches({e}, {q(p)}) THEN {strip(f'regexp_extract({e}, {q(p)}, 1)')} ELSE {d} END)"


def required(e: str, p: str, do_strip: bool = False) -> str:
    hit = f"regexp_extract({e}, {q(p)}, 1)"
    return f"(CASE WHEN regexp_matches({e}, {q(p)}) THEN {strip(hit) if do_strip else hit} END)"


def strict_double(e: str) -> str:
    s = strip(e)
    return f"(CASE WHEN regexp_matches({s}, {q(NUMBER)}) THEN TRY_CAST({s} AS DOUBLE) END)"


def above(e: str, limit: float) -> str:
    return f"coalesce(NOT isnan({e}) AND {e} > {limit!r}, false)"


def sniff(b64: str) -> str:
    whens = " ".join(f"WHEN starts_with({b64}, {q(p)}) THEN {q(k)}" for k, p in IMAGE_STARTS.items())
    return f"(CASE {whens} ELSE '' END)"


def data_uri(content: str) -> str:
    b = f"base64({content})"
    return f"(CASE WHEN {content} IS NULL THEN '' ELSE 'data:image/' || {sniff(b)} || ';base64,' || {b} END)"


UNIT = "(CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END)"
BASE = "'https://hd.example.com/ershoufang'"


# What the list pages' cards must parse to, from the rows they were built of.
_CARDS = """
WITH c AS (
  SELECT *, CAST(floor(p_partkey / 30) AS BIGINT) AS page_id,
         row_number() OVER (PARTITION BY floor(p_partkey / 30) ORDER BY p_partkey) - 1 AS pos,
         5 + (p_size % 13 <> 0)::INT + (p_size % 11 = 0)::INT AS n_facts FROM part),
o AS (
  SELECT *, CASE WHEN p_partkey % 101 = 0 THEN 'missing_id' WHEN p_size % 17 = 0 THEN 'bad_number'
                 WHEN p_size % 19 = 0 THEN 'missing_facts' WHEN n_facts < 6 THEN 'short_facts' END AS reject_reason FROM c)"""


def _part_info(price: str = "p_retailprice") -> str:
    def v(e):
        return f"coalesce({e}, '-')"
    fields = [
        f"'标题: ' || {v('p_name')}", f"'区县: ' || {v('p_brand')}", f"'小区: ' || {v('p_brand')}",
        "'位置: -'", f"'总价: ' || {v(f'CAST({price} AS VARCHAR)')} || '万'",
        f"'单价: ' || {v(f'CAST({price} * 10 AS VARCHAR)')} || '元/平'",
        f"'户型: ' || {v('p_type')}", f"'面积: ' || {v('CAST(CAST(p_size AS DOUBLE) AS VARCHAR)')}",
        "'朝向: -'", "'装修: -'", "'楼层: -'", "'建筑类型: -'",
    ]
    return "concat_ws('，', " + ", ".join(fields) + ")"


_SCORES = f"""
WITH l AS (SELECT p_partkey AS house_id, p_retailprice * 10 AS up FROM part),
rq AS (SELECT p_partkey AS house_id, p_partkey % 100 AS wish_id FROM part),
s0 AS (SELECT rq.house_id, rq.wish_id, l.up,
          CASE WHEN l.up IS NULL OR isnan(l.up) OR isinf(l.up) THEN NULL
               ELSE CAST(floor(l.up) AS BIGINT) % {S.STUB_MODULUS} END AS n
       FROM rq LEFT JOIN l ON rq.house_id = l.house_id),
s AS (SELECT house_id, wish_id,
         CASE WHEN n IS NULL OR n = {S.STUB_FAIL_AT} THEN ''
              ELSE '满意分: ' || CAST(n AS VARCHAR) || '分。' || {q(S.STUB_REASON)} END AS reply,
         CASE WHEN n IS NULL OR n = {S.STUB_FAIL_AT} OR n > {S.MAX_SCORE} THEN NULL
              ELSE CAST(n AS INTEGER) END AS score
      FROM s0)"""


def _text_json(t: str) -> str:
    return f"json_object('type', 'text', 'text', {t})"


PROMPT_SQL = f"""
WITH w AS (SELECT conv_id AS wish_id, text AS user_input FROM conversations WHERE role = 'user'
           QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) = 1),
l AS (SELECT p_partkey AS house_id, {_part_info()} AS info, (CAST(p_size AS DOUBLE) % 3 = 0) AS has_gallery FROM part),
rq AS (SELECT p_partkey AS house_id, p_partkey % 100 AS wish_id FROM part),
x AS (SELECT rq.house_id, rq.wish_id, {strip('w.user_input')} AS wish, l.info, coalesce(l.has_gallery, false) AS has_gallery
      FROM rq LEFT JOIN w ON rq.wish_id = w.wish_id LEFT JOIN l ON rq.house_id = l.house_id)
SELECT house_id, wish_id, CAST(json_array(
  json_object('role', 'system', 'content', json_array({_text_json(q(P.SYSTEM_PROMPT))})),
  json_object('role', 'user', 'content', to_json(list_concat(
     CASE WHEN coalesce(wish, '') <> '' THEN [{_text_json(q(P.WISH_HEADER) + " || wish")}] ELSE []::JSON[] END,
     [{_text_json(q(P.INFO_HEADER) + " || coalesce(info, '')")}],
     CASE WHEN has_gallery THEN [{_text_json(q(P.PLANS_MARKER))}, {_text_json(q(P.ROOMS_MARKER))}] ELSE []::JSON[] END)))
) AS VARCHAR) AS messages_json FROM x"""


def _image_json(uri: str) -> str:
    return f"json_object('type', 'image_url', 'image_url', json_object('url', {uri}))"


_JPEG = "unhex('FFD8FF') || encode({})"
PROMPT_IMAGES_SQL = PROMPT_SQL.replace(
    "has_gallery FROM part)", "has_gallery, p_brand, p_type FROM part)").replace(
    "coalesce(l.has_gallery, false) AS has_gallery", "coalesce(l.has_gallery, false) AS has_gallery, l.p_brand, l.p_type").replace(
    f"THEN [{_text_json(q(P.PLANS_MARKER))}, {_text_json(q(P.ROOMS_MARKER))}]",
    f"THEN [{_text_json(q(P.PLANS_MARKER))}, {_image_json(data_uri('(' + _JPEG.format('p_brand') + ')'))}, "
    f"{_text_json(q(P.ROOMS_MARKER))}, {_image_json(data_uri('(' + _JPEG.format('p_type') + ')'))}]")

# All words of the documents, each with its first and last place in its text.
_WORDS = """
WITH s AS (SELECT doc_id, string_split(text, ' ') AS ws FROM documents),
e AS (SELECT doc_id, i - 1 AS i, ws[i] AS word FROM s, range(1, len(ws) + 1) r(i)),
d AS (SELECT doc_id, word, min(i) AS first_i, max(i) AS last_i, length(word) >= 6 AS plan FROM e GROUP BY doc_id, word)"""


MAGIC_LIST = "[" + ", ".join(q(m) for m in C.MAGIC) + "]"

SQL: dict[str, str] = {
    "flagship": f"""
WITH li AS (SELECT l_orderkey, l_partkey,
              CAST({above(UNIT, C.UNIT_LIMIT)} AS INTEGER) AS fu,
              CAST({above('l_extendedprice', C.TOTAL_LIMIT)} AS INTEGER) AS ft FROM lineitem),
todo AS (SELECT * FROM li k WHERE fu = 0 AND ft = 0 AND NOT EXISTS
           (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = k.l_orderkey))
SELECT p_name, count(*) AS n FROM todo JOIN part ON todo.l_partkey = part.p_partkey
WHERE p_name IS NOT NULL GROUP BY p_name ORDER BY n DESC, p_name ASC LIMIT 10""",

    "card_explode": f"""
WITH s AS (SELECT page_id, string_split(html, '<li>') AS arr FROM pages),
c AS (SELECT page_id, CAST(i - 2 AS INTEGER) AS pos, split_part(arr[i], '</li>', 1) AS card
      FROM s, range(2, len(arr) + 1) r(i))
SELECT page_id, pos, {first_match('card', 'href="(.*?)"')} AS href,
       {first_match('card', '>(.*?)</a>')} AS text FROM c""",

    "first_match_default": f"""
SELECT page_id, {first_match('html', '<title>(.*?)</title>')} AS title,
       {first_match('html', '<h1>(.*?)</h1>')} AS h1,
       {first_match('html', '<p>(.*?)</p>')} AS para,
       {first_match('url', '[?]([^#]*)')} AS query,
       {first_match('url', '#(.*)$')} AS fragment FROM pages""",

    "facts_split": f"""
WITH p AS (SELECT page_id, string_split(url, '/') AS parts FROM pages)
SELECT page_id, CAST(len(parts) AS BIGINT) AS n_parts, {strip('parts[1]')} AS scheme,
       {strip('parts[3]')} AS host, {strip('parts[4]')} AS lang, {strip('parts[5]')} AS tail,
       {strict_double(f"regexp_replace({strip('parts[5]')}, '[?#].*$', '')")} AS tail_num,
       {strip('parts[6]')} AS extra FROM p""",

    "extract_reject": f"""
WITH p AS (SELECT html, string_split(url, '/') AS parts FROM pages),
r AS (SELECT CASE WHEN NOT regexp_matches(html, '<h1>(.*?)</h1>') THEN 'missing_id'
                  WHEN {strict_double(f"regexp_replace({strip('parts[5]')}, '[?#].*$', '')")} IS NULL THEN 'bad_number'
                  WHEN len(parts) < 6 THEN 'short_facts' ELSE 'kept' END AS outcome FROM p)
SELECT outcome, count(*) AS n FROM r GROUP BY outcome""",

    "listing_roundtrip": _CARDS + f"""
SELECT p_partkey AS house_id,
       replace(replace(replace({strip("p_name || CASE WHEN p_size % 3 = 0 THEN ',南北，通透' ELSE '' END")}, ',', '-'), '，', '-'), ' ', '-') AS title,
       'district-' || CAST(page_id % 5 AS VARCHAR) AS district, p_brand AS community, p_brand AS position,
       CASE WHEN p_size % 2 = 0 THEN '满五年' ELSE '-' END AS tax,
       CAST(CAST(p_partkey % 400 + 50 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) AS DOUBLE) AS total_price,
       CAST(p_partkey * 7 % 9000 + 10000 AS DOUBLE) AS unit_price,
       {BASE} || '/' || CAST(p_partkey AS VARCHAR) || '.html' AS link,
       CAST(p_size % 4 + 1 AS VARCHAR) || '室1厅' AS house_type, p_size + 40.5::DOUBLE AS house_size, '南 北' AS direction, '精装' AS fitment,
       (['高', '中', '低'])[p_partkey % 3 + 1] || '楼层(共' || CAST(p_size % 30 + 2 AS VARCHAR) || '层)' AS level,
       CASE WHEN p_size % 13 = 0 THEN '2005年建' ELSE '板楼' END AS build_type, page_id * 100000 + pos AS seq
FROM o WHERE reject_reason IS NULL""",

    "listing_rejects": _CARDS + """
SELECT page_id, CAST(pos AS INTEGER) AS pos, reject_reason FROM o WHERE reject_reason IS NOT NULL""",

    "title_clean": f"SELECT doc_id, translate({strip('text')}, ',， ', '---') AS title FROM documents",

    "page_frontier": f"""
WITH counts AS (
  SELECT n_regionkey, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey),
n AS (SELECT r_regionkey, lower(replace(r_name, ' ', '-')) AS slug, CAST(coalesce(cnt, 0) AS BIGINT) AS house_num
      FROM region LEFT JOIN counts ON r_regionkey = n_regionkey),
f AS (SELECT *, CAST(greatest(house_num - 3000, 0) AS BIGINT) AS beyond_cap, CAST(i AS INTEGER) AS page
      FROM n, range(1, CAST(ceil(least(house_num, 3000) / 30.0) AS INTEGER) + 1) r(i))
SELECT r_regionkey, house_num, beyond_cap, page, {BASE} || '/' || slug || '/pg' || CAST(page AS VARCHAR) || '/' AS url FROM f""",

    "result_count": """
SELECT n_nationkey, count(*) AS house_num FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey""",

    "region_scope": """
WITH m AS (SELECT n_regionkey, n_nationkey, n_name FROM nation),
f AS (SELECT n_regionkey, min(n_nationkey) AS k FROM m GROUP BY n_regionkey),
d AS (SELECT n_regionkey, n_nationkey, n_name, 'all' AS scope FROM m
      UNION ALL
      SELECT m.n_regionkey, m.n_nationkey, m.n_name, 'small' AS scope FROM m
      JOIN f ON m.n_regionkey = f.n_regionkey AND m.n_nationkey = f.k)
SELECT r_regionkey, r_name, scope, n_nationkey, n_name FROM d JOIN region ON n_regionkey = r_regionkey""",

    "screen_flags": f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(coalesce(contains(p_type, {q(C.TYPE_MARK)}), false) AS INTEGER) AS is_high_level,
       CAST({above(UNIT, C.UNIT_LIMIT)} AS INTEGER) AS is_unit_price_high,
       CAST({above('l_extendedprice', C.TOTAL_LIMIT)} AS INTEGER) AS is_total_price_high
FROM lineitem JOIN part ON l_partkey = p_partkey""",

    "screen_keep": f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE NOT coalesce(contains(p_type, {q(C.TYPE_MARK)}), false)
  AND NOT {above(UNIT, C.UNIT_LIMIT)} AND NOT {above('l_extendedprice', C.TOTAL_LIMIT)}""",

    "freq_top10": f"""
SELECT p_brand, count(*) AS n FROM part
WHERE {above('p_retailprice', C.PRICE_FLAG)} AND p_brand IS NOT NULL
GROUP BY p_brand ORDER BY n DESC, p_brand ASC LIMIT 10""",

    "freq_price": f"""
SELECT p_retailprice, count(*) AS n FROM part
WHERE {above('p_retailprice', C.PRICE_FREQ)} AND p_retailprice IS NOT NULL
GROUP BY p_retailprice""",

    "stage_counts": f"""
WITH f AS (SELECT ({above(UNIT, C.UNIT_LIMIT)} OR {above('l_extendedprice', C.TOTAL_LIMIT)}) AS bad FROM lineitem)
SELECT 'screen' AS stage, 'total' AS name, CAST(count(*) AS BIGINT) AS value FROM f
UNION ALL SELECT 'screen', 'kept', CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) FROM f
UNION ALL SELECT 'screen', 'rejected', CAST(count(*) FILTER (WHERE bad) AS BIGINT) FROM f""",

    "merge_inner": """
SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",

    "resume_anti": """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",

    "append_union": """
SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS lang FROM labels
UNION ALL
SELECT doc_id, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",

    "gallery_encode": _WORDS + """
SELECT doc_id, string_agg(word, ';' ORDER BY first_i) AS urls,
       string_agg(word || '##' || CAST(last_i AS VARCHAR), ';' ORDER BY first_i) AS url_dict, CAST(count(*) AS BIGINT) AS n
FROM d GROUP BY doc_id""",

    "gallery_decode": _WORDS + """,
tx AS (SELECT doc_id, string_agg(CASE WHEN i % 3 = 2 THEN word ELSE word || '##' || CAST(i AS VARCHAR) END, ';' ORDER BY i) AS text FROM e GROUP BY doc_id),
sp AS (SELECT doc_id, string_split(text, ';') AS arr FROM tx),
x AS (SELECT doc_id, i AS ord, arr[i] AS entry FROM sp, range(1, len(arr) + 1) q(i)),
v AS (SELECT doc_id, ord, string_split(entry, '##') AS kv FROM x WHERE entry <> ''),
m AS (SELECT doc_id, count(*) FILTER (WHERE len(kv) <> 2) AS malformed FROM v GROUP BY doc_id),
ok AS (SELECT doc_id, ord, kv[1] AS url, kv[2] AS descr FROM v WHERE len(kv) = 2),
g AS (SELECT doc_id, url, min(ord) AS first_ord, arg_max(descr, ord) AS descr FROM ok GROUP BY doc_id, url)
SELECT g.doc_id, CAST(row_number() OVER (PARTITION BY g.doc_id ORDER BY first_ord) - 1 AS INTEGER) AS pos,
       url, descr, CAST(m.malformed AS BIGINT) AS malformed
FROM g JOIN m ON g.doc_id = m.doc_id""",

    "image_kind_split": _WORDS + """,
l AS (SELECT doc_id, coalesce(list(word ORDER BY first_i) FILTER (WHERE plan), []) AS p,
             coalesce(list(word ORDER BY first_i) FILTER (WHERE NOT plan), []) AS r FROM d GROUP BY doc_id)
SELECT doc_id, array_to_string(p[1:8], ';') AS plan_urls, array_to_string(r[1:8], ';') AS room_urls,
       '户型图: ' || coalesce(p[1], '') || '; 房屋图片: ' || coalesce(r[1], '') AS preview FROM l""",

    "thumb_rewrite": f"""
SELECT page_id, replace(replace(trim({strip("' `' || url || '` '")}, '`'), '.example.', '.sample.'),
                        'http://', 'https://') AS thumb_url FROM pages""",

    "data_uri": f"""
WITH b AS (SELECT doc_id, unhex({MAGIC_LIST}[doc_id % {len(C.MAGIC)} + 1]) || encode(text) AS content FROM documents),
u AS (SELECT doc_id, {data_uri('content')} AS uri FROM b)
SELECT doc_id, regexp_extract(uri, '^data:image/([a-z]*);', 1) AS kind, CAST(length(uri) AS BIGINT) AS uri_len,
       md5(uri) AS uri_md5 FROM u""",

    "gallery_extract": """
WITH p AS (SELECT p_partkey AS house_id, 'https://img.example/' || CAST(p_partkey AS VARCHAR) AS base, p_size, p_type FROM part WHERE p_size % 10 <> 0)
SELECT house_id, 0 AS pos, base || '/plan.450x300.jpg' AS url, '户型图' AS descr FROM p
UNION ALL SELECT house_id, 1, base || '/a.450x300.jpg', CASE WHEN p_size % 3 = 0 THEN p_type ELSE '客厅' END FROM p
UNION ALL SELECT house_id, 2, base || '/n.450x300.jpg', '内' FROM p
UNION ALL SELECT house_id, 3, base || '/b.450x300.jpg?v=1&s=2', '' FROM p""",

    "card_parse": """
SELECT CAST(p_partkey // 30 AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 30 ORDER BY p_partkey) - 1 AS INTEGER) AS pos,
       p_name || CASE p_size % 6 WHEN 0 THEN '<div>x</div>' WHEN 1 THEN '' WHEN 3 THEN '<br>y' WHEN 4 THEN '<p>one<p>two<b>three'
                 ELSE '</li></span><i>z' END AS card
FROM part WHERE p_size % 6 <> 2""",

    "gallery_parse": """
WITH p AS (SELECT p_partkey AS house_id FROM part WHERE p_size % 10 <> 0)
SELECT house_id, 0 AS pos, house_id || '-1.450x300.jpg' AS url, 'later' AS descr FROM p
UNION ALL SELECT house_id, 1, house_id || '-2.450x300.jpg', '户型图' FROM p""",

    "snapshot_append": """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m%d') AS day, strftime(o_orderdate, '%Y') AS dt
FROM orders WHERE NOT (year(o_orderdate) = 1995 AND o_orderstatus = 'F')""",

    "price_bands": """
WITH RECURSIVE p AS (
  SELECT n_regionkey AS r, CAST(floor(o_totalprice) AS BIGINT) AS p
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
b(r, lo, hi, n) AS (
  SELECT r, CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT), count(*) FROM p GROUP BY r
  UNION ALL
  SELECT b.r, CASE WHEN p.p > (lo + hi) // 2 THEN (lo + hi) // 2 + 1 ELSE lo END AS l, CASE WHEN p.p > (lo + hi) // 2 THEN hi ELSE (lo + hi) // 2 END AS h, count(*)
  FROM b JOIN p ON p.r = b.r AND p.p BETWEEN b.lo AND b.hi WHERE b.n > 3000 AND b.lo < b.hi GROUP BY b.r, l, h),
f AS (SELECT * FROM b WHERE n <= 3000 OR lo = hi)
SELECT r AS r_regionkey, lo, hi, n, CAST(greatest(n - 3000, 0) AS BIGINT) AS beyond_cap, CAST(page AS INTEGER) AS page,
       'https://hd.example.com/ershoufang/' || r || '/p' || lo || '-' || hi || '/pg' || page || '/' AS url
FROM f, unnest(range(1, CAST(ceil(least(n, 3000) / 30.0) AS BIGINT) + 1)) t(page)""",

    "freq_top10_days": "SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10",

    "csv_exchange": "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents",

    "image_scan": f"""
WITH b AS (SELECT s_suppkey % 100 AS k, encode('GIF89a' || string_agg(s_name, ',' ORDER BY s_suppkey) || chr(10)) AS content FROM supplier GROUP BY 1),
u AS (SELECT k, content, {data_uri('content')} AS uri FROM b)
SELECT k, CAST(octet_length(content) AS BIGINT) AS n_bytes, regexp_extract(uri, '^data:image/([a-z]*);', 1) AS kind, md5(uri) AS uri_md5 FROM u""",

    "image_headers": """
WITH p AS (SELECT p_partkey, p_size, p_partkey % 3 AS nth, strlen(concat_ws(' ', p_name, p_brand, p_type)) AS n,
                  CASE WHEN p_size % 7 = 0 THEN p_size % 12 + 1 ELSE 0 END AS lost FROM part),
-- what a format needs around the words that it holds
s AS (SELECT *, CASE nth WHEN 0 THEN 57 + n WHEN 1 THEN 37 + 2 * n ELSE 38 + 3 * n END - lost AS n_bytes FROM p)
SELECT p_partkey, CAST(n_bytes AS BIGINT) AS n_bytes, ['png', 'gif', 'jpeg'][nth + 1] AS kind,
       CAST(p_partkey % 4000 + 1 AS INTEGER) AS width, CAST(p_size AS INTEGER) AS height,
       CASE WHEN nth = 0 AND p_size % 7 = 1 THEN 'damaged' WHEN lost > 0 THEN 'cut' ELSE 'whole' END AS state
FROM s""",

    "cards_upkeep": """
WITH o AS (SELECT *, (strftime(o_orderdate, '%Y'), o_orderkey) AS place FROM orders
           WHERE NOT (strftime(o_orderdate, '%Y') = '1994' AND o_orderstatus = 'F')),
f AS (SELECT o_custkey, arg_min({'p': o_orderpriority, 's': o_orderstatus, 't': o_totalprice}, place) AS r FROM o GROUP BY 1),
g AS (SELECT o_custkey, arg_min(o_orderkey || '.jpg', place) AS urls FROM o WHERE o_orderkey % 3 = 0 GROUP BY 1)
SELECT f.o_custkey AS house_id, g.urls,
       '标题: ' || coalesce(r.p, '-') || '，区县: ' || coalesce(r.s, '-') || '，小区: -，位置: -，总价: ' || coalesce(CAST(r.t AS VARCHAR), '-')
       || '万，单价: -元/平，户型: -，面积: -，朝向: -，装修: -，楼层: -，建筑类型: -' AS info
FROM f LEFT JOIN g ON g.o_custkey = f.o_custkey""",

    "image_join": _WORDS + f""",
w AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY doc_id, plan ORDER BY first_i) <= 8),
b AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark),
im AS (SELECT word, unhex(['FFD8FF', '89504E470D0A1A0A', ''][length(word) % 3 + 1]) || encode(word) AS content FROM b WHERE length(word) % 5 <> 0),
u AS (SELECT word, {data_uri('content')} AS uri FROM im),
j AS (SELECT w.doc_id, w.plan, w.first_i, u.uri FROM w JOIN u ON w.word = u.word)
SELECT doc_id, coalesce(string_agg(uri, ' ' ORDER BY first_i) FILTER (WHERE plan), '') AS plans,
       coalesce(string_agg(uri, ' ' ORDER BY first_i) FILTER (WHERE NOT plan), '') AS rooms
FROM j GROUP BY doc_id""",

    "render_text": f"SELECT p_partkey, {_part_info()} AS info FROM part",

    "number_text": """
WITH m AS (SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE AS price, l_quantity::DOUBLE AS qty FROM lineitem)
SELECT l_orderkey, l_linenumber, (price / qty)::VARCHAR AS unit, (price * 1e15::DOUBLE / qty)::VARCHAR AS big,
       (qty / (price * 1000::DOUBLE))::VARCHAR AS share
FROM m""",

    "lookup": f"""
SELECT p_partkey, {_part_info()} AS info,
       CASE WHEN p_size % 3 = 0 THEN 'img/' || p_brand || '/210x140.jpg' ELSE '' END AS plan_urls,
       CASE WHEN p_size % 3 = 0 THEN 'img/' || p_type || '/210x140.jpg;img/none' ELSE '' END AS room_urls
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50)""",

    "first_row_per_key": """
SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) = 1""",

    "first_nonempty_per_key": """
SELECT conv_id, turn, role, text FROM conversations WHERE role = 'assistant' AND length(text) > 0
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) = 1""",

    "prompt_json": PROMPT_SQL,

    "score_batch": _SCORES + "\nSELECT house_id, wish_id, reply, score FROM s",

    "shortlist": _SCORES + f"""
SELECT s.wish_id, p_brand AS community, p_type AS house_type, count(*) AS n_listings,
       max(s.score) AS max_score, avg(s.score) AS avg_score
FROM s JOIN part ON s.house_id = p_partkey WHERE s.score >= {S.SHORTLIST_MIN_SCORE}
GROUP BY s.wish_id, p_brand, p_type""",

    "kv_parse": f"""
WITH s AS (SELECT s_suppkey, s_name || '##m' || CAST(s_suppkey AS VARCHAR) || '; alt ## ' || CAST(s_nationkey AS VARCHAR)
             || ' ;bad;a##b##c;' || s_name || ' ## dup' || CAST(s_suppkey % 3 AS VARCHAR) AS t FROM supplier),
sp AS (SELECT s_suppkey, string_split(t, ';') AS arr FROM s),
e AS (SELECT s_suppkey, i AS ord, string_split({strip('arr[i]')}, '##') AS kv FROM sp, range(1, len(arr) + 1) q(i)),
ok AS (SELECT s_suppkey, ord, {strip('kv[1]')} AS name, {strip('kv[2]')} AS model FROM e WHERE len(kv) = 2),
d AS (SELECT s_suppkey, name, min(ord) AS first_ord, arg_max(model, ord) AS model FROM ok GROUP BY s_suppkey, name)
SELECT d.s_suppkey, CAST(row_number() OVER (PARTITION BY d.s_suppkey ORDER BY first_ord) - 1 AS INTEGER) AS pos,
       name, model, string_split(string_split(s.t, ';')[1], '##')[2] AS first_model
FROM d JOIN s ON d.s_suppkey = s.s_suppkey""",

    "lookup_one": f"""
SELECT p_partkey, {_part_info()} AS info,
       CASE WHEN p_size % 3 = 0 THEN 'img/' || p_brand || '/210x140.jpg' ELSE '' END AS plan_urls,
       CASE WHEN p_size % 3 = 0 THEN 'img/' || p_type || '/210x140.jpg;img/none' ELSE '' END AS room_urls
FROM part WHERE p_partkey = 7""",

    "region_districts": """
WITH d(city, scope, ord, district_cn, district_en) AS (VALUES
  ('bj', 'all', 0, '朝阳区', 'chaoyang'), ('bj', 'all', 1, '海淀区', 'haidian'), ('bj', 'all', 2, '西城区', 'xicheng'),
  ('bj', 'small', 0, '五道口', 'wudaokou'), ('hz', 'all', 0, '钱塘区', 'qiantangqu'),
  ('hd', 'all', 0, '丛台区', 'congtaiqu'), ('hd', 'all', 1, '复兴区', 'fuxingqu'), ('hd', 'all', 2, '邯山区', 'hanshanqu'),
  ('hd', 'all', 3, '经开区', 'jingkaiqu'), ('hd', 'small', 0, '丛台区', 'congtaiqu'))
SELECT n_nationkey, n_name, city, scope, district_cn, district_en FROM nation JOIN d ON n_nationkey % 4 = ord""",

    "frontier_status": f"""
WITH counts AS (
  SELECT n_regionkey, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey),
n AS (SELECT r_regionkey, lower(replace(r_name, ' ', '-')) AS slug, CAST(coalesce(cnt, 0) AS BIGINT) AS house_num
      FROM region LEFT JOIN counts ON r_regionkey = n_regionkey),
f AS (SELECT *, CAST(greatest(house_num - 3000, 0) AS BIGINT) AS beyond_cap, CAST(i AS INTEGER) AS page
      FROM n, range(1, CAST(ceil(least(house_num, 3000) / 30.0) AS INTEGER) + 1) r(i)),
l AS (SELECT DISTINCT page_id % 5 AS r, page_id % 101 AS n FROM pages)
SELECT r_regionkey, page, {BASE} || '/' || slug || '/pg' || CAST(page AS VARCHAR) || '/' AS url,
       EXISTS (SELECT 1 FROM l WHERE l.r = r_regionkey AND l.n = page) AS landed FROM f""",

    "shortlisted_listings": _SCORES + f"""
SELECT s.wish_id, s.house_id, s.score, p_name AS title, p_brand AS community, p_retailprice AS total_price
FROM s JOIN part ON s.house_id = p_partkey WHERE s.score >= {S.SHORTLIST_MIN_SCORE}""",

    "prompt_images": PROMPT_IMAGES_SQL,

    "score_all": _SCORES + """
SELECT house_id, CAST(3 AS BIGINT) AS wish_id, reply, score FROM s""",

    "reply_counts": _SCORES + """
SELECT 'replies' AS stage, 'asked' AS name, CAST(count(*) AS BIGINT) AS value FROM s
UNION ALL SELECT 'replies', 'answered', CAST(count(*) FILTER (WHERE reply <> '') AS BIGINT) FROM s
UNION ALL SELECT 'replies', 'failed', CAST(count(*) FILTER (WHERE reply = '') AS BIGINT) FROM s""",

    "preview_limits": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20",
}

SQL["merge_bucketed"], SQL["resume_bucketed"] = SQL["merge_inner"], SQL["resume_anti"]
SQL["frontier_first_page"] = f"SELECT * FROM ({SQL['page_frontier']}) t WHERE page = 1"
