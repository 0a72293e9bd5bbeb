"""DuckDB SQL of the queries that SQL can express.

Without: op3 and op4 (trained models), op6 (archives written and read back), op7 (peeled
sketches), op8 (greedy tiling), op9 (byte-pair merging), op10 (all pairs of whole sets take
SQL far too long on the whole table), op11 (SQL has no CRC-32).  Those are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from hearth.llm.licenses import STEMS, TEMPLATES, THRESHOLD
from hearth.llm.linededup import EDIT_WORDS, MIN_WORDS

_SPACES = r"[\x20\x09-\x0D]+"



def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _terms(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')"


def _notice(line: str) -> str:
    return "(" + " OR ".join(f"contains(lower({line}), {_q(s)})" for s in STEMS) + ")"


OP1 = rf"""
WITH f AS (
  SELECT doc_id, text, CASE WHEN doc_id % 10 = 0 THEN 'LICENSE.' || doc_id ELSE doc_id || '.txt' END AS name,
         CASE WHEN doc_id % 1000 = 0 THEN '/' || source WHEN doc_id % 100 = 0 THEN '/' || source || '/' || lang
              ELSE '/' || source || '/' || lang || '/' || (doc_id // 100) END AS dir FROM documents),
tm(template, license, body) AS (VALUES {", ".join(f"({i}, {_q(n)}, {_q(t)})" for i, (n, t) in enumerate(TEMPLATES))}),
tt AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({_terms('body')}) AS term FROM tm) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM f),
df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({_terms("coalesce(text, '')")})) AS term FROM f) GROUP BY term),
idf AS (SELECT v.term, ln((n + 1)::DOUBLE / (coalesce(df, 0) + 1)) + 1 AS idf FROM (SELECT DISTINCT term FROM tt) v LEFT JOIN df ON v.term = df.term, n),
g0 AS (SELECT template, license, tt.term, tf * idf AS v FROM tt JOIN idf ON tt.term = idf.term),
g1 AS (SELECT template, sqrt(sum(v * v)) AS norm FROM g0 GROUP BY template),
g AS (SELECT g0.template, license, term, v / norm AS v FROM g0 JOIN g1 ON g0.template = g1.template),
l AS (SELECT doc_id, name, text, string_split(text, chr(10)) AS ls FROM f WHERE text IS NOT NULL),
pa AS (SELECT doc_id, list_filter(string_split(array_to_string(list_transform(ls, lambda x: CASE WHEN regexp_matches(x, '[\p{{L}}\p{{N}}]') THEN x ELSE chr(1) END), chr(10)), chr(1)),
                                  lambda x: trim(x, chr(10)) <> '') AS ps FROM l),
wi AS (SELECT doc_id, i, w, trim(array_to_string(ps[i:i + w - 1], chr(10)), chr(10)) AS body
       FROM pa, range(1, len(ps) + 1) r(i), range(1, 6) z(w) WHERE i + w - 1 <= len(ps) AND {_notice('ps[i]')}),
un AS (
  SELECT doc_id, 'line' || i AS pos, ls[i] AS body FROM l, range(1, len(ls) + 1) r(i) WHERE {_notice('ls[i]')}
  UNION ALL SELECT doc_id, 'window' || i || '-' || w, body FROM wi WHERE contains(body, chr(10))
  UNION ALL SELECT doc_id, 'file', text FROM l WHERE name LIKE 'LICENSE%' AND {_notice('text')}),
tok AS (SELECT doc_id, pos, term, count(*) AS tf FROM (SELECT doc_id, pos, unnest({_terms('body')}) AS term FROM un) GROUP BY ALL),
w AS (SELECT doc_id, pos, tok.term, tf * coalesce(idf, ln((n + 1)::DOUBLE) + 1) AS w FROM tok LEFT JOIN idf ON tok.term = idf.term, n),
size AS (SELECT doc_id, pos, sqrt(sum(w * w)) AS size FROM w GROUP BY ALL),
dot AS (SELECT doc_id, pos, template, license, sum(w * v) AS dot FROM w JOIN g ON w.term = g.term GROUP BY ALL),
sc AS (SELECT d.doc_id, d.pos, license, round(dot / size, 6) AS score FROM dot d JOIN size s ON d.doc_id = s.doc_id AND d.pos = s.pos),
own AS (SELECT doc_id, license AS own, score FROM sc WHERE score >= {THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
lic AS (SELECT dir, own AS license FROM own JOIN f ON own.doc_id = f.doc_id WHERE name LIKE 'LICENSE%'
        QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, own) = 1),
up AS (SELECT dir, i AS depth, array_to_string(parts[1:i], '/') AS above
       FROM (SELECT DISTINCT dir, string_split(dir, '/') AS parts FROM f), range(1, len(parts) + 1) r(i)),
near AS (SELECT up.dir, above, license FROM up JOIN lic ON up.above = lic.dir QUALIFY row_number() OVER (PARTITION BY up.dir ORDER BY depth DESC) = 1)
SELECT f.doc_id, own AS own_license, score, coalesce(own, near.license) AS license, CASE WHEN own IS NULL THEN above END AS inherited_from
FROM f LEFT JOIN own ON f.doc_id = own.doc_id LEFT JOIN near ON f.dir = near.dir
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, coalesce(length(text), 0) AS n,
         (('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / CASE WHEN n >= size * 4 AND n <= size * 11 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w
  FROM k GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS most FROM s),
r AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above,
         sum(source_size) OVER ()::DOUBLE AS total
  FROM c),
v AS (SELECT *, (total * 1.5::DOUBLE - below) / above AS level FROM r),
t AS (
  SELECT source, source_size,
         least(most, coalesce((SELECT level FROM v x WHERE x.level * x.w <= x.most ORDER BY x.most / x.w, x.level LIMIT 1) * w, most)) AS target
  FROM v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
a AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) AS after
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN after - size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM a
"""

OP5 = rf"""
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, i AS pos, ls[i] AS line, list_filter(regexp_split_to_array(ls[i], '{_SPACES}'), lambda x: x <> '') AS words
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM p)),
w AS (SELECT doc_id, pos, len(words) AS n, array_to_string(words, ' ') AS full_line, words FROM l WHERE len(words) >= {MIN_WORDS}),
u AS (
  SELECT full_line, any_value(words) AS words, any_value(n) AS n, min({{'d': doc_id, 'p': pos}}) AS first
  FROM w GROUP BY full_line),
x AS (
  SELECT full_line, first, cut, array_to_string(list_concat(words[1:cut - 1], words[cut + 1:]), ' ') AS rest
  FROM (SELECT *, unnest(range(1, n + 1)) AS cut FROM u WHERE n >= {EDIT_WORDS})),
swapped AS (
  SELECT full_line FROM (SELECT full_line, first, min(first) OVER (PARTITION BY rest, cut) AS least FROM x) WHERE least < first),
longer AS (SELECT x.full_line FROM x JOIN u ON x.rest = u.full_line WHERE u.n >= {EDIT_WORDS} AND u.first < x.first),
shorter AS (SELECT u.full_line FROM x JOIN u ON x.rest = u.full_line WHERE u.n >= {EDIT_WORDS} AND x.first < u.first),
near AS (SELECT full_line FROM swapped UNION SELECT full_line FROM longer UNION SELECT full_line FROM shorter),
gone AS (
  SELECT w.doc_id, w.pos FROM w JOIN u USING (full_line)
  WHERE u.first <> {{'d': w.doc_id, 'p': w.pos}} OR w.full_line IN (SELECT full_line FROM near)),
kept AS (
  SELECT l.doc_id, count(*)::INTEGER AS n_lines, count(g.pos)::INTEGER AS n_removed,
         coalesce(string_agg(CASE WHEN g.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS body
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(body) AS kept_sha256 FROM kept
"""

OP12 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS place FROM d),
g AS (SELECT text_sha256, count(*) AS group_size, max(CASE WHEN place = 1 THEN doc_id END) AS keep_id FROM w GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

SQL: dict[str, str] = {"op1_license_scan": OP1, "op2_mix_sources": OP2, "op5_line_dedup": OP5, "op12_exact_dedup": OP12,
                       "op13_hard_negatives": OP13}
