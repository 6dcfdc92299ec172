"""DuckDB SQL for the operators that SQL can express; written from the contracts, not from the operators."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(c):
    return f"translate(coalesce({c}, ''), '{_UP}', '{_LOW}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_low('text')}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all({_low('text')}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT i, item_id, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s, w FROM b WHERE len(w) > 0),
bt AS (SELECT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM bw),
sizes AS (SELECT DISTINCT n FROM bt),
dw AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT DISTINCT r, dw.n, s, item_id FROM dw JOIN bt ON dw.n = bt.n AND array_to_string(w[s:s + dw.n - 1], ' ') = bt.t),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""

OP2 = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_low('text')}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS t
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS s FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM j JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS o FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.o),
comp AS (SELECT doc_id, min(o) AS c FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, comp.c AS component_id, w.doc_id = comp.c AS kept
FROM w JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)"""

_PATTERNS = [("cart", r"^[^/]+/(.*/)?(cart|checkout)(\.\w+)?/?$"), ("casino", "(^|[./_-])casino([./_-]|$)"),
             ("login", r"^[^/]+/(.*/)?login(\.\w+)?/?$"), ("porn", "(^|[./_-])porn([./_-]|$)"),
             ("spam-farm", r"^([^/]*\.)?spam-?farm\."), ("viagra", "(^|[./_-])viagra([./_-]|$)")]
_FIRST = "CASE " + " ".join(f"WHEN regexp_matches(host || path, '{p}') THEN '{n}'" for n, p in _PATTERNS) + " END"


def _fits(host, path):
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


OP4 = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE WHEN {_fits('example.net', '/en/')} THEN 'example.net/en/' WHEN {_fits('example.com', '/de/')} THEN 'example.com/de/'
                     WHEN {_fits('org', '/fr/')} THEN 'org/fr/' WHEN {_fits('net', '/')} THEN 'net/' END AS rule FROM h),
p AS (SELECT *, CASE WHEN rule IS NULL THEN {_FIRST} END AS pattern FROM r)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern
FROM p"""

OP9 = """
WITH l AS (SELECT r, doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
           FROM (SELECT row_number() OVER () AS r, * FROM documents)),
b AS (SELECT trim(line, ' ') AS t, min((doc_id, pos)) AS first FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 5),
k AS (SELECT r, doc_id, pos, line, b.t IS NOT NULL AND (doc_id, pos) <> b.first AS gone FROM l LEFT JOIN b ON trim(line, ' ') = b.t),
o AS (SELECT r, doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM k GROUP BY r, doc_id)
SELECT doc_id, n_lines, n_removed, CAST(length(kept) AS BIGINT) AS n_chars_left, sha256(kept) AS text_sha256 FROM o
UNION ALL SELECT doc_id, 0, 0, 0, sha256('') FROM documents WHERE text IS NULL"""

_CRC_STEPS = "list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"


def _crc32(key):
    """CRC-32 of an ASCII string, bit by bit."""
    codes = f"list_prepend(4294967295::BIGINT, list_transform(string_split({key}, ''), lambda c: ascii(c)::BIGINT))"
    return f"xor(list_reduce({codes}, lambda acc, b: {_CRC_STEPS}), 4294967295)"


# states of the walk: 0 nothing written, 1 a system turn, 2 ends with user, 3 ends with assistant
OP12 = f"""
WITH RECURSIVE f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS f FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE f <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
c AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, substr(role, 1, 1) AS ini,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
t AS (SELECT conv_id, i, ini, blank OR again AS dead, CAST(NOT blank AND NOT again AND cut AS INT) AS extra FROM c),
size AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
                count(*) FILTER (WHERE NOT blank AND again) AS duplicate, count(*) FILTER (WHERE NOT blank AND NOT again AND cut) AS truncated,
                count(*) FILTER (WHERE before IS NOT NULL AND (before || ini) NOT IN ('su', 'ua', 'au')) AS illegal FROM c GROUP BY conv_id),
ins AS (SELECT * FROM (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (2, 3, 'I'), (3, 2, 'I'),
                              (0, 3, 'II'), (1, 3, 'II'), (2, 2, 'II'), (3, 3, 'II')) AS x(a, b, ii)),
step AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) AS x(a, want, b)),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit FROM size
      UNION ALL
      SELECT conv_id, i, st, min(cost), arg_min(audit, (cost, audit)) FROM (
        SELECT w.conv_id, t.i, ins.b AS st, w.cost + 2 * length(ii) + 3 AS cost, w.audit || ii || 'D' AS audit
        FROM w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1 JOIN ins ON ins.a = w.st
        UNION ALL
        SELECT w.conv_id, t.i, step.b, w.cost + 2 * length(ii) + extra + CASE WHEN ini = want THEN 0 ELSE 2 END, w.audit || ii || CASE WHEN ini = want THEN 'K' ELSE 'R' END
        FROM w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1 AND NOT t.dead JOIN ins ON ins.a = w.st
               JOIN step ON step.a = ins.b AND (want <> 's' OR ini = 's')) GROUP BY conv_id, i, st),
fin AS (SELECT w.conv_id, min(w.cost + 2 * length(ii)) AS cost, arg_min(w.audit || ii, (w.cost + 2 * length(ii), w.audit || ii)) AS audit
        FROM w JOIN size ON size.conv_id IS NOT DISTINCT FROM w.conv_id AND size.n = w.i JOIN ins ON ins.a = w.st AND ins.b IN (0, 3) GROUP BY w.conv_id),
e AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, generate_subscripts(string_split(audit, ''), 1) AS j FROM fin WHERE audit <> ''),
p AS (SELECT *, count(*) FILTER (WHERE e <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
             count(*) FILTER (WHERE e <> 'D') OVER (PARTITION BY conv_id ORDER BY j DESC) AS rest FROM e),
txt AS (SELECT p.conv_id, string_agg(CASE WHEN e = 'K' THEN o.role WHEN rest % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
                                     CASE WHEN e = 'I' THEN '' ELSE o.text END, chr(10) ORDER BY j) AS s
        FROM p LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM p.conv_id AND o.i = p.i AND p.e <> 'I' WHERE e <> 'D' GROUP BY p.conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(s, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN size ON size.conv_id IS NOT DISTINCT FROM a.conv_id
     LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN txt ON txt.conv_id IS NOT DISTINCT FROM a.conv_id"""

OP13 = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_low('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: w[i:i + k - 1])) AS g FROM w, range(1, 6) AS r(k)),
f AS (SELECT lang, g, any_value(k) AS k, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 100),
c AS (SELECT lang, g, k, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.g, a, cut, x.f AS l, y.f AS r, n,
             CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM c JOIN total USING (lang) JOIN f x ON x.lang = c.lang AND x.g = c.g[1:cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
sub AS (SELECT lang, a, k, g, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, f AS a, k, g, unnest(range(2, k)) AS m FROM f WHERE k > 2)),
held AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS over FROM sub GROUP BY 1, 2),
q AS (SELECT b.* FROM b LEFT JOIN held USING (lang, g) WHERE over IS NULL OR 100 * over < 100 * a)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS BIGINT) AS rank,
       array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM q QUALIFY rank <= 2000"""

ORACLE_SQL = {"op1_decontamination": OP1, "op2_topk": OP2, "op3_near_dup": OP3, "op4_url_filter": OP4, "op9_line_dedup": OP9,
              "op12_conversation_repair": OP12, "op13_phrase_mining": OP13}
