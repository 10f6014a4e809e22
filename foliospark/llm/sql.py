"""DuckDB SQL for the operators that SQL can express: whole tables, plain definitions, no sketches or signatures."""

from __future__ import annotations

import re

from . import quality, secrets

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def either_case(names: str) -> str:
    """The letters of a pattern of names in both cases, ASCII only (RE2 also folds two non-ASCII letters)."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", names)


DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT rid, i, array_to_string(ws[i:i + 34], ' ') AS t FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY t) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + k AS i FROM hit, (SELECT unnest(range(0, 35)) AS k)),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
kept AS (SELECT w.rid, string_agg(w.w, ' ' ORDER BY w.i) AS t, count(*) AS n FROM w ANTI JOIN gone ON w.rid = gone.rid AND w.i = gone.i GROUP BY w.rid)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""

_ratios = ", ".join(f"{v.replace(' div ', ' // ')} AS {k}" for k, v in quality.RATIOS.items())
_ranks = ", ".join(f"row_number() OVER (PARTITION BY lang, source ORDER BY {k}) AS at_{k}" for k in quality.RATIOS)
_rules = [(k, "+", *r) for k, r in quality.UPPER.items()] + [(k, "-", *r) for k, r in quality.LOWER.items()]
_cuts = ", ".join(f"min({k}) FILTER (1000 * at_{k} >= {q} * n) AS {k}{q}" for k, q in sorted({(r[0], q) for r in _rules for q in r[2:4]}))
_spreads = ", ".join(f"abs({k}{q} - {k}{inner}) AS spread{i}" for i, (k, _, q, inner, _) in enumerate(_rules))
_mids = ", ".join(f"quantile_disc(spread{i}, 0.5) AS mid{i}" for i in range(len(_rules)))
_bad = " OR ".join(f"{k} {'>' if sign == '+' else '<'} {k}{q} {sign} ({f} * greatest(spread{i}, mid{i}) + 1)" for i, (k, sign, q, _, f) in enumerate(_rules))

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT rid, i, w AS a, lead(w) OVER p AS b, lead(w, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n > 1),
reps AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS i FROM twice, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY rid),
chars AS (SELECT rid, sum(length(w)) AS n FROM w GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT x) AS own FROM (SELECT rid, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
s AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(chars.n, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_lines,
    CAST(coalesce(lines.n - lines.own, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(reps.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN chars ON d.rid = chars.rid LEFT JOIN lines ON d.rid = lines.rid LEFT JOIN reps ON d.rid = reps.rid),
r AS (SELECT *, {quality.BASE} AS base_failed, {_ratios} FROM s),
p AS (SELECT *, {_ranks}, count(*) OVER (PARTITION BY lang, source) AS n FROM r WHERE NOT base_failed),
f AS (SELECT *, {_spreads} FROM (SELECT lang, source, {_cuts} FROM p GROUP BY lang, source)), o AS (SELECT {_mids} FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({_bad}, false) AS kept
FROM r LEFT JOIN f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source, o
"""

JACCARD = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (SELECT rid, list_sort(list_distinct(CASE WHEN len(ws) BETWEEN 1 AND 2 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END)) AS s FROM d),
node AS (SELECT s, min(rid) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
gram AS (SELECT node, n, unnest(s) AS g FROM node),
link AS (SELECT a.node AS u, b.node AS v FROM gram a JOIN gram b ON a.g = b.g AND a.node <> b.node AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.node, b.node HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT node AS u, node AS v FROM node UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
least AS (SELECT r.u AS node, min(d.doc_id) AS component_id FROM reach r JOIN node n ON r.v = n.node JOIN sets ON sets.s = n.s JOIN d ON d.rid = sets.rid GROUP BY r.u)
SELECT d.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM d JOIN sets ON d.rid = sets.rid LEFT JOIN node ON sets.s = node.s LEFT JOIN least ON node.node = least.node
"""

#: CRC-32 (reflected polynomial 0xEDB88320): eight shifts make a table entry, one look-up takes a byte.
SHARDS = r"""
WITH RECURSIVE shift AS (SELECT b, b AS c, 0 AS k FROM (SELECT unnest(range(0, 256)) AS b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shift WHERE k < 8),
entries AS (SELECT list(c ORDER BY b) AS t FROM shift WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, CAST(octet_length(encode(text)) + 8 AS BIGINT) AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, entries),
o AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run, sum(size) OVER () AS total,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS place FROM c),
s AS (SELECT *, CAST(least(23, (CAST(run AS HUGEINT) + size // 2) * 24 // total) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""


def _secrets() -> str:
    """The base patterns by scan; weak parts by their nearest complementary parts, as running extremes."""
    quote = r"""["'']?\x20*[:=]\x20*["'']?"""
    patterns = {
        "assign": either_case("(?:password|passwd|secret|token|api_?key)") + quote + "[A-Za-z0-9+/_.=-]+",
        "access": secrets.ACCESS, "hex": "[0-9a-f]{32,}", "weak": secrets.WEAK,
        "ident": either_case("(?:user(?:_?name)?|login|client_?id|account(?:_?id)?|key_?id)") + quote + "[A-Za-z0-9_.@-]{3,}",
        "endpoint": r"""(?:https?|ftp|postgres(?:ql)?|mysql|redis|mongodb|amqp|s3)://[^\x00-\x20"''<>]+""",
    }
    value = f"regexp_extract(m, '{patterns['assign'].replace('[A-Za-z0-9+/_.=-]+', '([A-Za-z0-9+/_.=-]+)')}', 1)"
    scan = " UNION ALL ".join(
        f"SELECT rid, {k} AS k, '{name}' AS kind, regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS gs FROM d" for k, (name, p) in enumerate(patterns.items()))
    near = lambda r: f"(coalesce({r}_before >= start - {secrets.SCOPE}, false) OR coalesce({r}_after <= stop + {secrets.SCOPE}, false))"
    sweeps = ", ".join(f"max(stop) FILTER (role = '{r}') OVER up AS {r}_before, min(start) FILTER (role = '{r}') OVER down AS {r}_after" for r in ("id", "secret"))
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
scan AS ({scan}),
each AS (SELECT rid, k, kind, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i FROM scan WHERE len(ms) > 0),
spot AS (SELECT rid, k, kind, m, CAST(sum(length(g) + length(m)) OVER (PARTITION BY rid, k ORDER BY i) AS BIGINT) AS stop FROM each),
p AS (SELECT rid, k, kind, stop - length(m) AS start, stop, CASE WHEN kind IN ('access', 'ident') THEN 'id' WHEN kind = 'endpoint' THEN 'endpoint' ELSE 'secret' END AS role FROM spot
  WHERE CASE kind WHEN 'assign' THEN length({value}) >= 8 WHEN 'weak' THEN regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]') ELSE true END),
q AS (SELECT *, {sweeps}, max(stop) FILTER (k < 3) OVER up AS over, min(start) FILTER (k < 3) OVER down AS under FROM p
  WINDOW up AS (PARTITION BY rid ORDER BY start, k, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), down AS (PARTITION BY rid ORDER BY start DESC, k DESC, stop DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT rid, k, kind, start, stop FROM q WHERE k < 3 OR (coalesce(over <= start, true) AND coalesce(under >= stop, true)
  AND CASE kind WHEN 'weak' THEN {near('id')} WHEN 'ident' THEN {near('secret')} ELSE {near('id')} AND {near('secret')} END))
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce({text} FILTER (k < 3), '')) AS base_sha256, coalesce({text} FILTER (k IS NOT NULL), '') AS spans
FROM d LEFT JOIN a ON d.rid = a.rid GROUP BY d.rid
"""


SECRETS = _secrets()
