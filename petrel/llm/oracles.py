"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from petrel.llm import decontaminate, lines, quality, resample, secrets, substrings

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_PLAIN = decontaminate._WORDS

_REACH = f"(PARTITION BY r, run ORDER BY i ROWS BETWEEN CURRENT ROW AND {substrings.ANCHORS - 1} FOLLOWING)"

SUBSTRINGS = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SPACED} AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL),
g AS MATERIALIZED (SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS lo, max(doc_id) AS hi FROM g GROUP BY h),
c AS (SELECT r, list(DISTINCT k) FILTER (gone) AS gone, bool_or(rep) AS rep FROM (SELECT r, unnest(range(i, i + 13)) AS k, lo < doc_id AS gone, lo <> hi AS rep FROM g JOIN f USING (h)) GROUP BY r),
s AS (SELECT r, doc_id, i, substr(h, 1, 16) AS h, i - row_number() OVER (PARTITION BY r ORDER BY i) AS run FROM g JOIN f USING (h) WHERE lo <> hi),
m AS (SELECT *, min(h) OVER {_REACH} AS least, count(*) OVER {_REACH} AS reach, count(*) OVER (PARTITION BY r, run) AS size, min(h) OVER (PARTITION BY r, run) AS whole, max(i) OVER (PARTITION BY r, run) AS run_end FROM s),
a AS (SELECT r, doc_id, i, run_end FROM (SELECT *, max(CASE WHEN reach = {substrings.ANCHORS} THEN least END) OVER (PARTITION BY r, run ORDER BY i ROWS BETWEEN {substrings.ANCHORS - 1} PRECEDING AND CURRENT ROW) AS seen FROM m) WHERE h = CASE WHEN size < {substrings.ANCHORS} THEN whole ELSE seen END),
l AS MATERIALIZED (SELECT r, a.doc_id, n, md5(array_to_string(w[i:i + n - 1], ' ')) AS h FROM a JOIN d USING (r), (SELECT 13 * (1 << k) AS n FROM range(1, 20) t(k)) WHERE i + n - 13 <= run_end),
longest AS (SELECT r, max(n) AS n FROM l JOIN (SELECT n, h FROM l GROUP BY n, h HAVING min(doc_id) <> max(doc_id)) USING (n, h) GROUP BY r),
x AS (SELECT r, doc_id, w, coalesce(gone, []) AS gone, rep FROM d LEFT JOIN c USING (r)),
y AS (SELECT r, doc_id, w, rep, len(gone) AS n_removed, CASE WHEN len(gone) = 0 THEN w ELSE list_transform(list_filter(list_transform(w, lambda v, i: {{'v': v, 'out': list_contains(gone, i)}}), lambda s: NOT s.out), lambda s: s.v) END AS kept FROM x)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256, CAST(coalesce(n, CASE WHEN rep THEN 13 ELSE 0 END) AS INTEGER) AS longest FROM y LEFT JOIN longest USING (r)
"""

_ESCAPED = "replace(replace(coalesce({x}, ''), '&', '&amp;'), '<', '&lt;')"
_TURN = "11 + length(" + _ESCAPED.format(x="role") + ") + 4 * (length(coalesce(role, '')) - length(replace(coalesce(role, ''), chr(10), ''))) + length(" + _ESCAPED.format(x="text") + ") + 5"

CHAT = rf"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns,
  coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (role = 'assistant'), '') AS loss, sum({_TURN}) AS f FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(f - n_turns AS BIGINT) AS formatted_chars FROM o
"""

_FENCES = quality.FENCES
_LO = [m for m, f in _FENCES.items() if f.below]


def _fences(level: int, keys: list[str]) -> str:
    by = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {by}measure" if keys else "PARTITION BY measure"
    names = "".join(f"{k} AS {k}_{level}, " for k in keys)
    at = sorted({0.5, *(q for f in _FENCES.values() for q in (f.middle, f.high))})
    of = lambda m, q: f"max(q{round(100 * q)}) FILTER (measure = '{m}')"
    spread = lambda m, f: f"greatest({of(m, f.high)} - {of(m, f.middle)}, {f.event * f.scale} // greatest({of(f.whole, 0.5)}, 1), 1)"
    wide = ", ".join(f"{of(m, f.high)} + {f.reach} * {spread(m, f)} AS {m}_hi_{level}" for m, f in _FENCES.items())
    low = "".join(f", {of(m, _FENCES[m].middle)} - {_FENCES[m].reach} * {spread(m, _FENCES[m])} AS {m}_lo_{level}" for m in _LO)
    quantile = lambda q: f"min((bucket % 64) << (bucket // 64)) FILTER (cum * 100 >= total * {round(100 * q)}) AS q{round(100 * q)}"
    group = f"GROUP BY {', '.join(map(str, range(1, len(keys) + 1)))}" if keys else ""
    inner = f"SELECT {by}measure, max(total) AS total, {', '.join(map(quantile, at))} FROM (SELECT {by}measure, bucket, sum(n) OVER ({part} ORDER BY bucket) AS cum, sum(n) OVER ({part}) AS total FROM (SELECT {by}measure, bucket, count(*) AS n FROM b GROUP BY ALL)) GROUP BY ALL"
    return f"f{level} AS (SELECT {names}max(total) AS rows_{level}, {wide}{low} FROM ({inner}) {group})"


def _picked(c: str) -> str:
    return f"CASE WHEN rows_2 >= {quality.LEAST_ROWS} THEN {c}_2 WHEN rows_1 >= {quality.LEAST_ROWS} THEN {c}_1 ELSE {c}_0 END"


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {_SPACED} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS h FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
c AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS c FROM g) WHERE c > 1) GROUP BY r),
m AS MATERIALIZED (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM d LEFT JOIN c USING (r)),
s AS MATERIALIZED (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed, {", ".join(f"CASE WHEN {f.whole} > 0 THEN {f.part} * {f.scale} // {f.whole} ELSE 0 END AS {m}" for m, f in _FENCES.items())} FROM m),
u AS (SELECT lang, source, unnest([{", ".join(f"'{m}'" for m in quality.MEASURES)}]) AS measure, unnest([{", ".join(quality.MEASURES)}]) AS v FROM s WHERE NOT base_failed),
b AS MATERIALIZED (SELECT lang, source, measure, e * 64 + (v >> e) AS bucket FROM (SELECT *, greatest(0, length(bin(v)) - 6) AS e FROM u)),
{_fences(2, ["lang", "source"])},
{_fences(1, ["lang"])},
{_fences(0, [])},
t AS (SELECT lang_2, source_2, {", ".join(f"{_picked(f'{m}_hi')} AS {m}_hi" for m in _FENCES)}, {", ".join(f"{_picked(f'{m}_lo')} AS {m}_lo" for m in _LO)} FROM f2 LEFT JOIN f1 ON lang_2 IS NOT DISTINCT FROM lang_1 CROSS JOIN f0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({" AND ".join([*(f"{m} <= {m}_hi" for m in _FENCES), *(f"{m} >= {m}_lo" for m in _LO)])}, true) AS kept
FROM s LEFT JOIN t ON lang IS NOT DISTINCT FROM lang_2 AND source IS NOT DISTINCT FROM source_2
"""


def _found(rank: int, rule: secrets.Rule) -> str:
    """Spans of a rule as a list: what stands between the matches gives their places."""
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    size = f"length(regexp_extract_all(text, {pattern}, {rule.group})[i])"
    start = f"CAST(coalesce(list_sum(list_transform(string_split_regex(text, {pattern})[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(regexp_extract_all(text, {pattern})[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    return f"SELECT r, {start} AS a, {rank} AS k, {start} + length(regexp_extract_all(text, {pattern})[i]) AS b FROM (SELECT r, text, unnest(range(1, len(regexp_extract_all(text, {pattern})) + 1)) AS i FROM d WHERE regexp_matches(text, {pattern})) WHERE {size} >= {rule.least}"


_KINDS = "[" + ", ".join(f"'{r.kind}'" for r in secrets.RULES) + "]"
_SPAN = f"string_agg({_KINDS}[k + 1] || ':' || a || ':' || b, ',' ORDER BY a, k)"

SECRETS = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
h AS MATERIALIZED ({" UNION ALL ".join(_found(k, r) for k, r in enumerate(secrets.RULES))}),
s AS (SELECT r, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, {_SPAN} FILTER (k < {secrets.BASE}) AS base, {_SPAN} AS spans FROM h GROUP BY r)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (r)
"""

JACCARD = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE ['<' || array_to_string(w, ' ') || '>'] END) AS g FROM d WHERE len(w) > 0 AND doc_id IS NOT NULL),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
e AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY 1, 2) JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE c * 1800 >= 800 * (na.n + nb.n)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
cls AS (SELECT a AS r, min(doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY 1),
same AS (SELECT r, CASE WHEN len(w) > 0 AND doc_id IS NOT NULL THEN min(doc_id) OVER (PARTITION BY w) ELSE doc_id END AS same_id FROM d),
k AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY 1)
SELECT doc_id, class_id, same_id, coalesce(n_links, 0) AS n_links FROM d JOIN cls USING (r) JOIN same USING (r) LEFT JOIN k USING (r)
"""

_BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWERED = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (SELECT r, doc_id, i, lines[i] AS line, {_LOWERED.format(x=f"trim(lines[i], {_BLANKS})")} AS k FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
m AS (SELECT k, min(doc_id) AS lo FROM l WHERE length(k) >= {lines.LEAST} GROUP BY k HAVING min(doc_id) < max(doc_id)),
g AS (SELECT r, doc_id, i, line, coalesce(lo < doc_id, false) AS gone FROM l LEFT JOIN m USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM g GROUP BY r, doc_id
"""

# CRC-32 by its table of 256 remainders, which the polynomial gives bit by bit
_BIT = "CASE c & 1 WHEN 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))), lambda c, x: xor(c >> 8, bits[(xor(c, x) & 255) + 1])), 4294967295)"

RESAMPLING = rf"""
WITH RECURSIVE step(b, k, c) AS (SELECT b, 0, b FROM range(256) t(b) UNION ALL SELECT b, k + 1, {_BIT} FROM step WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS bits FROM step WHERE k = 8),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS ws FROM documents),
o AS MATERIALIZED (SELECT r, unnest(ws) AS w FROM d),
v AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT unnest({_PLAIN}) AS w FROM benchmark) GROUP BY w),
h AS MATERIALIZED (SELECT w, {_CRC} % {resample.BUCKETS} AS bucket FROM (SELECT w FROM o UNION SELECT w FROM v), crc),
s AS (SELECT bucket, count(*) AS s FROM o JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM v JOIN h USING (w) GROUP BY bucket),
z AS (SELECT CAST((SELECT count(*) FROM o) + {resample.BUCKETS} AS DOUBLE) AS zs, CAST((SELECT coalesce(sum(n), 0) FROM v) + {resample.BUCKETS} AS DOUBLE) AS zt),
g AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * zs / (CAST(s + 1 AS DOUBLE) * zt))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket) CROSS JOIN z),
x AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM o JOIN h USING (w) JOIN g USING (bucket) GROUP BY r),
y AS MATERIALIZED (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('{resample.SEED}:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN x USING (r)),
f AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS rank, count(*) OVER () AS n FROM y WHERE n_features >= {resample.LEAST_WORDS} AND doc_id IS NOT NULL)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN rank <= {resample.PERCENT} * n // 100 THEN rank END AS BIGINT) AS rank FROM y LEFT JOIN f USING (r)
"""

ORACLES = {
    "op2_substring_dedup": SUBSTRINGS,
    "op3_chat_format": CHAT,
    "op4_quality_rules": QUALITY,
    "op5_secret_scan": SECRETS,
    "op6_jaccard_join": JACCARD,
    "op7_benchmark_decontamination": decontaminate.ORACLE,
    "op11_line_dedup": LINES,
    "op12_importance_resampling": RESAMPLING,
}
