"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH hashed AS (SELECT doc_id, sha256({LOWER}) AS h FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       h AS text_sha256
FROM hashed WINDOW w AS (PARTITION BY h)
"""

OP5 = """
WITH convs AS (
  SELECT conv_id, conv_id // 2 AS duo, list({'role': coalesce(role, 'user'), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), lasts AS (
  SELECT *, r[len(r)] AS l, r[1 + conv_id % len(r)] AS cut FROM (SELECT *, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') AS r FROM convs) WHERE len(r) > 0
), pairs AS (
  SELECT a.conv_id, a.turns[1:a.l] AS chosen, list_concat(a.turns[1:a.cut - 1], b.turns[b.cut:b.l]) AS rejected
  FROM lasts a JOIN lasts b ON a.duo = b.duo AND a.conv_id <> b.conv_id
), prefixes AS (
  SELECT *, list_min(list_transform(range(0, least(len(chosen), len(rejected)) + 1), lambda i: CASE WHEN i = least(len(chosen), len(rejected)) OR chosen[i + 1] <> rejected[i + 1] THEN i ELSE 1000000 END)) AS n FROM pairs
), sides AS (
  SELECT conv_id, n, chosen[1:n] AS p, chosen[n + 1:] AS c, rejected[n + 1:] AS r FROM prefixes
), rendered AS (
  SELECT conv_id, n,
    list_transform(p, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS ps,
    list_transform(c, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS cs,
    list_transform(r, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS rs, c, r
  FROM sides
)
SELECT conv_id, CAST(n AS BIGINT) AS prompt_turns,
  array_to_string(ps, '') AS prompt,
  array_to_string(cs, '') AS chosen_text,
  array_to_string(list_filter(list_transform(range(1, len(c) + 1), lambda i: CASE WHEN c[i].role = 'assistant' THEN (coalesce(list_sum(list_transform(cs[1:i - 1], lambda x: length(x))), 0) + 13 + length(c[i].role))::BIGINT || '-' || list_sum(list_transform(cs[1:i], lambda x: length(x)))::BIGINT END), lambda x: x IS NOT NULL), ',') AS chosen_mask,
  array_to_string(rs, '') AS rejected_text,
  array_to_string(list_filter(list_transform(range(1, len(r) + 1), lambda i: CASE WHEN r[i].role = 'assistant' THEN (coalesce(list_sum(list_transform(rs[1:i - 1], lambda x: length(x))), 0) + 13 + length(r[i].role))::BIGINT || '-' || list_sum(list_transform(rs[1:i], lambda x: length(x)))::BIGINT END), lambda x: x IS NOT NULL), ',') AS rejected_mask
FROM rendered
"""

#: op8: the same draws, with the distribution function summed by a recursive query.
OP8 = """
WITH RECURSIVE per AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), rated AS (
  SELECT source, (SELECT sum(n) FROM per)::DOUBLE * pow(n::DOUBLE, 0.5) / (SELECT sum(pow(n::DOUBLE, 0.5)) FROM per) / n AS rate FROM per
), drawn AS (
  SELECT doc_id, text, lang, d.source, n_chars, rate, ('0x' || md5('42:' || coalesce(doc_id::VARCHAR, 'null') || ':0')[1:13])::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM documents d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
), steps AS (
  SELECT rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM (SELECT DISTINCT rate FROM rated)
  UNION ALL
  SELECT rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM steps WHERE k < 200
), counted AS (
  SELECT d.*, (SELECT min(k) FROM steps s WHERE s.rate = d.rate AND s.c > d.u) AS copies FROM drawn d
)
SELECT doc_id, text, lang, source, n_chars, rate AS mean_rate, copies::INTEGER AS copies, i::INTEGER AS copy,
       md5('order42:' || coalesce(doc_id::VARCHAR, 'null') || ':' || i) AS shuffle_key
FROM counted, range(0, copies) t(i)
"""

SQL = {"op2_exact_dedup": OP2, "op5_preference": OP5, "op8_mixing": OP8}
