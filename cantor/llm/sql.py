"""DuckDB statements that give the rows of the queries SQL can express, built from the operators' parameters."""

from __future__ import annotations

import math

from . import licenses, mixing, quality


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _license_sql() -> str:
    known = ", ".join(f"({_text(v)}, {_text(k)})" for k, v in licenses.SENTENCES.items())
    hits = ", ".join(f"CASE WHEN line LIKE '%,{',%,'.join(ids)},%' THEN {_text(name)} END" for name, ids in licenses.RULES)
    return f"""
WITH known(sentence, sid) AS (VALUES {known}),
cut AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '\\n([a-z])', ' \\1', 'g'), '[.!?:;]+["\\x20\\x09\\x0B-\\x0D]|[.!?:;]*\\n'), lambda s: trim(s, ' ' || chr(9)) <> '') AS s FROM documents),
parts AS (SELECT r, unnest(s) AS s, generate_subscripts(s, 1) AS i FROM cut),
ids AS (SELECT r, string_agg(sid, ',' ORDER BY i) AS sentence_ids FROM parts JOIN known ON sentence = trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ') GROUP BY r),
lines AS (SELECT doc_id, len(s)::BIGINT AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids, ',' || replace(coalesce(sentence_ids, ''), ',', ',,') || ',' AS line FROM cut LEFT JOIN ids USING (r)),
named AS (SELECT *, list_filter([{hits}], lambda x: x IS NOT NULL) AS raw FROM lines)
SELECT doc_id, n_sentences, sentence_ids, array_to_string(list_filter(raw, lambda x, i: list_position(raw, x) = i), ',') AS license_ids, raw[1] AS license FROM named"""


def _mixing_sql() -> str:
    u = mixing.UNIT
    return f"""
WITH sizes AS (SELECT source, sum(length(coalesce(text, '')))::BIGINT AS size, sqrt(sum(length(coalesce(text, '')))::DOUBLE) AS wanted FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN size = 0 THEN {u} ELSE round((SELECT sum(size)::DOUBLE / sum(wanted) FROM sizes) * wanted / size * {u})::BIGINT END AS rate_ppm FROM sizes),
means AS (SELECT *, rate_ppm::DOUBLE / {u} / draws AS mean FROM (SELECT *, greatest(1, ceil(rate_ppm / {u * mixing.MOST_MEAN}))::BIGINT AS draws FROM rates)),
terms AS (SELECT source, k, exp(-mean) * pow(mean, k) / gamma(k + 1) AS p FROM means, LATERAL (SELECT unnest(range(0, ceil(mean + 12 * sqrt(mean) + 20)::BIGINT + 1)) AS k)),
steps AS (SELECT source, list(c ORDER BY k) AS cdf FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
drawn AS (SELECT d.*, m.rate_ppm, list_sum(list_transform(range(0, m.draws), lambda j: len(list_filter(s.cdf, lambda c: c <= ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || CASE WHEN j = 0 THEN '' ELSE ':' || j END), 1, 13))::BIGINT / {2**52}::DOUBLE))))::BIGINT AS copies
  FROM documents d JOIN means m ON d.source IS NOT DISTINCT FROM m.source JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)
SELECT *, ('0x' || substr(md5('{mixing.SEED}s:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 15))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn)"""


def _quality_sql() -> str:
    q = quality
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    words = ", ".join(map(_text, q.FUNCTION_WORDS))
    names = [name for name, _, _ in q.RULES]
    cases = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v_{name}" for name, bad, good in q.RULES)
    odds = lambda prior, a: f"ln({prior} / (1 - {prior}))" + "".join(f" + v_{n} * ln({a(n)} / (1 - {a(n)}))" for n in names)
    clip = lambda x, low: f"least({q.MOST}, greatest({low}, {x}))"
    fitted = ", ".join(clip(f"(sum(n * CASE v_{k} WHEN 1 THEN q WHEN -1 THEN 1 - q ELSE 0 END) + {q.SMOOTHING * q.ACCURACY}) / (sum(n * abs(v_{k})) + {q.SMOOTHING})", q.LEAST) for k in names)
    return f"""
WITH RECURSIVE cut AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {space}) <> '') AS l FROM documents),
grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM (SELECT r, i, list_slice(w, i, i + {q.WINDOW - 1}) AS g FROM (SELECT r, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM cut))),
covered AS (SELECT r, sum(least({q.WINDOW}, i - before))::BIGINT AS n FROM (SELECT r, i, lag(i, 1, -{q.WINDOW}) OVER (PARTITION BY r ORDER BY i) AS before FROM grams WHERE c > 1) GROUP BY r),
counted AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
  len(list_filter(w, lambda x: x IN ({words}))) AS n_function, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, len(list_filter(l, lambda x: right(x, 1) IN ('.', '!', '?', '"'))) AS n_ended, coalesce(n, 0)::BIGINT AS n_repeat_words FROM cut LEFT JOIN covered USING (r)),
voted AS (SELECT *, {cases}, ({q.BASE}) AS base_failed FROM counted),
patterns AS (SELECT {", ".join(f"v_{n}" for n in names)}, count(*) AS n FROM voted GROUP BY ALL),
em(it, prior, {", ".join(f"a_{n}" for n in names)}) AS (SELECT 0, {q.PRIOR}::DOUBLE, {", ".join([f"{q.ACCURACY}::DOUBLE"] * len(names))}
  UNION ALL SELECT it + 1, {clip(f"(sum(n * q) + {q.SMOOTHING * q.PRIOR}) / (sum(n) + {q.SMOOTHING})", 1 - q.MOST)}, {fitted}
  FROM (SELECT patterns.*, it, 1 / (1 + exp(-({odds("prior", lambda n: f"a_{n}")}))) AS q FROM em, patterns WHERE it < {q.ITERATIONS}) GROUP BY it)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {odds("prior", lambda n: f"a_{n}")} >= {math.log(1.0)} AS kept FROM voted, em WHERE it = {q.ITERATIONS}"""


LICENSE_SQL, MIXING_SQL, QUALITY_SQL = _license_sql(), _mixing_sql(), _quality_sql()
