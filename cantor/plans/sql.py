"""DuckDB statements that give the rows of the catalogue's queries."""

from __future__ import annotations

from ..functions.text import _ONE, _SEVERAL, _TO, ABBREVIATIONS
from ..operators.gate import MAX_END_GAP, MAX_LEAD_S, MIN_COVERAGE, MIN_DOC_COVERAGE, MIN_MEDIAN_CONF
from ..operators.metrics import APPARATUS_ID, MAX_DISCOUNT


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(map(_q, words)) + ")"


def _fold(x: str) -> str:
    out = f"translate({x}, {_q(_ONE)}, {_q(_TO)})"
    for letter, text in _SEVERAL.items():
        out = f"replace({out}, {_q(letter)}, {_q(text)})"
    return out


WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LANG = "coalesce(nullif(split_part(lower({}), '-', 1), ''), 'en')"

#: Common tables, each named once and put before the statements that use it.
_CTE = {
    "lines": f"lines AS (SELECT book_id, language, unnest(l) AS text, generate_subscripts(l, 1) AS ord FROM (SELECT doc_id AS book_id, {_LANG.format('lang')} AS language, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {WS})), lambda x: x <> '') AS l FROM documents))",
    "frags": "frags AS (SELECT *, 'text-p' || ord AS anchor_id FROM lines WHERE len(string_split(text, ' ')) >= 2)",
    "tok": "tok AS (SELECT book_id, ord, language, unnest(t) AS raw, generate_subscripts(t, 1) AS k, len(t) AS n FROM (SELECT book_id, ord, language, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS t FROM frags))",
    "cut": f"""cut AS (SELECT *, coalesce(sum(brk) OVER (PARTITION BY book_id, ord ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS frag FROM
  (SELECT *, CASE WHEN k < n AND right(raw, 1) IN ('.', '?', '!', ';', ':', ',', '—') AND NOT (right(raw, 1) IN ('.', '?', '!', ';') AND (length(core) <= 1 OR (language = 'fr' AND core IN {_in(ABBREVIATIONS['fr'])}) OR (language <> 'fr' AND core IN {_in(ABBREVIATIONS['en'])}))) THEN 1 ELSE 0 END AS brk FROM
  (SELECT *, regexp_replace(lower(CASE WHEN language = 'en' THEN raw ELSE {_fold('raw')} END), '[^a-z]', '', 'g') AS core FROM tok)))""",
    "merged": """merged AS (SELECT *, sum(starts) OVER (PARTITION BY book_id, ord ORDER BY k) - 1 AS mi FROM
  (SELECT *, CASE WHEN k = min(k) OVER (PARTITION BY book_id, ord, frag) AND (frag = 0 OR count(*) OVER (PARTITION BY book_id, ord, frag) >= 4) THEN 1 ELSE 0 END AS starts FROM cut))""",
    "phrased": """phrased AS (SELECT book_id, ord, language, k, raw, (CASE WHEN short THEN greatest(mi - 1, 0) ELSE mi END)::INT AS phrase FROM
  (SELECT *, sum(CASE WHEN mi = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY book_id, ord) < 4 AND max(mi) OVER (PARTITION BY book_id, ord) > 0 AS short FROM merged))""",
    "words": f"""words AS (SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY ord, k) - 1 AS g, ord, phrase, norm FROM
  (SELECT *, regexp_replace(lower(CASE WHEN language = 'en' THEN raw ELSE {_fold('raw')} END), '[^a-z'']', '', 'g') AS norm FROM phrased) WHERE norm <> '')""",
    "aligned": "aligned AS (SELECT *, 'text-p' || ord AS anchor_id, g * 30 + (g * 7) % 13 AS bf, g * 30 + (g * 7) % 13 + 20 AS ef, (book_id * 31 + g * 17) % 100 AS score FROM words WHERE (book_id * 7 + ord * 13) % 10 > 0)",
    "prows": "prows AS (SELECT book_id, ord, anchor_id, phrase AS phrase_index, arg_min(bf, g) AS begin_cs, (sum(score) // count(*))::BIGINT AS conf FROM aligned GROUP BY ALL)",
    "marked": f"""marked AS (SELECT *, CASE WHEN body THEN (sum(body::INT) OVER (PARTITION BY book_id ORDER BY ord) - 1)::BIGINT END AS body_idx FROM
  (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY ord) - 1 AS idx, NOT app OR sum(CASE WHEN app THEN 0 ELSE 1 END) OVER (PARTITION BY book_id) * 2 < count(*) OVER (PARTITION BY book_id) AS body FROM
  (SELECT book_id, ord, anchor_id, p IS NOT NULL AS placed, regexp_matches(anchor_id, '{APPARATUS_ID}') AS app FROM frags LEFT JOIN (SELECT DISTINCT book_id, anchor_id, 1 AS p FROM prows) USING (book_id, anchor_id))))""",
    "covered": """covered AS (SELECT book_id, count(*) AS paras, count(*) FILTER (placed) AS placed, min(idx) FILTER (placed) AS first_idx, max(idx) FILTER (placed) AS last_idx, count(*) FILTER (body) AS body_paras,
  min(body_idx) FILTER (placed AND body) AS first_body, max(body_idx) FILTER (placed AND body) AS last_body FROM marked GROUP BY book_id)""",
    "sized": "sized AS (SELECT book_id, max(g) * 30 / 100 + 60 AS audio_s FROM words GROUP BY book_id)",
    "ended": f"""ended AS (SELECT s.book_id, CASE WHEN b IS NULL THEN audio_s ELSE greatest(0, b - CASE WHEN sec * 1000 > {MAX_DISCOUNT} THEN 0 ELSE sec * 1000 END) END AS lead_s, CASE WHEN e IS NULL THEN audio_s ELSE greatest(0, audio_s - e) END AS tail_s, audio_s FROM sized s
  LEFT JOIN (SELECT book_id, arg_min(b, ord) AS b, arg_min(sec, ord) AS sec, max(ord) AS last_ord FROM (SELECT book_id, ord, min(begin_cs) / 100 AS b, min(begin_cs) // 100000 AS sec FROM prows GROUP BY ALL) GROUP BY book_id) f USING (book_id)
  LEFT JOIN (SELECT book_id, ord, max(ef) / 100 AS e FROM aligned GROUP BY ALL) l ON l.book_id = s.book_id AND l.ord = last_ord)""",
    "measured": """measured AS (SELECT c.book_id, paras, placed, round(first_body / body_paras, 3) AS start_gap, round((body_paras - 1 - last_body) / body_paras, 3) AS end_gap, round(coalesce(placed / (last_idx - first_idx + 1), 0), 3) AS span_coverage, round(lead_s, 1) AS lead_s, coalesce(median, 0) AS median_conf
  FROM covered c LEFT JOIN ended USING (book_id) LEFT JOIN (SELECT book_id, list_sort(list((conf + 40) / 100))[count(*) // 2 + 1] AS median FROM prows GROUP BY book_id) USING (book_id))""",
    "line": "line AS (SELECT conv_id AS book_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, role AS reader, length(text) * 10 AS secs_cs, coalesce(sum(length(text) * 10) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM conversations)",
    "begins": "begins AS (SELECT book_id, anchor_id, min(begin_cs) AS whole_begin FROM prows GROUP BY ALL)",
    "located": "located AS (SELECT b.*, coalesce(l.position, f.position) AS section, coalesce(l.start, f.start) AS section_start FROM begins b ASOF LEFT JOIN line l ON b.book_id = l.book_id AND b.whole_begin >= l.start JOIN (SELECT book_id, position, start FROM line WHERE position = 1) f ON f.book_id = b.book_id)",
    "kept": "kept AS (SELECT *, whole_begin - section_start AS \"begin\" FROM located SEMI JOIN (SELECT book_id, anchor_id FROM frags WHERE (book_id + ord) % 11 > 0) USING (book_id, anchor_id))",
    "pars": 'pars AS (SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY whole_begin, anchor_id) AS par, anchor_id, section, whole_begin, "begin", lead("begin") OVER (PARTITION BY book_id, section ORDER BY whole_begin, anchor_id) AS clip_end FROM kept)',
    "said": """said AS (SELECT book_id, ord, k, raw, norm, row_number() OVER (PARTITION BY book_id ORDER BY ord, k) - 1 AS g FROM
  (SELECT *, regexp_replace(lower(raw), '[^a-z'']', '', 'g') AS norm FROM (SELECT book_id, ord, unnest(t) AS raw, generate_subscripts(t, 1) AS k FROM (SELECT conv_id AS book_id, turn AS ord, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS t FROM conversations))) WHERE norm <> '')""",
    "spoken": """spoken AS (SELECT *, 200 + coalesce(sum(2 * length(norm) + 2) OVER (PARTITION BY book_id ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bf, count(*) OVER (PARTITION BY book_id) AS n FROM said)""",
    "cutlines": "cutlines AS (SELECT *, sum(h::INT) OVER (PARTITION BY book_id ORDER BY block) + CASE WHEN first(h) OVER (PARTITION BY book_id ORDER BY block) THEN 0 ELSE 1 END AS s FROM (SELECT book_id, ord - 1 AS block, text, len(string_split(text, ' ')) <= 3 AS h FROM lines))",
    "sectioned": "sectioned AS (SELECT book_id, block, text, h, title, dense_rank() OVER (PARTITION BY book_id ORDER BY s) AS section FROM (SELECT *, max(CASE WHEN h THEN text END) OVER (PARTITION BY book_id, s) AS title FROM cutlines) WHERE title IS NULL OR NOT regexp_matches(title, '(?i)^(contents|table of contents|transcriber|illustrations)'))",
}
_NEEDS = {
    "frags": ("lines",), "tok": ("frags",), "cut": ("tok",), "merged": ("cut",), "phrased": ("merged",), "words": ("phrased",), "aligned": ("words",), "prows": ("aligned",), "marked": ("frags", "prows"), "covered": ("marked",),
    "sized": ("words",), "ended": ("sized", "prows", "aligned"), "measured": ("covered", "ended", "prows"), "begins": ("prows",), "located": ("begins", "line"), "kept": ("located", "frags"), "pars": ("kept",), "spoken": ("said",), "cutlines": ("lines",), "sectioned": ("cutlines",),
}


def _with(select: str, *tables: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, ()):
            add(n)
        if name not in order:
            order.append(name)

    for t in tables:
        add(t)
    return "WITH " + ",\n".join(_CTE[t].replace(" AS (", " AS MATERIALIZED (", 1) for t in order) + "\n" + select


def _slug(x: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(lower({x}), '[’'']', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


def _entities(x: str, named: str = "&[a-z]+;") -> str:
    out = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    out = f"list_reduce(list_distinct(regexp_extract_all({out}, '&#([0-9]+);', 1)), lambda t, n: replace(t, '&#' || n || ';', chr(n::INT)), {out})"
    if named.startswith("&["):
        for a, b in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
            out = f"replace({out}, '{a}', '{b}')"
    return f"trim(regexp_replace(regexp_replace({out}, '{named}', ' ', 'g'), '\\s+', ' ', 'g'))"


_HEADING = _entities("regexp_extract(b, '(?is)^<h1[^>]*>(.*?)</h1>', 1)", "(?i)&[a-z]+;")
_ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_HREF = "CASE WHEN regexp_matches({0}, '(?i)^[a-z]+:') OR starts_with({0}, '#') THEN {0} ELSE '#' || coalesce(string_split({0}, '#')[2], regexp_replace(string_split(string_split({0}, '#')[1], '/')[-1], '(?i)\\.(xhtml|html|htm)$', '')) END"
_COVER = "placed / paras"
_PASS = f"median_conf >= {MIN_MEDIAN_CONF} AND span_coverage >= {MIN_COVERAGE} AND {_COVER} >= {MIN_DOC_COVERAGE} AND lead_s <= {MAX_LEAD_S} AND coalesce(start_gap, 1) <= {MAX_END_GAP} AND coalesce(end_gap, 1) <= {MAX_END_GAP}"
_PCT = "floor({} * 100 + 0.5)::BIGINT || '%'"
_REFUSAL = f"""CASE WHEN {_PASS} THEN NULL
  WHEN median_conf < {MIN_MEDIAN_CONF} THEN 'it aligned at median confidence ' || printf('%.2f', median_conf::DOUBLE) || '; the bar is 0.8 — the recording and the text may have drifted apart.'
  WHEN span_coverage < {MIN_COVERAGE} THEN 'only ' || {_PCT.format('span_coverage')} || ' of the text between the first and last matched paragraph lined up; the bar is 90% — somewhere in the middle the reading and the words part ways.'
  WHEN {_COVER} < {MIN_DOC_COVERAGE} THEN 'only ' || {_PCT.format('(' + _COVER + ')')} || ' of the tale''s paragraphs matched the recording; the bar is 50% — it may cover just part of the tale.'
  WHEN lead_s > {MAX_LEAD_S} THEN 'the recording plays for ' || floor(lead_s + 0.5)::BIGINT || ' seconds before the first paragraph it matched; the bar is 125 — its opening didn''t line up.'
  WHEN coalesce(start_gap, 1) > {MAX_END_GAP} THEN 'the narration starts ' || {_PCT.format('coalesce(start_gap, 1)')} || ' of the way into the text; the bar is 5% — it may skip the tale''s opening.'
  ELSE 'the narration stops ' || {_PCT.format('coalesce(end_gap, 1)')} || ' short of the text''s end; the bar is 5% — it may cover just part of the tale.' END"""
_RENAMED = "CASE WHEN (book_id % 3 = 0 AND ord % 5 = 0) OR (book_id % 7 = 0 AND ord % 6 > 0) THEN 'endnotes-p' || ord ELSE anchor_id END"

_MINT = """fold(book_id, i, ids) AS (SELECT book_id, 0, []::VARCHAR[] FROM bases
  UNION ALL SELECT book_id, i + 1, list_append(ids, CASE WHEN list_contains(ids, b[i + 1]) THEN b[i + 1] || '-' || list_filter(range(2, i + 3), lambda n: NOT list_contains(ids, b[i + 1] || '-' || n))[1] ELSE b[i + 1] END) FROM fold JOIN bases USING (book_id) WHERE i < len(b)),
minted AS (SELECT book_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS n FROM (SELECT book_id, ids FROM fold JOIN bases USING (book_id) WHERE i = len(b)))"""
_BASE = "coalesce(nullif({0}, ''), CASE WHEN {1} = 1 THEN 'beginning' ELSE 'section-' || {1} END)"
_ATTR = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
_XML = '<?xml version="1.0" encoding="utf-8"?>'
_PAGE = f'{_XML}<!DOCTYPE html><html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops" lang="'
_CS = "({0}) // 100 || '.' || lpad((({0}) % 100)::VARCHAR, 2, '0') || '0s'"

#: The given pages hold a list of links, an article whose first paragraph may be left open after a line break, and a footer.
_READ = "read AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->', '', 'g'), '<br>(<p>|</article>)', '<br></b></p>\\1', 'g') AS h FROM pages)"
_PARAGRAPHS = f"WITH {_READ}, p AS (SELECT page_id, unnest(l) AS raw, generate_subscripts(l, 1) AS i FROM (SELECT page_id, regexp_extract_all(h, '(?s)<p>(.*?)</p>', 1) AS l FROM read))"


def _decoded(x: str, amp: str = "&", lt: str = "<", gt: str = ">") -> str:
    out = f"replace(regexp_replace({x}, '&amp;?', chr(1), 'g'), '&', '{amp}')"
    for name, to in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", lt), ("gt", gt)):
        out = f"regexp_replace({out}, '{amp}{name};?', '{to}', 'g')"
    return f"replace({out}, chr(1), '{amp}')"


_WRITTEN = _decoded("{}", "&amp;", "&lt;", "&gt;")
_PLAIN = _decoded("regexp_replace({}, '<[^>]*>', '', 'g')")

ORACLE_SQL: dict[str, str] = {
    "paragraphs_html": f"{_PARAGRAPHS} SELECT page_id, i - 1 AS pos, trim(regexp_replace({_PLAIN.format('raw')}, '\\s+', ' ', 'g')) AS text FROM p",
    "anchored_html": f"{_PARAGRAPHS}, t AS (SELECT page_id AS book_id, i AS ord, 'text-p' || i AS anchor_id, {_entities(_WRITTEN.format('raw'))} AS text FROM p) SELECT * FROM t WHERE len(string_split(text, ' ')) >= 2",
    "html_blocks": f"""WITH {_READ}, links AS (SELECT page_id, regexp_extract_all(h, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS l, regexp_extract_all(h, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS w FROM read),
link AS (SELECT page_id, unnest(l) AS l, unnest(w) AS w, generate_subscripts(l, 1) AS i FROM links), target AS (SELECT page_id, w, i, {_HREF.format('l')} AS l FROM (SELECT * REPLACE ({_decoded('l')} AS l) FROM link)),
navs AS (SELECT page_id, '<nav><ul>' || string_agg('<li><a href="' || replace({_ATTR.format('l')}, '''', '&#x27;') || '">' || {_WRITTEN.format('w')} || '</a></li>', '' ORDER BY i) || '</ul></nav>' AS html FROM target GROUP BY page_id),
parts AS (SELECT page_id AS book_id, 0 AS block, html FROM navs UNION ALL SELECT page_id, 1, {_WRITTEN.format("regexp_extract(h, '(?s)<article>.*</article>')")} FROM read UNION ALL SELECT page_id, 2, {_WRITTEN.format("regexp_extract(h, '(?s)<footer>.*</footer>')")} FROM read)
SELECT * FROM (SELECT book_id, block, html, {_PLAIN.format('html')} AS text FROM parts) WHERE NOT regexp_matches(text, '(?i)project gutenberg|start of (the|this) project|end of (the|this) project')""",
    "minted_ids": _with(f"SELECT book_id, n - 1 AS pos, id FROM minted", "lines").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT book_id, n - 1", f",\nbases AS MATERIALIZED (SELECT book_id, list({_BASE.format(_slug('text'), 'ord')} ORDER BY ord) AS b FROM lines GROUP BY book_id),\n{_MINT}\nSELECT book_id, n - 1", 1),
    "section_anchors": _with("SELECT book_id, section, block, id || '-p' || row_number() OVER (PARTITION BY book_id, section ORDER BY block) AS anchor_id FROM sectioned JOIN minted m USING (book_id) WHERE m.n = section AND NOT h", "sectioned").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT book_id, section, block, id", f",\nbases AS MATERIALIZED (SELECT book_id, list({_BASE.format(_slug('title'), 'section')} ORDER BY section) AS b FROM (SELECT DISTINCT book_id, section, title FROM sectioned) GROUP BY book_id),\n{_MINT}\nSELECT book_id, section, block, id", 1),
    "measures": _with("""SELECT c.book_id, paras::INT AS paras, placed::INT AS placed, printf('%.3f', first_body / body_paras)::DOUBLE AS start_gap, printf('%.3f', (body_paras - 1 - last_body) / body_paras)::DOUBLE AS end_gap, true AS has_ends,
  coalesce(printf('%.3f', placed / (last_idx - first_idx + 1))::DOUBLE, 0) AS span_coverage, printf('%.1f', lead_s::DOUBLE)::DOUBLE AS lead_s, printf('%.1f', tail_s::DOUBLE)::DOUBLE AS tail_s, coalesce(phrases, 0)::INT AS phrases, coalesce(median, 0) AS median_conf, coalesce(turned, 0)::INT AS inversions, printf('%.0f', audio_s::DOUBLE)::INT AS audio_s
  FROM covered c JOIN ended USING (book_id) LEFT JOIN (SELECT book_id, count(*) AS phrases, list_sort(list((conf + 40) / 100))[count(*) // 2 + 1] AS median FROM prows GROUP BY book_id) USING (book_id)
  LEFT JOIN (SELECT book_id, count(*) FILTER (begin_cs < before - 100) AS turned FROM (SELECT book_id, begin_cs, lag(begin_cs) OVER (PARTITION BY book_id ORDER BY ord, phrase_index) AS before FROM prows) GROUP BY book_id) USING (book_id)""", "covered", "ended", "prows"),
    "overlay_smil": _with(f"""SELECT book_id, '<?xml version="1.0" encoding="utf-8"?><smil xmlns="http://www.w3.org/ns/SMIL" xmlns:epub="http://www.idpf.org/2007/ops" version="3.0"><body><seq id="spoken" epub:textref="book.xhtml" epub:type="bodymatter">' ||
  string_agg('<par id="p' || par || '"><text src="book.xhtml#' || {_ATTR.format('anchor_id')} || '"/><audio src="sound/' || lpad(section::VARCHAR, 4, '0') || '.mp3" clipBegin="' || {_CS.format('"begin"')} || '"' || coalesce(' clipEnd="' || {_CS.format('clip_end')} || '"', '') || '/></par>', '' ORDER BY par) || '</seq></body></smil>' AS smil FROM pars GROUP BY book_id""", "pars"),
    "paragraphs_txt": _with(f"SELECT book_id, ord, anchor_id, {_ESC.format('text')} AS html FROM frags", "frags"),
    "anchored_fragments": _with("SELECT book_id, ord, anchor_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM frags", "frags"),
    "named_entities": f"SELECT page_id, i - 1 AS pos, {_entities('raw')} AS text FROM (SELECT page_id, unnest(l) AS raw, generate_subscripts(l, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '<p[^>]*>([^<]*)</p>', 1) AS l FROM pages))",
    "headings": f"SELECT page_id, h AS heading, {_slug('h')} AS slug FROM (SELECT page_id, CASE WHEN b <> '' THEN {_HEADING} END AS h FROM (SELECT page_id, regexp_extract(html, '(?is)(<h1[^>]*>.*?</h1>)', 1) AS b FROM pages))",
    "slugs": f"SELECT doc_id, {_slug('split_part(text, chr(10), 1)')} AS slug FROM documents",
    "hrefs_same_page": f"SELECT page_id, i - 1 AS pos, {_HREF.format('h')} AS href FROM (SELECT page_id, unnest(l) AS h, generate_subscripts(l, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS l FROM pages))",
    "listen_urls": "SELECT page_id, regexp_replace(regexp_replace(url, '^http:', 'https:'), '://www\\.archive\\.org', '://archive.org') AS url FROM pages",
    "languages": f"SELECT doc_id, {_LANG.format('''upper(lang) || '-XX' ''')} AS language, 'en' AS default_language FROM documents",
    "folded": f"SELECT doc_id, {_fold('text')} AS text FROM documents",
    "words_normalized": _with("SELECT book_id, g, ord, phrase, norm FROM words", "words"),
    "phrase_cut": _with("SELECT book_id, ord, phrase, count(*) AS n_tokens, string_agg(raw, ' ' ORDER BY k) AS phrase_text FROM phrased GROUP BY book_id, ord, phrase", "phrased"),
    "phrase_counts": _with("SELECT book_id, count(DISTINCT (ord, phrase)) AS phrases, count(*) AS tokens FROM phrased GROUP BY book_id", "phrased"),
    "phrase_rows": _with("SELECT * FROM prows", "prows"),
    "flat_rows": _with("SELECT book_id, anchor_id, phrase_index, begin_cs / 100 AS begin_secs, conf / 100 AS confidence, 1 AS section FROM prows", "prows"),
    "word_archive": _with("SELECT book_id, anchor_id, count(*) AS n_words, string_agg(bf || ':' || norm || ':' || score, ' ' ORDER BY g) AS words FROM aligned GROUP BY ALL", "aligned"),
    "upper_median": "SELECT user_id, list_sort(list(value))[count(value) // 2 + 1] AS median FROM events GROUP BY user_id",
    "span_coverage": _with("SELECT * FROM covered", "covered"),
    "apparatus": _with("SELECT * FROM covered", "covered").replace("frags AS MATERIALIZED (SELECT *, 'text-p' || ord AS anchor_id FROM lines", f"frags AS MATERIALIZED (SELECT * REPLACE ({_RENAMED} AS anchor_id) FROM (SELECT *, 'text-p' || ord AS anchor_id FROM lines)").replace("'text-p' || ord AS anchor_id, g * 30", f"{_RENAMED.replace('ELSE anchor_id', '''ELSE 'text-p' || ord''')} AS anchor_id, g * 30"),
    "inversions": "SELECT user_id AS book_id, count(*) FILTER (value < before - 1) AS inversions FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) GROUP BY user_id",
    "confidence": _with("SELECT book_id, count(*) AS phrases, list_sort(list(conf))[count(*) // 2 + 1]::DOUBLE AS median_conf FROM prows GROUP BY book_id", "prows"),
    "lead_tail": _with("SELECT * FROM ended", "ended"),
    "verdict": _with(f"SELECT book_id, {_PASS} AS pass, floor({_COVER} * 1000 + 0.5) / 1000 AS doc_coverage FROM measured", "measured"),
    "refusal": _with(f"SELECT book_id, {_REFUSAL} AS refusal FROM measured", "measured"),
    "section_timeline": _with("SELECT book_id, position, reader, secs_cs, start FROM line", "line"),
    "asof_section": _with("SELECT * FROM located", "located"),
    "asof_events": "SELECT l.event_id, l.user_id, epoch_us(l.ts) AS \"at\", r.seen, epoch_us(r.ts) AS seen_at FROM events l ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS seen FROM events GROUP BY ALL) r ON l.user_id = r.user_id AND l.ts > r.ts",
    "frame_section_range": _with("SELECT b.book_id, anchor_id, whole_begin, coalesce(position, last) AS section FROM begins b JOIN (SELECT book_id, max(position) AS last FROM line GROUP BY book_id) USING (book_id) LEFT JOIN line l ON l.book_id = b.book_id AND whole_begin >= start AND whole_begin < start + secs_cs", "begins", "line"),
    "overlay_pars": _with("SELECT * FROM pars", "pars"),
    "overlay_summary": _with(
        """, used AS (SELECT line.* FROM line SEMI JOIN (SELECT book_id, section AS position FROM pars) USING (book_id, position))
SELECT a.book_id, coalesce(synced, 0) AS synced, n - coalesce(synced, 0) AS skipped, coalesce(sections, 0) AS sections, coalesce(total_secs, 0)::BIGINT AS total_secs, coalesce(readers, '') AS readers FROM (SELECT book_id, count(DISTINCT anchor_id) AS n FROM prows WHERE book_id IN (SELECT conv_id FROM conversations) GROUP BY book_id) a
LEFT JOIN (SELECT book_id, count(*) AS synced FROM pars GROUP BY book_id) USING (book_id) LEFT JOIN (SELECT book_id, count(*) AS sections, sum(secs_cs) AS total_secs FROM used GROUP BY book_id) USING (book_id)
LEFT JOIN (SELECT book_id, string_agg(reader, ',' ORDER BY p) AS readers FROM (SELECT book_id, reader, min(position) AS p FROM used WHERE reader <> '' GROUP BY ALL) GROUP BY book_id) USING (book_id)""",
        "pars", "line", "prows",
    ).replace("\n, used AS", ",\nused AS"),
    "overlay_package": _with(
        f""", used AS (SELECT line.* FROM line SEMI JOIN (SELECT book_id, section AS position FROM pars) USING (book_id, position)),
named AS (SELECT book_id, string_agg('<dc:contributor id="reader' || i || '">' || reader || '</dc:contributor><meta property="role" refines="#reader' || i || '" scheme="marc:relators">nrt</meta>', '' ORDER BY i) AS contributors
  FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY p) AS i FROM (SELECT book_id, reader, min(position) AS p FROM used WHERE reader <> '' GROUP BY ALL)) GROUP BY book_id),
sounds AS (SELECT book_id, {_CS.format('sum(secs_cs)::BIGINT')} AS span, string_agg('<item id="sound-' || position || '" href="sound/' || lpad(position::VARCHAR, 4, '0') || '.mp3" media-type="audio/mpeg"/>', '' ORDER BY position) AS items FROM used GROUP BY book_id),
bodies AS (SELECT book_id, '<section id="text">' || chr(10) || string_agg('<p id="text-p' || ord || '">' || {_ESC.format('text')} || '</p>', chr(10) ORDER BY ord) || chr(10) || '</section>' AS body FROM lines GROUP BY book_id),
told AS (SELECT doc_id AS book_id, {_LANG.format('lang')} AS language, {_ESC.format('string_split(text, chr(10))[1]')} AS title FROM documents)
SELECT book_id, '{_XML}<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="book-id" prefix="media: http://www.idpf.org/epub/vocab/overlays/#"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="book-id">urn:read-along:documents:' || book_id || '</dc:identifier><dc:title>' || title || '</dc:title><dc:language>' || language || '</dc:language><dc:creator>Unknown</dc:creator>' || contributors || '<dc:source>https://example.org/?a&amp;b</dc:source><meta property="dcterms:modified">2024-01-01T00:00:00Z</meta><meta property="media:duration">' || span || '</meta><meta property="media:duration" refines="#overlay">' || span || '</meta><meta property="media:active-class">cantor-spoken</meta></metadata><manifest><item id="text" href="book.xhtml" media-type="application/xhtml+xml" media-overlay="overlay"/><item id="overlay" href="book.smil" media-type="application/smil+xml"/><item id="contents" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="style" href="style.css" media-type="text/css"/>' || items || '</manifest><spine><itemref idref="text"/></spine></package>' AS opf,
  '{_PAGE}' || language || '" xml:lang="' || language || '"><head><title>' || title || '</title><link rel="stylesheet" href="style.css" type="text/css"/></head><body>' || body || '</body></html>' AS xhtml,
  '{_PAGE}' || language || '" xml:lang="' || language || '"><head><title>Contents</title></head><body><nav epub:type="toc"><h2>Contents</h2><ol><li><a href="book.xhtml">' || title || '</a></li></ol></nav></body></html>' AS nav
FROM named JOIN sounds USING (book_id) JOIN told USING (book_id) JOIN bodies USING (book_id)""",
        "pars", "line", "lines",
    ).replace("\n, used AS", ",\nused AS"),
    "clock_text": _with("SELECT book_id, anchor_id, whole_begin // 100 || '.' || lpad((whole_begin % 100)::VARCHAR, 2, '0') || '0s' AS clock, CASE WHEN h > 0 THEN h || 'h' || lpad(m::VARCHAR, 2, '0') || 'm' ELSE m || 'm' END AS length FROM (SELECT *, (whole_begin // 10) // 3600 AS h, floor((whole_begin // 10) % 3600 / 60 + 0.5)::BIGINT AS m FROM begins)", "begins"),
    "text_fingerprint": "SELECT doc_id, sha256(text) AS sha256, '1.0+' || left(sha256(text), 12) AS fingerprint FROM documents",
    "sectioning": _with("SELECT book_id, section, title AS section_title, count(*) AS blocks, min(block) AS first_block FROM sectioned GROUP BY ALL", "sectioned"),
    "chunk_sizes": _with("SELECT book_id, count(*) AS n_words, greatest(12, least(45, count(*) // 6)) AS chunk FROM words GROUP BY book_id", "words"),
    "lock_scores": _with("SELECT book_id, chunk, floor(avg(score) / 100 * CASE WHEN gap BETWEEN 0.12 AND 0.6 THEN 1 WHEN gap BETWEEN 0.08 AND 0.9 THEN 0.5 ELSE 0.15 END * 1e6 + 0.5)::BIGINT AS lock_micro FROM (SELECT book_id, chunk, score, CASE WHEN count(gap) OVER w = 0 THEN 0.3 ELSE list_sort(list(gap) FILTER (gap IS NOT NULL) OVER w)[count(gap) OVER w // 2 + 1] END AS gap FROM (SELECT book_id, g // 45 AS chunk, score, (lead(bf) OVER (PARTITION BY book_id, g // 45 ORDER BY g) - bf) / 100 AS gap FROM aligned) WINDOW w AS (PARTITION BY book_id, chunk)) GROUP BY book_id, chunk, gap", "aligned"),
    "ctc_align": _with("SELECT book_id, ord, k, bf, bf + 2 * length(norm) - 1 AS ef FROM (SELECT *, row_number() OVER w - 1 AS k, 200 + coalesce(sum(2 * length(norm) + 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bf FROM words WINDOW w AS (PARTITION BY book_id, ord ORDER BY g))", "words"),
    "chain_align": _with("SELECT book_id, (g // chunk)::INT AS seq, g AS w0, bf AS f0 FROM (SELECT *, greatest(12, least(45, n // 6)) AS chunk FROM spoken) WHERE g % chunk = 0 AND least(chunk, n - g) >= greatest(8, chunk // 2)", "spoken"),
    "bracket_align": _with("SELECT book_id, g, bf, bf + 2 * length(norm) - 1 AS ef FROM spoken WHERE n >= 2", "spoken"),
    "semi_anti_anchors": "SELECT doc_id, 'labelled' AS side FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) UNION ALL SELECT doc_id, 'bare' FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "doc_roundtrip": "SELECT doc_id, 'read-along/1' AS format, 'cantor/0.1.0' AS generator, left(text, 40) AS title, NULL::VARCHAR AS author, lang AS language, true AS unaligned FROM documents",
}
