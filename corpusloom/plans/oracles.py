"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

import unicodedata

from corpusloom.plans.queries import SETTINGS

# What follows is written out here and not imported, so that a wrong value in the engine shows. All are fixed values.

#: White space as code points that RE2 reads.
SPACES = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS, WORD = f"[{SPACES}]", f"[^{SPACES}]+"
ALPHA_WORD = rf"[^{SPACES}]*\p{{L}}[^{SPACES}]*"
PAGE_NUMBER = rf"^{WS}*\p{{Nd}}+{WS}*$"
CHAPTER_LINE = rf"^{WS}*(Chapter|CHAPTER){WS}+\p{{Nd}}+{WS}*$"
REFERENCES = rf"\n(References|REFERENCES|Bibliography|BIBLIOGRAPHY){WS}*\n[\s\S]*\z"
WORKS_CITED = rf"\n(Works Cited|WORKS CITED){WS}*\n[\s\S]*\z"
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x{09}-\x{0D} ]"
OPENINGS = rf"(?i)^(Scientific Foundations|Practical/Applied|Domain{WS}+\p{{Nd}}|Chapter{WS}+\p{{Nd}}|Section{WS}+\p{{Nd}}|Part{WS}+\p{{Nd}})"
EFFORT = [(5.0, "low difficulty"), (7.0, "moderate difficulty"), (8.5, "high difficulty")]
MOST_EFFORT = "near-maximal effort"
BINS = ["(0, 100]", "(100, 500]", "(500, 1000]", "(1000, 2000]", "(2000, 5000]", "(5000, 10000]", "(10000, 50000]", "(50000, inf]"]
INPUT_PRICE, OUTPUT_PRICE, PAUSE = 3.0, 15.0, 0.5
EXTRACTORS = {
    "epub": "extract_epub", "pdf": "extract_pdf", "html": "extract_html", "image_ocr": "extract_ocr", "spreadsheet": "extract_spreadsheet", "csv": "extract_spreadsheet",
    "xlsx": "extract_spreadsheet", "tsv": "extract_spreadsheet", "database": "extract_database", "sqlite": "extract_database", "json_db": "extract_database",
}
BOS, HEADER_START, HEADER_END, EOT = "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>"
SYSTEM_MESSAGE = (
    "You are a knowledgeable health and fitness professional with expertise in "
    "exercise science, strength and conditioning, nutrition, physical therapy, "
    "occupational therapy, and recovery. Provide accurate, evidence-based responses."
)
CONTINUE = "Continue the following: "
CLASSIFY = "Classify the following health/fitness text into the most appropriate category: "
LABELLED_AS = "This text falls under the category of: "
#: Compatibility decompositions of the letters of the tables' languages, and plain forms of typographic marks.
DECOMPOSED = {c: unicodedata.normalize("NFD", c) for c in "ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü"} | {"ﬁ": "fi", "…": "..."}
PLAIN = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "\u00a0": " ", "\u200b": ""}


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({x}, {quote(pattern)}, {to}, 'g')"


def strip(x: str) -> str:
    return sub(x, rf"\A{WS}+|{WS}+\z")


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {quote(pattern)}))"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {quote(pattern)})"


def words(x: str) -> str:
    return count(x, WORD)


def meaningful(x: str, least: int = 10) -> str:
    return f"({words(x)} >= {least} AND 2 * {count(x, ALPHA_WORD)} > {words(x)})"


def whitespace(x: str) -> str:
    return strip(sub(sub(x, "[ \\t]+", "' '"), "\\n{3,}", "chr(10) || chr(10)"))


def artifacts(x: str) -> str:
    return sub(sub(x, f"(?m){PAGE_NUMBER}"), f"(?m){CHAPTER_LINE}")


def residue(x: str) -> str:
    return sub(sub(sub(x, "<[^>]+>"), "&[a-zA-Z]+;", "' '"), r"&#\p{Nd}+;", "' '")


def unicode(x: str) -> str:
    for mark, plain in (DECOMPOSED | PLAIN).items():
        x = f"replace({x}, {quote(mark)}, {quote(plain)})"
    return x


def is_upper(x: str) -> str:
    return f"({has(x, r'\p{Lu}')} AND NOT {has(x, r'[\p{Ll}\p{Lt}]')})"


def is_title(x: str) -> str:
    return f"({has(x, r'[\p{Lu}\p{Lt}]')} AND NOT {has(x, r'(^|[^\p{Lu}\p{Ll}\p{Lt}])\p{Ll}|[\p{Lu}\p{Ll}\p{Lt}][\p{Lu}\p{Lt}]')})"


def book_heading(s: str) -> str:
    """Of a stripped line."""
    return f"(length({s}) >= 3 AND {words(s)} <= 10 AND ({has(s, OPENINGS)} OR ({is_upper(s)} AND {words(s)} >= 2) OR ({is_title(s)} AND {words(s)} >= 2 AND length({s}) < 60)))"


def page_heading(s: str) -> str:
    numbered = has(s, rf"^(Chapter|CHAPTER|Section|SECTION|Part|PART){WS}+\p{{Nd}}+") + " OR " + has(s, rf"^\p{{Nd}}+\.\p{{Nd}}*{WS}+[A-Z]")
    return f"({s} <> '' AND length({s}) <= 100 AND (({is_upper(s)} AND {words(s)} <= 8) OR {numbered}))"


NL = "chr(10)"
LINES = f"string_split(text, {NL})"
CHUNK_ID = "{0} || '_chunk_' || CASE WHEN length({1}::VARCHAR) < 4 THEN lpad({1}::VARCHAR, 4, '0') ELSE {1}::VARCHAR END"


def chunk_id(source: str, n: str) -> str:
    return CHUNK_ID.format(source, n)


# --- shared inputs ---------------------------------------------------------------------------------------------

LOG = """log AS (
  SELECT event_id AS pos, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%B %d, %Y') AS long_date,
    CASE WHEN event_id % 11 <> 0 THEN event_type END AS exercise,
    CASE WHEN event_id % 5 <> 0 THEN event_id % 4 + 1 END AS sets,
    CASE WHEN event_id % 3 <> 0 THEN user_id % 12 + 1 END AS reps,
    CASE WHEN event_id % 7 <> 0 THEN value END AS weight,
    CASE WHEN event_id % 2 = 0 THEN (event_id % 11)::DOUBLE END AS rpe, props AS notes
  FROM events
)"""


def band(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {b} THEN '{n}'" for b, n in EFFORT) + f" WHEN {x} IS NOT NULL THEN '{MOST_EFFORT}' END"


SENTENCE = f"""'On ' || long_date || ', the client performed ' ||
    CASE WHEN sets IS NOT NULL AND reps IS NOT NULL THEN sets || ' sets of ' || reps || ' reps of ' || coalesce({strip('exercise')}, 'an exercise') || coalesce(' at ' || weight::VARCHAR || ' lbs', '')
         WHEN sets IS NOT NULL THEN sets || ' sets of ' || coalesce({strip('exercise')}, 'an exercise')
         ELSE coalesce({strip('exercise')}, 'an exercise') END ||
    coalesce(', with an RPE of ' || rpe::VARCHAR || ', indicating ' || {band('rpe')}, '') ||
    CASE WHEN {strip('notes')} <> '' THEN ', (Note: ' || {strip('notes')} || ')' ELSE '' END || '.'"""
NARRATED = f"{LOG}, narrated AS (SELECT *, {SENTENCE} AS line FROM log)"

MESSAGES = "messages AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages FROM conversations GROUP BY conv_id)"
QA = """qa AS (
  SELECT conv_id * 100 + turn AS pos, text AS instruction, response, 'conv' || conv_id AS source_id
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS response FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant'
)"""
COMPLETIONS = f"completions AS (SELECT doc_id AS pos, string_split(text, {NL})[1] AS prompt, coalesce(text[length(string_split(text, {NL})[1]) + 2:], '') AS completion, source AS source_id FROM documents)"
LABELLED = "labelled AS (SELECT doc_id AS pos, text, lang AS label, source AS source_id FROM documents)"
VALID_QA = f"({strip('instruction')} <> '' AND {strip('response')} <> '' AND {words(strip('instruction'))} >= 3 AND {words(strip('response'))} >= 10 AND {strip('instruction')} <> {strip('response')})"
ALTERNATES = f"list_bool_and(list_transform(range(1, len(messages) + 1), lambda i: messages[i].role = CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END AND {strip('messages[i].content')} <> ''))"
VALID_CONVERSATION = f"(len(messages) >= 2 AND {ALTERNATES})"
VALID_COMPLETION = f"({strip('prompt')} <> '' AND {strip('completion')} <> '' AND {words('completion')} >= 10)"
VALID_LABEL = f"({strip('text')} <> '' AND {strip('label')} <> '' AND {words('text')} >= 5)"


def turn(role: str, content: str) -> str:
    return f"{quote(HEADER_START)} || {role} || {quote(HEADER_END)} || {NL} || {NL} || {content} || {quote(EOT)}"


PROLOGUE = f"{quote(BOS)} || {turn(quote('system'), quote(SYSTEM_MESSAGE))}"


def exchange(user: str, assistant: str) -> str:
    return f"{PROLOGUE} || {turn(quote('user'), user)} || {turn(quote('assistant'), assistant)}"


QA_TEXT = exchange("instruction", "response")
CONVERSATION_TEXT = f"{PROLOGUE} || array_to_string(list_transform(messages, lambda m: {turn('m.role', 'm.content')}), '')"
COMPLETION_TEXT = exchange(f"{quote(CONTINUE)} || prompt", "completion")
LABEL_TEXT = exchange(quote(CLASSIFY) + " || '\"' || text || '\"'", f"{quote(LABELLED_AS)} || label")
UNION = f"""{MESSAGES}, {QA}, {COMPLETIONS}, {LABELLED}, examples AS (
  SELECT {QA_TEXT} AS text, 'qa' AS format, source_id FROM qa WHERE {VALID_QA}
  UNION ALL SELECT {CONVERSATION_TEXT}, 'conversation', 'conv' || conv_id FROM messages WHERE {VALID_CONVERSATION}
  UNION ALL SELECT {COMPLETION_TEXT}, 'completion', source_id FROM completions WHERE {VALID_COMPLETION}
  UNION ALL SELECT {LABEL_TEXT}, 'classification', source_id FROM labelled WHERE {VALID_LABEL}
)"""
SPLIT = f"""{UNION}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY format ORDER BY md5('42:' || text), text) AS r, count(*) OVER (PARTITION BY format) AS n FROM examples
), split AS (
  SELECT text, format, source_id, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN r <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ranked
)"""
#: Conversations and, a million on, the same with " indeed" after their first message. A ratio of 200 L / (2 L + 7)
#: makes the second one alike; no two others are.
VARIED = f"""{MESSAGES}, varied AS (
  SELECT conv_id, {VALID_CONVERSATION} AS valid, coalesce(messages[1].content, '') AS key, false AS alike FROM messages
  UNION ALL SELECT conv_id + 1000000, {VALID_CONVERSATION}, coalesce(messages[1].content, '') || ' indeed', coalesce(messages[1].content, '') <> '' AND 200.0 * length(messages[1].content) / (2 * length(messages[1].content) + 7) > 85 FROM messages
)"""
KINDS = ", ".join(quote(k) for k in [*EXTRACTORS, "floppy_disk"])
REGISTRY = f"""registry AS (
  SELECT source AS id, [{KINDS}][substr(source, 4)::INT % {len(EXTRACTORS) + 1} + 1] AS type, 'data/' || source AS path, list_distinct(list(lang)) AS topics, substr(source, 4)::INT % 7 = 3 AS missing FROM documents GROUP BY source
)"""
EXTRACTOR = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXTRACTORS.items()) + " END"
RESULTS = """results AS (
  SELECT CASE WHEN doc_id % 2 = 0 THEN 'A' ELSE 'B' END AS variant, doc_id % 6 AS n_examples, length(text) AS response_length,
    CASE WHEN doc_id % 13 = 0 THEN 'failed' END AS error, length(text) // 4 AS input_tokens_est, doc_id % 500 AS output_tokens_est, (doc_id % 7)::DOUBLE / 4 AS elapsed FROM documents
)"""


def filled(template: str, n: int, topics: str = "") -> str:
    parts = [quote(p.replace("{n}", str(n)).replace("{topics}", topics).replace("{{", "{").replace("}}", "}")) for p in template.split("{text}")]
    return " || text || ".join(parts)


WHITESPACE_RAW = f"'  ' || chr(9) || replace(text, '. ', '.' || chr(9) || '  ') || {NL} || {NL} || {NL} || {NL} || ' end ' || {NL}"
ARTIFACT_RAW = f"'Chapter 3' || {NL} || replace(text, {NL}, {NL} || ' 42 ' || {NL}) || {NL} || 'CHAPTER 12  ' || {NL} || 'rest of 7 pages'"
REFERENCE_RAW = f"text || {NL} || 'References ' || {NL} || '[1] one' || {NL} || CASE WHEN doc_id % 2 = 0 THEN {NL} || 'Works Cited' || {NL} || ' two' ELSE '' END"
FULL_RAW = f"'<p>' || replace(text, {NL}, '&nbsp;<br>' || {NL} || {NL} || {NL} || {NL} || ' 17 ' || {NL}) || {NL} || 'Chapter 9' || {NL} || '</p>'"
MEANINGFUL_RAW = "CASE WHEN doc_id % 3 = 0 THEN replace(text, ' ', ' 7 7 ') ELSE text END"


def sectioned(key: str, source: str, heading: str, body: str) -> str:
    """Lines of `source` (key, p: order within key, line, more), numbered by the headings before them."""
    return f"""marked AS (SELECT *, {heading} AS h FROM {source}),
numbered AS (SELECT *, sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY p ROWS UNBOUNDED PRECEDING) AS section FROM marked),
grouped AS (
  SELECT {key}, section, max(CASE WHEN h THEN {strip('line')} END) AS heading, string_agg({body}, {NL} ORDER BY p) FILTER (WHERE NOT h) AS body, min(page) AS first_page FROM numbered GROUP BY {key}, section
)"""


CHUNKED = f"""
WITH RECURSIVE split AS (
  SELECT source, doc_id, string_split({sub('text', f'([.!?]){WS}+', quote(chr(92) + '1') + ' || chr(1)')}, chr(1)) AS ss FROM documents WHERE {strip('text')} <> ''
), counted AS (
  SELECT source, doc_id, ss, list_transform(ss, lambda s: {count('s', TOKEN)}) AS tt FROM split
), walk AS (
  SELECT doc_id, 0 AS k, 1 AS lo, 0::BIGINT AS ct, 0 AS idx, NULL::VARCHAR AS chunk FROM counted
  UNION ALL
  SELECT doc_id, k + 1, new_lo, (CASE WHEN flush THEN coalesce(list_sum(tt[new_lo:k]), 0) ELSE ct END + tt[k + 1])::BIGINT, idx + CASE WHEN flush THEN 1 ELSE 0 END, CASE WHEN flush THEN array_to_string(ss[lo:k], ' ') END
  FROM (
    SELECT *, CASE WHEN flush THEN coalesce(1 + list_max(list_filter(range(lo, k + 1), lambda j: list_sum(tt[j:k]) > 100)), lo) ELSE lo END AS new_lo
    FROM (SELECT w.*, c.ss, c.tt, (w.ct + c.tt[w.k + 1] > 800 AND w.k >= w.lo) AS flush FROM walk w JOIN counted c USING (doc_id) WHERE w.k < len(c.tt))
  )
), chunks AS (
  SELECT doc_id, idx - 1 AS i, chunk AS text FROM walk WHERE chunk IS NOT NULL
  UNION ALL
  SELECT w.doc_id, w.idx, array_to_string(c.ss[w.lo:w.k], ' ') FROM walk w JOIN counted c USING (doc_id) WHERE w.k = len(c.tt)
), indexed AS (
  SELECT d.source AS source_id, c.doc_id AS section_pos, row_number() OVER (PARTITION BY d.source ORDER BY c.doc_id, c.i) - 1 AS chunk_index, c.text FROM chunks c JOIN documents d USING (doc_id)
)
SELECT source_id, section_pos, chunk_index, {chunk_id('source_id', 'chunk_index')} AS chunk_id, text, {count('text', TOKEN)}::BIGINT AS token_count FROM indexed
"""


def describe_line(columns: list[str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"'{c}: ' || {c}" for c in columns) + "], lambda x: x IS NOT NULL), ' | ')"


def summaries(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", count(DISTINCT {column}) AS "unique",
  (SELECT {column} FROM documents WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
  (SELECT count(*) FROM documents WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC LIMIT 1) AS freq FROM documents"""


SQL: dict[str, str] = {
    "clean_whitespace": f"SELECT doc_id, {whitespace(WHITESPACE_RAW)} AS cleaned FROM documents",
    "page_artifacts": f"SELECT doc_id, {artifacts(ARTIFACT_RAW)} AS cleaned FROM documents",
    "references_removed": f"SELECT doc_id, {sub(sub(REFERENCE_RAW, REFERENCES), WORKS_CITED)} AS cleaned FROM documents",
    "html_residue": f"SELECT page_id, {residue(quote('') + ' || html || ' + quote('&#169;&frac12;&eacute;'))} AS cleaned FROM pages",
    "full_clean": f"SELECT doc_id, {whitespace(artifacts(residue(unicode(FULL_RAW))))} AS cleaned FROM documents",
    "normalize_unicode": f"SELECT doc_id, {unicode(quote('“ﬁne” – it’s…') + ' || text')} AS cleaned FROM documents",
    "meaningful_text": f"SELECT doc_id, {words('t')}::BIGINT AS words, {meaningful('t')}::BIGINT AS meaningful, {meaningful('t', 5)}::BIGINT AS meaningful_5 FROM (SELECT doc_id, {MEANINGFUL_RAW} AS t FROM documents)",
    "sentence_split": f"SELECT doc_id, generate_subscripts(ss, 1) - 1 AS pos, unnest(ss) AS sentence FROM (SELECT doc_id, string_split({sub('text', f'([.!?]){WS}+', quote(chr(92) + '1') + ' || chr(1)')}, chr(1)) AS ss FROM documents)",
    "token_estimates": f"SELECT doc_id, {count('text', TOKEN)}::BIGINT AS tokens, (length(text) // 4)::BIGINT AS char_tokens, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS preview, {chunk_id('source', 'doc_id')} AS chunk_id FROM documents",
    "heading_lines": f"SELECT doc_id, pos, {book_heading('s')}::BIGINT AS book, {page_heading('s')}::BIGINT AS page FROM (SELECT doc_id, pos, {strip('line')} AS s FROM (SELECT doc_id, generate_subscripts({LINES}, 1) - 1 AS pos, unnest({LINES}) AS line FROM documents))",
    "split_by_headings": f"""
WITH lines AS (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS p, 0 AS page FROM documents),
{sectioned('doc_id', 'lines', book_heading('(' + strip('line') + ')'), 'line')}
SELECT doc_id, section::BIGINT AS section_pos, coalesce(heading, 'Untitled Section') AS title, {strip('body')} AS section_text FROM grouped WHERE {words('body')} >= 20
""",
    "pdf_sections": f"""
WITH pages_ AS (SELECT doc_id // 10 AS book, doc_id % 10 + 1 AS page, text FROM documents WHERE {strip('text')} <> ''),
split AS (SELECT book, page, unnest({LINES}) AS line, page * 1000000 + generate_subscripts({LINES}, 1) AS p FROM pages_),
lines AS (SELECT book, page, {strip('line')} AS line, p FROM split),
{sectioned('book', 'lines', page_heading('line'), 'line')},
closed AS (SELECT *, lead(first_page) OVER (PARTITION BY book ORDER BY section) AS closing FROM grouped)
SELECT book, section::BIGINT AS section_pos, coalesce(heading, 'Page ' || closing, 'Final Section') AS title, body AS section_text, closing::BIGINT AS start_page FROM closed WHERE body IS NOT NULL AND {meaningful('body')}
""",
    "effort_bands": f"SELECT event_id, {band('(event_id % 21)::DOUBLE / 2')} AS band FROM events",
    "narrate_rows": f"WITH {NARRATED} SELECT pos AS section_pos, 'Training Log Entry' AS title, line AS text FROM narrated",
    "narrate_sessions": f"""
WITH {NARRATED}
SELECT date, 'Training Session - ' || any_value(long_date) AS title,
  'Training session on ' || any_value(long_date) || ':' || {NL} || string_agg('  - ' || line, {NL} ORDER BY pos) ||
  CASE WHEN coalesce(sum(sets), 0) <> 0 AND count(exercise) > 0 THEN {NL} || {NL} || 'Session summary: ' || count(exercise) || ' exercises, ' || sum(sets)::BIGINT || ' total sets across ' || string_agg(exercise, ', ' ORDER BY pos) || '.' ELSE '' END AS text,
  count(*) AS num_exercises
FROM narrated GROUP BY date
""",
    "describe_table": f"SELECT 'Database table ''nation'' with ' || (SELECT count(*) FROM nation) || ' rows and columns: n_nationkey, n_name, n_regionkey.' || {NL} || {NL} || string_agg({describe_line(['n_nationkey', 'n_name', 'n_regionkey'])}, {NL} ORDER BY n_nationkey) AS text FROM (SELECT * FROM nation ORDER BY n_nationkey LIMIT 20)",
    "describe_frame": f"SELECT 'Data with columns: c_name, c_nationkey, c_mktsegment' || {NL} || 'Total rows: ' || (SELECT count(*) FROM customer) || {NL} || {NL} || string_agg({describe_line(['c_name', 'c_nationkey', 'c_mktsegment'])}, {NL} ORDER BY c_custkey) AS text FROM (SELECT c_custkey, c_name, CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS c_nationkey, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 50)",
    "chunk_prose": CHUNKED,
    "chunk_tabular": f"""
WITH ranked AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r FROM documents),
grouped AS (SELECT source AS source_id, r // 5 AS chunk_index, string_agg(text, {NL} || {NL} ORDER BY r) AS text FROM ranked GROUP BY 1, 2)
SELECT source_id, chunk_index, {chunk_id('source_id', 'chunk_index')} AS chunk_id, text, {count('text', TOKEN)}::BIGINT AS token_count FROM grouped
""",
    "chunk_stats": "SELECT count(n_chars) AS count, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std, min(n_chars)::DOUBLE AS min, round(quantile_cont(n_chars, 0.25), 6) AS p25, round(quantile_cont(n_chars, 0.5), 6) AS p50, round(quantile_cont(n_chars, 0.75), 6) AS p75, max(n_chars)::DOUBLE AS max FROM documents",
    "extraction_summary": "SELECT lang, source, count(*) AS sections, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ROLLUP (lang, source)",
    "length_histogram": "WITH l AS (SELECT length(text) AS n FROM documents) " + " UNION ALL ".join(f"SELECT {i}::BIGINT AS bin_no, '{b}' AS bin, count(*) AS count FROM l WHERE n > {b[1:].split(',')[0]}" + ("" if "inf" in b else f" AND n <= {b.split(', ')[1][:-1]}") for i, b in enumerate(BINS)),
    "extremes": "(SELECT 'shortest' AS which, doc_id AS pos, length(text)::BIGINT AS length FROM documents ORDER BY 3, 2 LIMIT 1) UNION ALL (SELECT 'longest', doc_id, length(text)::BIGINT FROM documents ORDER BY 3 DESC, 2 LIMIT 1)",
    "value_counts": "SELECT source, lang, count(*) AS count FROM documents GROUP BY ALL",
    "describe_strings": " UNION ALL ".join(summaries(c) for c in ("lang", "source", "text")),
    "longest_per_source": "SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 3",
    "sample_head": "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 25",
    "random_sample": "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 30",
    "resume_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "resume_then_head": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 20",
    "registry_filter": f"WITH {REGISTRY} SELECT id, type, {EXTRACTOR} AS extractor FROM registry WHERE list_contains(topics, 'es')",
    "registry_validate": f"WITH {REGISTRY} SELECT id, 'missing file: ' || path AS error FROM registry WHERE missing UNION ALL SELECT id, 'unknown type: ' || type FROM registry WHERE {EXTRACTOR} IS NULL",
    "validate_qa": f"WITH {QA} SELECT pos, {VALID_QA}::BIGINT AS valid FROM qa",
    "validate_conversation": f"WITH {MESSAGES} SELECT conv_id, {VALID_CONVERSATION}::BIGINT AS valid FROM messages",
    "validate_completion": f"WITH {COMPLETIONS} SELECT pos, {VALID_COMPLETION}::BIGINT AS valid FROM completions",
    "validate_classification": f"WITH {LABELLED} SELECT pos, {VALID_LABEL}::BIGINT AS valid FROM labelled",
    "fuzzy_dedup": f"WITH {VARIED} SELECT conv_id FROM varied WHERE key <> '' AND NOT alike",
    "near_dup_pairs": f"WITH {QA}, firsts AS (SELECT instruction, min(pos) AS pos FROM qa WHERE instruction <> '' GROUP BY instruction) SELECT pos AS a, pos + 1000000 AS b FROM firsts WHERE 200.0 * length(instruction) / (2 * length(instruction) + 7) > 85",
    "validation_stats": f"""
WITH {VARIED}
SELECT 'conversations' AS dataset, count(*) AS total, count(*) FILTER (valid AND alike) AS duplicates_removed, count(*) FILTER (NOT valid) AS low_quality_removed, 0::BIGINT AS format_errors_removed, count(*) FILTER (valid AND NOT alike) AS passed FROM varied
""",
    "indel_similarity": """
WITH RECURSIVE p AS (SELECT a.item_id, a.text AS a, b.text AS b FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1),
walk AS (
  SELECT item_id, 0 AS i, list_transform(range(length(b)), lambda x: 0::INT) AS r FROM p
  UNION ALL
  SELECT item_id, i + 1, list(m ORDER BY j) FROM (
    SELECT w.item_id, w.i, t.j, max(greatest(w.r[t.j], coalesce(w.r[t.j - 1], 0) + CASE WHEN p.a[w.i + 1] = p.b[t.j] THEN 1 ELSE 0 END)) OVER (PARTITION BY w.item_id ORDER BY t.j ROWS UNBOUNDED PRECEDING)::INT AS m
    FROM walk w JOIN p USING (item_id), LATERAL (SELECT unnest(range(1, length(p.b) + 1)) AS j) t WHERE w.i < length(p.a)
  ) GROUP BY item_id, i
)
SELECT w.item_id, round(200.0 * w.r[len(w.r)] / (length(p.a) + length(p.b)), 6) AS ratio FROM walk w JOIN p USING (item_id) WHERE w.i = length(p.a)
""",
    "parse_responses": "SELECT conv_id || '-' || turn AS chunk_id, role AS instruction, text AS response FROM conversations, range(CASE WHEN (conv_id + turn) % 4 = 2 THEN 2 ELSE 1 END) WHERE role IS NOT NULL AND text IS NOT NULL",
    "records_round_trip": f"SELECT {chunk_id('source', 'doc_id')} AS chunk_id, source AS source_id, text, (length(text) // 4)::BIGINT AS token_count FROM documents",
    "tolerant_lines": "SELECT doc_id % 5 <> 0 AS good, CASE WHEN doc_id % 5 <> 0 THEN text END AS text, lang AS label FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT false, NULL, '{\"text\": broken ' || doc_id FROM documents WHERE doc_id % 5 = 0",
    "sample_files": "SELECT text, lang AS label FROM documents UNION ALL SELECT text, 'item' FROM benchmark",
    "line_counts": "SELECT count(*) AS records FROM documents",
    "documents_round_trip": "SELECT source AS source_id, CASE WHEN lang = 'en' THEN 'prose' ELSE 'tabular' END AS doc_type, row_number() OVER (PARTITION BY source, lang = 'en' ORDER BY doc_id) - 1 AS section_pos, 'T' || doc_id AS title, text, lang AS content_type FROM documents",
    "splits_round_trip": f"WITH {SPLIT} SELECT md5(text) AS text_md5, format, split FROM split WHERE format <> 'classification'",
    "csv_sessions": f"""
WITH {NARRATED.replace("CASE WHEN event_id % 2 = 0 THEN (event_id % 11)::DOUBLE END AS rpe, props AS notes", "CASE WHEN event_id % 2 = 0 THEN (event_id % 11)::DOUBLE END AS rpe, NULL::VARCHAR AS notes")}
SELECT date, 'Training Session - ' || any_value(long_date) AS title, count(*) AS num_exercises,
  'Training session on ' || any_value(long_date) || ':' || {NL} || string_agg('  - ' || coalesce(line, ''), {NL} ORDER BY pos) ||
  CASE WHEN coalesce(sum(sets), 0) <> 0 AND count(exercise) > 0 THEN {NL} || {NL} || 'Session summary: ' || count(exercise) || ' exercises, ' || sum(sets)::BIGINT || ' total sets across ' || string_agg(exercise, ', ' ORDER BY pos) || '.' ELSE '' END AS text
FROM narrated GROUP BY date
""",
    "chunk_totals": f"WITH t AS (SELECT {count('text', TOKEN)}::BIGINT AS n FROM documents) SELECT count(*) AS chunks, sum(n)::BIGINT AS total_tokens, round(avg(n), 6) AS avg_tokens FROM t",
    "registry_lookup": f"WITH {REGISTRY} SELECT 'id' AS by, id, type FROM registry WHERE id = (SELECT min(source) FROM documents) UNION ALL SELECT 'type', id, type FROM registry WHERE type = 'csv'",
    "dedup_keys": f"WITH {MESSAGES} SELECT 'c' || conv_id AS id, coalesce(messages[1].content, '') AS key FROM messages UNION ALL SELECT 'd' || doc_id, coalesce(text, '') FROM documents",
    "prompt_render": f"""
WITH chunks AS (SELECT {chunk_id('source', 'doc_id')} AS chunk_id, doc_id % 3 = 0 AS tabular, text FROM documents)
SELECT chunk_id, 'qa' AS kind, CASE WHEN tabular THEN {filled(SETTINGS.prompt('training_log_qa_instruction'), 5)} ELSE {filled(SETTINGS.prompt('qa_instruction'), 5)} END AS user_prompt FROM chunks
UNION ALL SELECT chunk_id, 'classification', {filled(SETTINGS.prompt('classification_instruction'), 3, ', '.join(SETTINGS.topics))} FROM chunks
""",
    "results_summary": f"WITH {RESULTS} SELECT count(*) AS chunks, count(*) FILTER (error IS NULL) AS successful, (sum(n_examples) FILTER (error IS NULL))::BIGINT AS examples, round(avg(n_examples) FILTER (error IS NULL), 6) AS avg_examples, round(avg(response_length) FILTER (error IS NULL), 6) AS avg_response_length FROM results",
    "compare_prompts": f"WITH {RESULTS} SELECT variant, (sum(n_examples) FILTER (error IS NULL))::BIGINT AS examples, count(error) AS errors, round(sum(response_length) FILTER (error IS NULL) / greatest(count(*) FILTER (error IS NULL), 1), 6) AS avg_response_length FROM results GROUP BY variant",
    "cost_estimate": f"""
WITH {RESULTS}, a AS (SELECT avg(input_tokens_est) AS i, avg(output_tokens_est) AS o, avg(elapsed) AS t, count(*) AS n FROM results)
SELECT round(i, 4) AS avg_input, round(o, 4) AS avg_output, round(i * n, 4) AS total_input, round(o * n, 4) AS total_output, round((t + {PAUSE}) * n / 60, 4) AS minutes,
  round(i * n / 1e6 * {INPUT_PRICE}, 4) AS input_cost, round(o * n / 1e6 * {OUTPUT_PRICE}, 4) AS output_cost, round(i * n / 1e6 * {INPUT_PRICE} + o * n / 1e6 * {OUTPUT_PRICE}, 4) AS total_cost FROM a
""",
    "perplexity": "SELECT round(exp(sum((doc_id % 40)::DOUBLE / 10.0 * (n_chars % 50 + 1)) / sum(n_chars % 50 + 1)), 6) AS perplexity FROM documents",
    "format_qa": f"WITH {QA} SELECT pos, {QA_TEXT} AS text FROM qa",
    "format_conversation": f"WITH {MESSAGES} SELECT conv_id, {CONVERSATION_TEXT} AS text FROM messages",
    "format_completion": f"WITH {COMPLETIONS} SELECT pos, {COMPLETION_TEXT} AS text FROM completions",
    "format_classification": f"WITH {LABELLED} SELECT pos, {LABEL_TEXT} AS text FROM labelled",
    "inference_prompt": f"SELECT item_id, {PROLOGUE} || {turn(quote('user'), 'text')} || {quote(HEADER_START + 'assistant' + HEADER_END)} || {NL} || {NL} AS text FROM benchmark",
    "format_counts": f"WITH {UNION} SELECT format, count(*) AS count FROM examples GROUP BY format",
    "stratified_split": f"WITH {SPLIT} SELECT md5(text) AS text_md5, format, source_id, split FROM split",
    "split_summary": f"WITH {SPLIT} SELECT split, 'format' AS kind, format AS value, count(*) AS count FROM split GROUP BY ALL UNION ALL SELECT split, 'source', source_id, count(*) FROM split GROUP BY ALL",
    "html_main_text": f"""
WITH raw AS (
  SELECT page_id, url, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, regexp_replace(regexp_extract(html, '<article>((?s:.*?))</article>', 1), '(<[^>]+>)+', {NL}, 'g') AS t FROM pages
), plain AS (
  SELECT page_id, url, replace(replace(replace(title, '&quot;', '"'), '&#x27;', ''''), '&amp;', '&') AS title, replace(replace(replace(t, '&quot;', '"'), '&#x27;', ''''), '&amp;', '&') AS t FROM raw
), cleaned AS (SELECT page_id, coalesce(nullif({strip('title')}, ''), url) AS title, {whitespace(artifacts(residue(unicode('t'))))} AS text FROM plain)
SELECT page_id, title, text FROM cleaned WHERE {meaningful('text')}
""",
    "html_article_text": f"""
WITH raw AS (
  SELECT page_id, regexp_replace(replace(regexp_replace(regexp_extract(html, '<article>((?s:.*?))</article>', 1), '</?b>', '', 'g'), '<br>', {NL}), '\\s*(<[^>]+>)+\\s*', {NL}, 'g') AS t FROM pages
), plain AS (
  SELECT page_id, replace(replace(replace(t, '&quot;', '"'), '&#x27;', ''''), '&amp;', '&') AS t FROM raw
), cleaned AS (SELECT page_id, {whitespace(artifacts(residue(unicode('t'))))} AS text FROM plain)
SELECT page_id, text FROM cleaned WHERE {meaningful('text')}
""",
    "stream_windowed_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS count FROM events GROUP BY ALL",
    "stream_clean": f"SELECT doc_id, t AS text FROM (SELECT doc_id, {whitespace(artifacts(residue('(' + unicode('text') + '  || ' + NL + " || ' 42 ' || " + NL + ')')))} AS t FROM documents) WHERE {meaningful('t')}",
}
