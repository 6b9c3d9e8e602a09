"""DuckDB twins of the queries that SQL can express, written from their definitions on the same tables.

The others cut bytes, run a tokenizer, draw samples or fit a model; the tests hold them against plain Python.
"""

from tickwright.llm.chat import BUDGET, END, HISTORY, LEAST_SPAN, OPEN, SAYS, TURN_MARKS
from tickwright.llm.quality_rules import RULES, mask_of

_GAP = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(regexp_split_to_array({{text}}, '{_GAP}'), lambda x: x <> '')"


def _found(pattern: str, text: str = "text") -> str:
    return f"CAST(len(regexp_extract_all({text}, '{pattern}')) AS BIGINT)"


_RULES = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, {_WORDS.format(text="text")} AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM windows),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM counted WHERE n > 1) GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         {_found('[#*$%&|<>]')} AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
         {_found('[A-Z]')} AS n_upper,
         CAST(len(list_filter(w, lambda x: NOT regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))) AS BIGINT) AS n_bare_words,
         {_found('!')} AS n_exclamations
  FROM split LEFT JOIN covered USING (r)),
ledger AS (
  SELECT *, CAST({" + ".join(f"CASE WHEN {rule.fails} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES))} AS BIGINT) AS fail_bits
  FROM measured)
SELECT *, (fail_bits & {mask_of("base")}) <> 0 AS base_failed, (fail_bits & {mask_of("base") | mask_of("3")}) = 0 AS kept FROM ledger"""

# Escaping adds a backslash for each backslash and one within each control string.
_CONTROLS = [r"<\|", r"\|>", r"\[/?INST\]", "</?s>", "<</?SYS>>"]


def _escaped_length(text: str) -> str:
    return " + ".join([f"length({text})", _found(r"\\", text), *[_found(c, text) for c in _CONTROLS]])


_CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
costs AS (
  SELECT *, {_found("[\\p{L}]+|[\\p{N}]+|[^\\s\\p{L}\\p{N}]")} + {TURN_MARKS} AS cost,
         {len(OPEN + SAYS + END)} + {_escaped_length("role")} + {_escaped_length("text")} AS chars
  FROM said),
placed AS (
  SELECT *, row_number() OVER o AS place, sum(cost) OVER o - cost AS before
  FROM costs WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
led AS (
  SELECT *, place = 1 AND role = 'system' AS system,
         coalesce(max(CASE WHEN place = 1 AND role = 'system' THEN cost END) OVER (PARTITION BY conv_id), 0) AS system_cost
  FROM placed),
cut AS (
  SELECT *, CASE WHEN system THEN 0 ELSE before - system_cost END AS a,
         CASE WHEN system THEN 0 ELSE before - system_cost + cost END AS b,
         greatest({BUDGET - HISTORY} - system_cost, {LEAST_SPAN}) AS cell
  FROM led),
home AS (
  SELECT *, 2 * (a // cell) + CASE WHEN NOT system AND (b - 1) // cell > a // cell AND a % cell <> 0 THEN 1 ELSE 0 END AS span
  FROM cut),
spans AS (SELECT conv_id, span, min(a) AS start FROM home GROUP BY ALL),
shown AS (
  SELECT conv_id, span, chars FROM home UNION ALL
  SELECT s.conv_id, s.span, h.chars FROM spans s JOIN home h ON h.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE (h.system AND s.span > h.span) OR (NOT h.system AND s.start BETWEEN h.b AND h.a + {HISTORY})),
sizes AS (SELECT conv_id, sum(chars) AS formatted_chars, count(DISTINCT span) AS n_windows FROM shown GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
         coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM placed GROUP BY conv_id)
SELECT w.conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars, n_windows
FROM whole w JOIN sizes s ON w.conv_id IS NOT DISTINCT FROM s.conv_id"""

_WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT *, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS first FROM payloads),
kinds AS (SELECT *, CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM firsts)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM kinds"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NEAR = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM split WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, concat_ws(' ', w[i], w[i + 1]) AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS (SELECT * FROM shingles JOIN sizes USING (doc_id)),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM sized x JOIN sized y USING (shingle)
  WHERE x.doc_id < y.doc_id AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT b, root FROM reached JOIN both_ways ON node = a),
roots AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN roots ON node = doc_id LEFT JOIN sizes USING (doc_id)"""

_PHRASES = f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(text, '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM words, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size),
counts AS (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS v FROM counts WHERE size > 1 AND f >= 10),
inner_phrases AS (
  SELECT lang, f, unnest([v[1] || ' ' || v[2], v[2] || ' ' || v[3]]) AS phrase FROM frequent WHERE size = 3),
within AS (SELECT lang, phrase, max(f) AS longer FROM inner_phrases GROUP BY ALL),
cuts AS (SELECT lang, phrase, f AS a, size, v, unnest(range(1, size)) AS k FROM frequent),
measured AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.v[1 : k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.v[k + 1 : c.size], ' ')),
lowest AS (SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank
  FROM lowest m LEFT JOIN within w ON w.lang = m.lang AND w.phrase = m.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": _CHAT,
    "op2_quality_rules": _RULES,
    "op5_warc": _WARC,
    "op7_minhash_dedup": _NEAR,
    "op11_collocations": _PHRASES,
}
