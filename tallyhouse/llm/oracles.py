r"""SQL for the registered queries of this folder that SQL can express, over whole tables.

The trained models (op2, op6, op8) and op10, which works on bytes, are tested against held-out labels and
brute force instead.
"""

from __future__ import annotations

from tallyhouse.llm import sharding

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _components(n: int, percent: int, more: str = "") -> str:
    """doc_id, n_shingles, component_id by all pairs that share a gram of n words."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {n}
    THEN [array_to_string(w[i:i + {n - 1}], ' ') FOR i IN range(1, len(w) - {n - 2})]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' '] ELSE [] END) AS gram FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (gram)
  WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= {percent} * (x.n + y.n - s.n)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS doc_id, b AS other FROM sides
  UNION SELECT r.doc_id, l.b FROM reached r JOIN sides l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
       least(d.doc_id, coalesce(l.least, d.doc_id)) AS component_id{more}
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""


NGRAM_JOIN = _components(3, 90)
NEAR_DUPLICATES = _components(5, 85, ", coalesce(l.least, d.doc_id) >= d.doc_id AS kept")

FILL_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
numbers AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x,
         ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y, ('0x' || h[25:32])::BIGINT % 100 AS spm FROM units),
parts AS (
  SELECT doc_id, text, n, array_to_string(u[1:least(x, y)], '') AS p,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:n], '') AS s,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') THEN 'plain' WHEN spm < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""


def _edit(cost: str, letter: str, then: str) -> str:
    return f"{{'c': {cost} + {then}.c, 'a': '{letter}' || {then}.a}}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


_NEXT = ("f2", "f2", "f3", "f2")  # the state after a user or assistant in each state
_MAY_KEEP = ("CASE ini WHEN 's' THEN f1 WHEN 'u' THEN f2 END", "CASE ini WHEN 'u' THEN f2 END",
             "CASE ini WHEN 'a' THEN f3 END", "CASE ini WHEN 'u' THEN f2 END")
_FIRST_EDITS = ",\n".join(
    f"    CASE WHEN gone THEN {_edit('4', 'D', f'f{i}')} WHEN ({_MAY_KEEP[i]}) IS NULL THEN "
    + _least(_edit("4", "D", f"f{i}"), _edit("3 + more", "R", _NEXT[i]))
    + " ELSE "
    + _least(_edit("4", "D", f"f{i}"), _edit("3 + more", "R", _NEXT[i]), _edit("more", "K", f"({_MAY_KEEP[i]})"))
    + f" END AS g{i}"
    for i in range(4)
)

# The cheapest edits by a recursion from the last row of each conversation to the first: least (cost, audit) of each state.
REPAIR = rf"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT FOR c IN string_split(k, '')]),
      lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)),
        lambda x, bit: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
      4294967295::BIGINT) % 20 AS kind FROM numbered),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, left(role, 1) AS ini,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM damaged),
faults AS (
  SELECT *, last = '' AS blank, last <> '' AND nth > 1 AS duplicate, last <> '' AND nth = 1 AND last NOT IN ('.', '!', '?') AS truncated,
         coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY n) || ini, 'ua') NOT IN ('su', 'ua', 'au') AS illegal FROM ordered),
counts AS (
  SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal FROM faults GROUP BY conv_id),
togo AS (
  SELECT conv_id, n + 1 AS n, {{'c': 0::BIGINT, 'a': ''}} AS f0, {{'c': 6::BIGINT, 'a': 'II'}} AS f1,
         {{'c': 3::BIGINT, 'a': 'I'}} AS f2, {{'c': 0::BIGINT, 'a': ''}} AS f3 FROM counts
  UNION ALL
  SELECT conv_id, n, {_least("g0", _edit("3", "I", "h2"))}, {_least("g1", _edit("3", "I", "h2"))}, h2, h3 FROM (
   SELECT conv_id, n, g0, g1, {_least("g2", _edit("3", "I", "g3"))} AS h2, {_least("g3", _edit("3", "I", "g2"))} AS h3 FROM (
    SELECT conv_id, n,
{_FIRST_EDITS}
    FROM (SELECT t.conv_id, f.n, f.ini, f.blank OR f.duplicate AS gone, CASE WHEN f.truncated THEN 3 ELSE 0 END AS more, f0, f1, f2, f3
          FROM togo t JOIN faults f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.n = t.n - 1)))),
audits AS (SELECT conv_id, f0.c AS cost, f0.a AS audit FROM togo WHERE n = 1),
edits AS (
  SELECT conv_id, p, audit[p] AS edit,
         count(*) FILTER (audit[p] <> 'I') OVER upto AS n, count(*) FILTER (audit[p] <> 'D') OVER upto AS nth
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM audits)
  WINDOW upto AS (PARTITION BY conv_id ORDER BY p)),
written AS (
  SELECT e.conv_id, e.p, e.edit, e.nth, f.role, CASE WHEN e.edit = 'I' THEN '' ELSE f.text END AS text,
         max(CASE WHEN e.edit = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS system
  FROM edits e LEFT JOIN faults f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.n = f.n WHERE e.edit <> 'D'),
repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || text, chr(10) ORDER BY p)) AS sha FROM written GROUP BY conv_id)
SELECT i.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(a.cost, 0)::BIGINT AS cost,
       coalesce(a.audit, '') AS audit, coalesce(r.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id
"""

# The shards take turns; a turn claims the first free slot in the shard's order of preference.
SHARDING = f"""
WITH RECURSIVE names AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name FROM range({sharding.SHARDS}) t(i)),
orders AS (
  SELECT i, ('0x' || substr(md5('offset:' || name), 1, 15))::BIGINT % {sharding.TABLE_SIZE} AS first,
         ('0x' || substr(md5('skip:' || name), 1, 15))::BIGINT % {sharding.TABLE_SIZE - 1} + 1 AS step
  FROM names),
turns AS (
  SELECT 0 AS turn, NULL::BIGINT AS slot, [false FOR k IN range({sharding.TABLE_SIZE})] AS claimed
  UNION ALL
  SELECT turn + 1, free, [claimed[k + 1] OR k = free FOR k IN range({sharding.TABLE_SIZE})]
  FROM (
    SELECT t.turn, t.claimed, (o.first + list_filter(range({sharding.TABLE_SIZE}),
        lambda k: NOT t.claimed[(o.first + k * o.step) % {sharding.TABLE_SIZE} + 1])[1] * o.step)
        % {sharding.TABLE_SIZE} AS free
    FROM turns t JOIN orders o ON o.i = t.turn % {sharding.SHARDS}
    WHERE t.turn < {sharding.TABLE_SIZE})),
owner AS (SELECT slot, ((turn - 1) % {sharding.SHARDS})::INTEGER AS shard FROM turns WHERE turn > 0),
placed AS (
  SELECT doc_id, (('0x' || substr(md5('place:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT
    % {sharding.TABLE_SIZE})::INTEGER AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN owner USING (slot)
"""

_ESCAPED = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
CHAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
written AS (
  SELECT *, length('<|im_start|>' || replace({_ESCAPED.format("role")}, chr(10), '<\/') || chr(10)
         || {_ESCAPED.format("text")} || '<|im_end|>' || chr(10)) AS chars,
         row_number() OVER o AS n, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
reached AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM written)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant' OR n = turns) AS n_examples,
       sum(upto) FILTER (role = 'assistant' OR n = turns)::BIGINT AS example_chars
FROM reached GROUP BY conv_id
"""

MIXING = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_SPACED})), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
         (2 * source_size)::DOUBLE AS most, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM sources),
filled AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
chosen AS (SELECT min_by(level, most / weight) AS level, min(most / weight) AS open
           FROM filled WHERE level < most / weight),
aims AS (
  SELECT f.source, source_size, CASE WHEN c.open IS NULL OR most / weight < c.open THEN most
         ELSE least(most, c.level * weight) END AS target FROM filled f, chosen c),
queued AS (
  SELECT s.*, source_size, target, sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size) AS upto
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
copies AS (
  SELECT doc_id, source, size, key, copy, (copy * source_size + upto) / nullif(target, 0) AS finish
  FROM queued, range(2) t(copy) WHERE size > 0),
ranked AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, key, doc_id, size, copy) AS reached
  FROM copies WHERE finish IS NOT NULL),
taken AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM ranked
  WHERE reached <= (SELECT sum(target) FROM aims) GROUP BY doc_id)
SELECT q.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(13, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, i FROM places JOIN windows USING (n, phrase)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: rule -> value, level in thousandths, reach, distance without spread. Stated here on their own, not taken from rules.py.
_RULES = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", 950, 1.0, 0.08),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 8)", 975, 2.0, 0.25),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", 975, 3.0, 0.3),
    "word_length": ("word_chars / greatest(n_words, 1)", 900, 3.0, 3.0),
}
_GAMMA = "1.0202020202020203::DOUBLE"
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, base_failed, '{rule}' AS rule, ({value})::DOUBLE AS value, {level} AS level FROM base"
    for rule, (value, level, _, _) in _RULES.items()
)
_CONSTANTS = ", ".join(f"('{rule}', {reach}::DOUBLE, {slack}::DOUBLE)" for rule, (_, _, reach, slack) in _RULES.items())


def _quantile_sql(name: str, keys: str) -> str:
    """Quantiles of the merged sketches: the first bin at which the count reaches the rank."""
    part = f"PARTITION BY {keys}"
    at = lambda rank: f"min(edge) FILTER (1000 * upto >= total * {rank})"
    return f"""{name}_q AS (
  SELECT {keys}, max(total) AS docs, {at("500")} * 0.99 AS mid, {at("level")} AS high,
         {at("(1000 - level)")} / {_GAMMA} AS low FROM (
    SELECT *, sum(n) OVER ({part} ORDER BY bin NULLS FIRST) AS upto, sum(n) OVER ({part}) AS total,
           CASE WHEN bin IS NULL THEN 0 ELSE pow({_GAMMA}, bin) END AS edge
    FROM (SELECT {keys}, level, bin, count(*) AS n FROM bins GROUP BY {keys}, level, bin)) GROUP BY {keys}),
{name} AS (
  SELECT *, CASE WHEN rule = 'word_length' THEN greatest(high - mid, mid - low) ELSE high - mid END AS away,
         away > mid * ({_GAMMA} - 1) AS wide FROM {name}_q)"""


QUALITY_RULES = rf"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, {_SPACED}) GROUP BY doc_id),
threes AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS times
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS three
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3))),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM threes WHERE times > 1) GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
  FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
vals AS ({_VALUES}),
bins AS (
  SELECT lang, source, rule, level, CASE WHEN value > 0 THEN ceil(ln(value) / ln({_GAMMA}))::INTEGER END AS bin
  FROM vals WHERE NOT base_failed),
{_quantile_sql("cell", "lang, source, rule")},
{_quantile_sql("of_lang", "lang, rule")},
{_quantile_sql("overall", "rule")},
constants(rule, reach, slack) AS (VALUES {_CONSTANTS}),
chosen AS (
  SELECT c.lang, c.source, c.rule,
         CASE WHEN c.docs >= 200 AND c.wide THEN [c.mid, reach * c.away]
              WHEN l.docs >= 200 AND l.wide THEN [l.mid, reach * l.away]
              WHEN o.wide THEN [o.mid, reach * o.away]
              WHEN c.docs >= 200 THEN [c.mid, slack]
              WHEN l.docs >= 200 THEN [l.mid, slack] ELSE [o.mid, slack] END AS fence
  FROM cell c JOIN of_lang l ON c.lang IS NOT DISTINCT FROM l.lang AND c.rule = l.rule
  JOIN overall o ON c.rule = o.rule JOIN constants k ON c.rule = k.rule),
judged AS (
  SELECT doc_id, bool_and(fence IS NULL OR (value <= fence[1] + fence[2]
         AND (v.rule <> 'word_length' OR value >= fence[1] - fence[2]))) AS inside
  FROM vals v LEFT JOIN chosen c ON v.lang IS NOT DISTINCT FROM c.lang
       AND v.source IS NOT DISTINCT FROM c.source AND v.rule = c.rule
  GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND inside AS kept
FROM base JOIN judged USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": NGRAM_JOIN,
    "op3_sharding": SHARDING,
    "op4_chat_formatting": CHAT,
    "op5_mixing": MIXING,
    "op7_decontamination": DECONTAMINATION,
    "op9_quality_rules": QUALITY_RULES,
    "op11_near_duplicates": NEAR_DUPLICATES,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_conversation_repair": REPAIR,
}
