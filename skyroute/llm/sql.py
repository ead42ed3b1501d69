"""DuckDB SQL that the queries of this subpackage are compared with."""

from __future__ import annotations

from skyroute.llm import licenses, rules

_STOP = ", ".join("'" + w + "'" for w in rules.STOP_WORDS)

QUALITY_RULES = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), windows AS (
  SELECT rid, i, array_to_string(words[i : i + 7], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest(range(8)) AS k) GROUP BY rid
), f AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(replace(text, '!', '')) AS n_ex,
    len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*$'))) AS n_ell,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}][\x20\x09-\x0D]'))) AS n_bul,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (rid)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 20 AND n_symbols / n_words <= 0.3
  AND n_ex / n_words <= 0.5 AND n_stop / n_words >= 0.005 AND n_dup_lines / n_lines <= 0.75
  AND n_ell / n_lines <= 0.5 AND n_bul / n_lines <= 0.95 AS kept
FROM b
"""

CHAT_FORMATTING = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER w AS i, coalesce(lag(role) OVER w <> role, true) AS opens,
    length(text) + len(regexp_extract_all(text,
      '[<\[]\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|\|endoftext\|>|INST\]|/INST\])')) AS body
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(body + CASE WHEN opens THEN 13 + length(role) + 11 ELSE 10 END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""

REPEATS = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT rid, doc_id, i, array_to_string(words[i : i + 49], ' ') AS win
  FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)
), later AS (
  SELECT rid, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS first FROM windows) WHERE doc_id > first
), marks AS (
  SELECT rid, i AS k, 1 AS d FROM later UNION ALL SELECT rid, i + 50, -1 FROM later
), steps AS (
  SELECT rid, k, sum(sum(d)) OVER (PARTITION BY rid ORDER BY k) AS depth,
    lead(k) OVER (PARTITION BY rid ORDER BY k) AS upto
  FROM marks GROUP BY rid, k
), gone AS (
  SELECT rid, unnest(range(k, upto)) AS p FROM steps WHERE depth > 0
), removed AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(len(ps), 0) AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(words, ' ')
    ELSE array_to_string(list_filter(words, lambda x, i: NOT list_contains(ps, i)), ' ') END) AS kept_sha256
FROM w LEFT JOIN removed USING (rid)
"""

_ALNUM = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def license_sql(templates: tuple[licenses.Template, ...] = licenses.TEMPLATES) -> str:
    grams = ", ".join(f"({t}, {q}, '{g}')" for t, x in enumerate(templates) for q, g in enumerate(x.grams()))
    about = ", ".join(f"({t}, '{x.label}', {x.base}, {len(x.words)}, {x.slack})" for t, x in enumerate(templates))
    return f"""
WITH t(template, q, gram) AS (VALUES {grams}),
about(template, label, base, size, slack) AS (VALUES {about}),
w AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM} AS words FROM documents),
g AS (
  SELECT rid, p, words[p + 1] || ' ' || words[p + 2] || ' ' || words[p + 3] AS gram
  FROM (SELECT rid, words, unnest(range(len(words) - 2)) AS p FROM w WHERE len(words) > 2)
), v AS (
  SELECT rid, template, p - q AS diagonal, min(q) AS first_q, list(q) AS qs
  FROM g JOIN t USING (gram) GROUP BY ALL
), apart AS (
  SELECT v.*, CASE WHEN diagonal - lag(diagonal) OVER along <= slack THEN 0 ELSE 1 END AS far
  FROM v JOIN about USING (template) WINDOW along AS (PARTITION BY rid, template ORDER BY diagonal)
), merged AS (
  SELECT rid, template, min(diagonal + first_q) AS first_word, list_distinct(flatten(list(qs))) AS qs
  FROM (SELECT *, sum(far) OVER (PARTITION BY rid, template ORDER BY diagonal) AS part FROM apart)
  GROUP BY rid, template, part
), spans AS (
  SELECT *, CASE WHEN base THEN covered = 1 ELSE covered >= {licenses.COVERED} END AS verified FROM (
    SELECT rid, label, base, first_word,
      len(list_distinct(flatten(list_transform(qs, lambda q: range(q, q + 3))))) / size AS covered
    FROM merged JOIN about USING (template))
), found AS (
  SELECT rid, count(*) FILTER (base AND verified) AS n_base,
    min(first_word) FILTER (base AND verified) AS first_word, max(first_word) FILTER (base AND verified) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND verified) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (verified) AS labels, max(covered) AS score
  FROM spans GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN found USING (rid)
"""


_SHINGLES = """CASE WHEN len(words) >= 5
  THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' '))
  WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END"""

CONTAINMENT = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_ALNUM} AS words FROM (SELECT DISTINCT doc_id, text FROM documents)
), i AS (
  SELECT row_number() OVER () AS iid, item_id, {_ALNUM} AS words FROM benchmark
), parts AS (
  SELECT DISTINCT rid, doc_id, unnest({_SHINGLES}) AS s FROM d
), items AS (
  SELECT DISTINCT iid, item_id, unnest({_SHINGLES}) AS s FROM i
), sized AS (SELECT *, count(*) OVER (PARTITION BY iid) AS n_item FROM items)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM parts JOIN sized USING (s) GROUP BY rid, doc_id, iid, item_id, n_item
HAVING count(*) / n_item >= 0.8
"""

RANKED_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), s AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d
), tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), i AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)
), wanted AS (
  SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(terms) AS term FROM i) GROUP BY ALL
), m AS (
  SELECT rid, doc_id, 100 - 75 + (75 * CAST(len(terms) AS BIGINT) * n_docs) // total AS m
  FROM d, s WHERE len(terms) > 0
), scored AS (
  SELECT iid, item_id, rid, doc_id, CAST(sum(times
      * CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN df USING (term) JOIN tf USING (term) JOIN m USING (rid), s GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank,
    doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def filter_audit_sql() -> str:
    """Every order and step counted from the documents themselves, not from subsets."""
    bits = "".join(f" WHEN '{name}' THEN {1 << i}" for i, name in enumerate("ABCDE"))
    return rf"""
WITH RECURSIVE orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || f FROM orders, (SELECT unnest(string_split('ABCDE', '')) AS f) WHERE length(o) < 5 AND NOT contains(o, f)
), filters AS (SELECT unnest(string_split('ABCDE', '')) AS f
), bit AS (SELECT f, CASE f{bits} END AS bit FROM filters
), steps AS (
  SELECT o, k AS step, substr(o, k, 1) AS f,
    coalesce((SELECT CAST(sum(bit) AS INTEGER) FROM bit WHERE contains(substr(o, 1, k - 1), bit.f)), 0) AS before,
    (SELECT bit FROM bit WHERE bit.f = substr(o, k, 1)) AS own
  FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS k) WHERE length(o) = 5
), t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^ 	-]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t
), known AS (
  SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(doc_id > first, false) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN known USING (doc_id)
), counted AS (
  SELECT part, o, step, f, own, count(*) FILTER (mask & (before | own) = 0) AS kept,
    count(*) FILTER (mask & before = 0 AND mask & own > 0) AS removed,
    count(*) FILTER (mask & before > 0 AND mask & own > 0) AS redundant,
    count(*) FILTER (mask = own) AS unique_fails,
    count(*) FILTER (good AND mask & before = 0 AND mask & own > 0) AS good_lost,
    count(*) FILTER (toxic AND mask & before = 0 AND mask & own > 0) AS toxic_lost
  FROM d, steps GROUP BY ALL
)
SELECT part, o AS filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
