"""Oracle SQL shared by several queries.

Written from the definition of each operator with lists, lambdas and plain
joins, not from the expressions the library uses.
"""

from __future__ import annotations

from catalog.inputs import DIALOGUES_SQL, POSTS_SQL, duck
from lexiloom.functions.stopwords import ENGLISH_STOP_WORDS

# Whitespace as class members.
WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANK_LINE = rf"^[{WS}]*$"
POSTS = f"posts AS ({duck(POSTS_SQL)})"


def valid(column: str) -> str:
    return f"coalesce(regexp_matches({column}, '[^{WS}]'), false)"


def lines(column: str) -> str:
    return f"string_split({column}, chr(10))"


def _first_line(column: str, test: str) -> str:
    """Position of the first line passing a test, or null."""
    return f"nullif(list_position(list_transform({lines(column)}, lambda l: {test}), true), 0)"


def headers(c: str) -> str:
    body = rf"NOT (regexp_matches(l, '{BLANK_LINE}') OR regexp_matches(l, '^[{WS}]*[A-Za-z-]+:'))"
    at = _first_line(c, body)
    return f"CASE WHEN {at} IS NULL THEN '' ELSE array_to_string(list_slice({lines(c)}, {at}, len({lines(c)})), chr(10)) END"


def quotes(c: str) -> str:
    return f"array_to_string(list_filter({lines(c)}, lambda l: NOT regexp_matches(l, '^[{WS}]*>')), chr(10))"


def signature(c: str) -> str:
    at = _first_line(c, f"regexp_matches(l, '^[{WS}]*--[{WS}]*$')")
    return f"CASE WHEN {at} IS NULL THEN {c} ELSE array_to_string({lines(c)}[1:({at}) - 1], chr(10)) END"


def tags(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"


def urls(c: str) -> str:
    return f"regexp_replace({c}, '(https?://[^{WS}]+|www\\.[^{WS}]+)', ' ', 'g')"


def emails(c: str) -> str:
    return f"regexp_replace({c}, '[^{WS}]+@[^{WS}]+\\.[^{WS}]+', ' ', 'g')"


def emoji(c: str) -> str:
    return f"regexp_replace({c}, '[\\x{{2600}}-\\x{{27bf}}\\x{{1f300}}-\\x{{1faff}}]', ' ', 'g')"


def spaces(c: str) -> str:
    return f"trim(regexp_replace({c}, '[{WS}]+', ' ', 'g'))"


def mended(c: str) -> str:
    """The derived posts hold one kind of damage."""
    return f"replace({c}, 'â€™', '''')"


def guarded(c: str, expression: str) -> str:
    return f"CASE WHEN {valid(c)} THEN {expression} ELSE '' END"


def cleaned(source: str = "posts") -> str:
    """CTEs ending in ``cleaned``: the source plus ``clean_text``."""
    steps = [mended, headers, quotes, signature, tags, urls, emails, emoji, spaces]
    ctes, prior = [], f"SELECT doc_id, category, lang, text, coalesce(text, '') AS t FROM {source}"
    ctes.append(f"s0 AS ({prior})")
    for i, step in enumerate(steps, start=1):
        ctes.append(
            f"s{i} AS (SELECT doc_id, category, lang, text, {guarded('t', step('t'))} AS t FROM s{i - 1})"
        )
    ctes.append(
        f"cleaned AS (SELECT doc_id, category, lang, text, t AS clean_text, "
        f"coalesce(length(text), 0) AS original_length, length(t) AS clean_length FROM s{len(steps)})"
    )
    return ",\n".join(ctes)


def words(c: str) -> str:
    """Runs of letters; characters and pairs of them in scripts without spaces."""
    unspaced = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]"
    runs = f"regexp_extract_all(lower({c}), '{unspaced}+')"
    pairs = f"list_transform({runs}, lambda r: list_transform(generate_series(1, length(r) - 1), lambda i: substr(r, i, 2)))"
    spaced = rf"regexp_extract_all(regexp_replace(lower({c}), '{unspaced}', ' ', 'g'), '[\p{{L}}]+')"
    return f"unnest({spaced} || regexp_extract_all(lower({c}), '{unspaced}') || flatten({pairs}))"


def detected(source: str, text: str, labelled: str = "documents") -> str:
    """CTEs ending in ``detected(doc_id, language)`` for a source CTE or table, learnt from a labelled one."""
    return f"""
lang_counts AS (SELECT language, word, count(*) AS n FROM
  (SELECT lang AS language, {words('text')} AS word FROM {labelled} WHERE lang IS NOT NULL) GROUP BY ALL),
lang_totals AS (SELECT language, sum(n) AS total FROM lang_counts GROUP BY language),
lang_profile AS (SELECT language, word, round(ln(1 + n / total / 1e-6), 6) AS weight
  FROM lang_counts JOIN lang_totals USING (language)),
lang_scores AS (SELECT doc_id, language, round(sum(weight), 6) AS score FROM
  (SELECT doc_id, {words(text)} AS word FROM {source} WHERE {valid(text)})
  JOIN lang_profile USING (word) GROUP BY ALL),
lang_best AS (SELECT doc_id, language FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, language) AS place FROM lang_scores)
  WHERE place = 1),
detected AS (SELECT s.doc_id, coalesce(b.language, 'unknown') AS language
  FROM {source} s LEFT JOIN lang_best b USING (doc_id))"""


STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)


def terms(c: str) -> str:
    return rf"unnest(regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]{{2,}}'))"


TFIDF_INDEX = f"""
tf AS (SELECT doc_id, term, count(*) AS tf FROM
  (SELECT doc_id, {terms('text')} AS term FROM documents WHERE {valid('text')})
  WHERE term NOT IN ({STOP_LIST}) GROUP BY ALL),
vocab AS (SELECT term, sum(tf) AS tf, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocab,
  (SELECT count(*) AS n FROM documents WHERE {valid('text')})),
weights AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM
  (SELECT doc_id, term, tf * idf AS raw FROM tf JOIN idf USING (term)))"""


def tfidf_hits(queries: str, k: int = 4) -> str:
    """CTEs ending in ``hits``, for a CTE or table ``queries(query_id, query)``."""
    return f"""{TFIDF_INDEX},
q_tf AS (SELECT query_id, term, count(*) AS tf FROM
  (SELECT query_id, {terms('query')} AS term FROM {queries} WHERE {valid('query')})
  WHERE term NOT IN ({STOP_LIST}) GROUP BY ALL),
q_weights AS (SELECT query_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS weight
  FROM (SELECT query_id, term, tf * idf AS raw FROM q_tf JOIN idf USING (term))),
scored AS (SELECT query_id, doc_id, round(dot, 6) AS score FROM (SELECT query_id, doc_id,
  sum(q.weight * w.weight) AS dot FROM q_weights q JOIN weights w USING (term) GROUP BY ALL) WHERE dot > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM scored),
hits AS (SELECT query_id, rank, r.doc_id, score, d.text FROM ranked r
  JOIN documents d USING (doc_id) WHERE rank <= {k})"""


PASSAGES = "passages AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
DIALOGUES = f"dialogues AS ({duck(DIALOGUES_SQL)})"
QUESTIONS = "questions AS (SELECT query_id, question AS query FROM dialogues)"

CONTEXTS = f"""
pieces AS (SELECT query_id, rank, '[' || rank || '] ' ||
    regexp_replace(regexp_replace(text, '^[{WS}]+', ''), '[{WS}]+$', '') AS piece FROM hits),
budget AS (SELECT *, sum(greatest(1, length(piece) // 4)) OVER
    (PARTITION BY query_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS running FROM pieces),
contexts AS (SELECT query_id, string_agg(piece, chr(10) || chr(10) ORDER BY rank) AS context,
    count(*) AS num_pieces FROM budget WHERE rank = 1 OR running <= 2000 GROUP BY query_id)"""


def piece_lengths(c: str, size: int, separators: list[str]) -> str:
    """List of piece lengths of a text by recursive splitting."""
    if not separators or separators[0] == "":
        return f"list_transform(range(length({c})), lambda z: 1)"
    sep, v = separators[0], f"p{len(separators)}"
    mark = " || ".join(["chr(10)"] * len(sep)) if "\n" in sep else f"'{sep}'"
    parts = f"string_split({c}, {mark})"
    whole = (
        f"list_filter(list_transform({parts}, lambda {v}, i{v}: "
        f"CASE WHEN i{v} < len({parts}) THEN {v} || {mark} ELSE {v} END), lambda {v}: {v} <> '')"
    )
    finer = piece_lengths(v, size, separators[1:])
    return (
        f"flatten(list_transform({whole}, lambda {v}: CASE WHEN length({v}) <= {size} "
        f"THEN [length({v})] ELSE {finer} END))"
    )


def chunked(source: str, text: str, size: int, overlap: int, name: str = "chunked") -> str:
    """CTEs ending in ``name(doc_id, chunk_index, num_chunks_in_doc, chunk_text)``."""
    lengths = piece_lengths(text, size, ["\n\n", "\n", ". ", " ", ""])
    tail = f"least({overlap}, acc[2] - acc[1])"
    return f"""
{name}_long AS (SELECT doc_id, {text} AS t, list_reduce(
    list_transform({lengths}, lambda n: [CAST(n AS BIGINT)]),
    lambda acc, p: CASE WHEN acc[2] - acc[1] + p[1] <= {size}
      THEN list_concat([acc[1], acc[2] + p[1]], acc[3:])
      ELSE list_concat(list_concat(
        [CASE WHEN {tail} + p[1] <= {size} THEN acc[2] - {tail} ELSE acc[2] END, acc[2] + p[1]],
        acc[3:]), [acc[1], acc[2]]) END,
    [CAST(0 AS BIGINT), CAST(0 AS BIGINT)]) AS acc
  FROM {source} WHERE {valid(text)} AND length({text}) > {size}),
{name}_spans AS (SELECT doc_id, t, list_concat(acc[3:], acc[1:2]) AS spans FROM {name}_long),
{name}_rows AS (SELECT doc_id, t, spans, unnest(range(len(spans) // 2)) AS i FROM {name}_spans),
{name} AS (SELECT doc_id, i AS chunk_index, len(spans) // 2 AS num_chunks_in_doc,
    substring(t, spans[2 * i + 1] + 1, spans[2 * i + 2] - spans[2 * i + 1]) AS chunk_text FROM {name}_rows
  UNION ALL SELECT doc_id, 0, 1, {text} FROM {source}
    WHERE {valid(text)} AND length({text}) <= {size})"""
