"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import (
    bpe,
    collocations,
    decontamination,
    host_rules,
    jaccard_join,
    language_mixture,
    licences,
    main_text,
    maxent_lm,
    pii,
    product_codes,
    toxicity,
    warc_zip,
)
from lexiloom.llm.common import remainder, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", pii.identifiers(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.with_hits(docs, table(spark, folder, "benchmark")).drop("text")
    hits = F.col("hits")
    n_hit = decontamination.n_hit(hits)
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(hits["items"]), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS key
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS key
  FROM words, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, v.item FROM places p JOIN windows v ON v.key = p.key AND v.n = p.n),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder("doc_id", 5) == 0
    model = language_mixture.MixtureModel.fit(docs.filter(~held_out))
    texts = docs.select("doc_id", "text", held_out.alias("held_out"))
    found = language_mixture.with_language(texts, model).drop("text")
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc_zip.archive(spark, table(spark, folder, "pages"))
    found = warc_zip.read(archives, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
last AS (SELECT sha1(h) AS d, max(page_id) AS r FROM p WHERE strlen(h) >= 1000 GROUP BY 1)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN r IS NULL OR r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN r <> page_id THEN r END AS refers_to
FROM p LEFT JOIN last ON d = sha1(h) AND strlen(h) >= 1000
"""


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    text = main_text.main_text(F.col("html")).alias("text")
    found = table(spark, folder, "pages").select("page_id", "url", text)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_maxent(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder("doc_id", 7) == 2
    model = maxent_lm.Model.fit(docs.filter(~held_out))
    return maxent_lm.score(docs, model, held_out)


def op7_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.judge(table(spark, folder, "documents"))


def _hosts_sql() -> str:
    """The measures by their definitions, the verdict by the formulas of the rule module."""
    failed = {
        "few": f"n_words < {host_rules.MIN_WORDS}",
        "repeats": f"100 * n_repeat_words > {host_rules.MAX_REPEATED} * n_words",
        "symbols": "10 * n_symbols > word_chars",
        "lines": "n_dup_lines > 3 AND 10 * n_dup_lines > n_words",
    }
    counts = ", ".join(f"count(*) FILTER ({c}) AS {k}" for k, c in failed.items())
    steps, verdict = [], []
    for k in failed:
        steps.append(f"""mean_{k} AS (SELECT h, n, hosts, {k} AS f, {k} / n AS own, sum({k} / n) OVER () AS total,
  sum(({k} / n) * ({k} / n)) OVER () AS square, sum(1 / n) OVER () AS noise FROM hosts),
prior_{k} AS (SELECT *, total / hosts AS m, (1 - total / hosts) * total / hosts AS spread FROM mean_{k}),
excess_{k} AS (SELECT *, square / hosts - m * m - spread * noise / hosts AS excess FROM prior_{k}),
weight_{k} AS (SELECT *, CASE WHEN excess > 1e-12 THEN greatest(1.0, spread / excess - 1) ELSE 1.0 END AS w FROM excess_{k}),
rate_{k} AS (SELECT *, (f + m * w) / (n + w) AS r, (total - own) / (hosts - 1) AS c,
  (square - own * own) / (hosts - 1) AS sq FROM weight_{k})""")
        verdict.append(f"""SELECT h FROM rate_{k} WHERE r > {host_rules.MAX_RATE} OR hosts > 1 AND r - {host_rules.SURE} * sqrt(r * (1 - r) / (n + w + 1))
  > greatest({host_rules.MOST}, c + {host_rules.APART} * sqrt(greatest(0.0, sq - c * c)))""")
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
windows AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(8)) AS k FROM twice WHERE c > 1) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
measured AS MATERIALIZED (SELECT doc_id, source, CAST(len(w.w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
hosts AS MATERIALIZED (SELECT source AS h, CAST(count(*) AS DOUBLE) AS n, count(*) OVER () AS hosts, {counts} FROM measured GROUP BY source),
{", ".join(steps)},
bad AS ({" UNION ".join(verdict)}),
judged AS (SELECT measured.*, n_words < {host_rules.MIN_WORDS} OR {failed["repeats"]} AS base_failed,
  EXISTS (SELECT 1 FROM bad WHERE h IS NOT DISTINCT FROM source) AS host_rejected FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept FROM judged
"""


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", licences.licences(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.components(table(spark, folder, "documents"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", bpe.digests(F.col("text"), vocabulary_path()).alias("found"))
    return found.select("doc_id", "found.*")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM w, range(1, 4) AS a(k), unnest(range(1, len(w) - k + 2)) AS b(i) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(p[1 : cut], ' ') AS one, array_to_string(p[cut + 1 : k], ' ') AS two
  FROM c, range(1, 3) AS t(cut) WHERE cut < k),
scored AS (
  SELECT t.lang, t.k, t.phrase, a, cut, x.f AS l, y.f AS r,
    CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts t JOIN f x ON x.lang = t.lang AND x.phrase = one JOIN f y ON y.lang = t.lang AND y.phrase = two),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) AS part FROM c WHERE k = 3)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN around o ON s.k = 2 AND o.lang = s.lang AND o.part = s.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_codes(spark: SparkSession, folder: str) -> DataFrame:
    return product_codes.compressed(table(spark, folder, "embeddings"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds written out, each part against each entry."""
    width = f"(len(v) // {parts})"
    steps = [
        f"""k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, label, q, v[q * {width} + 1 : (q + 1) * {width}] AS x FROM k, range({parts}) AS t(q)),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {entries}),
b0 AS MATERIALIZED (SELECT q, e, x AS c FROM p JOIN ids USING (vec_id))"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""n{r} AS MATERIALIZED (
  SELECT vec_id, label, p.q, x, min({{'d': list_sum(list_transform(range(1, len(x) + 1),
    lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT, 'e': e}}) AS m
  FROM p JOIN b{r} b ON b.q = p.q GROUP BY vec_id, label, p.q, x)"""
        )
        if r < rounds:
            steps.append(
                f"""s{r} AS (
  SELECT q, e, i, sum(x[i]) AS s, count(*) AS n
  FROM (SELECT q, m.e AS e, x, unnest(range(1, len(x) + 1)) AS i FROM n{r}) GROUP BY q, e, i),
b{r + 1} AS MATERIALIZED (
  SELECT b.q, b.e, coalesce(f.c, b.c) AS c FROM b{r} b LEFT JOIN (
    SELECT q, e, list(CAST(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END AS BIGINT) ORDER BY i) AS c
    FROM s{r} GROUP BY q, e) f ON f.q = b.q AND f.e = b.e)"""
            )
    return f"""
WITH {", ".join(steps)},
whole AS (
  SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY q) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM n{rounds} GROUP BY vec_id, label),
named AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY q, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  h AS codebooks_sha256
FROM whole, named
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_language": op3_language,
    "op4_warc": op4_warc,
    "op5_html": op5_html,
    "op6_maxent": op6_maxent,
    "op7_hosts": op7_hosts,
    "op8_licences": op8_licences,
    "op9_jaccard": op9_jaccard,
    "op10_bpe": op10_bpe,
    "op11_collocations": op11_collocations,
    "op12_toxicity": op12_toxicity,
    "op13_codes": op13_codes,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op4_warc": OP4_SQL,
    "op7_hosts": _hosts_sql(),
    "op11_collocations": OP11_SQL,
    "op13_codes": _codes_sql(),
}
