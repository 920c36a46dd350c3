"""Queries on text predicates, cleaning steps and language."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.inputs import documents, posts, table
from catalog.registry import query
from lexiloom.functions import text as T
from lexiloom.operators import cleaning, language
from lexiloom.plans.corpus import prepare_corpus
from lexiloom.sources.files import spread


def _step(name: str, function, expression):
    sql = f"WITH {S.POSTS} SELECT doc_id, {S.guarded('text', expression('text'))} AS result FROM posts"

    @query(name, sql)
    def run(spark, folder):
        return posts(spark, folder).select("doc_id", function(F.col("text")).alias("result"))

    return run


_step("fix_encoding", T.fix_encoding, S.mended)
_step("strip_headers", T.strip_headers, S.headers)
_step("strip_quotes", T.strip_quotes, S.quotes)
_step("strip_signature", T.strip_signature, S.signature)
_step("strip_urls", T.strip_urls, S.urls)
_step("strip_emails", T.strip_emails, S.emails)
_step("normalize_ws", T.normalize_whitespace, S.spaces)


_SCRIPTS = " привет мир, Ελλάδα, łódź škoda ć, ✓ → € 5, 日本語 😀"


@query("fix_encoding_damaged", f"SELECT doc_id, md5(text || '{_SCRIPTS}') AS mended FROM documents")
def fix_encoding_damaged(spark, folder):
    """Texts whose UTF-8 was read as Latin-1, once and twice; mended, both are what they were."""
    whole = F.concat("text", F.lit(_SCRIPTS))

    def damaged(text):
        return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")

    docs = documents(spark, folder).select("doc_id", whole.alias("text"))
    once, twice = damaged(F.col("text")), damaged(damaged(F.col("text")))
    kinds = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, once).otherwise(twice).alias("text"))
    return kinds.select("doc_id", F.md5(T.fix_encoding(F.col("text"))).alias("mended"))


# The repair step comes first: in damaged text a trade mark sign is no emoji.
@query(
    "strip_emoji",
    f"WITH {S.POSTS} SELECT doc_id, {S.guarded('text', S.emoji(S.mended('text')))} AS result FROM posts",
)
def strip_emoji(spark, folder):
    return posts(spark, folder).select(
        "doc_id", T.strip_emoji(T.fix_encoding(F.col("text"))).alias("result")
    )


@query(
    "strip_html",
    f"SELECT page_id, {S.guarded('html', S.tags('html'))} AS result FROM pages",
)
def strip_html(spark, folder):
    pages = spread(table(spark, folder, "pages"), "page_id")
    return pages.select("page_id", T.strip_html(F.col("html")).alias("result"))


@query("valid_text", f"WITH {S.POSTS} SELECT doc_id, {S.valid('text')} AS valid FROM posts")
def valid_text(spark, folder):
    return posts(spark, folder).select("doc_id", T.is_valid_text(F.col("text")).alias("valid"))


@query("index_filter", f"WITH {S.POSTS} SELECT doc_id, category FROM posts WHERE {S.valid('text')}")
def index_filter(spark, folder):
    return cleaning.drop_blank(posts(spark, folder), "text").select("doc_id", "category")


@query("clean_text", f"WITH {S.POSTS}, {S.cleaned()} SELECT doc_id, clean_text FROM cleaned")
def clean_text(spark, folder):
    return posts(spark, folder).select("doc_id", T.clean_text(F.col("text")).alias("clean_text"))


@query(
    "detect_language",
    f"WITH {S.detected('documents', 'text')} SELECT doc_id, language FROM detected",
)
def detect_language(spark, folder):
    docs = documents(spark, folder)
    found = language.with_language(docs, language.language_profile(docs), "text")
    return found.select("doc_id", "language")


@query(
    "detect_language_joined",
    f"WITH {S.detected('documents', 'text')} SELECT doc_id, language FROM detected",
)
def detect_language_joined(spark, folder):
    """The way taken when the profile is too large to hold."""
    docs = documents(spark, folder)
    profile = language.language_profile(docs)
    found = language.with_language(docs, profile, "text", profile_bound=0)
    return found.select("doc_id", "language")


# Letters stand for these characters, and what is no letter goes: the same texts in a script without spaces.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_CHARACTERS = "".join(chr(0x4E00 + 61 * i) for i in range(len(_LETTERS)))
_GOES = " .,;:!?\n\t"


@query(
    "detect_language_unspaced",
    f"""WITH written AS (SELECT doc_id, lang,
  translate(lower(text), '{_LETTERS}{_GOES}', '{_CHARACTERS}') AS text FROM documents),
{S.detected('written', 'text', 'written')} SELECT doc_id, language FROM detected""",
)
def detect_language_unspaced(spark, folder):
    """Languages of texts in a script without spaces."""
    written = F.translate(F.lower("text"), _LETTERS + _GOES, _CHARACTERS)
    docs = documents(spark, folder).withColumn("text", written)
    return language.with_language(docs, language.language_profile(docs), "text").select("doc_id", "language")


@query(
    "language_accuracy",
    f"""WITH known AS (SELECT * FROM documents WHERE doc_id % 2 = 0),
{S.detected('documents', 'text', 'known')}
SELECT lang, doc_id % 2 = 1 AS held_out, count(*) AS docs, count(*) FILTER (language = lang) AS found
FROM documents JOIN detected USING (doc_id) GROUP BY ALL""",
)
def language_accuracy(spark, folder):
    """Texts whose label was found, apart for those learnt from (even ids) and those held out."""
    docs = documents(spark, folder)
    found = language.with_language(docs, language.language_profile(docs.filter("doc_id % 2 = 0")), "text")
    return found.groupBy("lang", (F.col("doc_id") % 2 == 1).alias("held_out")).agg(
        F.count("*").alias("docs"), F.count_if(F.col("language") == F.col("lang")).alias("found")
    )


@query(
    "process_corpus",
    f"""WITH {S.POSTS}, {S.cleaned()}, {S.detected('cleaned', 'clean_text')}
SELECT doc_id, category, language, clean_text, CAST(original_length AS BIGINT) AS original_length,
  CAST(clean_length AS BIGINT) AS clean_length FROM cleaned JOIN detected USING (doc_id)""",
)
def process_corpus(spark, folder):
    profile = language.language_profile(documents(spark, folder))
    out = prepare_corpus(posts(spark, folder), profile)
    return out.select(
        "doc_id", "category", "language", "clean_text", "original_length", "clean_length"
    )


@query(
    "encoding_issues",
    """SELECT source AS category, count(*) FILTER (unicode(right(text, 1)) >= 128) AS broken,
  count(*) AS docs FROM documents GROUP BY source""",
)
def encoding_issues(spark, folder):
    """Texts that lost their last byte, as a cut-off transfer leaves them."""
    raw = F.col("text").cast("binary")
    cut = F.substring(raw, F.lit(1), F.octet_length("text") - 1)
    broken = T.has_encoding_issue(cut)
    return (
        documents(spark, folder)
        .groupBy(F.col("source").alias("category"))
        .agg(F.count_if(broken).alias("broken"), F.count("*").alias("docs"))
    )


@query(
    "printable_filter",
    rf"""SELECT doc_id, source AS category FROM documents WHERE {S.valid('text')}
  AND length(regexp_replace(text, '[^\p{{L}}\p{{M}}\p{{N}}\p{{P}}\p{{S}}{S.WS}]', '', 'g')) / length(text) >= 0.9
  AND list_max(list_transform(regexp_split_to_array(text, '[{S.WS}]+'), lambda w: length(w))) <= 40""",
)
def printable_filter(spark, folder):
    kept = cleaning.drop_binary(documents(spark, folder), "text", max_token=40)
    return kept.select("doc_id", F.col("source").alias("category"))
