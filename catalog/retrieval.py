"""Queries on embeddings, vector search and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.inputs import documents, passages, table
from catalog.registry import query
from lexiloom.functions.text import preview
from lexiloom.operators import tfidf
from lexiloom.operators.chunks import chunk_documents
from lexiloom.operators.coarse import CoarseIndex
from lexiloom.operators.coarse import recall as recall_of
from lexiloom.operators.encoder import hash_embed as embed_hashed
from lexiloom.operators.vectors import CellIndex
from lexiloom.operators.vectors import vector_topk as search_vectors
from lexiloom.plans.corpus import ingest
from lexiloom.plans.retrieval import positive_hits, retrieve
from lexiloom.sources.collection import Collection
from lexiloom.sources.scratch import scratch_path


def _md5_hash(term):
    """A term hash that other engines can compute as well."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long")


@query(
    "hash_embed",
    f"""WITH hashes AS (SELECT doc_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) AS h FROM
  (SELECT doc_id, {S.terms('text')} AS term FROM documents)),
sums AS (SELECT doc_id, (h // 2) % 64 AS pos, sum(CASE WHEN h % 2 = 1 THEN -1 ELSE 1 END) AS v
  FROM hashes GROUP BY ALL),
grid AS (SELECT doc_id, pos FROM documents, range(64) AS r(pos))
SELECT doc_id, string_agg(CAST(CAST(coalesce(v, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS buckets
FROM grid LEFT JOIN sums USING (doc_id, pos) GROUP BY doc_id""",
)
def hash_embed(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    sums = embed_hashed(docs, "text", 64, _md5_hash, normalize=False)
    shown = F.transform("embedding", lambda x: x.cast("long").cast("string"))
    return sums.select("doc_id", F.array_join(shown, ",").alias("buckets"))


def _centroids(vectors):
    """One query per label: the mean of all its vectors."""
    cells = vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("m"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "m")))
    return means.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        F.transform(ordered, lambda c: c["m"]).alias("embedding")
    )


_CENTROIDS = """means AS (SELECT label, pos, round(avg(x), 6) AS m FROM (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings) GROUP BY ALL),
centroids AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY pos) AS embedding FROM means GROUP BY label)"""


def _nearest(queries: str, k: int) -> str:
    return f"""pairs AS (SELECT query_id, vec_id, round(list_sum(list_transform(list_zip(q.embedding, v.embedding),
    lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))), 6) + 0 AS distance
  FROM {queries} q, embeddings v),
nearest AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs
  QUALIFY rank <= {k})"""


_TOPK = f"""WITH {_CENTROIDS}, {_nearest('centroids', 4)}
SELECT query_id, rank, vec_id, distance, round(1 / (1 + distance), 6) AS score FROM nearest"""


@query("vector_topk", _TOPK)
def vector_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return search_vectors(_centroids(vectors), vectors)


@query("vector_topk_lsh", _TOPK)
def vector_topk_cells(spark, folder):
    """Through a stored cell index, which must find the same rows."""
    vectors = table(spark, folder, "embeddings")
    index = CellIndex.build(vectors, path=scratch_path(spark, "cells"))
    return index.search(_centroids(vectors))


@query(
    "vector_recall",
    """SELECT count(*) AS queries, 10 * count(*) AS expected, TRUE AS reached
FROM embeddings WHERE vec_id % 100 = 0""",
)
def vector_recall(spark, folder):
    """Recall of the stored approximate index; queries are the vectors with ids divisible by 100."""
    vectors = table(spark, folder, "embeddings")
    queries = vectors.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    index = CoarseIndex.build(vectors, scratch_path(spark, "coarse"), k=10)
    found = recall_of(search_vectors(queries, vectors, 10), index.search(queries, 10))
    return found.select("queries", "expected", (F.col("recall") >= 0.9).alias("reached"))


@query(
    "tfidf_topk_stored",
    f"WITH {S.PASSAGES}, {S.tfidf_hits('passages')} SELECT query_id, rank, doc_id, score FROM hits",
)
def tfidf_topk_stored(spark, folder):
    """Against an index that was written and read back."""
    path = scratch_path(spark, "tfidf")
    tfidf.TfidfIndex.build(documents(spark, folder)).write(path)
    return tfidf.TfidfIndex.read(spark, path).search(passages(spark, folder))


@query(
    "batch_query_counts",
    f"""WITH queries AS (SELECT vec_id AS query_id, embedding FROM embeddings), {_nearest('queries', 5)}
SELECT query_id, count(*) AS num_results, max(distance) AS farthest FROM nearest GROUP BY query_id""",
)
def batch_query_counts(spark, folder):
    """Every stored vector as a query."""
    vectors = table(spark, folder, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return (
        search_vectors(queries, vectors, 5)
        .groupBy("query_id")
        .agg(F.count("*").alias("num_results"), F.max("distance").alias("farthest"))
    )


_EMBEDDED = f"""{S.chunked('documents', 'text', 1000, 100)},
texts AS (SELECT 'c' AS kind, doc_id || '_' || chunk_index AS id, chunk_text AS t FROM chunked
  UNION ALL SELECT 'q', CAST(item_id AS VARCHAR), text FROM benchmark WHERE {S.valid('text')}),
hashes AS (SELECT kind, id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) AS h FROM
  (SELECT kind, id, {S.terms('t')} AS term FROM texts)),
sums AS (SELECT kind, id, (h // 2) % 64 AS pos, sum(CASE WHEN h % 2 = 1 THEN -1 ELSE 1 END) AS v
  FROM hashes GROUP BY ALL),
squares AS (SELECT kind, id, sum(v * v) AS square FROM sums GROUP BY ALL),
units AS (SELECT kind, id, pos, CAST(CAST(v / sqrt(square) AS FLOAT) AS DOUBLE) AS x
  FROM sums JOIN squares USING (kind, id) WHERE square > 0),
norms AS (SELECT t.kind, t.id, t.t, coalesce(sum(x * x), 0) AS norm
  FROM texts t LEFT JOIN units u ON u.kind = t.kind AND u.id = t.id GROUP BY ALL),
dots AS (SELECT q.id AS q, c.id AS c, sum(q.x * c.x) AS dot FROM units q JOIN units c USING (pos)
  WHERE q.kind = 'q' AND c.kind = 'c' GROUP BY ALL),
pairs AS (SELECT q.id AS q, c.id AS c, c.t, round(greatest(q.norm + c.norm - 2 * coalesce(dot, 0), 0), 6) AS distance
  FROM (SELECT * FROM norms WHERE kind = 'q') q CROSS JOIN (SELECT * FROM norms WHERE kind = 'c') c
  LEFT JOIN dots d ON d.q = q.id AND d.c = c.id)"""


@query(
    "text_vector_topk",
    f"""WITH {_EMBEDDED}
SELECT CAST(q AS BIGINT) AS query_id, row_number() OVER (PARTITION BY q ORDER BY distance, c) AS rank,
  c AS doc_id, t AS text, round(1 / (1 + distance), 6) AS score FROM pairs QUALIFY rank <= 4""",
)
def text_vector_topk(spark, folder):
    """Passages against the embedded chunks of all documents."""
    chunks = chunk_documents(documents(spark, folder), "text", category_col="source")
    embedded = embed_hashed(chunks.select("chunk_id", "chunk_text"), "chunk_text", 64, _md5_hash)
    return retrieve(
        passages(spark, folder),
        embedded,
        "vector",
        id_col="chunk_id",
        text_col="chunk_text",
        embed_queries=lambda asked: embed_hashed(asked, "query", 64, _md5_hash),
    )


@query(
    "collection_topk",
    f"""WITH {_EMBEDDED}
SELECT CAST(q AS BIGINT) AS query_id, row_number() OVER (PARTITION BY q ORDER BY distance, c) AS rank,
  c AS doc_id, t AS text, round(1 / (1 + distance), 6) AS score FROM pairs QUALIFY rank <= 4""",
)
def collection_topk(spark, folder):
    """Passages against a collection that the documents were ingested into."""
    store = Collection(spark, scratch_path(spark, "collection"))
    docs = documents(spark, folder)
    ingest(
        docs,
        store,
        embed=lambda chunks: embed_hashed(chunks, "chunk_text", 64, _md5_hash),
        text_col="text",
        category_col="source",
    )
    return retrieve(
        passages(spark, folder),
        store,
        "vector",
        embed_queries=lambda asked: embed_hashed(asked, "query", 64, _md5_hash),
    )


@query(
    "batch_query_passes",
    f"""WITH queries AS (SELECT vec_id AS query_id, embedding FROM embeddings), {_nearest('queries', 5)}
SELECT query_id, count(*) AS num_results, max(distance) AS farthest FROM nearest GROUP BY query_id""",
)
def batch_query_passes(spark, folder):
    """Every stored vector as a query, in several passes over the vectors."""
    vectors = table(spark, folder, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    block = max(100, vectors.count() // 4)
    return (
        search_vectors(queries, vectors, 5, query_block=block)
        .groupBy("query_id")
        .agg(F.count("*").alias("num_results"), F.max("distance").alias("farthest"))
    )


@query(
    "tokenize_terms",
    f"""SELECT doc_id, term, count(*) AS n FROM
  (SELECT doc_id, {S.terms('text')} AS term FROM documents WHERE {S.valid('text')}) GROUP BY ALL""",
)
def tokenize_terms(spark, folder):
    found = tfidf.tokenize(documents(spark, folder), "doc_id", "text")
    return found.groupBy("doc_id", "term").agg(F.count("*").alias("n"))


@query(
    "vocabulary",
    f"WITH {S.TFIDF_INDEX} SELECT term, CAST(tf AS BIGINT) AS tf, df FROM vocab",
)
def vocabulary(spark, folder):
    return tfidf.vocabulary(tfidf.term_counts(documents(spark, folder)))


@query(
    "vocabulary_capped",
    f"""WITH {S.TFIDF_INDEX} SELECT term, CAST(tf AS BIGINT) AS tf, df FROM vocab
ORDER BY vocab.tf DESC, term LIMIT 5000""",
)
def vocabulary_capped(spark, folder):
    """With the cap that a caller may ask for."""
    return tfidf.vocabulary(tfidf.term_counts(documents(spark, folder)), 5000)


@query(
    "tfidf_weights",
    f"WITH {S.TFIDF_INDEX} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
)
def tfidf_weights(spark, folder):
    postings = tfidf.TfidfIndex.build(documents(spark, folder)).postings
    return postings.withColumn("weight", F.round("weight", 6))


@query(
    "tfidf_topk",
    f"WITH {S.PASSAGES}, {S.tfidf_hits('passages')} SELECT query_id, rank, doc_id, score FROM hits",
)
def tfidf_topk(spark, folder):
    index = tfidf.TfidfIndex.build(documents(spark, folder))
    return index.search(passages(spark, folder))


@query(
    "tfidf_topk_salted",
    f"WITH {S.PASSAGES}, {S.tfidf_hits('passages')} SELECT query_id, rank, doc_id, score FROM hits",
)
def tfidf_topk_salted(spark, folder):
    """The join for query tables that are too large to broadcast."""
    index = tfidf.TfidfIndex.build(documents(spark, folder))
    return index.search(passages(spark, folder), broadcast_queries=False)


@query(
    "hit_preview",
    f"""WITH {S.PASSAGES}, {S.tfidf_hits('passages')}
SELECT query_id, rank, CAST(doc_id AS VARCHAR) AS doc_id, score,
  replace(substring(text, 1, 100), chr(10), ' ') AS preview FROM hits""",
)
def hit_preview(spark, folder):
    hits = positive_hits(retrieve(passages(spark, folder), documents(spark, folder)))
    return hits.select("query_id", "rank", "doc_id", "score", preview(F.col("text")).alias("preview"))
