"""TF-IDF index and retrieval.

Texts never move: the terms of a document are counted where it lies, as a sorted
run of terms, and only (term, count) partials are shuffled for the vocabulary,
which is stored once. A vocabulary within the broadcast bound goes to the runs,
so weights and norms are computed in place; a larger one is joined, and then the
postings move, without text. The vocabulary holds every term unless a cap is
asked for. Ids must be unique and not null.

A search brings the queries to the postings. Each task goes through its documents
in blocks, knows the largest weight of every asked term in a block, and keeps the
best ``k`` per query: terms that together cannot lift a document above the
query's k-th score are only looked up for documents that other terms found, and
blocks that cannot reach it are skipped. What is shuffled is ``k`` rows per query
and task. Query tables beyond the bound take several passes, a block of queries
each, over postings stored by term for some documents at a time: a task joins such
pieces to large blocks, in which a term of many documents is a row of weights. A
shuffle join with salted terms is there for callers who prefer it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.functions.binding import explode_once
from lexiloom.functions.stopwords import ENGLISH_STOP_WORDS
from lexiloom.functions.text import is_valid_text
from lexiloom.functions.tokens import terms
from lexiloom.plans.sizing import BROADCAST_CHARS, chars_within, row_count_within, rows_read_at_once
from lexiloom.sources.scratch import kept, scratch_path

# Default result count and score precision.
TOP_K = 4
SCORE_DIGITS = 6
# Postings of one term that one task should meet in the salted join.
POSTINGS_PER_SALT = 200_000
# Directories a stored index spreads its terms over.
TERM_BUCKETS = 64
# Terms and characters of a vocabulary that is brought to the documents.
VOCABULARY_TERMS, VOCABULARY_CHARS = 500_000, 8_000_000
# Postings that a task searches at once; a document's postings stay together. After the first blocks, which give
# each query a k-th score, a block is so many times larger.
BLOCK, FIRST_BLOCKS, GROWTH = 1 << 16, 3, 32
# Stored postings that a task joins to a block.
JOINED = 1 << 21
# Rows of stored postings, of about ``BLOCK`` each, that are read from a file at once.
ROWS_AT_ONCE = 8
# Documents for which weak terms are looked up one by one.
_LOOKED_UP = 32
# A term of more than a document in so many has a row of weights in a block.
_DENSE = 8
# Documents of which the best one is compared for a first k-th score.
_STRIDE = 64
_SLACK = 10.0**-SCORE_DIGITS


def _bucket() -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(TERM_BUCKETS)).cast("int")


def tokenize(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term)``, one row per occurrence; blank and null texts have none."""
    return explode_once(df, [id_col], terms(F.col(text_col)), "term")


def term_runs(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Array of (term, tf) of a text, sorted by term, without stop words."""
    return word_runs(terms(text), stop_words)


def word_runs(words: Column, stop_words: Sequence[str] = ()) -> Column:
    """Array of (term, tf) of an array of words, sorted by term, without stop words."""
    unwanted = pa.array(sorted(set(stop_words)), pa.string())

    @F.arrow_udf("array<struct<term: string, tf: bigint>>")
    def count(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), sizes)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        order = pc.sort_indices(words)
        place = np.empty(len(words), dtype=np.int64)
        place[order.to_numpy()] = np.arange(len(words))
        at = place[coded.indices.to_numpy()]
        words = words.take(order)
        wanted = ~pc.is_in(words, value_set=unwanted).to_numpy(zero_copy_only=False)
        keep = wanted[at] if len(words) else np.zeros(0, dtype=bool)
        pairs, tf = np.unique(row[keep] * max(1, len(words)) + at[keep], return_counts=True)
        found, term = np.divmod(pairs, max(1, len(words)))
        offsets = np.searchsorted(found, np.arange(len(lists) + 1)).astype(np.int32)
        runs = pa.StructArray.from_arrays([words.take(pa.array(term)), pa.array(tf)], names=["term", "tf"])
        return pa.ListArray.from_arrays(pa.array(offsets), runs)

    return count(words)


def term_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """``(id, term, tf)`` without stop words, where the documents lie."""
    runs = explode_once(docs, [id_col], term_runs(F.col(text_col), stop_words), "run")
    return runs.select(id_col, "run.term", "run.tf")


def vocabulary(counts: DataFrame, max_terms: int | None = None) -> DataFrame:
    """Every term with its occurrences and document frequency.

    ``max_terms`` keeps the most frequent ones by occurrences; ties by term.
    """
    found = counts.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    if max_terms is None:
        return found
    return found.orderBy(F.desc("tf"), "term").limit(max_terms)


def inverse_frequency(df: Column, n: Column) -> Column:
    """Smoothed inverse document frequency."""
    return F.log((1 + n) / (1 + df)) + 1


def with_idf(vocab: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Vocabulary plus ``idf``; documents without a term count as documents."""
    n = docs.filter(is_valid_text(F.col(text_col))).agg(F.count("*").alias("n")).scalar()
    return vocab.withColumn("idf", inverse_frequency(F.col("df"), n))


def weigh(counts: DataFrame, vocab_idf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, term, weight)`` with unit-length rows; terms out of the vocabulary drop out.

    The join for vocabularies of any size: postings move to their terms and back to their documents.
    """
    raw = _raw(counts, vocab_idf, id_col)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("raw") / norm).alias("weight"))


def _raw(counts: DataFrame, vocab_idf: DataFrame, id_col: str) -> DataFrame:
    """``(id, term, raw)``: weights before rows get unit length."""
    known = counts.join(vocab_idf.select("term", "idf"), "term")
    return known.select(id_col, "term", (F.col("tf") * F.col("idf")).alias("raw"))


class _Weigher:
    """Weights of term runs by a vocabulary that every task holds."""

    def __init__(self, spark: SparkSession, vocab_idf: DataFrame):
        held = vocab_idf.select("term", "idf").toArrow().combine_chunks()
        columns = [pa.concat_arrays(held.column(c).chunks) if held.num_rows else None for c in ("term", "idf")]
        self.shared = spark.sparkContext.broadcast(columns)

    def __call__(self, runs: Column) -> Column:
        shared = self.shared

        @F.arrow_udf("array<struct<term: string, weight: double>>")
        def weights(lists: pa.Array) -> pa.Array:
            known, idf = shared.value
            flat = lists.flatten()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists)), sizes)
            if known is None:
                known, idf = pa.array([], pa.string()), pa.array([], pa.float64())
            coded = flat.field("term").dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=known)
            value = pc.fill_null(idf.take(place), math.nan).to_numpy(zero_copy_only=False)
            at = coded.indices.to_numpy()
            raw = flat.field("tf").to_numpy() * (value[at] if len(value) else 0.0)
            keep = ~np.isnan(raw)
            row, raw = row[keep], raw[keep]
            norm = np.sqrt(np.bincount(row, weights=raw * raw, minlength=len(lists)))
            offsets = np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)
            term = flat.field("term").filter(pa.array(keep))
            out = pa.StructArray.from_arrays([term, pa.array(raw / norm[row])], names=["term", "weight"])
            return pa.ListArray.from_arrays(pa.array(offsets), out)

        return weights(runs)


def _fits(vocab: DataFrame) -> bool:
    row = vocab.agg(F.count("*").alias("n"), F.sum(F.length("term")).alias("chars")).first()
    return row.n <= VOCABULARY_TERMS and (row.chars or 0) <= VOCABULARY_CHARS


def weighted(
    docs: DataFrame, vocab_idf: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str], in_place: bool
) -> DataFrame:
    """``(id, term, weight)`` of documents; with ``in_place`` nothing is shuffled."""
    if not in_place:
        return weigh(term_counts(docs, id_col, text_col, stop_words), vocab_idf, id_col)
    weigher = _Weigher(docs.sparkSession, vocab_idf)
    runs = docs.select(id_col, term_runs(F.col(text_col), stop_words).alias("runs"))
    rows = explode_once(runs, [id_col], weigher(F.col("runs")), "run")
    return rows.select(id_col, "run.term", "run.weight")


class _Asked:
    """Weighted queries by term, for a search through blocks of postings."""

    def __init__(self, asked: pa.Table, k: int):
        self.ids = pc.unique(asked.column("query_id").combine_chunks())
        query = pc.index_in(asked.column("query_id"), value_set=self.ids).to_numpy()
        self.terms = pc.unique(asked.column("term").combine_chunks())
        term = pc.index_in(asked.column("term"), value_set=self.terms).to_numpy()
        weight = asked.column("query_weight").to_numpy()
        order = np.argsort(query, kind="stable")
        self.query, self.term, self.weight = query[order], term[order], weight[order]
        self.edges = np.searchsorted(query[order], np.arange(len(self.ids) + 1))
        self.k = k

    def fresh(self) -> list[list]:
        """Best (score, document) per query, none yet."""
        return [[] for _ in range(len(self.ids))]

    def look(self, best: list[list], ids: list, term: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> None:
        """Go through a block: document ``ids``, and postings (term, document, weight)."""
        order = np.lexsort((doc, term))
        term, doc, weight = _summed_up(term[order], doc[order], weight[order])
        edges = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.search(best, ids, _Block(len(ids), edges, doc, weight))

    def search(self, best: list[list], ids: list, block: _Block) -> None:
        """Go through a block of postings by term."""
        bounds = self.weight * block.largest[self.term]
        # Terms of each query, weak ones first: as long as their bounds sum up to less than the k-th score, they find nothing.
        up = np.lexsort((bounds, self.query))
        up = up[bounds[up] > 0]
        query, term, factor = self.query[up], self.term[up], self.weight[up]
        edges = np.searchsorted(query, np.arange(len(self.ids) + 1))
        summed = np.concatenate(([0.0], np.cumsum(bounds[up])))
        leasts = np.array([hits[-1][0] - _SLACK if len(hits) >= self.k else 0.0 for hits in best])
        before = summed[edges[:-1]]
        totals = summed[edges[1:]] - before
        weak = (summed[1:] - before[query] < leasts[query]).astype(np.int64)
        firsts = edges[:-1] + np.bincount(query, weights=weak, minlength=len(self.ids)).astype(np.int64)
        rests = summed[firsts] - before
        terms_, factors = term.tolist(), factor.tolist()
        for q in np.flatnonzero((totals > 0) & (totals >= leasts)).tolist():
            least, rest, a, first, b = leasts[q], rests[q], edges[q], firsts[q], edges[q + 1]
            score = block.scores(terms_[first:b], factors[first:b])
            if first > a:
                able = np.flatnonzero(score >= least - rest - 1e-12)
                if len(able) > _LOOKED_UP:
                    # So many documents are left that going through the weak terms costs less.
                    score += block.scores(terms_[a:first], factors[a:first])
                else:
                    for t, f in zip(terms_[a:first], factors[a:first]):
                        score[able] += f * block.of(t, able)
            else:
                able = np.flatnonzero(score >= (least if least > 0 else block.first(score, self.k)))
            if not len(able):
                continue
            found, some = best[q], score[able]
            if len(able) > 4 * self.k:
                cut = some >= np.partition(some, len(some) - self.k)[len(some) - self.k] - _SLACK
                able, some = able[cut], some[cut]
            exact = np.round(some, SCORE_DIGITS)
            good = (exact >= least) & (some > 0)
            able, exact = able[good], exact[good]
            if not len(able):
                continue
            if len(able) > self.k:
                cut = np.partition(exact, len(exact) - self.k)[len(exact) - self.k]
                able, exact = able[exact >= cut], exact[exact >= cut]
            found += [(x, ids[d]) for x, d in zip(exact.tolist(), able.tolist())]
            found.sort(key=lambda hit: (-hit[0], hit[1]))
            del found[self.k :]


class _Block:
    """Postings of some documents by term; within a term by document."""

    def __init__(self, docs: int, edges: np.ndarray, doc: np.ndarray, weight: np.ndarray):
        self.docs, self.doc, self.weight = docs, doc, weight
        sizes = np.diff(edges)
        used = np.flatnonzero(sizes)
        self.largest = np.zeros(len(sizes))
        if len(used):
            self.largest[used] = np.maximum.reduceat(weight, edges[used])
        self.edges = edges.tolist()
        self.many = set(np.flatnonzero(sizes * _DENSE > docs).tolist())
        self.rows: dict[int, np.ndarray] = {}
        # Scores end with documents that do not exist, for whole strides.
        self.length = -(-docs // _STRIDE) * _STRIDE
        self.spare = np.empty(self.length)

    def row(self, term: int) -> np.ndarray:
        """Weights of a term in all documents."""
        if term not in self.rows:
            a, b = self.edges[term], self.edges[term + 1]
            row = self.rows[term] = np.zeros(self.length)
            row[self.doc[a:b]] = self.weight[a:b]
        return self.rows[term]

    def scores(self, terms_: list[int], factors: list[float]) -> np.ndarray:
        """Sums of the weights of terms times their factors."""
        few = [(self.edges[t], self.edges[t + 1], f) for t, f in zip(terms_, factors) if t not in self.many]
        if few:
            doc = np.concatenate([self.doc[a:b] for a, b, _ in few])
            weight = np.concatenate([self.weight[a:b] for a, b, _ in few])
            weight *= np.repeat([f for _, _, f in few], [b - a for a, b, _ in few])
            score = np.bincount(doc, weight, self.length)
        else:
            score = np.zeros(self.length)
        if len(few) < len(terms_):
            for t, f in zip(terms_, factors):
                if t in self.many:
                    np.multiply(self.row(t), f, out=self.spare)
                    score += self.spare
        return score

    def of(self, term: int, docs: np.ndarray) -> np.ndarray:
        """Weights of a term in some documents."""
        if term in self.many:
            return self.row(term)[docs]
        a, b = self.edges[term], self.edges[term + 1]
        own = self.doc[a:b]
        at = np.minimum(np.searchsorted(own, docs), b - a - 1)
        return np.where(own[at] == docs, self.weight[a:b][at], 0.0)

    def first(self, score: np.ndarray, k: int) -> float:
        """What each of the ``k`` best scores reaches at least, if they are positive."""
        tops = score.reshape(-1, _STRIDE).max(axis=1)
        least = np.partition(tops, len(tops) - k)[len(tops) - k] - _SLACK if len(tops) >= k else 0.0
        return max(least, np.nextafter(0.0, 1.0))


class TfidfIndex:
    """Vocabulary and postings of a corpus, lazily planned or read back from disk."""

    def __init__(
        self,
        vocab: DataFrame,
        postings: DataFrame,
        id_col: str = "doc_id",
        stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
        max_terms: int | None = None,
        placed: bool = False,
        raw: DataFrame | None = None,
    ):
        self.vocab = vocab
        self.postings = postings
        self.id_col = id_col
        self.stop_words = tuple(stop_words)
        self.max_terms = max_terms
        # Whether the postings still carry the partitioning by document.
        self.placed = placed
        # Postings before rows get unit length, if those are joined.
        self.raw = raw

    @classmethod
    def build(
        cls,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
        max_terms: int | None = None,
    ) -> TfidfIndex:
        """Count the vocabulary and plan the postings, which a search or a write computes."""
        counts = term_counts(docs, id_col, text_col, stop_words)
        # Read several times below, and of a size that decides how weights are computed.
        vocab = kept(with_idf(vocabulary(counts, max_terms), docs, text_col), "vocabulary")
        fits = _fits(vocab)
        postings = weighted(docs, vocab, id_col, text_col, stop_words, fits)
        raw = None if fits else _raw(counts, vocab, id_col)
        return cls(vocab, postings, id_col, stop_words, max_terms, placed=True, raw=raw)

    def write(self, path: str) -> None:
        """Store both tables for later searches.

        Postings lie in buckets of terms, so a search opens only the buckets of
        the terms it asks for. Rows are ranged on bucket, term and id: a term
        with very many postings is split over several files.
        """
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
        (
            self.postings.withColumn("bucket", _bucket())
            .repartitionByRange("bucket", "term", self.id_col)
            .sortWithinPartitions("bucket", "term", self.id_col)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{path}/postings")
        )

    @classmethod
    def read(
        cls,
        spark: SparkSession,
        path: str,
        id_col: str = "doc_id",
        stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
        max_terms: int | None = None,
    ) -> TfidfIndex:
        """Open a stored index; the stop words and cap must be those it was built with."""
        return cls(
            spark.read.parquet(f"{path}/vocabulary"),
            spark.read.parquet(f"{path}/postings"),
            id_col,
            stop_words,
            max_terms,
        )

    def query_weights(self, queries: DataFrame, query_id: str, query_text: str) -> DataFrame:
        counts = term_counts(queries, query_id, query_text, self.stop_words)
        return weigh(counts, self.vocab, query_id).withColumnRenamed("weight", "query_weight")

    def search(
        self,
        queries: DataFrame,
        k: int = TOP_K,
        query_id: str = "query_id",
        query_text: str = "query",
        broadcast_queries: bool | None = None,
    ) -> DataFrame:
        """``(query_id, rank, doc_id, score)``: best ``k`` by cosine, only scores above 0.

        Blank queries have no terms and so no hits. Scores are rounded before
        ranking and ties go to the smaller id, so results do not depend on the
        order of summation. ``broadcast_queries=False`` asks for the salted join;
        otherwise queries beyond the bound go through the postings block by block.
        """
        if broadcast_queries is False:
            scored = self._score_salted(self.query_weights(queries, query_id, query_text), query_id)
        elif chars_within(queries, query_text):
            scored = self._best(self._asked(queries, query_id, query_text), queries.schema[query_id].dataType, k)
        else:
            return self._in_passes(queries, k, query_id, query_text)
        return _ranked(scored, k)

    def _asked(self, queries: DataFrame, query_id: str, query_text: str) -> pa.Table:
        """Weights of a bounded set of queries."""
        asked = self.query_weights(queries, query_id, query_text)
        return asked.select(F.col(query_id).alias("query_id"), "term", "query_weight").toArrow()

    def _in_passes(self, queries: DataFrame, k: int, query_id: str, query_text: str) -> DataFrame:
        """One block of queries after another; what each finds is stored.

        Weights of queries and postings are computed once, before the passes. Ids with the
        same texts (told by 128 bits) are asked once, as the least of them.
        """
        spark = queries.sparkSession
        queries = kept(queries.select(query_id, query_text), "queries")
        hashes = [F.sum(F.xxhash64(F.lit(seed), query_text).cast("decimal(38,0)")) for seed in (0, 1)]
        same = [F.count(query_text).alias("n"), hashes[0].alias("a"), hashes[1].alias("b")]
        texts = queries.filter(F.col(query_text).isNotNull()).groupBy(F.col(query_id).alias("query_id")).agg(*same)
        texts = kept(texts, "asked")
        first = kept(texts.groupBy("n", "a", "b").agg(F.min("query_id").alias("first")), "first")
        once = queries.join(first, F.col(query_id).eqNullSafe(F.col("first")), "left_semi")
        chars = once.agg(F.sum(F.length(query_text).cast("long"))).first()[0] or 0
        # Blocks by hash of the id differ a little in size; half a block to spare.
        blocks = max(1, math.ceil(1.5 * chars / BROADCAST_CHARS))
        weights = kept(self.query_weights(once, query_id, query_text), "query-weights")
        weights = weights.select(F.col(query_id).alias("query_id"), "term", "query_weight")
        path, block = scratch_path(spark, "hits"), F.pmod(F.xxhash64("query_id"), F.lit(blocks))
        packed = kept(self._packed(), "postings")
        for b in range(blocks):
            asked = weights.filter(block == b).toArrow()
            with rows_read_at_once(spark, ROWS_AT_ONCE):
                self._best(asked, queries.schema[query_id].dataType, k, packed).write.mode("append").parquet(path)
        hits = _ranked(spark.read.parquet(path), k).withColumnRenamed("query_id", "first")
        members = texts.join(first, ["n", "a", "b"]).select("query_id", "first")
        found = hits.withColumnRenamed("first", "f").join(members, F.col("f").eqNullSafe(F.col("first")))
        return found.select("query_id", "rank", "doc_id", "score")

    def _placed(self) -> DataFrame:
        """Postings with those of a document together."""
        if self.placed:
            return self.postings
        return self.postings.repartition(F.col(self.id_col)).sortWithinPartitions(self.id_col)

    def _packed(self) -> DataFrame:
        """A row for some documents: their ids, and postings by term, so that files may be read in any pieces."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _whole_documents(batches, 1):
                ids, new = _documents(table)
                coded = table.column(1).combine_chunks().dictionary_encode()
                term = coded.indices.to_numpy()
                order = np.argsort(term, kind="stable")
                doc, weight = (np.cumsum(new) - 1)[order], table.column(2).to_numpy()[order]
                term, doc, weight = _summed_up(term[order], doc, weight)
                counts = np.bincount(term, minlength=len(coded.dictionary))
                row = [ids, coded.dictionary, pa.array(counts.astype(np.int32)), pa.array(doc.astype(np.int32)), pa.array(weight)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in row]
                yield pa.RecordBatch.from_arrays(lists, names=["ids", "terms", "counts", "docs", "weights"])

        kind = self.postings.schema[self.id_col].dataType.simpleString()
        rows = self._placed().select(self.id_col, "term", "weight")
        lists = f"ids array<{kind}>, terms array<string>, counts array<int>, docs array<int>, weights array<double>"
        return rows.mapInArrow(pack, lists)

    def _best(self, asked: pa.Table, query_type, k: int, packed: DataFrame | None = None) -> DataFrame:
        """``(query_id, doc_id, score)``, at most ``k`` rows of a query from each task."""
        postings = self.postings
        spark = postings.sparkSession
        if packed is not None:
            return self._searched(packed, asked, query_type, k, _joined_blocks)
        wanted = spark.createDataFrame(pa.table({"term": pc.unique(asked.column("term").combine_chunks())}))
        if self.placed:
            postings = postings.join(F.broadcast(wanted), "term", "left_semi")
        else:
            # Postings of asked terms move to their documents, not once per query.
            keys = ["term"]
            if "bucket" in postings.columns:
                wanted, keys = wanted.withColumn("bucket", _bucket()), ["bucket", "term"]
            postings = postings.join(F.broadcast(wanted), keys, "left_semi").repartition(F.col(self.id_col))
            postings = postings.sortWithinPartitions(self.id_col)
        return self._searched(postings.select(self.id_col, "term", "weight"), asked, query_type, k)

    def _searched(self, rows: DataFrame, asked: pa.Table, query_type, k: int, read=None) -> DataFrame:
        """Search ``rows``: postings, or what ``read`` turns into blocks."""
        shared = rows.sparkSession.sparkContext.broadcast(_Asked(asked, k))
        id_type = self.postings.schema[self.id_col].dataType
        read = read or _blocks

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = shared.value
            best, kind = asked.fresh(), None
            for ids, block in read(batches, asked.terms):
                kind = ids.type
                asked.search(best, ids.to_pylist(), block)
            held = [(q, *hit) for q, hits in enumerate(best) for hit in hits]
            if held:
                query, score, name = zip(*held)
                columns = [asked.ids.take(pa.array(query)), pa.array(name, kind), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "doc_id", "score"])

        schema = f"query_id {query_type.simpleString()}, doc_id {id_type.simpleString()}, score double"
        return rows.mapInArrow(search, schema)

    def _summed(self, pairs: DataFrame, query_id: str) -> DataFrame:
        dot = F.sum(F.col("query_weight") * F.col("weight"))
        summed = pairs.groupBy(
            F.col(query_id).alias("query_id"), F.col(self.id_col).alias("doc_id")
        ).agg(dot.alias("dot"))
        score = F.round("dot", SCORE_DIGITS).alias("score")
        return summed.filter("dot > 0").select("query_id", "doc_id", score)

    def _asked_postings(self, asked: DataFrame) -> DataFrame:
        """Postings of asked terms; of the others no more than their part of the norms moves."""
        wanted = asked.select("term").distinct()
        if row_count_within(wanted, VOCABULARY_TERMS) is not None:
            wanted = F.broadcast(wanted)
        if self.raw is None:
            return self.postings.join(wanted, "term", "left_semi")
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")
        norms = self.raw.groupBy(F.col(self.id_col).alias("__id")).agg(norm)
        some = self.raw.join(wanted, "term", "left_semi")
        some = some.join(norms, F.col(self.id_col).eqNullSafe(F.col("__id")))
        return some.select(self.id_col, "term", (F.col("raw") / F.col("norm")).alias("weight"))

    def _score_salted(self, asked: DataFrame, query_id: str) -> DataFrame:
        asked = kept(asked, "query-weights")
        salts = F.ceil(F.col("df") / POSTINGS_PER_SALT).cast("int")
        spread = self.vocab.select("term", salts.alias("salts"))
        left = self._asked_postings(asked).join(spread, "term").withColumn(
            "salt", F.pmod(F.xxhash64(self.id_col), F.col("salts")).cast("int")
        )
        right = asked.join(spread, "term").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        )
        return self._summed(left.join(right.drop("salts"), ["term", "salt"]), query_id)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every query, with their rank."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "doc_id", "score")


def _documents(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """Ids of the documents in a table of postings, and where the postings of each begin."""
    ids = table.column(0).combine_chunks()
    same = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
    new = np.concatenate(([True], ~same))
    return ids.filter(pa.array(new)), new


def _summed_up(term: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted postings; rows of one document that repeat a term are added."""
    fresh = np.concatenate(([True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])))[: len(term)]
    if fresh.all():
        return term, doc, weight
    starts = np.flatnonzero(fresh)
    return term[starts], doc[starts], np.add.reduceat(weight, starts)


def _blocks(batches: Iterator[pa.RecordBatch], terms_: pa.Array) -> Iterator[tuple[pa.Array, _Block]]:
    """Ids of documents, and their postings of some terms, from postings by document."""
    for table in _whole_documents(batches):
        ids, new = _documents(table)
        doc = np.cumsum(new) - 1
        place = pc.index_in(table.column(1).combine_chunks(), value_set=terms_)
        wanted = place.is_valid().to_numpy(zero_copy_only=False)
        term, doc, weight = place.drop_null().to_numpy(), doc[wanted], table.column(2).to_numpy()[wanted]
        order = np.lexsort((doc, term))
        term, doc, weight = _summed_up(term[order], doc[order], weight[order])
        yield ids, _Block(len(ids), np.searchsorted(term, np.arange(len(terms_) + 1)), doc, weight)


def _joined_blocks(batches: Iterator[pa.RecordBatch], terms_: pa.Array) -> Iterator[tuple[pa.Array, _Block]]:
    """The same from stored rows, those of about ``JOINED`` postings at once."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        for i in range(batch.num_rows):
            held.append(batch.slice(i, 1))
            rows += len(batch.column(3)[i].values)
            if rows >= JOINED:
                yield _joined(held, terms_)
                held, rows = [], 0
    if held:
        yield _joined(held, terms_)


def _joined(rows: list[pa.RecordBatch], terms_: pa.Array) -> tuple[pa.Array, _Block]:
    """Stored rows as one block, of some terms."""
    ids, words, counts, doc, weight = (pa.concat_arrays([r.column(c).flatten() for r in rows]) for c in range(5))
    counts = counts.to_numpy().astype(np.int64)
    docs, runs = (np.array([len(r.column(c).flatten()) for r in rows]) for c in (0, 1))
    # A run of postings for each term and row.
    offset = np.repeat(np.cumsum(docs) - docs, runs)
    start = np.cumsum(counts) - counts
    place = pc.fill_null(pc.index_in(words, value_set=terms_), -1).to_numpy()
    known = np.flatnonzero(place >= 0)
    known = known[np.argsort(place[known], kind="stable")]
    size = counts[known]
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[known] - ends + size, size)
    sizes = np.bincount(place[known], weights=size, minlength=len(terms_)).astype(np.int64)
    doc = doc.to_numpy()[at] + np.repeat(offset[known], size)
    return ids, _Block(len(ids), np.concatenate(([0], np.cumsum(sizes))), doc, weight.to_numpy()[at])


def _whole_documents(batches: Iterator[pa.RecordBatch], growth: int = GROWTH) -> Iterator[pa.Table]:
    """Postings in tables of about ``BLOCK`` rows, after the first ones ``growth`` times that, cut between documents."""
    held: list[pa.RecordBatch] = []
    rows, block, done = 0, BLOCK, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= block:
            table = pa.Table.from_batches(held)
            ids = table.column(0).combine_chunks()
            same = pc.equal(ids, ids[-1]).to_numpy(zero_copy_only=False)
            cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield table.slice(0, cut)
                done += 1
                block = BLOCK * (growth if done >= FIRST_BLOCKS else 1)
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)
