"""Language detection against a word profile learnt from labelled text.

A profile holds the words of each language with a log weight over a common floor.
In scripts that put no space between words, the characters and pairs of
neighbouring characters stand for words. A text scores the sum of the weights of
its words; the best language wins, equal scores go to the first name, and a text
with no profiled word is ``unknown``. Null and empty texts have no words.

Characters and pairs are met as numbers, where they are counted or looked up; only
those of a profile are written as text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.functions.binding import explode_once, let
from lexiloom.operators.tfidf import word_runs
from lexiloom.plans.sizing import BROADCAST_ROWS
from lexiloom.sources.scratch import kept

# Fixed value: what invalid or undecidable text is labelled.
UNKNOWN = "unknown"
# Scripts written without spaces between words.
UNSPACED_SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")
_UNSPACED = "".join(rf"\p{{Is{name}}}" for name in UNSPACED_SCRIPTS)
WORD = rf"[\p{{L}}&&[^{_UNSPACED}]]+"
CHARACTER = f"[{_UNSPACED}]"
PAIR = f"(?=({CHARACTER}{{2}}))"
FLOOR = 1e-6
DIGITS = 6
# Scores are sums of whole numbers of these parts, the same in any order.
_PARTS = 10**DIGITS
# Steps of a weight of one, by which words are divided into those held and the others.
_STEPS = 64
# Texts x languages that a task scores at once.
_CELLS = 1 << 20
# Texts x words of a profile that are counted as a table, for each word met.
_SPARSE = 4
# Code points, and bits of one.
_POINTS, _BITS = 0x110000, 21


def words(text: Column) -> Column:
    """Lower-cased runs of letters; characters and pairs of them where a script has no spaces."""

    def found(lowered: Column) -> Column:
        spaced, single, pairs = (
            F.regexp_extract_all(lowered, F.lit(pattern), F.lit(group))
            for pattern, group in ((WORD, 0), (CHARACTER, 0), (PAIR, 1))
        )
        return F.when(lowered.rlike(CHARACTER), F.concat(spaced, single, pairs)).otherwise(spaced)

    return let(F.lower(text), found)


def _parts_of(text: Column) -> Column:
    """What ``words`` are made of: ``spaced`` words, and the lower-cased ``text`` if it has characters that stand for words."""

    def found(lowered: Column) -> Column:
        spaced = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
        return F.struct(spaced.alias("spaced"), F.when(lowered.rlike(CHARACTER), lowered).alias("text"))

    return let(F.lower(text), found)


@cache
def _characters() -> np.ndarray:
    """For every code point, whether Spark's expressions find it in the scripts without spaces."""
    spark, step = SparkSession.active(), 1 << 12
    points = [p for p in range(_POINTS) if not 0xD800 <= p < 0xE000]
    rows = [("".join(map(chr, points[at : at + step])),) for at in range(0, len(points), step)]
    left = spark.createDataFrame(rows, "t string").select(F.regexp_replace("t", f"[^{_UNSPACED}]+", ""))
    marks = np.zeros(_POINTS, dtype=bool)
    for (found,) in left.collect():
        marks[[ord(c) for c in found]] = True
    return marks


def _numbers(texts: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters and pairs of neighbours in scripts without spaces: the text of each, and its number."""
    texts = pc.fill_null(texts, "")
    row = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    known = marks[points]
    pairs = np.flatnonzero(known[:-1] & known[1:] & (row[:-1] == row[1:]))
    number = np.concatenate((points[known], (points[pairs] << _BITS) | points[pairs + 1]))
    return np.concatenate((row[known], row[pairs])), number


def _number(word: str, marks: np.ndarray) -> int:
    """The number of a character or pair of a script without spaces; below 0 for other words."""
    if len(word) > 2 or not all(marks[ord(c)] for c in word):
        return -1
    return ord(word) if len(word) == 1 else ord(word[0]) << _BITS | ord(word[1]) if word else -1


def _written(number: int) -> str:
    first, last = divmod(number, 1 << _BITS)
    return chr(first) + chr(last) if first else chr(last)


def _counts(marks):
    """Batches of (language, parts of a text) to counts of the words of each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = marks.value
        for batch in batches:
            parts = batch.column(1)
            lists = parts.field("spaced")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            coded, names = lists.flatten().dictionary_encode(), batch.column(0).dictionary_encode()
            language = names.indices.to_numpy()
            row, number = _numbers(parts.field("text"), marked)
            numbers, place = np.unique(number, return_inverse=True)
            found = [
                (np.repeat(language, sizes), coded.indices.to_numpy(), coded.dictionary),
                (language[row], place, pa.array([_written(n) for n in numbers.tolist()], pa.string())),
            ]
            for of, at, texts in found:
                cells, n = np.unique(of.astype(np.int64) * max(1, len(texts)) + at, return_counts=True)
                of, at = np.divmod(cells, max(1, len(texts)))
                columns = [names.dictionary.take(pa.array(of)), texts.take(pa.array(at)), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["language", "word", "n"])

    return count


def language_profile(
    labelled: DataFrame,
    text_col: str = "text",
    language_col: str = "lang",
    words_per_language: int | None = None,
) -> DataFrame:
    """``(language, word, weight)`` for the words of each language.

    ``words_per_language`` keeps the most frequent ones; ties by word.
    """
    known = labelled.filter(F.col(language_col).isNotNull())
    texts = known.select(F.col(language_col).cast("string").alias("language"), _parts_of(F.col(text_col)).alias("parts"))
    marks = labelled.sparkSession.sparkContext.broadcast(_characters())
    met = texts.mapInArrow(_counts(marks), "language string, word string, n bigint")
    counts = met.groupBy("language", "word").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    top = counts
    if words_per_language is not None:
        best = Window.partitionBy("language").orderBy(F.desc("n"), "word")
        top = counts.withColumn("place", F.row_number().over(best)).filter(
            F.col("place") <= words_per_language
        )
    weight = F.log(1 + F.col("n") / F.col("total") / FLOOR)
    return top.join(totals, "language").select(
        "language", "word", F.round(weight, DIGITS).alias("weight")
    )


def with_language(
    df: DataFrame,
    profile: DataFrame,
    text_col: str = "clean_text",
    profile_bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """``df`` plus ``language``, which depends on the text alone.

    A profile within the bound of rows goes to every task and rows are scored
    where they are, without a shuffle. Of a larger one the words of most weight
    go there; a text whose best language the other words cannot overtake is
    decided. Only the texts left are joined with the whole profile, by their
    words. All ways give the same rows.
    """
    profile = kept(profile.select("language", "word", "weight"), "profile")
    spark, parts = df.sparkSession, _parts_of(F.col(text_col))
    if profile.limit(profile_bound + 1).count() <= profile_bound:
        return df.withColumn("language", _classifier(spark, profile.toArrow())(parts))
    held, least = _heaviest(profile, profile_bound)
    if not held.num_rows:
        return _joined(df, profile, text_col)
    marked = kept(df.withColumn("language", _classifier(spark, held, least)(parts)), "languages")
    decided, left = marked.filter("language is not null"), marked.filter("language is null").drop("language")
    return decided.unionByName(_joined(left, profile, text_col))


def _heaviest(profile: DataFrame, bound: int) -> tuple[pa.Table, float]:
    """All rows of the words of most weight, at most ``bound``, and what any other word adds to a language at most."""
    by_word = profile.groupBy("word").agg(F.sum("weight").alias("most"), F.count("*").alias("n"))
    step = F.floor(F.col("most") * _STEPS)
    steps = by_word.groupBy(step.alias("step")).agg(F.sum("n").alias("n"), F.max("most").alias("most")).collect()
    cut, taken, least = None, 0, 0.0
    for row in sorted(steps, key=lambda r: -r["step"]):
        taken += row["n"]
        if taken > bound:
            least = row["most"]
            break
        cut = row["step"]
    words_held = by_word.filter(step >= cut if cut is not None else F.lit(False)).select("word")
    return profile.join(words_held, "word", "left_semi").select("language", "word", "weight").toArrow(), least


class _Profile:
    """The languages of each word and their weights, one word after the other.

    ``least`` is what a word that is not held adds to a language at most; without it all are held.
    """

    def __init__(self, profile: pa.Table, least: float, marks: np.ndarray):
        # Weights have DIGITS digits; their sum over a word's languages may be off by parts of the last one.
        self.least = np.ceil(least * _PARTS) + 1 if least else 0.0
        names = pc.unique(profile.column("language").combine_chunks()).sort()
        word = profile.column("word").combine_chunks()
        self.words = pc.unique(word)
        self.marks = marks
        number = np.array([_number(w, marks) for w in self.words.to_pylist()], dtype=np.int64)
        self.places = np.argsort(number, kind="stable")
        self.numbers = number[self.places]
        row = pc.index_in(word, value_set=self.words).to_numpy(zero_copy_only=False)
        order = np.argsort(row, kind="stable")
        self.edges = np.searchsorted(row[order], np.arange(len(self.words) + 1))
        language = pc.index_in(profile.column("language").combine_chunks(), value_set=names)
        self.language = language.to_numpy(zero_copy_only=False)[order]
        weight = profile.column("weight").to_numpy()[order]
        self.weight = np.rint(weight * _PARTS)
        self.labels = np.array(names.to_pylist() + [UNKNOWN], dtype=object)

    def scores(self, texts: int, text_of: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Texts x languages: sums of the weights of words, each met once in a text. All are whole numbers."""
        n, many = len(self.labels) - 1, len(self.words)
        if texts * many <= _SPARSE * len(place):
            table = np.zeros((many, n))
            table[np.repeat(np.arange(many), np.diff(self.edges)), self.language] = self.weight
            at_once = max(1, _CELLS // max(1, many))
            cuts = np.searchsorted(text_of, np.arange(0, texts + at_once, at_once))
            out = np.zeros((texts, n))
            for at, a, b in zip(range(0, texts, at_once), cuts[:-1], cuts[1:]):
                some = min(at_once, texts - at)
                met = np.bincount((text_of[a:b] - at) * many + place[a:b], minlength=some * many)
                out[at : at + some] = met.reshape(some, many).astype(np.float64) @ table
            return out
        # Every word is met once for each of its languages.
        times = self.edges[place + 1] - self.edges[place]
        ends = np.cumsum(times)
        entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.edges[place] - ends + times, times)
        cell = np.repeat(text_of, times) * n + self.language[entry]
        return np.bincount(cell, weights=self.weight[entry], minlength=texts * n).reshape(texts, n)

    def best(self, parts: pa.StructArray) -> np.ndarray:
        """The label of the parts of each text; none where words that are not held may decide."""
        n, lists = len(self.labels) - 1, parts.field("spaced")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        place = pc.index_in(lists.flatten(), value_set=self.words)
        known = pc.is_valid(place).to_numpy(zero_copy_only=False)
        text_of = np.repeat(np.arange(len(lists)), sizes)[known]
        row, number = _numbers(parts.field("text"), self.marks)
        sizes = sizes + np.bincount(row, minlength=len(lists))
        at = np.minimum(np.searchsorted(self.numbers, number), max(0, len(self.numbers) - 1))
        held = self.numbers[at] == number if len(self.numbers) else np.zeros(len(number), dtype=bool)
        place = place.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(row):
            text_of, place = np.concatenate((text_of, row[held])), np.concatenate((place, self.places[at[held]]))
            order = np.argsort(text_of, kind="stable")
            text_of, place = text_of[order], place[order]
        scores = self.scores(len(lists), text_of, place)
        if not n:
            return self.labels[np.zeros(len(lists), dtype=np.int64)]
        found = self.labels[np.where(scores.max(axis=1) > 0, scores.argmax(axis=1), n)]
        if self.least:
            others = sizes - np.bincount(text_of, minlength=len(lists))
            first = scores.max(axis=1)
            second = np.partition(scores, n - 2, axis=1)[:, n - 2] if n > 1 else np.zeros(len(lists))
            found[(others > 0) & (first - second <= others * self.least)] = None
        return found


def _classifier(spark: SparkSession, profile: pa.Table, least: float = 0.0):
    """Arrow function from the parts of a text to the best language."""
    shared = spark.sparkContext.broadcast(_Profile(profile, least, _characters()))

    @F.arrow_udf("string")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        at_once = max(1, _CELLS // max(1, len(held.labels)))
        for parts in batches:
            found = [held.best(parts.slice(at, at_once)) for at in range(0, len(parts), at_once)]
            yield pa.array(np.concatenate(found).tolist() if found else [], type=pa.string())

    return classify


def _joined(df: DataFrame, profile: DataFrame, text_col: str) -> DataFrame:
    """Texts stay where they are: words move, with their number.

    Copies of a text multiply all its scores alike, so they need not be told apart.
    """
    digest = F.substring(F.unhex(F.sha2(F.col(text_col), 256)), 1, 16)
    counted = word_runs(words(F.col(text_col)))
    met = (
        explode_once(df, [digest.alias("__text")], counted, "run")
        .select("__text", F.col("run.term").alias("word"), "run.tf")
    )
    parts = F.round(F.col("weight") * _PARTS).cast("long")
    scores = (
        met.join(profile.select("language", "word", parts.alias("parts")), "word")
        .groupBy("__text", "language")
        .agg(F.sum(F.col("parts") * F.col("tf")).alias("score"))
        .filter(F.col("score") > 0)
    )
    best = scores.groupBy("__text").agg(
        F.min(F.struct((-F.col("score")).alias("cost"), "language")).alias("best")
    )
    return (
        df.withColumn("__text", digest)
        .join(best, "__text", "left")
        .withColumn("language", F.coalesce("best.language", F.lit(UNKNOWN)))
        .drop("best", "__text")
    )
