"""Toxicity by subword bags: vectors of character n-grams averaged into a linear softmax.

A word is the average of the vectors of its character n-grams, edges included, and
a passage of a text the average of its words; a linear softmax over the average
says whether the passage is toxic. Vectors and softmax are trained together in
numpy. A word that training never saw shares n-grams, and so vectors, with words
that it did see: misspellings and other endings are found.

A text counts as toxic as its most toxic passage: one word among thousands would
vanish in an average over a long text. Training knows labels of texts only, so
it learns from the passage that decides at the time. A logistic curve, fitted on
texts kept apart, turns the decision into a probability.

Training reads a sample of labelled texts, ``SAMPLE`` at most by the hash of
their ids, whole. A pass is one job: each of ``SHARDS`` tasks takes steps over its
texts, and the driver averages the models, which have a fixed size. Scoring is
one scan of the texts with the model folded into one number for each n-gram
bucket, since all of it is linear.

Cases: null, empty and blank texts are one passage without words, as are texts
without a letter or digit; repeated rows score alike, and in training rows of one
id are one text; null ids and null labels are not learnt from; without labelled
texts every score is 0, and with one label only, that label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import remainder
from lexiloom.sources.scratch import scratch_path

#: Labelled texts that training reads at most.
SAMPLE = 6144
#: Characters of the n-grams, edges of words included.
SIZES = (3, 4, 5, 6)
BUCKETS, WIDTH = 1 << 17, 8
#: Words of a passage; each passage starts a word after the one before.
PASSAGE = 2
#: Passes over the sample.
PASSES = 5
#: Texts that share a step, and the length of a step for each kind of parameter.
BATCH = 8
RATE, WEIGHT_RATE, BIAS_RATE = 30.0, 0.0002, 0.02
#: Files of the sample; models trained on them are averaged after each pass.
SHARDS = 4
#: One in so many sampled texts is kept for the curve.
APART = 4
LIMIT = 0.7
#: Characters taken at once, cut at a word's edge where there is one.
PIECE = 1 << 18

_SPACE = 0x20
#: Code points below 0x80 as they are read: letters in lower case, digits, and blanks for the rest.
_ASCII = np.array([ord(c) if (c := chr(i).lower()).isalnum() else _SPACE for i in range(128)], dtype=np.uint32)
_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of bounded length; words stay whole unless they are longer than a piece."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
            end = cut if cut > 0 else end
        yield text[at:end]
        at = end


class Grams:
    """Character n-grams of a piece of text, a bucket for each place and size."""

    def __init__(self, text: str):
        codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), dtype=np.uint32)
        codes = np.where(codes < 128, _ASCII[np.minimum(codes, 127)], codes)
        blank = codes == _SPACE
        # Runs of blanks shrink to one, which is both the end of a word and the start of the next.
        one = np.ones(len(codes), dtype=bool)
        np.logical_and(blank[1:], blank[:-1], out=one[1:])
        np.logical_not(one[1:], out=one[1:])
        self.codes = codes[one]
        edges = np.flatnonzero(self.codes == _SPACE)
        self.words = len(edges) - 1
        self.starts, sizes = edges[:-1], np.diff(edges)
        #: Places from one on to the end of its word, for all places but the last blank.
        self.room = np.repeat(edges[1:], sizes) - np.arange(len(self.codes) - 1)
        self.per_word = sum(np.maximum(sizes + 2 - n, 0) for n in SIZES).astype(np.float32)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets by place, and which places an n-gram starts at, for every size."""
        rolling = whole = self.codes + np.uint32(1)
        for n in range(2, max(SIZES) + 1):
            rolling = rolling[: len(whole) - n + 1] * _STEP + whole[n - 1 :]
            if n in SIZES and len(rolling):
                yield (rolling * _SPREAD) >> _SHIFT, self.room[: len(rolling)] >= n - 1

    def summed(self, of_bucket: np.ndarray) -> np.ndarray:
        """Average of a number for each bucket over the n-grams of each word."""
        if not self.words:
            return np.zeros(0, dtype=np.float32)
        total = np.zeros(len(self.room), dtype=np.float32)
        for buckets, inside in self:
            total[: len(buckets)] += of_bucket[buckets] * inside
        return np.add.reduceat(total, self.starts) / self.per_word

    def bag(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams of words a to b, and the weight of each; weights sum to 1 if there are words."""
        if a >= b:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.float32)
        at = self.starts[a]
        end = self.starts[b] if b < self.words else len(self.room)
        each = np.repeat(1 / ((b - a) * self.per_word[a:b]), np.diff(np.append(self.starts[a:b], end)))
        room, buckets, weights = self.room[at:end], [], []
        rolling = whole = self.codes[at : end + max(SIZES)] + np.uint32(1)
        for n in range(2, max(SIZES) + 1):
            rolling = rolling[: len(whole) - n + 1] * _STEP + whole[n - 1 :]
            if n in SIZES and len(rolling):
                m = min(len(rolling), len(room))
                inside = room[:m] >= n - 1
                buckets.append(((rolling[:m] * _SPREAD) >> _SHIFT)[inside])
                weights.append(each[:m][inside])
        return np.concatenate(buckets), np.concatenate(weights)


def _windows(words: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every passage; a text without words is one empty passage."""
    first = np.arange(max(1, words - PASSAGE + 1))
    return first, np.minimum(first + PASSAGE, words)


def _averages(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Average over the words of each passage; 0 for an empty one."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return (total[last] - total[first]) / np.maximum(last - first, 1)


@dataclass
class Model:
    """Vectors of the buckets, weights and bias of the softmax's second class, and the curve."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def folded(self) -> np.ndarray:
        """What an n-gram adds to the decision."""
        return (self.vectors @ self.weights).astype(np.float32)

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -500, 500)))

    @classmethod
    def new(cls, odds: float) -> Model:
        rng = np.random.default_rng(0)
        vectors = rng.normal(scale=0.1, size=(BUCKETS, WIDTH)).astype(np.float32)
        return cls(vectors, rng.normal(scale=0.5, size=WIDTH).astype(np.float32), float(np.log(odds)))

    def cells(self) -> np.ndarray:
        return np.concatenate((self.vectors.ravel(), self.weights, [self.bias])).astype(np.float32)

    @classmethod
    def of_cells(cls, cells: np.ndarray) -> Model:
        cells = cells.astype(np.float32)
        return cls(cells[: BUCKETS * WIDTH].reshape(BUCKETS, WIDTH), cells[BUCKETS * WIDTH : -1], float(cells[-1]))

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | float:
        """Model of the labelled documents, or the only label there is (0 without any)."""
        known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y is not null")
        chosen = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
        path = scratch_path(docs.sparkSession, "toxicity-sample")
        # SAMPLE rows at most: copies of an id are merged before they are shuffled.
        (
            texts.join(F.broadcast(chosen), "id")
            .groupBy("id", "y")
            .agg(F.max(F.coalesce("t", F.lit(""))).alias("t"))
            .withColumn("apart", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(APART)) == 0)
            .repartition(SHARDS, "id")
            .write.parquet(path)
        )
        sample = docs.sparkSession.read.parquet(path)
        count = {r.y: r.n for r in sample.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
        if len(count) < 2:
            return float(next(iter(count), 0))
        model = cls.new(count[1] / count[0])
        for _ in range(PASSES):
            model = _passed(sample.filter(~F.col("apart")), model)
        decided = _scored(sample.filter("apart"), model, "t", ["y"]).toArrow()  # a share of SAMPLE numbers
        model._calibrate(decided.column("decision").to_numpy(), decided.column("y").to_numpy() > 0)
        return model

    def _calibrate(self, decision: np.ndarray, truth: np.ndarray) -> None:
        """Logistic curve through the decisions; targets keep off 0 and 1 by their counts."""
        if not truth.any() or truth.all():
            return
        up, down = truth.sum(), (~truth).sum()
        target = np.where(truth, (up + 1) / (up + 2), 1 / (down + 2))
        centre, spread = decision.mean(), decision.std() + 1e-9
        x = np.stack(((decision - centre) / spread, np.ones(len(decision))), axis=1)
        line = np.array([1.0, np.log(up / down)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
            curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
            move = np.linalg.solve(curve, x.T @ (p - target) + 1e-4 * line)
            line -= move * min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
        self.slope = float(line[0] / spread)
        self.shift = float(line[1] - line[0] * centre / spread)


def _decisions(text: str, folded: np.ndarray, bias: float) -> Iterator[tuple[Grams, np.ndarray, np.ndarray, np.ndarray]]:
    """N-grams, passages and their decisions for every piece."""
    for piece in _pieces(text) if text else ("",):
        grams = Grams(piece)
        first, last = _windows(grams.words)
        yield grams, first, last, _averages(grams.summed(folded), first, last) + bias


def deciding(text: str, model: Model, folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bag of the passage that decides."""
    best = None
    for grams, first, last, decision in _decisions(text, folded, model.bias):
        k = int(decision.argmax())
        if best is None or decision[k] > best[3]:
            best = grams, first[k], last[k], decision[k]
    grams, a, b, _ = best
    return grams.bag(a, b)


def trained(model: Model, rows: list[tuple[str, int]]) -> Model:
    """The model after one pass over some texts, in batches that share a step."""
    model = Model(model.vectors.copy(), model.weights.copy(), model.bias)
    folded = model.folded()
    for at in range(0, len(rows), BATCH):
        bags, ys = [], []
        for text, y in rows[at : at + BATCH]:
            bags.append(deciding(text, model, folded))
            ys.append(y)
        sizes = [len(b) for b, _ in bags]
        text_of = np.repeat(np.arange(len(bags)), sizes)
        bucket = np.concatenate([b for b, _ in bags]).astype(np.int64)
        weight = np.concatenate([w for _, w in bags])
        decision = np.bincount(text_of, weights=folded[bucket] * weight, minlength=len(bags)) + model.bias
        off = 1 / (1 + np.exp(-np.clip(decision, -60, 60))) - np.array(ys)
        # The same buckets of several n-grams are summed before they move.
        touched, place = np.unique(bucket, return_inverse=True)
        slope = np.bincount(place, weights=off[text_of] * weight).astype(np.float32)
        of_weights = slope @ model.vectors[touched]
        model.vectors[touched] -= RATE * slope[:, None] * model.weights
        model.weights -= WEIGHT_RATE * of_weights
        model.bias -= BIAS_RATE * float(off.sum())
        folded[touched] = model.vectors[touched] @ model.weights
        if not at // BATCH % 8:
            folded = model.folded()
    return model


def _passed(sample: DataFrame, model: Model) -> Model:
    """Each file of the sample trains on its own; the models are averaged."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t, int(y > 0)) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if rows:
            cells = trained(shared.value, rows).cells() * len(rows)
            yield pa.RecordBatch.from_arrays([pa.array([cells.tobytes()], pa.binary()), pa.array([len(rows)])], names=["cells", "n"])

    total, texts = 0.0, 0
    # One row of a fixed size for each of the SHARDS files of the sample.
    for row in sample.select("t", "y").mapInArrow(run, "cells binary, n bigint").toLocalIterator():
        total, texts = total + np.frombuffer(row.cells, dtype=np.float32).astype(np.float64), texts + row.n
    shared.unpersist()
    return Model.of_cells(total / texts) if texts else model


def _scored(frame: DataFrame, model: Model, text_col: str, keep: list) -> DataFrame:
    """``keep`` and ``decision``, that of the most toxic passage."""
    shared = frame.sparkSession.sparkContext.broadcast((model.folded(), model.bias))

    @F.arrow_udf("double")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        folded, bias = shared.value
        for texts in batches:
            most = [max(d[3].max() for d in _decisions(t.as_py() or "", folded, bias)) for t in texts]
            yield pa.array(most, pa.float64())

    return frame.select(*keep, decide(F.col(text_col)).alias("decision"))


def score(docs: DataFrame, model: Model | float, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for every row."""
    ids = [F.col(id_col), held_out.alias("held_out")]
    if isinstance(model, float):
        found = docs.select(*ids, F.lit(model).alias("score"))
    else:
        at = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("decision") * model.slope + model.shift))
        found = _scored(docs, model, text_col, ids).withColumn("score", 1 / (1 + F.exp(-at))).drop("decision")
    return found.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Scores of all documents by a model of those whose crc32 modulo 3 is not 1."""
    held_out = remainder(id_col, 3) == 1
    return score(docs, Model.fit(docs, labels.filter(~held_out), id_col), held_out, id_col)
