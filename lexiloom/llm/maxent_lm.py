"""Hashed maximum-entropy language model with class-factored softmax.

A token's probability is that of its class given the two tokens before it, times
that of the token within its class, given the same two. Classes come from word
endings. The class softmax sums weights of hashed features: a bias, the previous
word (bigram), the word before it (skip), and both together. Within a class the
words are hashed into groups, which share a softmax with the same four kinds of
features, crossed with the group. Within a group, the maximum-entropy solution
for token features alone is the relative frequency, taken with the base model's
smoothing, so all probabilities of a context add up to one.

* Token counts, (context, class) counts and counts of every feature of a group come
  from one pass over all training texts; counters of a task are flushed when they
  are full. The contexts are hashed into a table of fixed size, which is all a
  gradient needs.
* Each training step of the classes sends the weights out, sums gradients over the
  contexts on the executors, and takes back one number per weight. The softmax of
  each class's groups is a problem of its own and is solved in one task.
* Scoring works on arrays of many documents. Tokens frequent enough for a table
  of ``HOT`` entries are looked up in place; all others are joined with the
  counts, so the vocabulary may have any size and no key is hot.

Cases: null and empty texts have one token, the end; tokens never seen in
training have count 0; with nothing to train on all counts are 0; repeated rows
each get their result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import LOWER, as_bytes, chunks, mix, word_hashes
from lexiloom.sources.scratch import scratch_path

CLASSES, PREVIOUS, SKIPPED = 32, 256, 16
CONTEXTS = PREVIOUS * SKIPPED
#: Hashed weights.
WEIGHTS = 1 << 17
STEPS = 12
#: Groups of words in a class, all of them, and hashed weights of a class for both words before and the group.
GROUPS = 32
LEAVES, BOTH = CLASSES * GROUPS, 1 << 12
#: Most steps of a class's groups, and variance of the Gaussian prior of their weights.
GROUP_STEPS, VARIANCE = 40, 0.5
#: Where the counts of (context, class), (previous, group), (skipped, group) and hashed pairs begin.
_BIGRAMS = CONTEXTS * CLASSES
_SKIPS = _BIGRAMS + PREVIOUS * LEAVES
_PAIRS = _SKIPS + SKIPPED * LEAVES
CELLS = _PAIRS + CLASSES * BOTH
#: Tokens that every executor keeps in memory, and tokens a task counts before it hands over.
HOT, HELD = 200_000, 300_000
#: The end of a text; words are never empty.
END = b""
_CHUNK = 1 << 20


def word_class(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Class 1 and up by the last two bytes of a word; the end is class 0."""
    ending = (before.astype(np.uint64) << np.uint64(8)) | last
    return (1 + mix(ending + np.uint64(1)) % np.uint64(CLASSES - 1)).astype(np.int64)


def classes_of(tokens: list[bytes]) -> np.ndarray:
    last = np.array([t[-1] if t else 0 for t in tokens], dtype=np.uint64)
    before = np.array([t[-2] if len(t) > 1 else 0 for t in tokens], dtype=np.uint64)
    return np.where([not t for t in tokens], 0, word_class(last, before))


def word_group(classes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Group of a word among those of all classes, by its class and hash."""
    return classes * GROUPS + ((hashes >> np.uint64(40)) % np.uint64(GROUPS)).astype(np.int64)


def groups_of(tokens: list[bytes]) -> np.ndarray:
    groups = classes_of(tokens) * GROUPS
    words = np.array([bool(t) for t in tokens], dtype=bool)
    groups[words] = word_group(groups[words] // GROUPS, word_hashes(b"\n".join(tokens))[0])
    return groups


def _pair(context: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Hashed feature of both words before and a group, among those of its class."""
    return (mix((context * LEAVES + group).astype(np.uint64)) % np.uint64(BOTH)).astype(np.int64)


class Tokens:
    """Words of several texts, an end after each, with class, group and context of every token."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join([t.translate(LOWER) for t in texts])
        self.words = data.split()
        hashes, starts, ends = word_hashes(data)
        last = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        self.sizes = np.diff(np.concatenate(([0], last)))  # words of each text
        self.firsts = np.concatenate(([0], last[:-1])) if len(texts) else last
        n_words, n_texts = len(hashes), len(texts)
        at = np.arange(n_words) + np.repeat(np.arange(n_texts), self.sizes)
        raw = np.frombuffer(data, dtype=np.uint8)
        self.classes = np.zeros(n_words + n_texts, dtype=np.int64)
        self.groups = np.zeros(n_words + n_texts, dtype=np.int64)
        previous = np.zeros(n_words + n_texts, dtype=np.int64)
        if n_words:
            before = np.where(ends - starts > 1, raw[np.maximum(ends - 2, 0)], 0)
            self.classes[at] = word_class(raw[ends - 1], before)
            self.groups[at] = word_group(self.classes[at], hashes)
            previous[at] = 1 + ((hashes >> np.uint64(20)) % np.uint64(PREVIOUS - 1)).astype(np.int64)
        one, two = np.zeros_like(previous), np.zeros_like(previous)
        one[1:], two[2:] = previous[:-1], self.classes[:-2] % SKIPPED
        self.starts = self.firsts + np.arange(n_texts)  # place of each text's first token
        two[self.starts] = 0
        self.contexts = one * SKIPPED + two

    def cells(self) -> np.ndarray:
        """How often each (context, class) and each feature of a group occurs."""
        previous, skipped = np.divmod(self.contexts, SKIPPED)
        found = [
            self.contexts * CLASSES + self.classes,
            _BIGRAMS + previous * LEAVES + self.groups,
            _SKIPS + skipped * LEAVES + self.groups,
            _PAIRS + self.classes * BOTH + _pair(self.contexts, self.groups),
        ]
        return np.bincount(np.concatenate(found), minlength=CELLS)


def _features() -> np.ndarray:
    """Weight numbers of the four features of every (context, class)."""
    context = np.arange(CONTEXTS)
    kinds = np.stack([np.zeros(CONTEXTS, np.int64), 1 + context // SKIPPED, 1_000 + context % SKIPPED, 10_000 + context])
    mixed = mix((kinds.T[:, None, :] * CLASSES + np.arange(CLASSES)[None, :, None]).astype(np.uint64))
    return (mixed % np.uint64(WEIGHTS)).astype(np.int64)


def class_chances(weights: np.ndarray) -> np.ndarray:
    """Probability of every class in every context."""
    scores = weights[_features()].sum(axis=2)
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def corpus_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, cell, n)``: counts of tokens (cell null) and of contexts and features (token null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        cells = np.zeros(CELLS, dtype=np.int64)

        def out() -> pa.RecordBatch:
            n = pa.array(list(seen.values()), pa.int64())
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.nulls(len(seen), pa.int64()), n], names=["token", "cell", "n"]
            )
            seen.clear()
            return batch

        for batch in batches:
            texts = as_bytes(batch.column(0))
            for a, b in chunks(texts, _CHUNK):
                tokens = Tokens(texts[a:b])
                seen.update(tokens.words)
                seen[END] += b - a
                cells += tokens.cells()
                if len(seen) > HELD:
                    yield out()
        yield out()
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(at), pa.binary()), pa.array(at), pa.array(cells[at])], names=["token", "cell", "n"]
        )

    rows = docs.select(text_col).mapInArrow(run, "token binary, cell bigint, n bigint")
    return rows.groupBy("token", "cell").agg(F.sum("n").alias("n"))


def train(cells: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights of the class softmax from ``(cell, n)``, by gradients summed on the executors."""
    context = F.expr(f"cell div {CLASSES}").alias("context")
    spark = cells.sparkSession
    path = scratch_path(spark, "maxent-contexts")
    by_context = cells.groupBy(context).agg(F.collect_list(F.struct(F.expr(f"cell % {CLASSES}").alias("c"), "n")).alias("seen"))
    by_context.write.parquet(path)  # CONTEXTS rows of CLASSES pairs at most
    stored, weights = spark.read.parquet(path), np.zeros(WEIGHTS)
    for _ in range(steps):
        sent = spark.sparkContext.broadcast(weights)

        def gradient(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            features, chances = _features(), class_chances(sent.value)
            seen, expected = np.zeros(WEIGHTS), np.zeros(WEIGHTS)
            for batch in batches:
                for at, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    n = np.zeros(CLASSES)
                    for pair in pairs:
                        n[pair["c"]] = pair["n"]
                    for k in range(features.shape[2]):
                        np.add.at(seen, features[at, :, k], n)
                        np.add.at(expected, features[at, :, k], n.sum() * chances[at])
            used = np.flatnonzero(expected)
            yield pa.RecordBatch.from_pydict({"w": used, "seen": seen[used], "expected": expected[used]})

        found = stored.mapInArrow(gradient, "w bigint, seen double, expected double")
        rows = found.groupBy("w").agg(F.sum("seen").alias("seen"), F.sum("expected").alias("expected")).toArrow()
        seen, expected = rows.column("seen").to_numpy(), rows.column("expected").to_numpy()
        # Each gradient is scaled by how often its weight was used; counts near 0 say little.
        weights = weights.copy()
        weights[rows.column("w").to_numpy()] += np.clip((seen - expected) / (0.5 * (seen + expected) + 5), -1, 1) / 2
        sent.unpersist()
    return weights


def group_chances(of: int, contexts: np.ndarray, bigrams: np.ndarray, skips: np.ndarray, pairs: np.ndarray):
    """Probability of every group of a class in every context, and the mean log10 likelihood of each step.

    From how often the class occurs in each context, and each feature of its groups: penalised
    likelihood, by scaled gradients. A step that lowers it is taken back and tried at half its length.
    """
    at = np.arange(CONTEXTS)
    hashed = _pair(at[:, None], of * GROUPS + np.arange(GROUPS)[None, :])
    seen = [bigrams.sum(axis=0), bigrams, skips, pairs]
    weights, total = [np.zeros(x.shape) for x in seen], max(1, int(contexts.sum()))
    best, kept, reached, rate, move = -np.inf, None, [], 0.5, None
    for _ in range(GROUP_STEPS):
        bias, one, two, both = weights
        scores = bias + one[at // SKIPPED] + two[at % SKIPPED] + both[hashed]
        top = scores.max(axis=1, keepdims=True)
        chances = np.exp(scores - top)
        sums = chances.sum(axis=1, keepdims=True)
        chances /= sums
        fit = sum(float((n * w).sum()) for n, w in zip(seen, weights)) - float(contexts @ (top + np.log(sums))[:, 0])
        aim = fit - sum(float((w * w).sum()) for w in weights) / (2 * VARIANCE)
        if aim < best:
            rate /= 2
            weights = [w + rate * m for w, m in zip(kept[0], move)]
            continue
        done = aim - best < 1e-6 * total
        best, kept = aim, (weights, chances)
        reached.append(fit / total / float(np.log(10)))
        if done:
            break
        share = (contexts[:, None] * chances).reshape(PREVIOUS, SKIPPED, GROUPS)
        shared = np.bincount(hashed.ravel(), weights=share.ravel(), minlength=BOTH)
        expected = [share.sum(axis=(0, 1)), share.sum(axis=1), share.sum(axis=0), shared]
        move = [
            np.clip((n - e - w / VARIANCE) / (0.5 * (n + e) + 1 / VARIANCE), -1, 1)
            for n, e, w in zip(seen, expected, weights)
        ]
        weights = [w + rate * m for w, m in zip(weights, move)]
    return kept[1], reached


def train_groups(cells: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log10 probability of every group given its class in every context, and mean log10 likelihoods of each class.

    Each class is solved in one task, from a number of counts that does not depend on the corpus.
    """

    def solve(table: pa.Table) -> pa.Table:
        of, cell, n = table.column("k")[0].as_py(), table.column("cell").to_numpy(), table.column("n").to_numpy()
        dense = np.zeros(CELLS, dtype=np.int64)
        dense[cell] = n
        own = slice(of * GROUPS, of * GROUPS + GROUPS)
        chances, reached = group_chances(
            of,
            dense[:_BIGRAMS].reshape(CONTEXTS, CLASSES)[:, of],
            dense[_BIGRAMS:_SKIPS].reshape(PREVIOUS, LEAVES)[:, own],
            dense[_SKIPS:_PAIRS].reshape(SKIPPED, LEAVES)[:, own],
            dense[_PAIRS:].reshape(CLASSES, BOTH)[of],
        )
        held = np.log10(chances).astype(np.float32).tobytes()
        return pa.table({"k": pa.array([of], pa.int64()), "held": [held], "first": [reached[0]], "last": [reached[-1]]})

    of = F.expr(
        f"CASE WHEN cell < {_BIGRAMS} THEN cell % {CLASSES} WHEN cell < {_PAIRS} THEN"
        f" (cell - {_BIGRAMS}) % {LEAVES} div {GROUPS} ELSE (cell - {_PAIRS}) div {BOTH} END"
    )
    words_only = cells.select(of.cast("long").alias("k"), "cell", "n").filter("k > 0")
    solved = words_only.groupBy("k").applyInArrow(solve, "k bigint, held binary, first double, last double").toArrow()
    # A class that was never met has nothing to tell its groups apart by; an end has one group.
    held = np.full((CONTEXTS, CLASSES, GROUPS), -np.log10(GROUPS), dtype=np.float32)
    held[:, 0] = 0
    fit = np.zeros((CLASSES, 2))
    for k, table, first, last in zip(*(solved.column(c).to_pylist() for c in ("k", "held", "first", "last"))):
        held[:, k], fit[k] = np.frombuffer(table, dtype=np.float32).reshape(CONTEXTS, GROUPS), (first, last)
    return held.reshape(CONTEXTS, LEAVES), fit


@dataclass
class Model:
    """What scoring needs in memory, and the counts of all tokens as a table."""

    log_class: np.ndarray
    log_group: np.ndarray
    hot: dict[bytes, int]
    limit: int
    counts: DataFrame
    total: int
    distinct: int
    group_size: np.ndarray
    #: Mean log10 likelihood of a word's group given its class, before the first and after the last step.
    group_fit: np.ndarray

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text", steps: int = STEPS) -> Model:
        spark = docs.sparkSession
        path = scratch_path(spark, "maxent-counts")
        corpus_counts(docs, text_col).write.parquet(path)
        stored = spark.read.parquet(path)
        counts = stored.filter("token is not null").select("token", F.col("n").alias("c"))
        cells = stored.filter("cell is not null").select("cell", "n")
        weights = train(cells.filter(F.col("cell") < _BIGRAMS), steps)
        log_group, group_fit = train_groups(cells)

        def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            size, kinds = np.zeros(LEAVES, dtype=np.int64), np.zeros(LEAVES, dtype=np.int64)
            for batch in batches:
                of = groups_of(batch.column(0).to_pylist()) if batch.num_rows else np.zeros(0, np.int64)
                np.add.at(size, of, batch.column(1).to_numpy())
                kinds += np.bincount(of, minlength=LEAVES)
            yield pa.RecordBatch.from_pydict({"k": np.arange(LEAVES), "size": size, "kinds": kinds})

        sums = counts.mapInArrow(by_group, "k bigint, size bigint, kinds bigint")
        sums = sums.groupBy("k").agg(F.sum("size"), F.sum("kinds")).collect()
        size, kinds = np.zeros(LEAVES, dtype=np.int64), np.zeros(LEAVES, dtype=np.int64)
        for k, a, b in sums:
            size[k], kinds[k] = a, b
        # The least count for which the frequent tokens still fit in memory.
        steps_of = counts.groupBy(F.floor(F.log2("c") * 8).alias("s")).agg(F.count("*").alias("t"), F.min("c").alias("c"))
        limit, held = None, 0
        for row in sorted(steps_of.collect(), key=lambda r: -r["s"]):
            held += row["t"]
            if held > HOT:
                break
            limit = row["c"]
        limit = limit if limit is not None else 1 << 62
        rows = counts.filter(F.col("c") >= limit).toArrow()  # HOT rows at most
        hot = dict(zip(rows.column("token").to_pylist(), rows.column("c").to_pylist()))
        return cls(
            np.log10(class_chances(weights)), log_group, hot, limit, counts.filter(F.col("c") < limit),
            int(size.sum()), int(kinds.sum()), size + kinds, group_fit,
        )


_PARTS = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, counted double, context double,"
    " sizes double, rare array<binary>, times array<bigint>"
)


def score(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and the model's ``score``."""
    spark = docs.sparkSession
    held = (model.log_class, model.log_group, model.hot, np.log10(model.group_size + 1))
    shared = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_class, log_group, hot, log_size = shared.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for a, b in chunks(texts, _CHUNK):
                tokens = Tokens(texts[a:b])
                chances = log_class[tokens.contexts, tokens.classes] + log_group[tokens.contexts, tokens.groups]
                context = np.add.reduceat(chances, tokens.starts)
                sizes = np.add.reduceat(log_size[tokens.groups], tokens.starts)
                known, counted, rare, times = [], [], [], []
                end = hot.get(END, 0)
                for first, n in zip(tokens.firsts.tolist(), tokens.sizes.tolist()):
                    own = tokens.words[first : first + n]
                    found = [hot.get(w, 0) for w in own]
                    counts = np.array([*found, end])
                    known.append(int((counts > 0).sum()))
                    counted.append(float(np.log10(counts + 1).sum()))
                    left = Counter(w for w, c in zip(own, found) if not c)
                    if END not in hot:
                        left[END] += 1
                    rare.append(list(left))
                    times.append(list(left.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + b - a)),
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(tokens.sizes + 1),
                        pa.array(known, pa.int64()),
                        pa.array(counted, pa.float64()),
                        pa.array(context, pa.float64()),
                        pa.array(sizes, pa.float64()),
                        pa.array(rare, pa.list_(pa.binary())),
                        pa.array(times, pa.list_(pa.int64())),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "counted", "context", "sizes", "rare", "times"],
                )
                row += b - a

    path = scratch_path(spark, "maxent-parts")
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    wanted.mapInArrow(run, _PARTS).write.parquet(path)
    parts = spark.read.parquet(path)
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("token"), F.col("x.times").alias("k")
    )
    looked_up = (
        rare.join(model.counts, "token")
        .groupBy("row")
        .agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("rest"))
    )
    counted = F.col("counted") + F.coalesce("rest", F.lit(0.0))
    per_token = float(np.log10(model.total + model.distinct + 1))
    return parts.drop("rare", "times").join(looked_up, "row", "left").select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("context") + counted - F.col("sizes")).alias("score"),
    )
