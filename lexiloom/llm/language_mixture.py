"""Language identification by inference of a multilingual mixture.

A model holds, for each language, the probability of every hashed byte trigram
(lower-cased; ASCII other than letters and digits is a space). A document is a
mixture of languages: expectation-maximisation finds the proportions from the
trigram likelihoods, first over all languages, then over nested sets of the
strongest ones; the set with the best penalised likelihood counts.

Training sums counts in a table of fixed size per task, so what is shuffled and
collected is bounded by languages x buckets, whatever the corpus. Prediction is
row-local.

Cases: null text, or text without a letter, is ``und`` with score 0; so is
every text if nothing was learnt. Equal proportions go to the first name.
Training skips null texts and null labels; empty texts add nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import LETTERS, as_bytes, chunks, give_back

UNDETERMINED = "und"
BUCKETS = 1 << 16
#: The model is a dense table on every executor: 512 KB per language.
MAX_LANGUAGES = 500
#: Added to every count.
SMOOTHING = 0.1
#: Overlapping trigrams repeat each byte: so many count as one observation.
OVERLAP = 3.0
FIRST_STEPS, SET_STEPS = 8, 4
#: Bytes whose trigrams are worked on at once.
CHUNK = 1 << 19
#: Rows of an Arrow batch whose texts are copied at once.
ROWS = 512
#: Languages one training task counts before it hands over.
HELD = 64


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every trigram; texts are padded by spaces."""
    framed = [b" " + t.translate(LETTERS) + b" " for t in texts]
    data = np.frombuffer(b"".join(framed), dtype=np.uint8).astype(np.uint32)
    of = np.repeat(np.arange(len(framed)), [len(t) for t in framed])
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    blank = (data == 32)
    within = (of[:-2] == of[2:]) & ~(blank[:-2] & blank[1:-1]) & ~(blank[1:-1] & blank[2:])
    hashed = (code * np.uint32(2654435761)) >> np.uint32(16)
    return hashed[within], of[:-2][within]


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, bucket, n)`` over all labelled texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                b = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(b), "bucket": b, "n": n[b]})
            held.clear()

        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            langs = batch.column(0).to_pylist()
            texts = as_bytes(batch.column(1))
            for lang in sorted(set(langs)):
                if lang not in held and len(held) >= HELD:
                    yield from out()
                own = [t for t, x in zip(texts, langs) if x == lang]
                total = held.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for a, b in chunks(own, 4 * CHUNK):
                    total += np.bincount(_trigrams(own[a:b])[0], minlength=BUCKETS)
        yield from out()

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return (
        labelled.filter("lang is not null and text is not null")
        .mapInArrow(count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


@dataclass
class MixtureModel:
    """Trigram probabilities (buckets x languages) of the named languages."""

    names: list[str]
    chance: np.ndarray

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> MixtureModel:
        """Learn from all rows with a text and a label."""
        found = trigram_counts(docs, text_col, lang_col).limit(MAX_LANGUAGES * BUCKETS + 1).toArrow()
        langs = found.column("lang").to_pylist()
        names = sorted(set(langs))
        if len(names) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        counts = np.full((BUCKETS, len(names)), SMOOTHING)
        place = {name: i for i, name in enumerate(names)}
        counts[found.column("bucket").to_numpy(), [place[x] for x in langs]] += found.column("n").to_numpy()
        return cls(names, (counts / counts.sum(axis=0)).astype(np.float32))

    def mixtures(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the chosen languages, and log-likelihood per trigram over a flat model's."""
        shares = np.zeros((len(texts), len(self.names)))
        gain = np.zeros(len(texts))
        for a, b in chunks(texts, CHUNK):
            shares[a:b], gain[a:b] = self._infer(texts[a:b])
        return shares, gain

    def _infer(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        n_texts, n_langs = len(texts), len(self.names)
        bucket, of = _trigrams(texts)
        key, times = np.unique(of.astype(np.uint64) << np.uint64(16) | bucket, return_counts=True)
        own = (key >> np.uint64(16)).astype(np.int64)
        likely = self.chance[(key & np.uint64(0xFFFF)).astype(np.int64)]
        total = np.bincount(own, weights=times, minlength=n_texts)
        there = total > 0
        if not len(own):
            return np.zeros((n_texts, n_langs)), np.zeros(n_texts)
        starts = np.searchsorted(own, np.flatnonzero(there))

        def step(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """One round of expectation and maximisation; the log-likelihood before it."""
            joint = likely * share[own]
            sums = np.maximum(joint.sum(axis=1), 1e-30)
            new = np.zeros_like(share)
            new[there] = np.add.reduceat(joint * (times / sums)[:, None], starts)
            new[there] /= total[there, None]
            return new, np.bincount(own, weights=times * np.log(sums), minlength=n_texts)

        share = np.full((n_texts, n_langs), 1 / n_langs, dtype=np.float32)
        for _ in range(FIRST_STEPS):
            share = step(share)[0].astype(np.float32)
        order = np.argsort(-share, axis=1, kind="stable")
        rank = np.argsort(order, axis=1, kind="stable")
        best, value, fit = np.zeros_like(share), np.full(n_texts, -np.inf), np.zeros(n_texts)
        growing = there
        for k in range(1, n_langs + 1):
            tried = np.where(rank < k, share + 1e-6, 0)
            tried = (tried / tried.sum(axis=1, keepdims=True)).astype(np.float32)
            for _ in range(SET_STEPS if k > 1 else 0):
                tried = step(tried)[0].astype(np.float32)
            loglik = step(tried)[1]
            penalised = loglik / OVERLAP - 0.5 * (k - 1) * np.log(np.maximum(total, 2))
            # A text's set grows as long as it gains by it, whatever the texts beside it do.
            growing = growing & (penalised > value)
            best[growing], value[growing], fit[growing] = tried[growing], penalised[growing], loglik[growing]
            if not growing.any():
                break
        flat = -np.log(BUCKETS)
        return best, np.where(there, fit / np.maximum(total, 1) - flat, 0)


def with_language(docs: DataFrame, model: MixtureModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` plus a struct: ``lang_pred``, its proportion ``score``, all proportions, ``gain``.

    ``gain`` is the log-likelihood per trigram above that of a model under which
    all trigrams are alike: below 0, no learnt language explains the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, shares: map<string, double>, gain: double>")
    def detect(column: pa.Array) -> pa.Array:
        model, rows = shared.value, []
        for first in range(0, len(column), ROWS):
            texts = column.slice(first, ROWS).to_pylist()
            lettered = [bool(t) and any(map(str.isalpha, t)) for t in texts]  # Unicode category L
            usable = [t.encode() for t, ok in zip(texts, lettered) if ok] if model.names else []
            shares, gains = model.mixtures(usable) if usable else (None, None)
            at = 0
            for ok in lettered:
                if not (ok and usable):
                    rows.append((UNDETERMINED, 0.0, [], 0.0))
                    continue
                row = shares[at]
                top = int(row.argmax())
                mix = [(model.names[i], float(row[i])) for i in np.flatnonzero(row > 0)]
                rows.append((model.names[top], min(1.0, float(row[top])), mix, float(gains[at])))
                at += 1
            give_back()
        return pa.StructArray.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.map_(pa.string(), pa.float64())),
                pa.array([r[3] for r in rows], pa.float64()),
            ],
            names=["lang_pred", "score", "shares", "gain"],
        )

    return docs.withColumn(out, detect.asNondeterministic()(F.col(text_col)))


def accepted(language: Column) -> Column:
    """Whether some learnt language explains the text."""
    return (language["lang_pred"] != UNDETERMINED) & (language["gain"] > 0)
