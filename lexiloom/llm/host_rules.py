"""Quality rules at host level.

Each document is measured and tested by rules. Failures are counted per host
and rule, and the rate of a host is shrunk towards a beta prior whose two
parameters come from the mean and spread of all hosts' rates (method of moments). A host is rejected if for some rule its shrunk rate passes an absolute
limit, or if most of its documents fail and its rate stands out: the rate less
``SURE`` posterior deviations is above what the other hosts' mean and ``APART``
of their deviations allow. The verdict is joined back to its documents.

Measures are written once to the shared folder. Only counts are shuffled for
the rates (combined before the shuffle). The join back has rejected hosts on
one side only and a handful of numbers per document on the other, so a host
with a third of all rows is split by the engine's skew handling or broadcast.

Cases: null and empty texts have no words and fail; a null host is a host of
its own; repeated rows count each; no rows give no rows; with one host, or equal
rates, the prior is that of the mean with a weight of one document; with one host
only the absolute limit counts; a rate equal to a limit (a tie) passes. Columns beyond those asked for are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import as_bytes
from lexiloom.sources.scratch import scratch_path

MIN_WORDS = 20
#: Percent of words that lie in repeated windows.
MAX_REPEATED = 30
WINDOW = 8
#: A host goes if its shrunk failure rate for a rule is above this.
MAX_RATE = 0.9
#: It also goes above this rate if it stands out from the others by so many deviations, its own and theirs.
MOST, SURE, APART = 0.5, 2.0, 3.0
SYMBOLS = b"#*$%&|<>"

_MEASURES = "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
#: Blanks and the second to last bytes of characters.
_NO_CHARS = bytes([*b" \t\n\v\f\r", *range(0x80, 0xC0)])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that the text has at least twice.

    Sequences get exact numbers by doubling: pairs, fours, eights. ``window``
    must be a power of two.
    """
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    size, different = 1, len(number)
    while size < window:
        if different == len(ids):
            return 0
        _, ids, n = np.unique(
            ids[:-size] * (different + 1) + ids[size:], return_inverse=True, return_counts=True
        )
        size, different = size * 2, len(n)
    if different == len(ids):
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(n[ids] > 1)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measures(text: Column) -> Column:
    """The five measures of each text."""

    @F.arrow_udf(_MEASURES)
    def run(texts: pa.Array) -> pa.Array:
        columns: list[list[int]] = [[], [], [], [], []]
        for data in as_bytes(texts):
            words = data.split()
            values = (
                len(words),
                len(data.translate(None, _NO_CHARS)),
                len(data.translate(None, _NOT_SYMBOLS)),
                duplicate_lines(data),
                repeated_words(words),
            )
            for column, value in zip(columns, values):
                column.append(value)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run.asNondeterministic()(text)


def rules(m: Column) -> dict[str, Column]:
    """Whether a measured document fails each rule. The first two reject it by themselves."""
    return {
        "few_words": m["n_words"] < MIN_WORDS,
        "repeats": 100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["word_chars"],
        "same_lines": (m["n_dup_lines"] > 3) & (10 * m["n_dup_lines"] > m["n_words"]),
    }


def shrunk_rates(counts: DataFrame, host: str, n: str, failures: list[str]) -> DataFrame:
    """A row per host and rule: ``rate`` (posterior mean), ``sd``, and the ``limit`` that the other hosts set.

    The prior's mean is the mean of the hosts' rates and its weight comes from
    their variance beyond what sampling explains. The limit uses the mean and
    variance of the other hosts: sums over all less the host's own share.
    """
    sums = [F.count("*"), F.sum(1 / F.col(n))]
    for f in failures:
        rate = F.col(f) / F.col(n)
        sums += [F.sum(rate), F.sum(rate * rate)]
    hosts, noise, *rest = (float(v or 0) for v in counts.agg(*sums).first())  # one row: two numbers and two per rule
    rules = []
    for i, f in enumerate(failures):
        total, square = rest[2 * i : 2 * i + 2]
        mean = total / hosts if hosts else 0.0
        # A beta distribution's variance is mean * (1 - mean) / (weight + 1).
        spread = mean * (1 - mean)
        excess = square / hosts - mean * mean - spread * noise / hosts if hosts else 0.0
        weight = max(1.0, spread / excess - 1) if excess > 1e-12 else 1.0
        numbers = {"mean": mean, "weight": weight, "total": total, "square": square}
        rules.append(F.struct(F.lit(f).alias("rule"), F.col(f).alias("f"), *(F.lit(v).alias(k) for k, v in numbers.items())))
    rows = counts.select(F.col(host), F.col(n).alias("n"), F.explode(F.array(*rules)).alias("r")).select(host, "n", "r.*")
    rows = rows.withColumn("rate", (F.col("f") + F.col("mean") * F.col("weight")) / (F.col("n") + F.col("weight")))
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("weight") + 1))
    if hosts < 2:
        return rows.select(host, "rule", "rate", sd.alias("sd"), F.lit(1.0).alias("limit"))
    own = F.col("f") / F.col("n")
    rows = rows.withColumn("centre", F.greatest(F.lit(0.0), (F.col("total") - own) / (hosts - 1)))
    apart = F.sqrt(F.greatest(F.lit(0.0), (F.col("square") - own * own) / (hosts - 1) - F.col("centre") * F.col("centre")))
    limit = F.greatest(F.lit(MOST), F.col("centre") + APART * apart)
    return rows.select(host, "rule", "rate", sd.alias("sd"), limit.alias("limit"))


def judge(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """``keep`` columns, the measures, ``base_failed``, ``host_rejected`` and ``kept``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "host-rules")
    docs.select(*keep, F.col(host_col).alias("__host"), measures(F.col(text_col)).alias("__m")).write.parquet(path)
    measured = spark.read.parquet(path)
    failed = rules(F.col("__m"))
    counts = measured.groupBy("__host").agg(
        F.count("*").alias("__n"), *[F.sum(c.cast("long")).alias(k) for k, c in failed.items()]
    )
    rates = shrunk_rates(counts, "__host", "__n", list(failed))
    outside = (F.col("rate") > max_rate) | (F.col("rate") - SURE * F.col("sd") > F.col("limit"))
    rejected = (
        rates.groupBy(F.col("__host").alias("__bad")).agg(F.bool_or(outside).alias("__hit")).filter("__hit")
    )
    base = failed["few_words"] | failed["repeats"]
    return (
        measured.join(rejected, F.col("__host").eqNullSafe(F.col("__bad")), "left")
        .select(
            *keep,
            "__m.*",
            base.alias("base_failed"),
            F.coalesce("__hit", F.lit(False)).alias("host_rejected"),
        )
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )
