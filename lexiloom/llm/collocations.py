"""Phrase collocations of each language, counted with depth-truncated suffix trees by word prefix.

Texts are cut into pieces and words; every place in a piece starts a suffix, of
which a tree keeps the first words only. The trees are built level by level, as
far as counts make it worth while:

* Vertical partitioning. A level extends the prefixes that the level before found
  often enough. Prefixes are dealt into groups such that a group's suffixes fit a
  memory budget: counts are summed over a table of cells, and neighbouring cells
  are packed until the budget is full. A prefix beyond the budget gets groups of
  its own and is dealt by its next word, one level deeper.
* Subtrees. A task sorts its suffixes by group and prefix, merges equal ones, and
  sends each group one compact run. Whoever receives a group merges the runs into
  the group's subtree: sorted, without any other group, with leaf totals. Prefix
  counts are sums of leaves.

So one pass over the texts counts words, one pairs of frequent words, and one
triples whose two pairs are frequent; which words and pairs those are is a bit
table of bounded size, which may let more pass, never less. Words are 64-bit
hashes of language and word; the table of counted words holds the words
themselves and is checked: if a frequent word shared its hash with another one,
the next seed is taken. Scores and counts are exact.

Cases: null and empty texts have no words; a null language is ``und``; repeated
rows count as often as they are there; phrases of equal score and count are
ordered by their words; an empty table gives an empty table. Texts longer than a
slice are taken in slices, and phrases across their edges are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import LOWER, mix
from lexiloom.llm.membership import bit_table, held
from lexiloom.sources.scratch import scratch_path

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Suffixes of a group, and groups of one prefix or cells at most (beyond, groups get larger).
BUDGET, MOST_GROUPS = 1 << 20, 1 << 20
#: Cells for each group that the counts ask for.
CELLS_PER_GROUP = 16
#: Words and distinct words a task holds before it sends its runs.
HELD_WORDS, HELD_KINDS = 1 << 21, 1 << 19
#: Bytes of a text taken at once.
SLICE = 1 << 20
SEEDS = 8

_MARK = b"\n"
#: Lower-case, and all that ends a piece as a line end.
_READ = bytes(10 if b in b".,;:!?\n\v\f\r" else c for b, c in enumerate(LOWER))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def slices(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Slices of a text at ends of pieces, else at blanks, and whether the last piece goes on."""
    at = 0
    while at < len(data):
        end, open_ended = len(data), False
        if end - at > SLICE:
            cut = data.rfind(_MARK, at, at + SLICE)
            if cut <= at:
                cut, open_ended = max(data.rfind(b" ", at, at + SLICE), data.rfind(b"\t", at, at + SLICE)), True
            if cut <= at:  # a single word longer than a slice
                cuts = [c for b in (_MARK, b" ", b"\t") if (c := data.find(b, at + SLICE)) >= 0]
                cut = min(cuts, default=len(data))
                open_ended = cut < len(data) and data[cut] != 10
            end = cut
        yield data[at:end], open_ended
        at = end


def words(data: bytes) -> list[bytes]:
    """Words in order; a mark ends every piece."""
    out: list[bytes] = []
    for piece in data.split(_MARK):
        own = piece.split()
        if own:
            out += own
            out.append(_MARK)
    return out


class _Numbers(dict):
    """Number of each word, in order of first sight; 0 is the mark."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Held:
    """Words of several texts of one language: their numbers, and the hash of each number."""

    def __init__(self, lang: str, seed: int):
        self.lang, self.seed = lang.encode(), seed
        self.numbers, self.parts, self.size = _Numbers({_MARK: 0}), [], 0

    def add(self, data: bytes, open_ended: bool, before: list[bytes], depth: int) -> list[bytes]:
        """Words of a slice after ``before``, the words that its phrases begin with; returns those of the next."""
        found = words(data)
        if not found:
            return before if open_ended else []
        if open_ended:
            found.pop()
        row = before + found
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, row), np.int32, len(row)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(row)
        return _last(row, depth - 1) if open_ended else []

    def full(self) -> bool:
        return self.size >= HELD_WORDS or len(self.numbers) >= HELD_KINDS

    def hashes(self) -> np.ndarray:
        """Hash by number; that of the mark is 0 and of no word."""
        head = self.lang + b"\0"
        found = [xxhash.xxh3_64_intdigest(head + w, self.seed) or 1 for w in self.numbers]
        found[0] = 0
        return np.array(found, dtype=np.uint64)

    def counts(self) -> tuple[list[bytes], np.ndarray]:
        """Words and their occurrences."""
        n = np.bincount(np.concatenate(self.parts), minlength=len(self.numbers)) if self.parts else np.zeros(1, int)
        return list(self.numbers)[1:], n[1:]

    def suffixes(self, depth: int, shared: Frequent) -> tuple[np.ndarray, np.ndarray]:
        """Distinct suffixes (n, depth) as hashes, in which all that is shorter is frequent, and their counts."""
        hashes = self.hashes()
        row = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        n = len(row) - depth + 1
        if n <= 0:
            return np.zeros((0, depth), np.uint64), np.zeros(0, np.int64)
        able = np.ones(n, dtype=bool)
        if depth == 2:
            word_able = shared.held(hashes[:, None])
            word_able[0] = False
            for k in range(depth):
                able &= word_able[row[k : k + n]]
        else:
            inner = np.flatnonzero(np.logical_and.reduce([row[k : k + n] > 0 for k in range(depth)]))
            able[:] = False
            own = [hashes[row[k + inner]] for k in range(depth)]
            keep = np.ones(len(inner), dtype=bool)
            for k in range(2):
                keep &= shared.held(np.stack(own[k : k + depth - 1], axis=1))
            able[inner[keep]] = True
        at = np.flatnonzero(able)
        # HELD_KINDS and the words of one slice need 21 bits, so three numbers fit a word.
        packed = np.zeros(len(at), dtype=np.uint64)
        for k in range(depth):
            packed = packed << np.uint64(21) | row[at + k].astype(np.uint64)
        packed, counts = np.unique(packed, return_counts=True)
        low = np.uint64((1 << 21) - 1)
        columns = [hashes[(packed >> np.uint64(21 * (depth - 1 - k)) & low).astype(np.int64)] for k in range(depth)]
        return np.stack(columns, axis=1), counts


def _last(row: list[bytes], n: int) -> list[bytes]:
    """The last ``n`` words after the last mark."""
    out: list[bytes] = []
    for word in reversed(row):
        if len(out) == n or word == _MARK:
            break
        out.append(word)
    return out[::-1]


def path_hash(path: np.ndarray) -> np.ndarray:
    """One 64-bit value for each row of word hashes; places only, never an identity."""
    total = np.full(len(path), path.shape[1], dtype=np.uint64)
    for column in path.T:
        total = mix(total * _ODD + column)
    return total


class Frequent:
    """Bit table of prefixes that may be frequent."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def held(self, path: np.ndarray) -> np.ndarray:
        return held(self.bits, path_hash(path))


class Groups:
    """Groups of prefixes: by cell, and for prefixes beyond the budget by their next word."""

    def __init__(self, of_cell: np.ndarray, heavy: np.ndarray, first: np.ndarray, own: np.ndarray):
        self.of_cell, self.heavy, self.first, self.own = of_cell, heavy, first, own

    def of(self, path: np.ndarray) -> np.ndarray:
        """Group of every suffix, by all its words but the last."""
        places = path_hash(path[:, :-1])
        out = self.of_cell[(places & np.uint64(len(self.of_cell) - 1)).astype(np.int64)]
        if len(self.heavy):
            at = np.searchsorted(self.heavy, places).clip(max=len(self.heavy) - 1)
            alone = np.flatnonzero(self.heavy[at] == places)
            share = mix(path[alone, -1]) % self.own[at[alone]].astype(np.uint64)
            out = out.copy()
            out[alone] = self.first[at[alone]] + share.astype(np.int64)
        return out


def packed_cells(counts: np.ndarray, budget: int) -> tuple[np.ndarray, int]:
    """Group of each cell, neighbours together while they fit the budget, and the number of groups."""
    out, group, size = np.zeros(len(counts), dtype=np.int64), 0, 0
    for i, n in enumerate(counts.tolist()):
        if size and size + n > budget:
            group, size = group + 1, 0
        out[i] = group
        size += n
    return out, group + 1


def deal(prefixes: DataFrame) -> Groups:
    """Groups for prefixes (place, n); the driver holds the cells and the prefixes beyond the budget."""
    total = prefixes.agg(F.sum("n")).first()[0] or 0
    budget = max(BUDGET, total // MOST_GROUPS)
    # Fewer than total / budget, so MOST_GROUPS at most.
    heavy = prefixes.filter(F.col("n") > budget).groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    places, n = heavy.column("place").to_numpy().view(np.uint64), heavy.column("n").to_numpy()
    order = np.argsort(places)
    places, n = places[order], n[order]
    cells = 1 << max(8, int(CELLS_PER_GROUP * total // budget).bit_length())
    rest = prefixes.filter(F.col("n") <= budget)
    rows = rest.groupBy(F.expr(f"place & {cells - 1}L").alias("cell")).agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(cells, dtype=np.int64)
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    of_cell, groups = packed_cells(counts, budget)
    own = -(-n // budget) + 1
    return Groups(of_cell, places, groups + np.cumsum(own) - own, own)


def run_of(path: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted suffixes with their counts; the words before the last are kept once for each run of equals."""
    head = path[:, :-1]
    new = np.concatenate(([True], (head[1:] != head[:-1]).any(axis=1)))
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(path))).astype(np.uint32)
    sizes = np.array([len(path), len(starts), path.shape[1]], dtype=np.int64)
    parts = (sizes, lengths, counts.astype(np.uint64), head[starts], path[:, -1])
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def of_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, heads, depth = np.frombuffer(data, dtype=np.int64, count=3).tolist()
    at = 24
    lengths = np.frombuffer(data, dtype=np.uint32, count=heads, offset=at)
    at += 4 * heads
    counts = np.frombuffer(data, dtype=np.uint64, count=n, offset=at).astype(np.int64)
    at += 8 * n
    head = np.frombuffer(data, dtype=np.uint64, count=heads * (depth - 1), offset=at).reshape(heads, depth - 1)
    at += 8 * heads * (depth - 1)
    last = np.frombuffer(data, dtype=np.uint64, count=n, offset=at)
    return np.concatenate((np.repeat(head, lengths, axis=0), last[:, None]), axis=1), counts


def subtree(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Leaves (word hashes down from the root) in order, and their totals."""
    paths, counts = zip(*map(of_run, runs))
    path, count = np.concatenate(paths), np.concatenate(counts)
    order = np.lexsort(path.T[::-1])
    path, count = path[order], count[order]
    new = np.concatenate(([True], (path[1:] != path[:-1]).any(axis=1)))
    starts = np.flatnonzero(new)
    return path[starts], np.add.reduceat(count, starts)


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))


def _held(batches: Iterator[pa.RecordBatch], depth: int, seed: int) -> Iterator[Held]:
    """Texts of a task by language, whenever a language's words are enough."""
    open_: dict[str, Held] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, before = lang.as_py(), []
            for data, open_ended in slices((text.as_py() or "").encode().translate(_READ)):
                own = open_.get(lang) or open_.setdefault(lang, Held(lang, seed))
                before = own.add(data, open_ended, before, depth)
                if own.full():
                    yield open_.pop(lang)
                elif len(open_) > 64 or sum(x.size for x in open_.values()) > 2 * HELD_WORDS:
                    yield open_.pop(max(open_, key=lambda k: open_[k].size))
    yield from open_.values()


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, f"collocations-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _words(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, n, h): occurrences and hash of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _held(batches, 1, seed):
            found, n = own.counts()
            columns = [pa.array([own.lang.decode()] * len(found), pa.string()), pa.array(found, pa.binary()), pa.array(n)]
            columns.append(pa.array(own.hashes()[1:].view(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n", "h"])

    found = texts.mapInArrow(run, "lang string, word binary, n bigint, h bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.min("h").alias("h"))


def _frequent_words(texts: DataFrame, least: int) -> tuple[DataFrame, int]:
    """The counted words, and a seed by which no frequent word shares its hash."""
    for seed in range(SEEDS):
        counted = _stored(_words(texts, seed), "words")
        same = counted.groupBy("h").agg(F.count("*").alias("c"), F.max("n").alias("n"))
        if same.filter((F.col("c") > 1) & (F.col("n") >= least)).isEmpty():
            return counted, seed
    raise RuntimeError(f"frequent words share 64-bit hashes under {SEEDS} seeds")


def _level(texts: DataFrame, depth: int, prefixes: DataFrame, shorter: DataFrame, seed: int, least: int) -> DataFrame:
    """(h1, ..., n): suffixes of ``depth`` words that occur ``least`` times or more.

    ``prefixes`` (place, n) are dealt into groups; ``shorter`` (place) are the
    frequent phrases of one word less that a suffix must consist of.
    """
    context = texts.sparkSession.sparkContext
    groups = context.broadcast(deal(prefixes))
    shared = context.broadcast(Frequent(bit_table(shorter, "place")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _held(batches, depth, seed):
            path, counts = own.suffixes(depth, shared.value)
            if not len(path):
                continue
            group = groups.value.of(path)
            order = np.lexsort((*path.T[::-1], group))
            path, counts, group = path[order], counts[order], group[order]
            starts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1))
            ends = np.append(starts[1:], len(group))
            runs = [run_of(path[a:b], counts[a:b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(group[starts]), pa.array(runs, pa.binary())], names=["g", "run"])

    names = [f"h{k + 1}" for k in range(depth)]

    def build(runs: pa.Table) -> pa.Table:
        path, counts = subtree(runs.column("run").to_pylist())
        often = counts >= least
        columns = [pa.array(column[often].view(np.int64)) for column in np.ascontiguousarray(path.T)]
        return pa.table([*columns, pa.array(counts[often])], names=[*names, "n"])

    sent = texts.mapInArrow(send, "g bigint, run binary")
    schema = ", ".join(f"{name} bigint" for name in (*names, "n"))
    return _stored(sent.groupBy("g").applyInArrow(build, schema), f"level{depth}")


def _place(*names: str):
    """``path_hash`` of the columns."""

    @F.arrow_udf("bigint")
    def place(*columns: pa.Array) -> pa.Array:
        path = np.stack([c.to_numpy().view(np.uint64) for c in columns], axis=1)
        return pa.array(path_hash(path).view(np.int64))

    return place(*[F.col(name) for name in names]).alias("place")


def _score(a: str, l: str, r: str):
    """floor(1000000 a a / (l r)) in whole numbers; counts have up to 16 digits."""
    wide = [F.col(x).cast("decimal(16,0)") for x in (a, a, l, r)]
    top = (wide[0] * wide[1]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    below = (wide[2] * wide[3]).cast("decimal(32,0)")
    return F.call_function("div", top, below)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, share: int = SHARE, top: int = TOP
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language."""
    texts = _texts(docs, lang_col, text_col)
    counted, seed = _frequent_words(texts, least)
    often = counted.filter(F.col("n") >= least).select("h", "lang", F.col("word").cast("string").alias("word"), "n")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    word_places = _stored(often.select("n", _place("h")), "word-places")
    pairs = _level(texts, 2, word_places, word_places, seed, least)
    pair_places = _stored(pairs.select("n", _place("h1", "h2")), "pair-places")
    triples = _level(texts, 3, pair_places, pair_places, seed, least)

    def word(k: int) -> DataFrame:
        columns = [F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}")]
        return often.select(*columns, *([F.col("lang")] if k == 1 else []))

    # A pair goes if a triple around it occurs at least half as often.
    ends = [triples.select(F.col(a).alias("h1"), F.col(b).alias("h2"), "n") for a, b in (("h1", "h2"), ("h2", "h3"))]
    around = ends[0].unionAll(ends[1]).groupBy("h1", "h2").agg(F.max("n").alias("longer"))
    two = (
        pairs.withColumnRenamed("n", "a").join(around, ["h1", "h2"], "left")
        .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
        .join(word(1), "h1").join(word(2), "h2")
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"))
        .withColumn("score", _score("a", "l", "r"))
    )
    first = pairs.select("h1", "h2", F.col("n").alias("n12"))
    last = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("n").alias("n23"))
    three = (
        triples.withColumnRenamed("n", "a").join(first, ["h1", "h2"]).join(last, ["h2", "h3"])
        .join(word(1), "h1").join(word(2), "h2").join(word(3), "h3")
        .withColumn("s1", _score("a", "n1", "n23")).withColumn("s2", _score("a", "n12", "n3"))
    )
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(early, F.col("n1")).otherwise(F.col("n12")).alias("l"),
        F.when(early, F.col("n23")).otherwise(F.col("n3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    # One row for each language.
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), F.col("score").cast("long").alias("score"),
    )
