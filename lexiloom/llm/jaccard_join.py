"""Near-duplicate join on word n-grams by prefixes under several global orders.

Two sets with Jaccard similarity t or more share a token among the first
``n - ceil(t n) + 1`` tokens of each under *any* order of all tokens. The first
order puts frequent tokens last and serves as an inverted index; a pair that
meets there must be able to reach the overlap from the place of its token, and
must share a prefix token under further, independent orders, before the whole
sets are compared.

Layout for large data:

* Sets of equal content are one class; only classes are compared.
* The first order comes from the number of documents of every token. It only
  decides how much work there is: any order gives the same result.
* Texts are never shuffled: sets are made anew where they are needed, from one
  document of a class, and a bit table of bounded size keeps other documents out.
* No posting list emits all its pairs at first. In each round every component
  in a list meets one leader of that list, so pairs grow with the postings;
  links merge components, and lists with one component left are done. Once
  pairs of different components are few for the postings left, or a round finds
  nothing new, all of them are compared, so no link is lost.
* A class has 1,024 parities of its set. Sets differ in at least as many members
  as parities, so pairs too far apart go before sets are made.
* Classes are numbered, and postings of the rounds hold numbers only; parities
  join distinct pairs, and folded to 256 the postings that make all pairs.
* Tokens are counted by their upper bits, 32 within a range, so a token takes
  four bytes; one in some 8,000 passes for shared without being so.
* Rounds are written to the shared folder, which cuts lineage.

Cases: null, empty and blank texts have no tokens, link with nothing and are
components of their own; a text with fewer words than a token is one token;
repeated rows and equal texts share a component; null ids take part but name no
component. Shingles are 64-bit hashes (pairs compare 48 bits) and classes 128-bit sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import LOWER, as_bytes, chunks, give_back, mix, small_batches, word_hashes
from lexiloom.sources.scratch import scratch_path

WORDS = 5
PERCENT = 75
#: Orders that a pair must pass besides the index's.
FURTHER_ORDERS = 2
#: Fields of the frequency table.
FIELDS = 1 << 20
#: Rounds of one leader per list, at most; pairs left over are all compared.
ROUNDS = 3
#: Pairs of different components for each posting left that are compared without a further round.
PAIRS_PER_POSTING = 4
#: Tokens that are counted together.
RANGE = 1 << 19
#: Words of 64 parities that tell the sets of a pair apart, and those they are folded to where pairs are made.
PARITIES, FOLDED = tuple(f"p{i}" for i in range(16)), tuple(f"q{i}" for i in range(4))
#: Bits of a membership table per entry, and at most.
BITS_PER_ENTRY, MAX_BITS = 16, 1 << 28

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_FIELD = np.uint64(FIELDS - 1)


class Sets:
    """Sorted distinct token hashes of several texts, one after the other."""

    def __init__(self, texts: list[bytes], n: int = WORDS):
        data = b"\n".join([t.translate(LOWER) for t in texts])
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        words, starts, _ = word_hashes(data)
        last = np.searchsorted(starts, ends)
        first = np.concatenate(([0], last[:-1])).astype(np.int64)
        runs = _runs(words, n)
        parts = []
        for a, b in zip(first.tolist(), last.tolist()):
            own = runs[a : b - n + 1] if b - a >= n else _runs(words[a:b], b - a)
            own = np.sort(own)
            parts.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) else own)
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.edges = np.concatenate(([0], np.cumsum(self.sizes)))
        self.tokens = np.concatenate(parts) if parts else words

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.tokens[self.edges[i] : self.edges[i + 1]]

    def keys(self) -> list[bytes]:
        """128 bits of each set: two sums of differently scrambled members."""
        halves = []
        for odd in _ODD[1:3]:
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.tokens ^ odd))))
            halves.append(sums[self.edges[1:]] - sums[self.edges[:-1]])
        both = np.stack(halves, axis=1).tobytes() if len(self) else b""
        return [both[16 * i : 16 * i + 16] for i in range(len(self))]

    def parities(self) -> np.ndarray:
        """Words of 64 bits for each set; a bit is the parity of the members that fall on it."""
        spots, out = mix(self.tokens ^ _ODD[0]), np.zeros((len(PARITIES), len(self)), dtype=np.uint64)
        for word in range(len(PARITIES)):
            own = (spots >> np.uint64(6)) % np.uint64(len(PARITIES)) == word
            bits = np.where(own, np.uint64(1) << (spots & np.uint64(63)), np.uint64(0))
            sums = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bits)))
            out[word] = sums[self.edges[1:]] ^ sums[self.edges[:-1]]
        return out.view(np.int64)

    def shared_firsts(self, order: Order, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Set number, token and place of the prefix tokens that other documents may have too."""
        ranks, parts = order.of(self.tokens), []
        for k, (a, b) in enumerate(zip(self.edges[:-1].tolist(), self.edges[1:].tolist())):
            first = np.argsort(ranks[a:b], kind="stable")[: prefix_size(b - a, percent)]
            places = np.flatnonzero(ranks[a:b][first] > 0)
            if len(places):
                parts.append((np.full(len(places), k), self.tokens[a:b][first[places]], places))
        if not parts:
            none = np.zeros(0, dtype=np.int64)
            return none, none.astype(np.uint64), none
        return tuple(np.concatenate(column) for column in zip(*parts))


@dataclass
class Order:
    """The index's order: tokens of one document, then rare ones, then frequent ones; ties by hash.

    ``bits`` tell which tokens several documents have, and ``steps`` hold the
    doublings of their frequency by hash field. Both have a size that is fixed
    by their limits; when they are full, more tokens pass for shared or
    frequent, which changes the order but no result. Both go by the bits of a
    token above the lowest ``dropped``, scrambled.
    """

    bits: np.ndarray
    steps: np.ndarray
    dropped: int

    def of(self, tokens: np.ndarray) -> np.ndarray:
        seen = mix(tokens >> np.uint64(self.dropped))
        return np.where(_held(self.bits, seen), self.steps[(seen & _FIELD).astype(np.int64)] + 1, 0)


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    if n <= 0 or len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = mix(total * _ODD[0] + words[i : len(words) - n + 1 + i])
    return total


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Tokens that a partner must share one of."""
    return n - -(-percent * n // 100) + 1 if n else 0


def packed(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of every token, which is what sets are compared by."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _share(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Filters under the further orders, then the exact test."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    for k in range(FURTHER_ORDERS):
        x, y = (a, b) if not k else (np.sort(mix(a ^ _ODD[3])), np.sort(mix(b ^ _ODD[3])))
        if not _share(x[: prefix_size(len(a), percent)], y[: prefix_size(len(b), percent)]):
            return False
    both = _share(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


#: Rows of an Arrow batch whose texts are copied at once.
_ROWS = 256


def _read(docs: DataFrame, id_col: str, text_col: str, wanted) -> DataFrame:
    columns = [F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")]
    if wanted is not None:
        columns.append(F.xxhash64(columns[0]).alias("h"))
    return docs.select(*columns)


def _sets_of(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[tuple[pa.Array, Sets]]:
    """Ids and sets of a few documents at a time."""
    for batch in batches:
        if wanted is not None:
            named = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(_held(wanted.value, batch.column(2).to_numpy()) | ~named))
        for at in range(0, batch.num_rows, _ROWS):
            ids, texts = batch.column(0).slice(at, _ROWS), as_bytes(batch.column(1).slice(at, _ROWS))
            for a, b in chunks(texts, 1 << 18):
                yield ids.slice(a, b - a), Sets(texts[a:b])


def _mapped(docs: DataFrame, id_col: str, text_col: str, schema: str, each, wanted=None) -> DataFrame:
    """Arrow pass over (id, text): ``each(ids, sets, state)`` gives columns for a few documents.

    ``wanted`` is a broadcast membership table of id hashes; documents out of it
    are left alone, but for those without an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for ids, sets in _sets_of(batches, wanted):
            out = each(ids, sets, state)
            if out is not None:
                yield out
        state.clear()
        give_back()

    return _read(docs, id_col, text_col, wanted).mapInArrow(run, schema)


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again."""
    path = scratch_path(frame.sparkSession, f"jaccard-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _members(docs, id_col, text_col) -> DataFrame:
    def each(ids, sets, _):
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sets.sizes), pa.array(sets.keys(), pa.binary())],
            names=["id", "n", "key"],
        )

    return _mapped(docs, id_col, text_col, "id bigint, n bigint, key binary", each)


def _order(docs, id_col, text_col, classes: DataFrame, wanted) -> Order:
    """From the number of classes of every token, counted on one document of each.

    Tasks send sorted runs of tokens to ranges of the hash. A range has ``RANGE``
    tokens or somewhat fewer, which 32 bits tell apart but for few.
    """
    total = classes.agg(F.sum("n")).first()[0] or 0
    dropped = 32 - min(32, max(0, -(-total // RANGE) - 1).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, sets in _sets_of(batches, wanted):
            held.append(sets.tokens)
            size += len(sets.tokens)
            if size >= 2 * RANGE:
                yield _token_runs(held, dropped)
                held, size = [], 0
        if size:
            yield _token_runs(held, dropped)
        held.clear()
        give_back()

    def count(runs: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(t, dtype=np.uint32) for t in runs.column("tokens").to_pylist()])
        counts = np.concatenate([np.frombuffer(c, dtype=np.uint32) for c in runs.column("counts").to_pylist()])
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order].astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1))
        n = np.add.reduceat(counts, starts)
        several = n > 1
        shared = mix(np.uint64(runs.column("at")[0].as_py() << 32) | tokens[starts[several]].astype(np.uint64))
        return pa.table({"token": shared.view(np.int64), "n": n[several]})

    sent = _read(docs, id_col, text_col, wanted).mapInArrow(send, "at bigint, tokens binary, counts binary")
    shared = _stored(sent.groupBy("at").applyInArrow(count, "token bigint, n bigint"), "tokens")
    field = F.expr(f"token & {FIELDS - 1}L").alias("at")
    rows = shared.groupBy(field).agg(F.max("n").alias("n")).toArrow()  # FIELDS rows at most
    steps = np.zeros(FIELDS, dtype=np.uint8)
    steps[rows.column("at").to_numpy()] = np.log2(rows.column("n").to_numpy()).astype(np.uint8)
    return Order(_bits(shared, "token")[0], steps, dropped)


def _token_runs(held: list[np.ndarray], dropped: int) -> pa.RecordBatch:
    """Distinct tokens without their lowest bits, and their counts, a row for each range of the hash."""
    tokens, counts = np.unique(np.concatenate(held) >> np.uint64(dropped), return_counts=True)
    at = (tokens >> np.uint64(32)).astype(np.int64)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    ends, counts = np.append(starts[1:], len(at)), counts.astype(np.uint32)
    columns = [pa.array([x[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()) for x in (tokens.astype(np.uint32), counts)]
    return pa.RecordBatch.from_arrays([pa.array(at[starts]), *columns], names=["at", "tokens", "counts"])


def _bits(hashes: DataFrame, *columns: str) -> np.ndarray:
    """Membership table of each column of 64-bit hashes, two bits a hash, built by the executors."""
    n = hashes.count()
    size = 1 << max(16, min(MAX_BITS, n * BITS_PER_ENTRY).bit_length())
    spots = [
        F.struct(F.lit(k).alias("table"), F.expr(f"{spot} & {size - 1}L").alias("s"))
        for k, column in enumerate(columns)
        for spot in (column, f"shiftright({column}, 29)")
    ]
    rows = (
        hashes.select(F.explode(F.array(*spots)).alias("at"))
        .select("at.*")
        .filter("s is not null")
        .groupBy("table", F.shiftright("s", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
        .toArrow()
    )
    tables = np.zeros((len(columns), size // 64), dtype=np.int64)
    tables[rows.column("table").to_numpy(), rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return tables.view(np.uint64)


def _held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the table."""
    signed, mask, found = hashes.view(np.int64), np.int64(len(table) * 64 - 1), None
    for spot in (signed & mask, (signed >> np.int64(29)) & mask):
        bit = (table[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1)
        found = bit if found is None else found & bit
    return found.astype(bool)


def _key_hash(keys: list[bytes]) -> np.ndarray:
    """First half of each key, as the column expression below has it."""
    return np.frombuffer(b"".join(keys), dtype=np.uint64)[::2]


def _first_half(key: str) -> Column:
    """First eight bytes of a key, little-endian, as a signed number."""
    parts = [
        F.shiftleft(F.conv(F.hex(F.substring(key, i + 1, 1)), 16, 10).cast("long"), 8 * i) for i in range(8)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.bitwiseOR(part)
    return out


def _postings(docs, id_col, text_col, classes: DataFrame, shared, wanted, percent: int) -> DataFrame:
    """(node, n, parities, its prefix tokens that other classes may have, with their places), a row for each class."""

    def postings(ids, sets, _):
        of, tokens, places = sets.shared_firsts(shared.value, percent)
        if not len(of):
            return None
        some, first = np.unique(of, return_index=True)
        offsets = pa.array(np.append(first, len(of)).astype(np.int32))
        pairs = pa.StructArray.from_arrays([pa.array(tokens.view(np.int64)), pa.array(places)], names=["token", "place"])
        columns = [sets.sizes[some], *sets.parities()[:, some]]
        return pa.RecordBatch.from_arrays(
            [pa.array(sets.keys(), pa.binary()).take(pa.array(some)), *map(pa.array, columns), pa.ListArray.from_arrays(offsets, pairs)],
            names=["key", "n", *PARITIES, "firsts"],
        )

    words = ", ".join(f"{p} bigint" for p in PARITIES)
    schema = f"key binary, n bigint, {words}, firsts array<struct<token: bigint, place: bigint>>"
    made = _mapped(docs, id_col, text_col, schema, postings, wanted).dropDuplicates(["key"])
    return made.join(classes.select("key", "node"), "key").drop("key")


def _lists(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """A row for each prefix token of a class, with its component; labels are joined once for a class."""
    return _labelled(classes.select("node", "n", "firsts"), labels).select("node", "n", "component", F.inline("firsts"))


def _gathered(postings: DataFrame) -> DataFrame:
    """Back to a row for each class; a prefix bounds the array."""
    firsts = F.collect_list(F.struct("token", "place")).alias("firsts")
    return postings.groupBy("node", "n").agg(firsts)


def _sets(docs, id_col, text_col, needed: DataFrame) -> DataFrame:
    """(key, tokens) of the classes in ``needed`` (key, id), made from the document of that id in each."""
    context = docs.sparkSession.sparkContext
    named = F.when(F.col("id").isNotNull(), F.xxhash64("id"))
    of_keys, of_ids = _bits(needed.select(_first_half("key").alias("k"), named.alias("h")), "k", "h")
    table, wanted = context.broadcast(of_keys), context.broadcast(of_ids)

    def each(ids, sets, state):
        keys = sets.keys()
        keep = np.flatnonzero(_held(table.value, _key_hash(keys)))
        done = state.setdefault("keys", set())
        rows = []
        for i in keep:
            if keys[i] not in done:  # copies within a task; others are dropped below
                if len(done) < 100_000:
                    done.add(keys[i])
                rows.append((keys[i], packed(sets[i])))
        if not rows:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
            names=["key", "tokens"],
        )

    made = _mapped(docs, id_col, text_col, "key binary, tokens binary", each, wanted)
    return made.dropDuplicates(["key"])


def _verified(docs, id_col, text_col, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The components (a, b) of the pairs of classes that link."""
    both = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = _stored(both.join(classes, "node"), "needed")
    sets = _sets(docs, id_col, text_col, needed).join(needed.select("key", "node"), "key")

    @F.arrow_udf("boolean")
    def test(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            # One pair at a time: the sets of a batch can be large.
            pairs = ((x.as_py(), y.as_py()) for x, y in zip(a, b))
            yield pa.array([linked(unpacked(x), unpacked(y), percent) for x, y in pairs], pa.bool_())
        give_back()

    # Leaders, which have many pairs, come first; then the pairs are spread by the other end.
    met = (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
        .select("ca", "cb", test.asNondeterministic()(F.col("x"), F.col("y")).alias("ok"))
    )
    return met.filter("ok").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b); a component is its least node.

    Alternating star contraction: each round hangs neighbours below the least
    one around, and the edges are written out; it ends once they are stars: no
    node hangs below two others, and none that has nodes below it hangs itself.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours move to the least of the neighbourhood.
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours move to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        edges = _stored(small, "stars")
        ends = F.array(F.struct("a", F.lit(1).alias("up")), F.struct(F.col("b").alias("a"), F.lit(0).alias("up")))
        ends = edges.select(F.explode(ends).alias("n"))
        nodes = ends.groupBy("n.a").agg(F.sum("n.up").alias("up"), F.min("n.up").alias("low"))
        if nodes.filter("up > 1 or (up = 1 and low = 0)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _labelled(frame: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return frame.withColumn("component", F.col("node"))
    found = labels.withColumnRenamed("component", "c")
    return frame.join(found, "node", "left").withColumn("component", F.coalesce("c", "node")).drop("c")


def _mixed(postings: DataFrame) -> DataFrame:
    """Postings of tokens that more than one component has."""
    several = (
        postings.groupBy("token")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x <> y")
        .select("token")
    )
    return postings.join(several, "token", "left_semi")


def _left(postings: DataFrame) -> tuple[int, int]:
    """Number of postings, and of pairs of different components within lists."""
    own = postings.groupBy("token", "component").agg(F.count("*").alias("c"))
    lists = own.groupBy("token").agg(F.sum("c").alias("n"), F.sum(F.col("c").cast("double") * F.col("c")).alias("same"))
    pairs = (F.col("n").cast("double") * F.col("n") - F.col("same")) / 2
    row = lists.agg(F.sum("n").alias("n"), F.sum(pairs).alias("pairs")).first()
    return row.n or 0, row.pairs or 0


def _met(postings: DataFrame, sketches: DataFrame, seed: int, percent: int) -> DataFrame:
    """One document of each component in a list with the list's leader."""
    # In the first round a document's place is the same in all lists, so alike documents have one leader.
    place = F.xxhash64(F.lit(seed), "node") if not seed else F.xxhash64(F.lit(seed), "token", "node")
    one = postings.groupBy("token", "component").agg(F.min(F.struct(place.alias("p"), *_WHOLE, "place")).alias("d"))
    leader = one.groupBy("token").agg(F.min("d").alias("l"))
    met = one.join(leader, "token").filter(_fits("d.n", "d.place", "l.n", "l.place", percent))
    pairs = met.filter("d.node <> l.node").select(*_ends("d", "l")).distinct()
    return _close(pairs, sketches, percent)


def _close(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets the parities do not tell apart."""
    for end in "ab":
        of_end = sketches.select(F.col("node").alias(end), F.struct("n", *PARITIES).alias(f"of_{end}"))
        pairs = pairs.join(of_end, end)
    return pairs.filter(_near("of_a", "of_b", PARITIES, percent)).drop("of_a", "of_b")


#: What a posting tells of its class.
_WHOLE = ("node", "component", "n")


def _ends(a: str, b: str) -> list[Column]:
    """Classes and components of a pair."""
    names = {"a": f"{a}.node", "b": f"{b}.node", "ca": f"{a}.component", "cb": f"{b}.component"}
    return [F.col(at).alias(name) for name, at in names.items()]


def _fits(n: str, i: str, m: str, j: str, percent: int) -> Column:
    """Whether sets of sizes n and m can link if the first token they share is at places i and j."""
    most = F.least(F.col(n) - F.col(i), F.col(m) - F.col(j))
    return (100 + percent) * most >= percent * (F.col(n) + F.col(m))


def _near(a: str, b: str, words: tuple[str, ...], percent: int) -> Column:
    """Whether the parities of two sets allow a link: every one that differs stands for a member of one set."""
    apart = sum(F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in words)
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _all_pairs(postings: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components in a list that sizes and places allow.

    Lists are matched by their distinct (size, place) first, so a long list of
    documents that cannot link makes no pairs.
    """
    folded = [reduce(Column.bitwiseXOR, map(F.col, PARITIES[i :: len(FOLDED)])).alias(q) for i, q in enumerate(FOLDED)]
    kinds = postings.select("token", "n", "place").distinct()
    other = kinds.select("token", F.col("n").alias("m"), F.col("place").alias("j"))
    able = kinds.join(other, "token").filter(_fits("n", "place", "m", "j", percent))
    whole = F.struct(*_WHOLE, *FOLDED)
    postings = postings.join(sketches.select("node", *folded), "node")
    left = postings.select("token", "n", "place", whole.alias("l")).join(able, ["token", "n", "place"])
    right = postings.select("token", F.col("n").alias("m"), F.col("place").alias("j"), whole.alias("r"))
    joined = left.join(right, ["token", "m", "j"]).filter("l.component <> r.component and l.node < r.node")
    pairs = joined.filter(_near("l", "r", FOLDED, percent)).select(*_ends("l", "r")).distinct()
    return _close(pairs, sketches, percent)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``(id_col, n_shingles, component_id)``: least id among documents reachable by links."""
    with small_batches(docs.sparkSession):
        members, classes, labels = _linked_classes(docs, id_col, text_col, percent)
    classes = _labelled(classes, labels)
    least = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    named = classes.join(least, "component").select("key", "component_id")
    out = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"]
    full = members.filter("n > 0")
    empty = members.filter("n = 0").withColumn("component_id", F.col("id"))
    return full.join(named, "key").select(*out).unionAll(empty.select(*out))


def _linked_classes(docs, id_col, text_col, percent: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Documents with their class, classes with their least id, and the component of each class that links."""
    members = _stored(_members(docs, id_col, text_col), "members")
    # Classes without tokens link with nothing, not even with each other.
    full = members.filter("n > 0")
    classes = full.groupBy("key").agg(F.min("id").alias("id"), F.max("n").alias("n"))
    classes = _stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # One document of each class is enough for counts and prefixes; a few more pass the table.
    named = classes.select(F.xxhash64("id").alias("h"))
    wanted = docs.sparkSession.sparkContext.broadcast(_bits(named, "h")[0])
    order = docs.sparkSession.sparkContext.broadcast(_order(docs, id_col, text_col, classes, wanted))
    sketches = postings = _stored(_postings(docs, id_col, text_col, classes, order, wanted, percent), "postings")
    order.unpersist()  # of the size of the index's token table
    classes = classes.drop("n")

    def links(pairs: DataFrame) -> DataFrame:
        return _stored(_verified(docs, id_col, text_col, classes, _stored(pairs, "pairs"), percent), "links")

    labels = None
    for seed in range(ROUNDS + 1):
        left = _stored(_mixed(_lists(postings, labels)), "mixed")
        n, pairs = _left(left)
        if not n:
            break
        last = seed == ROUNDS or pairs <= PAIRS_PER_POSTING * n
        found = links(_all_pairs(left, sketches, percent) if last else _met(left, sketches, seed, percent))
        fresh = not found.isEmpty()
        if not fresh and not last:
            found = links(_all_pairs(left, sketches, percent))
            last, fresh = True, not found.isEmpty()
        if fresh:
            # Stars stand for the links of earlier rounds.
            labels = connected(found if labels is None else found.unionAll(labels.toDF("a", "b")))
        if last:
            break
        postings = _stored(_gathered(left), "postings")
    return members, classes, labels


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without those whose component has a smaller id; rows of one id are one document.

    Ids decide: a bit table of the ids that go or come twice lets the other rows
    through without a shuffle. Of the rest, rows of ids that stay are joined back.
    """
    named = F.col(id_col).cast("long").alias("id")
    found = _stored(components(docs, id_col, text_col), "components")
    ids = found.filter(F.col(id_col).isNotNull()).groupBy(named).agg(
        F.min((F.col("component_id") != F.col(id_col)).cast("int")).alias("gone"), F.count("*").alias("c")
    )
    ids = _stored(ids, "ids").withColumn("h", F.xxhash64("id"))
    doubtful = _bits(ids.filter("gone = 1 or c > 1"), "h")[0]
    stays = ids.filter("gone = 0")
    flagged = stays.filter(_in_table(doubtful, "h"))
    back = _bits(flagged, "h")[0]
    hashed = F.xxhash64(F.col(id_col).cast("long"))
    marked = docs.select("*", F.when(F.col(id_col).isNotNull(), hashed).alias("__hash"))
    sure = marked.filter(F.col("__hash").isNull() | ~_in_table(doubtful, "__hash")).drop("__hash")
    rest = marked.filter(F.col("__hash").isNotNull() & _in_table(doubtful, "__hash") & _in_table(back, "__hash"))
    rest = rest.join(flagged.select(F.col("id").alias("__id")), F.col(id_col).cast("long") == F.col("__id"), "left_semi")
    return sure.unionAll(rest.drop("__hash").dropDuplicates([id_col]))


def _in_table(table: np.ndarray, column: str) -> Column:
    """Whether a hash may be in the table; null is not."""
    shared = _context().broadcast(table)

    @F.arrow_udf("boolean")
    def held(hashes: pa.Array) -> pa.Array:
        return pa.array(_held(shared.value, hashes.fill_null(0).to_numpy(zero_copy_only=False)), pa.bool_())

    return held(F.col(column))


def _context():
    return SparkSession.active().sparkContext
