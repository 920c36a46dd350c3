"""Benchmark decontamination with a generalised suffix automaton.

Test items are cut into lower-cased words and built into one suffix automaton;
training words stream through it, and the length of the longest suffix that
some item contains is known at every word. Where it reaches the window, the
last ``window`` words occur in an item. An item shorter than the window is one
window of its own, found through the suffix links.

Items come in blocks of bounded size: each block makes one automaton, which is
broadcast and passes over all rows in place (no shuffle); hits of earlier
blocks travel in a column. Items longer than a block are cut into overlapping
parts, which changes no window.

Cases: null or empty texts have no words and no hits; repeated rows each get
their result; repeated items count once per id; an item with null id counts
under the empty id; no items means no hits. Other columns stay as they are.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import LETTERS, as_bytes, give_back

WINDOW = 10
#: Benchmark bytes per automaton; at most about 200 bytes of memory each.
BLOCK_BYTES = 512 << 10
#: Words of an item per part.
PART_WORDS = 20_000

_HITS = "struct<n_words: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<string>>"
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and any non-ASCII characters."""
    return text.translate(LETTERS).split()


class SuffixAutomaton:
    """All word sequences inside the items, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, tokens in items:
            last = 0
            for token in tokens:
                last = self._extend(last, token)
        self._mark(items)

    def _new(self, length: int, following: dict[bytes, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, token: bytes) -> int:
        """A copy of ``q`` for the shorter sequences that end in ``p`` and the token."""
        copy = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, token: bytes) -> int:
        q = self.next[last].get(token)
        if q is not None:  # another item has it already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, token)
        state = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, token)
        return state

    def _mark(self, items: list[tuple[str, list[bytes]]]) -> None:
        """For each state: the state of its last ``window`` words, and short items ending there."""
        self.of_window: list[int] = [-1] * len(self.next)
        self.short: dict[int, list[tuple[int, str]]] = {}
        own: dict[int, set[tuple[int, str]]] = {}
        for name, tokens in items:
            if 0 < len(tokens) < self.window:
                state = 0
                for token in tokens:
                    state = self.next[state][token]
                own.setdefault(state, set()).add((len(tokens), name))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= self.window:
                self.of_window[state] = state if self.length[up] < self.window else self.of_window[up]
            if found := [*own.get(state, ()), *self.short.get(up, ())]:
                self.short[state] = sorted(found, reverse=True)
        self.marked = [w >= 0 or s in self.short for s, w in enumerate(self.of_window)]
        self.items: dict[int, set[str]] = {}
        for name, tokens in items:
            state = 0
            for i, token in enumerate(tokens):
                state = self.next[state][token]
                if i + 1 >= self.window:
                    self.items.setdefault(self.of_window[state], set()).add(name)

    def match(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word ranges inside occurrences of windows, and the items they come from."""
        follow, link, length, marked = self.next, self.link, self.length, self.marked
        window, spans, states, found = self.window, [], set(), set()
        state = size = 0
        for i, token in enumerate(tokens):
            to = follow[state].get(token)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = follow[state].get(token)
                size = length[state]
                if to is None:
                    continue
            state = to
            size += 1
            if not marked[state]:
                continue
            longest = 0
            if size >= window:
                longest = window
                states.add(self.of_window[state])
            for n, name in self.short.get(state, ()):
                if n <= size:
                    found.add(name)
                    longest = max(longest, n)
            if longest:
                start = i + 1 - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for state in states:
            found |= self.items[state]
        return spans, found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _matcher(shared, cut: bool):
    """Arrow function from texts and earlier hits to all hits; with ``cut``, ``rest`` is a hit text without them."""
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    fields = [("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))]

    @F.arrow_udf(_HITS.replace(">>, items", ">>, rest: string, items") if cut else _HITS)
    def match(texts: pa.Array, before: pa.Array) -> pa.Array:
        automaton, rows = shared.value, []
        for text, had in zip(as_bytes(texts), before.to_pylist()):
            tokens = words(text)
            spans, items = automaton.match(tokens)
            if had:
                spans = _merged(spans + [(x["start"], x["stop"]) for x in had["spans"]])
                items |= set(had["items"])
            row = {
                "n_words": len(tokens),
                "spans": [{"start": a, "stop": b} for a, b in spans],
                "items": sorted(items),
            }
            if cut:
                row["rest"] = without_spans(text, spans).decode() if spans else None
            rows.append(row)
        kind = [*fields[:2], ("rest", pa.string()), fields[2]] if cut else fields
        out = pa.array(rows, type=pa.struct(kind))
        del rows
        give_back()
        return out

    return match.asNondeterministic()


def _parts(window: int):
    @F.arrow_udf("array<binary>")
    def parts(texts: pa.Array) -> pa.Array:
        out = []
        for text in as_bytes(texts):
            tokens = words(text)
            step = max(1, PART_WORDS - window + 1)
            last = max(1, len(tokens) - window + 1)
            out.append([b" ".join(tokens[i : i + PART_WORDS]) for i in range(0, last, step) if tokens])
        return pa.array(out, type=pa.list_(pa.binary()))

    return parts


def automata(
    items: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
):
    """Automata of the items, one block at a time."""
    pieces = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        F.explode(_parts(window)(F.col(text_col))).alias("part"),
    ).distinct()
    size = pieces.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        own = pieces.filter(F.pmod(F.xxhash64("item", "part"), F.lit(blocks)) == b).collect()
        yield SuffixAutomaton([(r["item"], bytes(r["part"]).split()) for r in own], window)


def with_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    out: str = "hits",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    cut: bool = False,
) -> DataFrame:
    """``docs`` plus ``out``: ``n_words``, hit word ranges ``spans`` (stop exclusive), ``items``.

    With ``cut``, also ``rest``: the text without them, null where there are none.
    """
    spark = docs.sparkSession
    hits: Column = F.lit(None).cast(_HITS)
    passes = 0
    for automaton in automata(items, window=window, block_bytes=block_bytes):
        match = _matcher(spark.sparkContext.broadcast(automaton), cut)
        docs = docs.withColumn(out, match(F.col(text_col), hits))
        hits = F.col(out)
        passes += 1
    if not passes:
        empty = spark.sparkContext.broadcast(SuffixAutomaton([], window))
        docs = docs.withColumn(out, _matcher(empty, cut)(F.col(text_col), hits))
    return docs


def n_hit(hits: Column) -> Column:
    """Words inside hit ranges."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the characters from the first to the last word of each range."""
    where, kept, at = [m.span() for m in _WORD.finditer(text)], [], 0
    for start, stop in spans:
        kept.append(text[at : where[start][0]])
        at = where[stop - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    max_coverage: float = 0.5,
) -> DataFrame:
    """Remove hit ranges from texts; documents with more than ``max_coverage`` of hit words go.

    Texts without hits stay as they are, null included.
    """
    hits = F.col("__hits")
    # Texts are cut where they are matched: a second function would mean a second worker for each task.
    found = with_hits(docs, items, text_col, "__hits", window, cut=True)
    kept = found.filter(n_hit(hits) <= max_coverage * hits["n_words"])
    return kept.withColumn(text_col, F.coalesce(hits["rest"], F.col(text_col))).drop("__hits")
