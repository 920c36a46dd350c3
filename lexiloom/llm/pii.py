"""Personal data behind disguises, with spans in the source text.

Transducers rewrite a text step by step: look-alike letters and digits,
characters of no width, at and dot disguises, spelled digits. Each step keeps
which source characters every piece of its output came from, so identifiers
found in the normalised text map back to ranges of the source. Identifiers of
the plain text are always kept; normalisation only adds.

Spans are ``kind:start:end`` in code points, end exclusive. Work is row-local.
Cases: null is empty text; an identifier found both ways counts once; repeated
rows each get their result; a table without rows gives none; other columns are
not touched. An at between mere blanks counts only after a word that may name a
mailbox and before a domain that ends in a known last label.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.llm.common import LETTERS, give_back

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++(?:(?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before each at sign, and its domain."""
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def detect(text: str) -> list[Span]:
    """Plain identifiers by kind, then start."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = m[0].split(".")
        if len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


class Alignment:
    """Which source range each part of a rewritten text came from.

    ``edits`` are (source start, source end, output length), in order and
    disjoint; all other characters are copied.
    """

    def __init__(self, edits: list[tuple[int, int, int]]):
        self.at, self.edits, shift = [], edits, 0
        for start, end, size in edits:
            self.at.append(start + shift)
            shift += size - (end - start)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Smallest source range with all that the output range came from."""
        return self._one(start)[0], self._one(end - 1)[1]

    def _one(self, place: int) -> tuple[int, int]:
        k = bisect.bisect_right(self.at, place) - 1
        if k < 0:
            return place, place + 1
        start, end, size = self.edits[k]
        beyond = place - self.at[k] - size
        return (start, end) if beyond < 0 else (end + beyond, end + beyond + 1)


def rewrite(text: str, pattern: re.Pattern, output: Callable[[re.Match], str | None]) -> tuple[str, Alignment | None]:
    """Replace matches; None keeps one. No alignment means nothing changed."""
    parts, edits, done = [], [], 0
    for m in pattern.finditer(text):
        new = output(m)
        if new is None or new == m[0]:
            continue
        parts += [text[done : m.start()], new]
        edits.append((m.start(), m.end(), len(new)))
        done = m.end()
    if not edits:
        return text, None
    return "".join([*parts, text[done:]]), Alignment(edits)


# Letters of other scripts that look like Latin ones, side by side.
_LOOK = dict(
    zip(
        "АВЕКМНОРСТХаеорсухіјѕԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα",
        "ABEKMHOPCTXaeopcyxijsdqwhABEZHIKMNOPTYXoa",
        strict=True,
    )
)
# Signs that stand for at, dot, hyphen, plus and space.
_LOOK |= {"\uff20": "@", "\ufe6b": "@", "\uff0e": ".", "\u3002": ".", "\u2024": ".", "\uff61": ".", "\uff0b": "+"}
_LOOK |= dict.fromkeys("\u2010\u2011\u2012\u2013\u2212", "-") | dict.fromkeys("\u00a0\u2007\u2009\u202f", " ")
_LOOK |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
# Digits of other scripts, ten in a row from each zero.
_LOOK |= {chr(zero + d): str(d) for zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
# Mathematical letters: thirteen Latin alphabets of 52 letters.
_LOOK |= {chr(0x1D400 + 52 * k + i): chr((65 if i < 26 else 71) + i) for k in range(13) for i in range(52)}
# Circled, squared, raised and other forms that Unicode takes for one ASCII letter, digit or sign.
for _block in (range(0x100, 0x3400), range(0xFB00, 0x10000), range(0x1F100, 0x1F200)):
    for _c in map(chr, _block):
        _plain = unicodedata.normalize("NFKC", _c)
        if len(_plain) == 1 and (_plain.isalnum() or _plain in "@.+-_") and _plain.isascii():
            _LOOK.setdefault(_c, _plain)
# Squared and negative circled capitals have no such form; 26 in a row from each A.
_LOOK |= {chr(first + i): chr(65 + i) for first in (0x1F150, 0x1F170) for i in range(26)}
_LOOKALIKE = re.compile("[" + "".join(map(re.escape, _LOOK)) + "]")
_NO_WIDTH = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff]+")

_B = r"[ \t]{0,3}"
_S = r"[ \t]{1,3}"
_DOT = r"(?:dot|punkt|punto|point)"
_NAME = r"[A-Za-z0-9-]{1,63}"
_BRACKET_DOT = rf"{_B}[\[({{<]{_B}(?:{_DOT}|\.){_B}[\])}}>]{_B}"
# Last labels that, after a plain word "dot", tell a domain from prose.
_LAST = "com|org|net|edu|gov|mil|info|biz|io|ai|app|dev|example|test|invalid|uk|de|fr|es|nl|eu|ca|au|jp|cn|br|mx|ch"
# An at between brackets, as a character reference, between underscores, or as a word before a domain with a dot in disguise.
_AT_SIGN = re.compile(
    rf"{_B}[\[({{<]{_B}(?:at|@|arroba){_B}[\])}}>]{_B}|&#64;|&commat;|&#x40;"
    rf"|_{{1,2}}at_{{1,2}}(?={_NAME}(?:_{{1,2}}dot_{{1,2}}{_NAME}){{1,9}})"
    rf"|{_S}(?:at|arroba){_S}(?={_NAME}(?:(?:\.|{_S}dot{_S}){_NAME})*(?:{_BRACKET_DOT}{_NAME}|{_S}dot{_S}(?:{_LAST})(?![A-Za-z0-9-])))",
    re.I,
)
_DOT_SIGN = re.compile(rf"(?<=[A-Za-z0-9])(?:{_BRACKET_DOT}|&#46;|&period;|&#x2e;|{_S}dot{_S}|_{{1,2}}dot_{{1,2}})(?=[A-Za-z0-9])", re.I)
_LOOSE_AT = re.compile(rf"(?<=[A-Za-z0-9])(?:{_S}@{_B}|{_B}@{_S})(?={_NAME}(?:\.{_NAME})*\.(?:{_LAST})(?![A-Za-z0-9-]))", re.I)
# Words that stand before an at in prose, where a gap alone does not make them a mailbox.
_PROSE = frozenset(
    "i me you he him she her it we us they them this that these those all here there now today soon one ones out up down in on off or and"
    " ask asked asks available book booked booking call came check find found get go going good hosted is look looked looking looks meet met"
    " order page pages read register see seen shop shopping site sites sold speak start stay stop store talk time times visit was were work"
    " works working".split()
)


def _at(m: re.Match) -> str | None:
    """An at in disguise; between mere blanks it needs a word that may name a mailbox."""
    if m[0].strip(" \t").lower() not in ("at", "arroba", "@"):
        return "@"
    before = m.string[max(0, m.start() - 64) : m.start()]
    word = _LAST_WORD.search(before)
    return "@" if word and word[0].lower() not in _PROSE else None


_LAST_WORD = re.compile(r"[A-Za-z0-9._%+-]+\Z")

# Digit words of the languages, zero to nine.
_SPELLED = {
    w: str(d)
    for row in (
        "zero one two three four five six seven eight nine",
        "oh one two three four five six seven eight niner",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for d, w in enumerate(row.split())
}
_WORD = "|".join(sorted(_SPELLED, key=lambda w: (-len(w), w)))
_ONE = rf"(?:{_WORD})"
# Runs of at least two digit words, or one beside a literal digit, plus or dot.
_DIGITS = re.compile(
    rf"(?<!\w)(?:plus[ -]{{1,2}})?{_ONE}(?:[ ,-]{{1,2}}{_ONE})+(?!\w)|(?<![^\W\d]){_ONE}(?=[ .-]?[0-9])|(?<=[0-9+][ -]){_ONE}(?!\w)|(?<=[.+]){_ONE}(?!\w)",
    re.I,
)
_PLUS = re.compile(r"(?<!\w)plus[ -]{1,2}(?=[0-9])", re.I)
_SPLIT = re.compile(r"[ ,-]+")


def _spelled(m: re.Match) -> str:
    words = _SPLIT.split(m[0].lower())
    return "".join("+" if w == "plus" else _SPELLED[w] for w in words)


_SPELLED_BYTES = frozenset(w.encode() for w in _SPELLED)
_DIGIT_BYTES = frozenset(b"0123456789")


def _may_look_alike(text: str, low: str) -> bool:
    """Whether a character is outside Latin-1, or one of the two rewritten ones inside."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return "\u00a0" in text or "\u00ad" in text


def _may_disguise(text: str, low: str) -> bool:
    """Whether there is a bracket, a character reference, or the word dot."""
    if "(" in text or "[" in text or "{" in text or "<" in text:
        return True
    return "&#" in text or "&c" in low or "&p" in low or " dot" in low or "\tdot" in low or "_dot" in low


def _may_spell(text: str, low: str) -> bool:
    """Whether a digit word has a neighbour that can belong to the same number.

    An identifier has four digits or more, so one of them spelled stands next
    to another digit, a digit word, a dot or a plus.
    """
    words = low.encode().translate(LETTERS).split()
    if _SPELLED_BYTES.isdisjoint(words):
        return False
    near = lambda w, end: w in _SPELLED_BYTES or w in (b"dot", b"plus") or w[end] in _DIGIT_BYTES
    for i, word in enumerate(words):
        if word in _SPELLED_BYTES:
            if (i and near(words[i - 1], -1)) or (i + 1 < len(words) and near(words[i + 1], 0)):
                return True
    return False


# Each step with a cheap test that holds wherever the step could change an identifier.
STEPS: tuple[tuple[Callable[[str, str], bool], re.Pattern, Callable[[re.Match], str | None]], ...] = (
    (_may_look_alike, _NO_WIDTH, lambda m: ""),
    (_may_look_alike, _LOOKALIKE, lambda m: _LOOK[m[0]]),
    (_may_disguise, _AT_SIGN, _at),
    (_may_disguise, _DOT_SIGN, lambda m: "."),
    (lambda text, low: "@" in text, _LOOSE_AT, _at),
    (_may_spell, _DIGITS, _spelled),
    (lambda text, low: "plus" in low, _PLUS, lambda m: "+"),
)


def normalise(text: str) -> tuple[str, list[Alignment]]:
    """Normalised text and the alignments of the steps that changed it, first to last."""
    chain: list[Alignment] = []
    low = text.lower()
    for may, pattern, output in STEPS:
        if not may(text, low):
            continue
        text, alignment = rewrite(text, pattern, output)
        if alignment:
            chain.append(alignment)
            low = text.lower()
    return text, chain


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans by kind as listed, start and end."""
    base = detect(text)
    plain, chain = normalise(text)
    if not chain:
        return base, base
    found = set(base)
    for kind, start, end in detect(plain):
        for alignment in reversed(chain):
            start, end = alignment.source(start, end)
        # A plain number is complete: a digit word after it is prose.
        if kind in ("card", "phone") and any(k == kind and a < end and start < b for k, a, b in base):
            continue
        found.add((kind, start, end))
    return base, sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def mask(text: str, spans: list[Span]) -> str:
    """Text with ``<KIND>`` for each span; overlapping spans become one, named by the first."""
    out, done, last = [], 0, -1
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(end, merged[-1][2])
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[done:start], f"<{kind.upper()}>"]
        done = end
    return "".join([*out, text[done:]])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_REPORT = "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base_sha256: string, spans: string, n_added: bigint>"


def identifiers(text: Column) -> Column:
    """Counts of plain identifiers by kind, hash of their list, all spans, number added."""

    @F.arrow_udf(_REPORT)
    def run(texts: pa.Array) -> pa.Array:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        hashes, spans, added = [], [], []
        for scalar in texts:
            base, found = find(scalar.as_py() or "")
            for kind in KINDS:
                counts[kind].append(sum(s[0] == kind for s in base))
            hashes.append(hashlib.sha256(listed(base).encode()).hexdigest())
            spans.append(listed(found))
            added.append(len(found) - len(base))
        columns = [pa.array(counts[k], pa.int64()) for k in KINDS]
        columns += [pa.array(hashes, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
        return pa.StructArray.from_arrays(
            columns, names=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
        )

    return run.asNondeterministic()(text)


def masked(text: Column) -> Column:
    """Text with every identifier replaced by its kind; null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        texts = (scalar.as_py() for scalar in texts)
        out = pa.array([None if t is None else mask(t, find(t)[1]) for t in texts], pa.string())
        give_back()
        return out

    return run(text)
