"""Recall and precision of disguised identifiers, by kind, on planted texts."""

import random
import unicodedata

import pytest

from lexiloom.llm import pii

DIGITS = "zero one two three four five six seven eight nine".split()
WORDS = "the mill opened near river and people walked slowly past old houses until evening came".split()
DECOYS = [
    "see you @ example.com today", "Ask at booking dot com or", "we met at noon dot on time", "look at shop dot com for more",
    "two at three dot four", "one plus two is three", "call me at home @ five.thirty", "it is 4.5 at 3 dot 2", "chapter one two",
    "version 1.2.3 at 10.11", "a dot com company", "name_at_place", "his at_sign and dot_sign", "section ④ of ⑤",
]


def _card(rng):
    body = [rng.randrange(10) for _ in range(15)]
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(body)))
    return "".join(map(str, [*body, -total % 10]))


def _wide(text):
    return "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in text)


def _circled(text):
    return "".join(chr(0x24D0 + ord(c) - 97) if "a" <= c <= "z" else c for c in text)


def _hidden(text):
    return "​".join(text)


def _cyrillic(text):
    return text.translate(str.maketrans("aeopc", "аеорс"))


EMAIL = {
    "brackets": lambda e: e.replace("@", " (at) ").replace(".", " [dot] "),
    "words": lambda e: e.replace("@", " at ").replace(".", " dot "),
    "underscores": lambda e: e.replace("@", "_at_").replace(".", "_dot_"),
    "references": lambda e: e.replace("@", "&#64;").replace(".", "&#46;"),
    "wide": _wide,
    "circled": _circled,
    "hidden": _hidden,
    "cyrillic": _cyrillic,
    "gap": lambda e: e.replace("@", " @ "),
}
NUMBER = {
    "spelled": lambda n: " ".join("plus" if c == "+" else DIGITS[int(c)] for c in n),
    "wide": _wide,
    "arabic": lambda n: "".join(chr(0x0660 + int(c)) if c.isdigit() else c for c in n),
    "bold": lambda n: "".join(chr(0x1D7CE + int(c)) if c.isdigit() else c for c in n),
    "hidden": _hidden,
}


def planted(kind, rng):
    if kind == "email":
        name = "".join(rng.choice("abcdefghklmnopr") for _ in range(6))
        return f"{name}@{rng.choice(['acme', 'contoso', 'place'])}.{rng.choice(['com', 'org', 'de'])}"
    if kind == "card":
        return _card(rng)
    if kind == "phone":
        return "+" + "".join(str(rng.randrange(1, 10)) for _ in range(11))
    return ".".join(str(rng.randrange(256)) for _ in range(4))


@pytest.mark.parametrize(
    "kind, how",
    [("email", h) for h in EMAIL] + [(k, h) for k in ("card", "phone") for h in NUMBER] + [("ip", h) for h in ("wide", "arabic", "bold", "hidden")],
)
def test_recall_and_place(kind, how):
    """At least 98 of 100 are found, and none is placed outside the source of its characters."""
    rng = random.Random(f"{kind} {how}")
    caught = 0
    for _ in range(100):
        before, after = (" ".join(rng.choices(WORDS, k=6)) for _ in range(2))
        hidden = (EMAIL if kind == "email" else NUMBER)[how](planted(kind, rng))
        text = f"{before}, {hidden}, {after}."
        base, spans = pii.find(text)
        start, end = len(before) + 2, len(before) + 2 + len(hidden)
        assert all(start <= a < b <= end for _, a, b in spans), (text, spans)
        caught += (kind, start, end) in spans
    assert caught >= 98


def test_precision_on_prose():
    rng = random.Random(11)
    for _ in range(500):
        parts = [rng.choice(DECOYS) if rng.random() < 0.3 else " ".join(rng.choices(WORDS, k=5)) for _ in range(8)]
        text = ", ".join(parts) + "."
        assert pii.find(text) == ([], []), text


def test_look_alikes_are_single_ascii_characters():
    assert all(len(a) == len(b) == 1 and b.isascii() for a, b in pii._LOOK.items())
    assert pii._LOOK["Ⓙ"] == "J" and pii._LOOK["🅹"] == "J" and pii._LOOK["⑦"] == "7"
    plain = [c for c in map(chr, range(0x2460, 0x24FF)) if len(n := unicodedata.normalize("NFKC", c)) == 1 and n.isascii()]
    assert len(plain) > 60 and all(pii.normalise(c)[0].isascii() for c in plain)


def test_cases(spark):
    """Null, empty, very long and repeated texts; columns with clashing names; no rows."""
    from pyspark.sql import functions as F

    long = "some prose of words " * 100_000 + "bob (at) site [dot] com"
    rows = [(1, None, 1), (2, "", 2), (3, long, 3), (3, long, 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_email long")
    out = table.select(F.col("n_email").alias("was"), pii.identifiers(F.col("text")).alias("r")).orderBy("was").collect()
    assert [(r.was, r.r.n_email, r.r.n_added) for r in out] == [(1, 0, 0), (2, 0, 0), (3, 0, 1), (3, 0, 1)]
    assert out[2].r.spans == out[3].r.spans == f"email:{len(long) - 23}:{len(long)}"
