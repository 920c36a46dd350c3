"""Row-local operators against brute force, the public library and planted cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import bpe, decontamination, host_rules, licences, main_text, pii
from lexiloom.llm.queries import vocabulary_path

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """The base definitions word by word."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_plain_identifiers_equal_the_definitions():
    rng = random.Random(1)
    pieces = ["a", "b.c", "@", "@@", ".", "-", "+", " ", "12", "1.2.3.4", "300", "4111 1111-11111111", "+1 (017) 555-7713", "_", "é", "x@y.z", "0" * 20]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert pii.detect(text) == plain_spans(text), text


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("to john (at) site [dot] com now", "email", "john (at) site [dot] com"),
        ("to john dot doe at site dot com!", "email", "john dot doe at site dot com"),
        ("ｊｏ＠ｓｉｔｅ．ｃｏｍ x", "email", "ｊｏ＠ｓｉｔｅ．ｃｏｍ"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("a​b@c​d.com", "email", "a​b@c​d.com"),
        ("call plus four four two zero seven nine four six zero nine five eight", "phone", None),
        ("ip one nine two dot one six eight dot one dot two.", "ip", None),
        ("no four one one one one one one one one one one one one one one one", "card", None),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, source):
    base, found = pii.find(text)
    assert base == [] and len(found) == 1 and found[0][0] == kind
    if source:
        assert text[found[0][1] : found[0][2]] == source
    assert f"<{kind.upper()}>" in pii.mask(text, found)


def test_clean_prose_has_no_identifiers():
    for text in ("the end at the dot of one", "one two, look at the shop. Go at noon", "a+b at 3.5 of 12-13", ""):
        assert pii.find(text) == ([], [])


def test_prose_after_a_plain_number_stays_outside():
    assert pii.find("+1 (848) 555-1373 Un an oule") == ([("phone", 0, 17)], [("phone", 0, 17)])


def test_pii_columns(spark):
    rows = [(1, "a x@y.com", "k"), (1, "a x@y.com", "k"), (2, None, None), (3, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = df.select("doc_id", pii.identifiers(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    assert [r.n_email for r in out] == [1, 1, 0, 0] and out[0].spans == "email:2:9"
    assert out[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert df.limit(0).select(pii.identifiers(F.col("text"))).count() == 0
    masked = [r[0] for r in df.select(pii.masked(F.col("text"))).collect()]
    assert masked == ["a <EMAIL>", "a <EMAIL>", None, ""]


def brute_hits(text, items, window=10):
    words = decontamination.words(text)
    hit, names = set(), set()
    for name, item in items:
        size = min(window, len(item))
        wanted = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
        for i in range(len(words) - size + 1 if wanted else 0):
            if tuple(words[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                names.add(name)
    return hit, names


def test_automaton_equals_all_windows():
    rng = random.Random(2)
    for window in (3, 4):
        for _ in range(400):
            items = [(str(i), [rng.choice("abc").encode() for _ in range(rng.randrange(9))]) for i in range(4)]
            text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(40))).encode()
            spans, names = decontamination.SuffixAutomaton(items, window).match(decontamination.words(text))
            hit, wanted = brute_hits(text, items, window)
            assert {i for a, b in spans for i in range(a, b)} == hit and names == wanted


def test_decontamination_of_rows(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Start, {item.upper()}! rest of a longer text that goes on and on for more words than it"), (2, item), (3, None), (4, ""), (5, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hits", F.lit("kept"))
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (10, "goes on")], "item_id long, text string")
    for block in (1 << 19, 8):  # one automaton, and several
        out = decontamination.with_hits(docs.drop("hits"), items, block_bytes=block).orderBy("doc_id").collect()
        assert [sorted(r.hits["items"]) for r in out] == [["10", "7"], ["7"], [], [], []]
        assert sum(s["stop"] - s["start"] for s in out[0].hits["spans"]) == 13
    kept = {r.doc_id: r for r in decontamination.decontaminate(docs, items).collect()}
    assert kept.keys() == {1, 3, 4, 5} and kept[1].hits == "kept"
    assert kept[1].text == "Start, ! rest of a longer text that  and on for more words than it" and kept[3].text is None
    assert decontamination.with_hits(docs.drop("hits"), items.limit(0)).filter("size(hits.spans) > 0").count() == 0
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0


TEXTS = ["", " ", "  a  b ", "x<|endoftext|> y<|endoftext|>", "don't we'll I'VE \x1c\x85  z", "a" * 3000, "é" * 200 + "日本語😀", "\n\n \t x", "12½²", "×÷ ª", "end\r\n"]


def test_bpe_equals_the_public_library():
    from tokenizers import Tokenizer

    public, own = Tokenizer.from_file(vocabulary_path()), bpe.ByteBpe(vocabulary_path(), memory=5)
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(" ab'\n1é.　Ωs") for _ in range(60)) for _ in range(300)]
    for text in texts:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == public.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids) == public.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_forced_boundaries_are_in_no_token():
    own = bpe.ByteBpe(vocabulary_path())
    parts = own.cut(b"q\xffzx\x00abc")
    assert b"".join(parts) == b"q\xffzx\x00abc" and len(parts) > 1
    joins = {a[-1:] + b[:1] for a, b in zip(parts, parts[1:])}
    assert not any(pair in token for pair in joins for token in own.ids)


def test_bpe_round_trip_in_rows(spark):
    df = spark.createDataFrame([(1, t) for t in TEXTS] + [(2, None)], "doc_id long, text string")
    ids = df.select("text", bpe.encode(F.col("text"), vocabulary_path()).alias("ids"))
    back = ids.select("text", bpe.decode(F.col("ids"), vocabulary_path()).alias("back")).collect()
    assert all((r.text or "") == r.back for r in back)


def brute_repeats(words, window):
    seen, covered = {}, set()
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            covered |= {i + k for i in starts for k in range(window)}
    return len(covered)


def test_repeated_words():
    rng = random.Random(4)
    for _ in range(500):
        words = [rng.choice(["a", "b"]).encode() for _ in range(rng.randrange(40))]
        assert host_rules.repeated_words(words, 8) == brute_repeats(words, 8)
    assert host_rules.duplicate_lines(b"a\n \n\na\n b\nb\na") == 2


def test_hosts(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good if i % 2 else "short", "mixed") for i in range(20)]
    rows += [(100 + i, "# $ % & " * 20 + " ".join(f"v{i}{k}" for k in range(9)), "bad") for i in range(60)]
    rows += [(200, good, "small"), (201, None, None), (202, good, None)]
    out = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(out) == len(rows) and out[1].kept and not out[0].kept and out[200].kept and out[202].kept
    assert out[201].n_words == 0 and out[201].base_failed
    assert all(out[100 + i].host_rejected and not out[100 + i].kept for i in range(60))
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert host_rules.judge(empty).count() == 0


def host_rows(rates, good, bad, n=100):
    """Documents of hosts that fail a rule at the given rates."""
    return [(1000 * h + i, bad if i < rate * n else good, f"h{h}") for h, rate in enumerate(rates) for i in range(n)]


def verdicts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_words", F.lit(-1))
    out = host_rules.judge(docs, keep=("doc_id", "source")).collect()
    return {r.source for r in out if r.host_rejected}, out


def test_hosts_are_compared_with_each_other(spark):
    """A host that fails far more often than the others goes, its good documents with it; with such others it stays."""
    good, bad = " ".join(f"w{i}" for i in range(30)), " ".join(f"#$%&{k}" for k in range(30))
    low = [0.02, 0.0, 0.05, 0.03, 0.01]
    rejected, out = verdicts(spark, host_rows([*low, 0.8], good, bad))
    assert rejected == {"h5"} and sum(not r.kept and not r.base_failed for r in out if r.source == "h5") == 100
    assert all(r.kept for r in out if r.source != "h5")
    assert verdicts(spark, host_rows([*low, 0.4], good, bad))[0] == set()  # stands out, but most documents are good
    assert verdicts(spark, host_rows([0.7, 0.8, 0.6, 0.85, 0.65, 0.8], good, bad))[0] == set()  # no worse than the others
    assert verdicts(spark, host_rows([*low, 1.0], good, bad, n=2))[0] == set()  # two documents prove little
    assert verdicts(spark, host_rows([0.8], good, bad))[0] == set() and verdicts(spark, host_rows([1.0], good, bad))[0] == {"h0"}


def test_a_rate_equal_to_the_limit_passes(spark):
    good = " ".join(f"w{i}" for i in range(30))
    bad = " ".join(f"#$%&{k}" for k in range(30))
    assert verdicts(spark, host_rows([0.9], good, bad))[0] == set()  # one host: the rate is that of the mean
    assert verdicts(spark, host_rows([0.91], good, bad))[0] == {"h0"}


def test_measures_of_a_very_long_text(spark):
    text = "\n".join(f"line {i % 7} of a long text with words {i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text, None), (1, text, None)], "doc_id long, text string, source string")
    rows = host_rules.judge(docs).collect()
    words = text.split()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].n_words == len(words) and rows[0].n_dup_lines == 0
    assert rows[0].word_chars == sum(map(len, words)) and rows[0].n_repeat_words == 8 * 60_000


def test_licences():
    text = "Intro here.\n" + licences.SENTENCES["gpl-free"] + ".\nMy note.\n" + licences.SENTENCES["gpl-hope"] + ".\nReleased under the MIT License."
    _, ids, found = licences.scan(text)
    assert ids == "gpl-free,gpl-hope,mit-released" and [f[0] for f in found] == ["GPL-3.0", "MIT"]
    assert licences.scan(licences.SENTENCES["gpl-hope"] + ".\n" + licences.SENTENCES["gpl-free"])[2] == []
    assert licences.scan(None) == licences.scan("") == (0, "", [])


def cut_value(content, edges, keep):
    return (
        sum(s for s, k in zip(content, keep) if s > 0 and not k)
        - sum(s for s, k in zip(content, keep) if s < 0 and k)
        + sum(w for a, b, w in edges if keep[a] != keep[b])
    )


def test_minimum_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 8)
        content = [round(rng.uniform(-3, 3), 2) for _ in range(n)]
        edges = [(a, b, rng.random()) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        got = cut_value(content, edges, main_text.minimum_cut(content, edges))
        best = min(cut_value(content, edges, [m >> i & 1 == 1 for i in range(n)]) for m in range(1 << n))
        assert abs(got - best) < 1e-6


def test_main_text():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header class='site-header'>Site</header><nav><a href=x>Home</a></nav>"
        "<div class='cookie-notice'>We use cookies on this site, accept them all.</div><article><h1>Title &amp; more</h1><p>First <b>bold\n text</b> here."
        "<p>Short.<script>var a='</p>';</script><aside>Side bar text.</aside><p>Last&nbsp;one.</article>"
        "<section id='comments'><p>Reader said this is a long comment with words.</p></section><form><p>Your name please.</p></form><footer>&copy; x</footer></body>"
    )
    assert main_text.extract(page) == "Title & more\nFirst bold text here.\nShort.\nLast one."
    assert main_text.extract(None) == main_text.extract("") == main_text.extract("<p></p><!-- x") == ""
