import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators.cleaning import (
    drop_binary,
    drop_blank,
    process_documents,
    require_columns,
    require_rows,
)

STEPS = [
    T.fix_encoding,
    T.strip_headers,
    T.strip_quotes,
    T.strip_signature,
    T.strip_html,
    T.strip_urls,
    T.strip_emails,
    T.strip_emoji,
    T.normalize_whitespace,
    T.clean_text,
]


def test_valid_text(apply):
    assert apply(T.is_valid_text, None, "", " \n\t ", "  　", "word") == [
        False,
        False,
        False,
        False,
        True,
    ]


@pytest.mark.parametrize("step", STEPS, ids=lambda s: s.__name__)
def test_steps_give_empty_text_for_unusable_input(apply, step):
    assert apply(step, None, "", "  \n ") == ["", "", ""]


def misread(text, times=1):
    """UTF-8 bytes read as windows-1252; its gaps as controls."""
    for _ in range(times):
        shown = [bytes([b]).decode("cp1252", "replace") for b in text.encode()]
        text = "".join(chr(b) if c == "\ufffd" else c for b, c in zip(text.encode(), shown))
    return text


@pytest.mark.parametrize("times", [1, 2])
def test_damaged_runs_of_any_script_are_decoded(apply, times):
    texts = ["škoda ć …т", "✓ ok → €5", "привет мир", "Ελλάδα", "łódź żółw", "日本語", "naïve Ünal ß", "😀"]
    assert apply(T.fix_encoding, *[misread(t, times) for t in texts]) == texts


def test_what_real_text_has_is_left_alone(apply):
    texts = ["DÉJÀ…", "É\xa0!", "É…", "ÂGE – «É»", "N°5 ¿Qué?", "Å", "Ñ – Ñ"]
    assert apply(T.fix_encoding, *texts) == texts
    quoted = ["CAFÉ”", "café…”", "BÖ”", "à la “mode”"]
    assert apply(T.fix_encoding, *quoted) == [t.replace("”", '"').replace("“", '"') for t in quoted]


def test_what_comes_out_is_not_looked_at_again(apply):
    texts = ["&amp;lt; alone", "&amp;lt; and &lt;", "Å¡koda Ä‡ …Ñ‚", "âœ“ ok"]
    assert apply(T.fix_encoding, *texts) == ["&lt; alone", "&lt; and <", "škoda ć …т", "✓ ok"]


def test_fix_encoding(apply):
    assert apply(
        T.fix_encoding,
        "sheâ€™s here",
        "nothing odd here.",
        "cafÃ© dÃ©jÃ\xa0",
        "ÃƒÂ©",
        "a &lt;b&gt; &amp; &#233; &#x41; &nosuch;",
        "<i>x &amp; y</i>",
        "one\r\ntwo\rthree\x00\x07",
        "“curly” ‘quotes’ ﬁn Ａ",
        "naïve façade, âge, Über",
        "ðŸ˜€",
    ) == [
        "she's here",
        "nothing odd here.",
        "café déjà",
        "é",
        "a <b> & é A &nosuch;",
        "<i>x &amp; y</i>",
        "one\ntwo\nthree",
        "\"curly\" 'quotes' fin A",
        "naïve façade, âge, Über",
        "😀",
    ]


def test_strip_headers(apply):
    assert apply(
        T.strip_headers,
        "From: me@x.example\nSubject: hi\nLines: 3\n\nThe body.\nMore: of it",
        "No header in this one.\nSecond line",
        "To: you\n\nNote: gone as well\nkept",
        "From: me\nLines: 0",
        "  X-Odd-Name:value\n\t\n  indented body",
        "1st: a digit is no header",
    ) == [
        "The body.\nMore: of it",
        "No header in this one.\nSecond line",
        "kept",
        "",
        "  indented body",
        "1st: a digit is no header",
    ]


def test_strip_headers_of_many_lines(apply):
    many = "".join(f"Key: {i}\n" for i in range(50_000)) + "body"
    assert apply(T.strip_headers, many) == ["body"]


def test_strip_quotes(apply):
    assert apply(
        T.strip_quotes, "mine\n > theirs\nmine too", "a > b stays", "> only", "a\n>", ">\n\nb"
    ) == ["mine\nmine too", "a > b stays", "", "a", "\nb"]


def test_strip_signature(apply):
    assert apply(
        T.strip_signature,
        "text\n-- \nName\nTown",
        "a -- b\n--- not this",
        "--\nall of it",
        "x\n--",
        "first\n--\nmid\n--\nlast",
    ) == ["text", "a -- b\n--- not this", "", "x", "first"]


def test_strip_html(apply):
    assert apply(T.strip_html, "<b>big</b> and <i>thin</i>", "a < b", "<a\nhref='x'>y</a>", "<>") == [
        " big  and  thin ",
        "a < b",
        " y ",
        "<>",
    ]


def test_strip_urls(apply):
    assert apply(
        T.strip_urls, "at https://x.example/a?b=1 or http://y.example, or www.z.example.", "HTTP://X"
    ) == ["at   or   or  ", "HTTP://X"]


def test_strip_emails(apply):
    assert apply(
        T.strip_emails,
        "write (me@site.example), please",
        "no@dot at.all",
        "@a@b.c x@.y.z x@y. x@y.z",
    ) == ["write   please", "no@dot at.all", "    x@y.  "]


@given(st.lists(st.text(alphabet="a@. ", max_size=12), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_strip_emails_equals_plain_pattern(apply, texts):
    import re

    want = [re.sub(r"\S+@\S+\.\S+", " ", t) if t.strip() else "" for t in texts]
    assert apply(T.strip_emails, *texts) == want


def test_strip_emoji(apply):
    assert apply(T.strip_emoji, "hi 😀 and 👍🏽!", "plain 12 #", "👩‍🔬1️⃣🇩🇪x") == [
        "hi   and  !",
        "plain 12 #",
        "   x",
    ]


def test_normalize_whitespace(apply):
    assert apply(T.normalize_whitespace, "a   b", "a\n\n\n\nb", "  a  ", "a\xa0 b\t c") == [
        "a b",
        "a b",
        "a",
        "a b c",
    ]


def test_clean_text(apply):
    messy = (
        "From: someone@x.example (Some One)\nSubject: Re: things\nLines: 9\n\n"
        "In article <77@y.example> they wrote:\n> old words\n\n"
        "Itâ€™s <b>really</b> good 😀, see https://z.example/q and   ask me@x.example.\n"
        "-- \nSome One\nsome.one@x.example\n"
    )
    once = apply(T.clean_text, messy, "Bonjour, ceci reste tel quel.", "From: a\nLines: 0\n\n")
    assert once == [
        "In article they wrote: It's really good , see and ask",
        "Bonjour, ceci reste tel quel.",
        "",
    ]
    assert apply(T.clean_text, *once) == once


@given(st.lists(st.text(max_size=60), min_size=1, max_size=20))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_cleaned_text_has_no_loose_whitespace(apply, texts):
    for out in apply(T.clean_text, *texts):
        assert out == " ".join(out.split())


def test_steps_stay_linear_on_unbroken_runs(apply):
    started = time.time()
    apply(T.clean_text, "x" * 400_000, "a." * 200_000, "\n" * 300_000 + "x", "@" * 100_000)
    assert time.time() - started < 30


def test_encoding_issue(spark):
    df = spark.createDataFrame([(b"ok \xc3\xa9",), (b"\x80bad",), (None,)], "raw BINARY")
    got = [r[0] for r in df.select(T.has_encoding_issue(F.col("raw"))).collect()]
    assert got == [False, True, False]


def test_preview_and_lengths(apply):
    assert apply(T.preview, "a\nb" + "c" * 200) == ["a b" + "c" * 97]
    assert apply(T.text_length, None, "", "😀a") == [0, 0, 2]


def test_process_documents_keeps_rows(spark):
    df = spark.createDataFrame(
        [(1, "Subject: x\n\nhello   world"), (2, None), (3, "Lines: 0")], "doc_id LONG, text STRING"
    )
    got = {r.doc_id: r for r in process_documents(df).collect()}
    assert (got[1].clean_text, got[1].original_length, got[1].clean_length) == ("hello world", 25, 11)
    assert (got[2].clean_text, got[2].original_length) == ("", 0)
    assert [r.doc_id for r in process_documents(df, drop_empty=True).collect()] == [1]


def test_filters_and_checks(spark):
    df = spark.createDataFrame([("good words here",), (" ",), (None,), ("M" * 300,)], "t STRING")
    assert drop_blank(df, "t").count() == 2
    assert [r.t for r in drop_binary(df, "t").collect()] == ["good words here"]
    with pytest.raises(ValueError):
        require_columns(df, "t", "missing")
    with pytest.raises(ValueError):
        require_rows(df.filter("t = 'none'"))
    assert require_rows(require_columns(df, "t")).count() == 4
