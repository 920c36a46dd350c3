"""Main text: planted templates, broken pages, and what the cut adds to the costs."""

import time

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import main_text

BODY = "<p>This is the first long sentence of the article, and it goes on.</p><p>Here is another one that says more.</p>"
LINES = "This is the first long sentence of the article, and it goes on.\nHere is another one that says more."
AROUND = (
    '<html><body class="has-sidebar"><nav><a href=x>Home</a></nav>%s<div class="related-posts"><p>See also this other story.</p></div>'
    '<div id="comments"><article class="comment"><p>What a fine text, I think so too, dear author.</p></article></div>'
    "<p>Copyright 2020 Site Inc, all of it.</p></body></html>"
)


@pytest.mark.parametrize(
    "holder",
    [
        '<article class="post type-post tag-news">%s</article>',
        '<article class="post has-header">%s</article>',
        '<div class="post-content share-enabled">%s</div>',
        '<div id="search-engines-story">%s</div>',
        '<div class="menu-left"><div class="widget"><article>%s</article></div></div>',
        '<main id="content">%s</main>',
        '<div class="content sidebar-right"><p class="lead">%s</div>',
    ],
)
def test_no_article_is_lost_to_a_name(holder):
    assert main_text.extract(AROUND % (holder % BODY)) == LINES


@pytest.mark.parametrize(
    "names, score",
    [
        ("sidebar", -7), ("site-nav", -7), ("ad-slot", -7), ("ads2", -7), ("cookie-banner", -7), ("share", -7), ("search-box", 0),
        ("has-header", 0), ("tag-news", 0), ("entry-content", 1), ("Story", 1), ("content sidebar", 0), ("heading", 0), ("", 0),
    ],
)
def test_names(names, score):
    assert main_text.by_names(names) == score


def test_cut_gives_short_blocks_the_label_of_their_neighbours():
    """A page without telling elements: the sign of a block's own cost loses its short lines, the cut keeps them."""
    menu = '<div class="x1">' + "".join(f'<div><a href="/{i}">Part {i}</a></div>' for i in range(6)) + "</div>"
    long = "<p>%s says that the harbour will be closed for the whole of the coming winter, as it was in the last.</p>"
    story = "<div>" + long % "Ann" + "<p>Three reasons</p>" + long % "Bob" + "<p>Not yet</p>" + long % "Cy" + "</div>"
    found = main_text.blocks(f"<body>{menu}{story}<div><div>Imprint</div><div>Contact us</div></div></body>")
    costs = [main_text.costs(b) for b in found]
    kept = main_text.minimum_cut(costs, main_text.smoothness(found))
    alone = [b.text for b, c in zip(found, costs) if c > 0]
    labelled = [b.text for b, k in zip(found, kept) if k]
    want = [b.text for b in found if " says that " in b.text or b.text in ("Three reasons", "Not yet")]
    assert len(alone) == 3 and labelled == want


@pytest.mark.parametrize(
    "piece, end",
    [
        ("<a ", ""), ('<a "', ">"), ('<a ">', '"'), ("<a '\">", ""), ("<span>", "<h1>x</h1>" * 9), ("<span>x</b>", ""), ("<button>", ""),
        ("<!-- ", ""), ("<p>x<", ""), ("<div>", "x"), ("<span>x<h1>", ""), ("&", ""), ("</p", ""), ("<b><p>", ""),
    ],
)
def test_broken_pages_take_linear_time(piece, end):
    started = time.perf_counter()
    main_text.extract(piece * 20000 + end)
    assert time.perf_counter() - started < 5


def test_unclosed_and_self_closed_elements_hide_no_text():
    for before in ("<head><title>t</title><body>", "<svg/>", "<button>Go ", "<svg width=1 />", "<p title=\"it's\">", "<select><option>"):
        assert main_text.extract(f"{before}<article>{BODY}</article>").endswith(LINES), before
    assert main_text.extract(f"<article>{BODY}</article><script>var a = 1 < 2") == LINES
    assert main_text.extract("<article><p>When 1 < 2 and 3 <4 it is &lt;so&gt;.</p></article>") == "When 1 < 2 and 3 <4 it is <so>."


def test_cases(spark):
    """Null, empty, repeated and very long pages, clashing columns, an empty table."""
    page = AROUND % f"<article>{BODY}</article>"
    rows = [(1, None, "a"), (2, "", "b"), (3, page, "c"), (3, page, "c"), (4, f"<article>{BODY * 20000}</article>", None)]
    table = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = table.select("page_id", F.col("text").alias("n_chars"), main_text.main_text(F.col("html")).alias("text"))
    got = sorted(((r.page_id, r.n_chars, r.text) for r in out.collect()), key=repr)
    assert [g[0] for g in got] == [1, 2, 3, 3, 4]
    assert got[0][2] == got[1][2] == "" and got[2] == got[3] == (3, "c", LINES)
    assert got[4][2] == "\n".join([LINES] * 20000)
    assert table.limit(0).select(main_text.main_text(F.col("html"))).count() == 0
