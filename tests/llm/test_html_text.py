import pytest
from pyspark.sql import types as T

from tallywind.llm.html_text import extract, main_text, path_scores, _blocks, OPTIONS

ARTICLE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
    "<header><a href=/>Site</a></header><nav><ul><li><a>Home, sweet.</a><li><a>About us, here.</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies, as all do. Accept, please.</div>"
    "<article><h1>Title &amp; more</h1><p>First  paragraph,\n with text.<br>And a line.</p>"
    "<p><b>Bold, unclosed. More text, and more of it.<p>Next &lt;one&gt; &eacute; here.</p>"
    "<ul><li>item<li>other</ul><div class=ad>Buy, buy, buy! Now, or never.</div>"
    "<form><input name=q><label>Mail</label></form>"
    "<script>var t='</p><p>not text, at all.';</script><!-- a comment, too --></article>"
    "<aside>Side, bar. Text, text.</aside><section id=comments><p>Reader, comment. Nice, text.</p></section>"
    "<footer>&copy; Site, all rights.</footer></body></html>"
)
TEXT = (
    "Title & more\n\nFirst paragraph, with text. And a line.\n\nBold, unclosed. More text, and more of it."
    "\n\nNext <one> é here.\n\nitem\n\nother"
)


def test_article_without_furniture():
    assert main_text(ARTICLE) == TEXT


def test_article_in_plain_divisions():
    page = (
        "<body><div><a>Home</a> <a>News</a></div><div><h2>Head</h2><p>Long text, with marks. And more, of it."
        "<p>Second, of some length. Yes.</div><div>copyright</div></body>"
    )
    assert main_text(page) == "Head\n\nLong text, with marks. And more, of it.\n\nSecond, of some length. Yes."


def test_comment_articles_are_not_the_article():
    page = (
        "<main><article><p>The text, itself.</p></article>"
        "<article class='comment'><p>A reply, longer than the text, by far.</p></article></main>"
    )
    assert main_text(page) == "The text, itself."


def test_names_of_layout_are_no_furniture():
    text = "<p>The text, itself. And some more of it, here.</p>"
    for opened in (
        "<body class='has-sidebar'>",
        "<div class='row with-sidebar'>",
        "<article class='post comments-open'>",
        "<div id='comments'>",  # all there is
    ):
        assert main_text(opened + text) == "The text, itself. And some more of it, here."
    side = "<div class='leftSidebar'><p>Side text, with marks. Long, long, long text of it.</p></div>"
    assert main_text(side + "<div>" + text + "</div>") == "The text, itself. And some more of it, here."


LONG = "Long text of the page, with marks. And more of it, sentence by sentence, until it ends. "


def test_selected_text_outside_of_teasers():
    teasers = "<article><h3>Other</h3><p>Short.</p></article>" * 3
    page = f"<body><div id=content><h1>Head</h1><p>{LONG * 3}</p><p>{LONG}</p></div><section>{teasers}</section></body>"
    assert main_text(page) == f"Head\n\n{(LONG * 3).strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_unselected_branches_of_an_article_drop_out(tag):
    rest = "<div><h4>By</h4><i>A. Writer</i></div><ul><li><a>Home</a><li><a>News</a><li><a>More</a></ul>"
    text = f"<p>{LONG * 2}</p><p>{LONG}</p><p>Short.<b>Note</b></p>"
    want = f"Head\n\n{(LONG * 2).strip()}\n\n{LONG.strip()}\n\nShort.Note"
    title = "<header><div><h1>Head</h1></div></header>"
    for inside in (title + text + rest, f"{title}<div>{text}</div>{rest}", f"{title}<div>{text}{rest}</div>"):
        assert main_text(f"<body><{tag}>{inside}</{tag}></body>") == want


def test_short_paragraphs_of_other_inline_paths_stay():
    page = f"<article><h1>Head</h1><p><b>Lead.</b></p>{f'<p>{LONG * 3}</p>' * 5}</article>"
    assert main_text(page).split("\n\n")[:2] == ["Head", "Lead."]


def test_articles_of_one_main_stay():
    page = f"<main><ul><li>Up</ul><article><p>{LONG}</p></article><article><p>{LONG}</p></article></main>"
    assert main_text(page) == f"{LONG.strip()}\n\n{LONG.strip()}"


def test_path_scores_prefer_text_with_punctuation():
    scores = path_scores(_blocks("<div><p>Some text, with marks, and more.</p><b>x</b><i>y</i><u>z</u></div>"), OPTIONS)
    assert max(scores, key=scores.get).endswith("p")


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("just text", "just text"),
        ("a < b & c", "a < b & c"),
        ("<p>cut <b", "cut"),
        ("<p>x</p><script>never closed, <p>y", "x"),
        ("<p title='a>b'>x</p>", "x"),
        ('<p title="unclosed>x</p>', "x"),
        ("<p>a&nbsp;&nbsp;b &#x41;&#66; &am</p>", "a b AB &am"),
        ("<!-- only a comment", ""),
        ("<p></p><p> \n </p>", ""),
        ("</div></p>x", "x"),
    ],
)
def test_broken_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 3000 + "deep, text." + "</div>" * 3000) == "deep, text."
    long = "<article>" + "<p>Some words, here.</p>" * 20000 + "</article>"
    assert main_text(long).count("\n\n") == 19999


def test_rows(spark):
    schema = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())]
        + [T.StructField(n, T.StringType()) for n in ("html", "text", "n_chars")]
    )
    made = [(1, "u", ARTICLE, "clash", "x"), (2, None, None, None, None), (1, "u", ARTICLE, "clash", "x"), (None, "v", "", "", "")]
    found = extract(spark.createDataFrame(made, schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, found.collect()), key=repr)
    want = sorted([(1, "u", TEXT, len(TEXT)), (2, None, "", 0), (1, "u", TEXT, len(TEXT)), (None, "v", "", 0)], key=repr)
    assert got == want
    assert extract(spark.createDataFrame([], schema)).count() == 0


def test_elements_of_any_depth():
    deep = 250 * "<div>" + "<p>Deep words, which stay.</p><nav>no menu</nav>" + 250 * "</div>"
    page = (
        "<body><nav>menu here</nav><div id=page><article><p>First words, of the article.</p>"
        f"{deep}<p>Last words, of the article.</p></article></div></body>"
    )
    words = ["First words, of the article.", "Deep words, which stay.", "Last words, of the article."]
    assert main_text(page) == "\n\n".join(words)
    assert main_text(20_000 * "<div>" + "words, here." + 20_000 * "</div>") == "words, here."
    assert main_text(20_000 * "<b>" + "words, here." + 20_000 * "</i>") == "words, here."
