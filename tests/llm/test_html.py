"""Main text of pages: the standard library's parser on the test pages, block rules, odd markup."""

import time
from html.parser import HTMLParser

import pytest

from tabrix.llm import html_extract as X
from tabrix.llm import queries as Q
from tests.conftest import SF_SMALL

PROSE = ("It was one of the days on which all of them would have been at the house, and she knew "
         "that it was not for her to say who had to be there. ")
SHORT = "So it went."


class Article(HTMLParser):
    """Blocks of text inside <article>, without rules."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "br", "li"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1"):
            self.parts.append(" ")

    def handle_data(self, data):
        if self.depth > 0:
            self.parts.append(data)


def test_query_equals_a_plain_parser(spark):
    got = Q.QUERIES["op13_main_text"](spark, SF_SMALL)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        p = Article()
        p.feed(pages[r["page_id"]]["html"])
        p.close()
        assert r["text"] == " ".join("".join(p.parts).split())
        assert (r["url"], r["n_chars"]) == (pages[r["page_id"]]["url"], len(r["text"]))


def page(body, attrs=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body{attrs}>"
            f"{body}</body></html>")


def p(text):
    return f"<p>{text}</p>"


OUTSIDE = [
    "<nav><ul><li><a href=/>Home</a></li><li>About</li></ul></nav>",
    "<header><h1>Site</h1><p>" + PROSE * 2 + "</p></header>",
    "<footer>&copy; 2020 " + PROSE + "</footer>",
    "<aside>" + p(PROSE * 2) + "</aside>",
    "<div class='sidebar left'>" + p(PROSE) + "</div>",
    "<div id=cookieNotice>" + p("We use cookies. " + PROSE) + "</div>",
    "<div class='ad-slot-2'>" + p(PROSE) + "</div>",
    "<form action=/s><label>Name</label><textarea><p>x</textarea><p>" + PROSE + "</p></form>",
    "<script>var a = '<p>" + PROSE + "</p>';</script>",
    "<style>.a{content:'<p>'}</style>",
    "<section class='comments'><article><p>" + PROSE * 2 + "</p></article></section>",
    "<div id='comment-list'><div class=comment>" + p(PROSE) + "</div></div>",
    "<div role='navigation'>" + p(SHORT) + "</div>",
    "<!-- <p>" + PROSE + "</p> -->",
    "<ul><li><a href=/1>" + PROSE + "</a></li></ul>",
    "<div class=promo><p>" + SHORT + "</div>",
    "<button>Push " + PROSE + "</button><select><option>One<option>Two</select>",
]


@pytest.mark.parametrize("part", OUTSIDE)
@pytest.mark.parametrize("mark", [("<article>", "</article>"), ("<main class=post>", "</main>"),
                                  ("<div id=c>", "</div>")])
def test_what_is_not_the_article_goes(part, mark):
    text = "<h1>A title</h1>" + p(PROSE) + p(SHORT) + p(PROSE * 2) + p("End. " + PROSE)
    want = f"A title {PROSE}{SHORT} {PROSE * 2}End. {PROSE}".strip()
    assert X.extract(page(part + mark[0] + text + mark[1])) == want
    assert X.extract(page(mark[0] + text + mark[1] + part)) == want
    inner = mark[0] + "<h1>A title</h1>" + p(PROSE) + part + text[text.index("<p>" + SHORT):]
    # inside, a header may be the article's own, and an unmarked list of links next to a short
    # block decides it, unless an article's blocks do
    own = {"<article>": "<header>", "<main class=post>": "<header>", "<div id=c>": "<ul>"}
    if not part.startswith(own[mark[0]]):
        assert X.extract(page(inner + mark[1])) == want


def test_an_article_keeps_its_short_and_plain_blocks():
    table = "<table><tr><td>12</td><td>34</td></tr></table>"
    odd = "zxq " * 40
    body = ("<article class='post has-sidebar'><header class=entry-header><h1>On &amp; off</h1>"
            f"</header><p>{SHORT}<p>{odd}{table}<pre>a  =\n 1</pre><ul><li>one<li>two</ul>"
            f"<p>See <a href=/x>this</a> and <b>that</b>.<br>Line<p>a<b>b</b>c&nbsp;&lt;d&gt;</article>")
    assert X.extract(page(body, " class='with-ads'")) == (
        f"On & off {SHORT} {odd.strip()} 12 34 a = 1 one two See this and that. Line abc <d>")


def test_second_pass():
    def b(n, zone=X.NEUTRAL, article=0, heading=False):
        return X.Block("x" * n, 0, zone, article, heading)

    found = [b(9), b(9), b(99), b(9), b(9), b(9), b(99), b(9, heading=True), b(99), b(9)]
    label = [None, None, False, None, None, None, True, None, False, None]
    assert X.second_pass(found, label) == [
        False, False, False, False, False, True, True, False, False, False]
    # an article's blocks ask the article alone; without any decided one they stay
    inner = [b(99), b(9, X.ARTICLE, 1), b(99, X.BAD, 1), b(9, X.ARTICLE, 1), b(99)]
    assert X.second_pass(inner, [True, None, False, None, False]) == [
        True, True, False, True, False]
    assert X.second_pass([b(9), b(99)], [None, False]) == [True, False]
    assert X.second_pass([], []) == []


@pytest.mark.parametrize("text", [
    None, "", "   ", "<", "<>", "a < b", "</p>", "<p", "<p class='", "<!--", "<!-->x", "<![CDATA[x]]>",
    "<script>", "plain text", "&amp;&bogus;&#x41;&#0;&#99999999;", "<p>\x00\ud83d</p>".replace(
        "\ud83d", "\U0001f600"), "<a href=\"x>y</a><p>z", "<article></article></article><p>q"])
def test_odd_markup_does_not_fail(text):
    got = X.extract(text)
    assert isinstance(got, str) and got == " ".join(got.split())


def test_whole_text_without_rules_is_kept():
    assert X.extract("plain text") == "plain text"
    assert X.extract("a < b &amp; c") == "a < b & c"
    assert X.extract("<p>Of.</p><p>Sh is.") == "Of. Sh is."
    long = f"<article>{p(PROSE) * 20_000}</article>"
    assert X.extract(long) == " ".join([PROSE.strip()] * 20_000)


@pytest.mark.parametrize("unit", [
    '<a title="x>', "<div>", "<b><p>", "</i>", "<script>", "<!--", "<li>", "<td><p>", "<svg>", "<h1>x",
    "<", "<i><div></i>"])
def test_linear_time(unit):
    t = time.process_time()
    X.extract("<i>" + unit * 60_000 + "</section></i>" * 20_000)
    assert time.process_time() - t < 20


def test_awkward_pages(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (None, None, "<p>a</p>", 2), (2, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(tuple, X.extract_pages(df).collect()), key=repr)
    assert got == [(1, "u", "", 0), (1, "u", "", 0), (2, "v", "", 0), (None, None, "a", 1)]
    assert X.extract_pages(df.limit(0)).collect() == []
    dotted = df.select("page_id", df["html"].alias("te.xt"))
    assert X.extract_pages(dotted, html_col="te.xt", keep=()).count() == 4
