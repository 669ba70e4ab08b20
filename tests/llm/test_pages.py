import html
import random
import re
import time

import pytest

from clickmill.llm import pages

ARTICLE = "<article><h1>The title</h1><p>One, two.</p><p>Three &amp; four &lt;b&gt;</p></article>"
WANTED = "The title\nOne, two.\nThree & four <b>"


def brute(page):
    """Blocks of the article element of the test pages."""
    inside = page[page.index("<article>") + len("<article>") :]
    end = re.search("</article>|<footer>", inside)
    inside = inside[: end.start()] if end else inside
    inside = re.sub("</?(p|h1|br)>", "\0", inside)
    parts = [html.unescape(re.sub("<[^>]*>", "", x)) for x in inside.split("\0")]
    return "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)


def test_test_pages_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {r.page_id: brute(r.html) for r in df.collect()}
    got = pages.extract_pages(df).collect()
    assert len(got) == len(expected)
    for r in got:
        assert r.text == expected[r.page_id]
        assert r.n_chars == len(r.text)


SURROUNDINGS = [
    "<nav><ul><li><a href='/'>Home, sweet home. Click here for everything, now.</a></li></ul></nav>",
    "<header><h2>Site name. It is long, and has punctuation.</h2></header>",
    "<footer><p>Imprint. Terms, privacy.</p></footer>",
    "<aside><p>Also read this, and that. And more, more, more.</p></aside>",
    "<div class='sidebar'><p>Popular: this, that. And other things, too.</p></div>",
    "<div class=\"cookie-notice\"><p>We use cookies. Accept, please.</p></div>",
    "<div id=ad-42>Buy this, now. Buy that, too.</div>",
    "<form><label>Your mail</label><input name=x><button>Send, now.</button></form>",
    "<script>var x = '<p>not text</p>';</script>",
    "<style>p > a { color: red }</style>",
    "<!-- a comment <p>not text</p> -->",
    "<section class='comments'><article class='comment'><p>I agree, fully. Nice, very nice.</p>"
    "</article></section>",
    "<div hidden><p>Hidden text, really. Not seen.</p></div>",
    "<div style='display:none'>Not seen, ever.</div>",
    "<noscript>Turn on scripts, please.</noscript>",
]


@pytest.mark.parametrize("extra", SURROUNDINGS)
def test_parts_outside_the_article_are_left_out(extra):
    for body in (extra + ARTICLE, ARTICLE + extra, extra + ARTICLE + extra):
        page = f"<!DOCTYPE html><html><head><title>T, t.</title></head><body>{body}</body></html>"
        assert pages.main_text(page) == WANTED


def test_page_without_article_element():
    body = "<div class='page'>" + "".join(SURROUNDINGS) + "<div id='main-text'>"
    body += "<h1>Title</h1>" + "<p>A sentence, with marks. And another one.</p>" * 3
    page = f"<html><body>{body}<ul><li>a, b</li><li>c</li></ul></div></div></body></html>"
    wanted = ["Title", *["A sentence, with marks. And another one."] * 3, "a, b", "c"]
    assert pages.main_text(page) == "\n".join(wanted)


LONG = "<p>A sentence, with marks. And another one, somewhat longer, to read.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<article><h1>T</h1><div class=body>{LONG * 6}</div></article>",
        f"<article><section>{LONG * 9}</section><section><p>Short.</p></section></article>",
        f"<div class=page><p class=lead>Lead.</p><div class=body>{LONG * 6}</div></div>",
        f"<div class=page><div class=body>{LONG * 6}</div><h2>Appendix</h2><p>End.</p></div>",
        f"<article><div class=body>{LONG * 9}</div><div class=appendix><p>a</p><p>b</p></div></article>",
        f"<main><h1>T</h1><article>{LONG * 6}</article></main>",
        f"<div><div class=title><h1>T</h1></div><div class=body>{LONG * 9}</div></div>",
        f"<div><section>{LONG * 9}</section><section>{LONG}</section></div>",
    ],
)
def test_all_parts_of_an_article_are_kept(page):
    wanted = [x for x in re.sub("<[^>]*>", "\n", page).split("\n") if x]
    page = f"<html><body>{SURROUNDINGS[0]}{page}{SURROUNDINGS[2]}</body></html>"
    assert pages.main_text(page).split("\n") == wanted


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='content has-sidebar'><article>{LONG * 3}</article></div>",
        f"<div class='with-header no-sidebar'>{LONG * 3}</div>",
        f"<div class='header'><article>{LONG * 3}</article></div>",
        f"<div id=sidebar><div>{LONG * 3}</div></div>",
        f"<article>{LONG * 3}<section id='related-work'><h2 id='search'>S</h2>{LONG}</section></article>",
        f"<article>{LONG * 3}<section id=related><h2 id='search-algorithms'>S</h2>{LONG}</section></article>",
        f"<div><h2 id='search-algorithms'>S</h2>{LONG * 3}</div>",
        f"<div style='overflow:hidden;border:none'>{LONG * 3}</div>",
        f"<div data-class='footer' data-state='hidden'>{LONG * 3}</div>",
        f"<article><div class=widget>{LONG * 3}</div></article>",
        f"<article><div class=header><h1>T</h1></div>{LONG * 3}</article>",
    ],
)
@pytest.mark.parametrize("extra", ["", *SURROUNDINGS])
def test_names_alone_do_not_drop_the_article(page, extra):
    wanted = [x for x in re.sub("<[^>]*>", "\n", page).split("\n") if x]
    page = f"<html><body>{extra}{page}{extra}</body></html>"
    assert pages.main_text(page).split("\n") == wanted


@pytest.mark.parametrize(
    "name",
    ["post-comments", "user-comments", "newsletter-signup-cta", "gdpr-consent", "blog-sidebar",
     "footer-widgets", "adsbygoogle", "most-read", "articleComments"],
)
def test_names_are_told_by_their_last_word(name):
    extra = f"<div class='{name}'><p>Some words, and more of them. Not the article.</p></div>"
    for body in (extra + ARTICLE, ARTICLE + extra, ARTICLE.replace("</article>", extra + "</article>")):
        if name in ("blog-sidebar", "footer-widgets") and body.endswith("</article>") and extra in body[8:-10]:
            continue
        assert pages.main_text(f"<html><body>{body}</body></html>") == WANTED, (name, body)


@pytest.mark.parametrize("seed", range(12))
def test_pages_whose_names_say_nothing(seed):
    rng = random.Random(seed)
    names = rng.sample([f"{a}{b}" for a in "xyzqk" for b in range(9)], 5)
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Entry {i}, more</a></li>" for i in range(6)) + "</ul>"
    note = "<p>This site, like many, is kept by its readers. Thank you.</p>"
    wanted = [f"A sentence, number {i}, with marks. {'And so on. ' * rng.randrange(1, 9)}".strip()
              for i in range(rng.randrange(4, 12))]
    article = "<h1>The title</h1>" + "".join(f"<p>{x}</p>" for x in wanted)
    body = f"<div class={names[0]}>{menu}</div><div class={names[1]}>{article}</div>"
    body += f"<div class={names[2]}>{note}</div><div class={names[3]}>{menu}</div>"
    if seed % 2:
        body = f"<div class={names[2]}>{note}</div>" + body
    assert pages.main_text(f"<html><body>{body}</body></html>").split("\n") == ["The title", *wanted]


def test_parts_of_one_path_and_lone_titles_stay():
    page = f"<body><section>{LONG * 9}</section><section>{LONG}</section></body>"
    assert pages.main_text(page).count("\n") == 9
    page = f"<body><div class=a><h1>T</h1></div><div class=b>{LONG * 9}</div></body>"
    assert pages.main_text(page).startswith("T\n")
    links = "<ul>" + "<li><a href=x>A book, its title</a></li>" * 5 + "</ul>"
    page = f"<body><div class=b>{LONG * 9}{links}</div></body>"
    assert pages.main_text(page).count("A book") == 5
    assert pages.main_text(f"<body>{links}</body>").count("A book") == 5


@pytest.mark.parametrize("inner", ["", "a b, c. "])
def test_deep_pages_take_time_in_proportion(inner):
    start = time.perf_counter()
    text = pages.main_text(f"<div>{inner}" * 100_000 + "deep" + "</div>" * 100_000)
    assert time.perf_counter() - start < 20
    assert text.endswith("deep")


def test_formulas_and_elements_that_are_not_shown():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn>"
    page += "<annotation encoding='t'>x=1</annotation></math> hold.</p>"
    page += "<p style='color:red; DISPLAY : none'>a</p><p aria-hidden=true>b</p><p HIDDEN>c</p>"
    assert pages.main_text(page + "<p hidden=until-found>d</p></article>") == "Let x=1 hold.\nd"


def test_long_comments_are_not_the_article():
    for name in ("comments", "comment-list", "ad-box"):
        page = f"<p>Short, but the article.</p><div class={name}>{LONG * 50}</div>"
        assert pages.main_text(page) == "Short, but the article."
        page = f"<article><p>Short.</p></article><div class={name}><article>{LONG * 50}</article></div>"
        assert pages.main_text(page) == "Short."
    page = f"<article><p>Short.</p></article><div class=sidebar>{LONG * 50}</div>"
    assert pages.main_text(page) == "Short."
    cards = f"<div class=related><article>{LONG}</article></div>"
    assert pages.main_text(f"<article><p>Short.</p></article>{cards}") == "Short."
    assert pages.main_text(f"<div class=text>{LONG * 9}</div>{cards}").count("\n") == 8


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("no tags at all, but text", "no tags at all, but text"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<p>open <b>bold<p>next <i>one", "open bold\nnext one"),
        ("<p>cut <a href='x", "cut"),
        ("<p>cut <!-- never ends", "cut"),
        ("<script>only code", ""),
        ("</div></p><p>x</p></ul>", "x"),
        ("<p>a&nbsp;&#10;b&#x41;&eacute;&unknown;</p>", "a bAé&unknown;"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<p title='a>b'>x</p><p title=it's>y</p>", "x\ny"),
        ("<P CLASS=x>Upper<BR/>case</P>", "Upper\ncase"),
        ("<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>", "one\ntwo\n1\n2\n3"),
    ],
)
def test_odd_markup(page, wanted):
    assert pages.main_text(page) == wanted


def test_long_page_and_extra_columns(spark):
    text = "<p>" + "word, " * 200_000 + "</p>"
    df = spark.createDataFrame(
        [(1, "u", text, "x"), (None, None, None, "y"), (1, "u", text, "x")],
        "page_id long, url string, html string, text string",
    )
    got = pages.extract_pages(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 6 * 200_000 - 1, 6 * 200_000 - 1]


def test_kept_columns_named_like_inner_ones(spark):
    df = spark.createDataFrame([("<p>x y</p>", "a", "b")], "html string, _html string, tag string")
    got = pages.extract_pages(df, ["_html", "tag", "html"]).collect()
    assert [tuple(r) for r in got] == [("a", "b", "<p>x y</p>", "x y", 3)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.extract_pages(df).collect() == []
