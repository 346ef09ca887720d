import pytest

from chronotape.llm.extraction import extract_text, main_text
from chronotape.llm.html_blocks import read_page

LONG = "The first paragraph of the story tells at length what happened on that day."
NEXT = "The second one goes on about it, with more words than any menu would have."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain words only", "plain words only"),
        (f"<article><h1>Title</h1><p>{LONG}<p>{NEXT}</article>", f"Title {LONG} {NEXT}"),
        (f"<body><nav><a href='/'>Home</a></nav><div class=ad>Buy</div><article><p><b>{LONG}<br><p>{NEXT}</article><footer>&copy; me</footer>", f"{LONG} {NEXT}"),
        (f"<main><p>a &amp; b &lt;c&gt; &#233; &nbsp; d</p><p>{LONG}</p></main>", f"a & b <c> é d {LONG}"),
        (f"<div id=content><p>{LONG}</p><script>var a = '<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> --><p>{NEXT}</p></div>", f"{LONG} {NEXT}"),
        (f"<div class='post'><p>{LONG}</p></div><div class='comments'><p>{NEXT}</p><p>{NEXT}</p></div>", LONG),
        (f"<div class='post-body'><p>{LONG}</p><aside>Side</aside><form>Mail <input></form></div><div class='cookie-notice'>We use cookies</div>", LONG),
        (f"<header><h1>Site</h1></header><article><header><h1>Story</h1></header><p>{LONG}</p></article>", f"Story {LONG}"),
        (f"<div class='with-sidebar'><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></div>", f"{LONG} one two x y"),
        (f"<article><p>in<b>li</b>ne <i>text</i>\n\t more</p>{LONG}</article>", f"inline text more {LONG}"),
        ("<p>2 < 3 and 4 > 1 <unclosed", "2 < 3 and 4 > 1 <unclosed"),
        (f"<head><title>No</title><body><p>{LONG}", LONG),
        (f"<article>{LONG}<textarea>no</textarea></article></div></div>", LONG),
    ],
)
def test_main_text(html, text):
    assert main_text(html, None) == text


def test_long_and_broken_pages_end():
    assert main_text("<div>" * 30_000 + "deep", None) == "deep"
    assert len(main_text("<p>word " * 20_000, None)) == 5 * 20_000 - 1
    assert read_page("<a href=\"" * 300).blocks


def page(k, inner, host="h.example"):
    return (k, f"https://www.{host}/p/{k}?x#y", inner)


def template(body, extra=""):
    return f"<html><body><div class='top7'>Welcome everybody to this place</div><div class='col3'>{body}</div>{extra}</body></html>"


def test_hosts_vote(spark):
    # alone, the last page's longest part is a teaser; its host's other pages say where the text is
    rows = [page(k, template(f"<p>{LONG} {k}</p><p>{NEXT}</p>")) for k in range(8)]
    rows += [page(50, template("<p>A short note, but the text of this page it is.</p>", f"<div class='tease'>{NEXT[:60]}</div>"))]
    rows += [(60, None, None), (61, "no url", f"<article>{LONG}</article>"), (62, "http://other.example", ""), (None, "http://h.example/", template(LONG))]
    rows += [rows[0]]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, text string")
    out = extract_text(pages).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert got[0].text == f"{LONG} 0 {NEXT}" and got[0].path == "html/body/div.col0" and got[0].host == "h.example"
    assert got[50].text == "A short note, but the text of this page it is."
    assert got[60].text == got[62].text == "" and got[61].text == LONG and got[None].text == LONG


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div class=post><p>{LONG}</p><div class=body><p>{NEXT}</p><p>{LONG}</p><p>{NEXT}</p></div></div>", f"{LONG} {NEXT} {LONG} {NEXT}"),
        (f"<body><section><p>{LONG}</p><p>{NEXT}</p><p>{LONG}</p></section><section><p>{NEXT}</p></section>", f"{LONG} {NEXT} {LONG} {NEXT}"),
        (f"<div class=post><blockquote><p>{LONG}</p><p>{NEXT}</p><p>{LONG}</p></blockquote><p>{NEXT}</p></div>", f"{LONG} {NEXT} {LONG} {NEXT}"),
        (f"<main><article><p>{LONG}</p><p>{LONG}</p></article><section><p>{NEXT}</p></section></main>", f"{LONG} {LONG} {NEXT}"),
    ],
)
def test_all_article_text_is_held(html, text):
    assert main_text(html, None) == text


ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>{NEXT}</p></article>"
SIDE = "<div class='sidebar'><p>Read this too.</p></div>"


@pytest.mark.parametrize(
    "html",
    [
        f"<body><div class='content-sidebar-wrap'>{ARTICLE}{SIDE}</div>",
        f"<body><p>Hello</p><div class='layout sidebar-right'><div id='search-results-article'>{ARTICLE}</div>{SIDE}</div>",
        f"<body><form id='aspnetForm'><nav>Home</nav>{ARTICLE}<div class='comments'><article class='comment'><p>{LONG}</p></article></div></form>",
        f"<body><form><div class='page-overlay'><p>Title</p><p>{LONG}</p><p>{NEXT}</p></div></form>",
        f"<body><x-app class='has-widget widget-area'>{ARTICLE}</x-app>",
    ],
)
def test_wrappers_named_like_boilerplate_keep_their_article(html):
    assert main_text(html, None) == f"Title {LONG} {NEXT}"


def test_boilerplate_stays_out_where_a_text_is_read():
    comments = f"<div class='comments'><article class='comment'><p>{LONG}</p></article><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body><div class='post'><p>{NEXT}</p></div>{comments}{SIDE}", None) == NEXT
    assert main_text(f"<body><div class='sidebar-wrap'>{ARTICLE}{comments}</div>", None) == f"Title {LONG} {NEXT}"


def test_a_hosts_path_may_not_cost_article_text():
    html = f"<body><div class=a><p>{LONG}</p></div><div class=b><p>{NEXT}</p><p>{NEXT}</p></div>"
    assert main_text(html, "body/div.a") == f"{LONG} {NEXT} {NEXT}"


def test_empty(spark):
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
