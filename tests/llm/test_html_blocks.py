"""Block cutting on odd markup, slopes of the network, and extraction on held-out pages."""

import html
import re

import numpy as np
import pytest

from cliploom.llm import html_blocks as H
from cliploom.llm.queries import QUERIES


def texts(page):
    return [t for _, t, _ in H.blocks(page)]


@pytest.mark.parametrize(("page", "expected"), [
    ("", []), ("plain  text\n here", ["plain text here"]), ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b</b><i>c</i>d</p>", ["a bcd"]),
    ("<p>1 &lt; 2 &amp;&nbsp;&eacute; &#65;</p>", ["1 < 2 & é A"]), ("<p>one<br>two</p>", ["one two"]), ("<script>if (a</b) '<p>x</p>'</script><p>y</p>", ["y"]),
    ("<p>a</p><!-- <p>b</p> --><p>c</p>", ["a", "c"]), ("<p title='a > b'>c</p>", ["c"]), ("a < b and c > d", ["a < b and c > d"]), ("<p>a</p><!-- open", ["a"]),
    ("<style>p{}</style", []), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]), ("<head><title>t</title></head><body>b</body>", ["b"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<div>a<hr>b</div></div></p>c", ["a", "b", "c"]), ("<p>&amp;lt;p&amp;gt;</p>", ["&lt;p&gt;"]), ('<p class="x>y</p><p>z</p>', None),
])
def test_blocks(page, expected):
    found = texts(page)
    if expected is not None:
        assert found == expected


ARTICLE = "<article><p>one</p><p>two</p></article>"


@pytest.mark.parametrize("before", [
    "<script>if(s.indexOf('<!--')>=0){}</script>", "<head><style><!-- p{} </style></head><body>", "<div title='<!-- x'></div>", "<textarea><!-- x</textarea>", "<svg><title><!-- x --></title></svg>",
    "<script>s='-->'</script><script>t='<!--'</script>", "<!-->", "<!--->", "<!-- x --!>", "<script>x</script foo>", "<style>x</style/>", "<noscript><style>p{}</noscript>",
    "<div><svg><path d='M0'></div>", "<svg><g>", "<p><canvas>x", "<div><object><param name=a>x</div>", "<div><video><source src=a></div><video>x</video>", "<a href=x><svg><path></a>",
    "<span><svg></span>", "<ul><li><canvas>x<li><math></ul>", "<head><noscript><link></head><body>", "<head><template>x<body>", "<svg><svg></svg><text>x</text></svg>", "<svg><title>x</svg>", "<div><svg></div><!-- </svg> -->", "<td><audio>x</td>",
])
def test_what_stands_before_an_article_does_not_take_it(before):
    assert texts(before + ARTICLE)[-2:] == ["one", "two"]
    assert texts(before + ARTICLE + "<svg><path></svg>")[-2:] == ["one", "two"]
    assert "x" not in texts(before + ARTICLE)


@pytest.mark.parametrize(("page", "expected"), [
    ("<p>a</p><!-- b > <p>c</p> d", ["a"]), ("<p>a</p><!-- <!-- b", ["a"]), ("<p>a</p><script>x<p>b</p>", ["a"]), ("<div>a<svg><text>x</text></svg>b</div>", ["a b"]),
    ("<div>a<video><p>x</p></video>b</div>", ["a b"]), ("<div>a<object><div>x</div></div></object>b</div>", ["a b"]), ("<div>a<canvas>x</div>b", ["a", "b"]), ("<p>a<video><p>x</p></video>b</p>", ["a b"]),
])
def test_unseen_parts_stay_unseen(page, expected):
    assert texts(page) == expected


def test_paths_close_what_they_must():
    found = H.blocks("<body><div class='post main-content'><p>a<p>b</div><footer id=foot>c</footer>")
    assert found[0][0] == ("body", "div", ".content", ".main", ".post", "p") and found[1][0] == found[0][0]
    assert found[2][0] == ("body", "footer", ".foot")


@pytest.mark.parametrize(("path", "expected"), [
    (("body", "article", "p"), "main"), (("body", "p"), None), (("body", "article", "header", "h1"), "main"), (("body", "header", "h1"), "header"),
    (("body", "article", "section", ".comments", "p"), "comments"), (("body", "div", ".ad"), "advert"), (("body", "div", ".cookie", ".notice"), "notice"), (("body", "nav", "ul", "li"), "menu"),
])
def test_purpose(path, expected):
    assert H.purpose(path) == expected


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = H.Labeller(5, 3, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = rng.standard_normal((6, 4, 5)), np.ones((6, 4, 1))
    mask[4:, 1], mask[2:, 3] = 0, 0
    label, weight = rng.integers(0, 2, (6, 4)).astype(float), mask[..., 0] / mask.sum()

    def loss():
        p = net.scores(x, mask)
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum()

    slopes = net.slopes(x, mask, label, weight)
    for k, v in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(n) for n in v.shape)
            old = v[at]
            v[at] = old + 1e-4
            up = loss()
            v[at] = old - 1e-4
            down = loss()
            v[at] = old
            assert slopes[k][at] == pytest.approx((up - down) / 2e-4, abs=1e-5)


def article(page):
    """The blocks of the article of a given page, by pattern."""
    cut = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    found = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in cut]
    return "\n".join(x for x in found if x)


def test_given_pages(spark):
    folder = "/root/testdata/sf0.1"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op9_html_blocks"](spark, folder).collect()
    assert {r["page_id"] for r in rows} == pages.keys() and len(rows) == len(pages)
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in rows)
    assert np.mean([r["text"] == article(pages[r["page_id"]]["html"]) for r in rows]) >= 0.97


def test_odd_pages(spark):
    long = "<p>" + "word " * 50_000 + "</p>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav><ul><li><a href=x>a</a></ul></nav>"), (4, "u", "<article><p>Text of some length, as it is.</p></article>"), (4, "u", "<article><p>Text of some length, as it is.</p></article>"), (5, "u", f"<article>{long * 3}</article>")]
    pages = spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = H.main_text(pages).collect()
    assert sorted(r["page_id"] for r in found) == [1, 2, 3, 4, 4, 5]
    by_id = {r["page_id"]: r for r in found}
    assert by_id[1]["text"] == by_id[2]["text"] == "" and by_id[1]["n_chars"] == 0
    assert by_id[4]["text"] == "Text of some length, as it is."
    assert by_id[5]["text"] == "\n".join([("word " * 50_000).strip()] * 3)
    assert H.main_text(pages.limit(0)).count() == 0
    unnamed = spark.createDataFrame([(1, "u", "<div>a</div><p>b</p>")], "page_id long, url string, html string")
    assert H.main_text(unnamed).first()["text"] == "a\nb"


@pytest.mark.parametrize("page", ["<a " * 50_000, '<a "' * 50_000, "<p>" * 20_000, "<!--" * 50_000, "<script>" * 20_000, "&lt;" * 50_000])
def test_hostile_markup_ends_soon(page):
    import time

    begin = time.time()
    H.blocks(page)
    assert time.time() - begin < 20


@pytest.mark.parametrize("page", [
    "<svg>" * 50_000, "<svg><g>" * 50_000 + "</g>" * 50_000, "<svg></b>" * 50_000, "<svg>" + "</svg " * 50_000 + "<svg>", "<p><canvas>" * 20_000, "<video><style>" * 50_000, "<script>" + "</script " * 50_000, "<!-->" * 50_000, "<!--" * 50_000 + ">",
])
def test_unclosed_unseen_markup_ends_soon(page):
    test_hostile_markup_ends_soon(page)


SAID = "Die Sprache der Landschaft ist alt und reich, und wer sie hört, versteht den Wind."
SHAPES = {
    "<ul><li>erster Punkt der Liste</li><li>zweiter Punkt</li></ul>": ["erster Punkt der Liste", "zweiter Punkt"],
    f"<ol><li>{SAID}</li><li>zwei</li></ol>": [SAID, "zwei"],
    f"<blockquote>{SAID}</blockquote>": [SAID],
    f"<blockquote><p>{SAID}</p></blockquote>": [SAID],
    "<pre>x = 1;\nprint(x)</pre>": ["x = 1; print(x)"],
    "<h2>Ein Zwischentitel</h2>": ["Ein Zwischentitel"],
    "<h3>Kurz</h3>": ["Kurz"],
    f"<div>{SAID}</div>": [SAID],
    f"<section><h2>Noch ein Titel</h2><p>{SAID}</p></section>": ["Noch ein Titel", SAID],
    "<table><tr><th>Jahr</th><th>Wert</th></tr><tr><td>1999</td><td>12</td></tr></table>": ["Jahr", "Wert", "1999", "12"],
    "<figure><img src=x><figcaption>Ein Bild vom See</figcaption></figure>": ["Ein Bild vom See"],
    "<dl><dt>Wort</dt><dd>Erklärung des Wortes</dd></dl>": ["Wort", "Erklärung des Wortes"],
}


@pytest.fixture(scope="module")
def fitted():
    """A labeller fitted on as many given pages as production takes."""
    import pyarrow.parquet as pq

    pages = [p for p in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist() if p]
    return H.fit(pages[: H.Settings().pages], H.Settings())


def kept(net, page):
    return [t for t, s in H.labelled_pages([page], net)[0] if s >= 0.5]


@pytest.mark.parametrize("wrap", ["article", "main", "div id='content'", "div class='post'"])
def test_articles_keep_items_quotations_code_tables_and_subheads(fitted, wrap):
    end = wrap.split()[0]
    for inner, texts in SHAPES.items():
        page = (
            f"<html><head><title>T</title></head><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
            f"<{wrap}><h1>Ein Titel über vieles</h1><p>{SAID} {SAID}</p>{inner}<p>{SAID}</p></{end}><footer><p>Impressum und Kontakt</p></footer></body></html>"
        )
        assert kept(fitted, page) == ["Ein Titel über vieles", f"{SAID} {SAID}", *texts, SAID], inner


def test_an_article_without_names_is_found(fitted):
    """Nothing names it, so its last block may go with what follows it on other pages."""
    page = f"<html><body><div><a href='/x'>Start</a></div><div id='wrap'><h1>Ein Titel über vieles</h1><p>{SAID} {SAID}</p><p>{SAID}</p></div></body></html>"
    assert kept(fitted, page)[:2] == ["Ein Titel über vieles", f"{SAID} {SAID}"]


def test_other_parts_inside_an_article_go(fitted):
    page = f"<html><body><article><h1>Titel eins</h1><p>{SAID}</p><div class='share'>Teilen</div><section class='comments'><p>{SAID}</p></section><aside><p>{SAID}</p></aside><p>{SAID} Ende.</p></article></body></html>"
    assert kept(fitted, page) == ["Titel eins", SAID, f"{SAID} Ende."]
