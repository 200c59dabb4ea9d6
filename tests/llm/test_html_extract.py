from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from hexloom.llm.html_extract import FEATURES, classify, extract, extract_pages, labelled_pages, labelled_table, labelled_tree, text_blocks

TREE = labelled_tree()
INLINE = {"b", "i", "a", "em", "span", "strong"}


class Article(HTMLParser):
    """The text inside article elements, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag not in INLINE:
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.blocks.append("")
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def by_parser(page):
    p = Article()
    p.feed(page)
    p.close()
    return " ".join(b for b in (" ".join(x.split()) for x in p.blocks) if b)


def test_given_pages_against_another_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = extract_pages(pages).toPandas()
    assert got.columns.tolist() == ["page_id", "url", "text", "n_chars"]
    want = {r.page_id: by_parser(r.html) for r in pages.collect()}
    assert len(got) == len(want) and {r.page_id: r.text for r in got.itertuples()} == want
    assert (got.n_chars == got.text.str.len()).all()


def test_tree_on_pages_it_has_not_seen():
    for seed, least in ((5, 0.99), (99, 0.99)):
        rows, keep = labelled_table(labelled_pages(200, seed))
        assert (classify(TREE, rows) == keep).mean() > least


def test_tree_uses_the_neighbours():
    used = lambda t: set() if len(t) == 1 else {FEATURES[t[0]]} | used(t[2]) | used(t[3])
    assert {"words", "link_density", "link_density_after", "outside"} <= used(TREE)


LINE = "The council met on Tuesday to talk about the new bridge over the river that was planned long ago."


@pytest.mark.parametrize("name", ["layout no-sidebar", "content has-comments", "more-space", "post tag-form", "col with-nav", "post", "", "sidebar-left content"])
def test_names_of_what_is_around_everything(name):
    around = f'<body class="home has-sidebar"><div class="{name}"><h1>Bridge</h1><p>{LINE}</p><p>Yes.</p><p>{LINE}</p></div><div class="sidebar"><p>{LINE}</p></div>'
    assert extract(around, TREE) == f"Bridge {LINE} Yes. {LINE}"
    assert extract(f"<form id=aspnetForm><nav><a href=/>Home</a></nav>{around}</form>", TREE) == f"Bridge {LINE} Yes. {LINE}"


@pytest.mark.parametrize("part", ["<aside>{}</aside>", '<div class="sidebar"><p>{}</p></div>', '<div id="cookie-notice">{}</div>', '<section class="comments"><article class="comment"><p>{}</p></article></section>', '<div class="post-comments"><p>{}</p></div>', '<div role="contentinfo">{}</div>', "<form><p>{}</p></form>", '<ul class="main-nav"><li>{}</ul>', '<article class="related"><p>{}</p></article>'])
def test_other_parts_go(part):
    text = part.format("Something else that is long enough to look like the text of an article, if it were one.")
    for page in (f"<article><p>{LINE}</p></article>{text}", f"{text}<div><p>{LINE}</p></div>", f"<main><p>{LINE}</p>{text}<p>{LINE}</p></main>"):
        assert extract(page, TREE) in (LINE, f"{LINE} {LINE}")
    if "<form>" not in part:
        assert extract(f"<body>{text}", TREE) == ""


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Home</a> Site name</header><div id="cookie-notice">We use cookies here. OK?</div>
<div class="layout"><div class="sidebar"><p>Popular things to read in a long line without links at all.</p></div>
<main><h1>A &lt;b&gt; title</h1><p>First&nbsp;para
graph with <em>in</em>line <a href="/x">link</a>.<p>Second one<br>after break.<ul><li>One item</li><li>Two items here</ul>
<blockquote>Quoted.</blockquote><table><tr><td>cell a<td>cell b</table><script>var a = "</p><p>no";</script>
<aside>Aside text that nobody wants.</aside><form><label>Name</label><input value="x"><button>Send</button></form>
<div class="ad-box">Buy this now, please.</div><p hidden>unseen</p><noscript>Enable scripts</noscript></main>
<section id="comments"><p>A reader says something long enough to look like text of the article itself.</p></section></div>
<nav><ul><li><a href=a>a</a><li><a href=b>b</a></ul></nav><footer>&copy; someone</footer></body></html>"""


def test_parts_of_a_page():
    assert extract(PAGE, TREE) == "A <b> title First para graph with inline link. Second one after break. One item Two items here Quoted. cell a cell b"


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""), ("plain words only", "plain words only"), ("<p>a < b & c</p>", "a < b & c"), ("<p>cut <b", "cut"), ("<p>cut &am", "cut &am"),
        ("<p>x<!-- never closed <p>y", "x"), ("<p>x<script>never closed <p>y", "x"), ('<p title="a>b">x</p>', "x"), ('<p title="open>x</p>', "x"),
        ("<p>&#233;&#x20AC;&amp;amp;&bogus;</p>", "é€&amp;&bogus;"), ("<!-->x<p>y</p>", "x y"), ("</div></p>x", "x"),
    ],
)
def test_broken_pages(page, want):
    assert extract(page, TREE) == want


def test_long_pages_take_time_in_proportion():
    assert len(text_blocks("<b>" * 50_000 + "x")) == 1
    assert len(text_blocks("<p><span>y " * 50_000)) == 50_000
    assert extract("<a href='" + "x" * 200_000, TREE) == ""
    assert extract('<p "' + '"=' * 50_000 + ">z", TREE) is not None


def test_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "<p>z y x w v</p>", "c"), (3, "<p>z y x w v</p>", "c")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in extract_pages(df).collect()) == [(1, "", 0), (2, "", 0), (3, "z y x w v", 9), (3, "z y x w v", 9)]
    assert extract_pages(df.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("page", ['<main><div class="reviews"><p>{}</p></div></main>', "<main><fieldset>{}</fieldset></main>", '<header><a href=/>Site</a> name</header><div class="header-content"><p>{}</p></div>', '<main><section class="legal"><p>{}</p></section></main><nav><a href=/>a</a></nav>'])
def test_a_page_about_what_its_names_say(page):
    text = f"{LINE} {LINE} {LINE}"
    assert extract(page.format(text), TREE) == text


@pytest.mark.parametrize("name", ["share-price", "popular-vote", "form-letter", "related-rates"])
def test_a_paragraph_is_no_part_of_a_page_by_half_a_name(name):
    assert extract(f'<article><p>{LINE}</p><p class="{name}">{LINE}</p></article><nav><a href=/>a</a></nav>', TREE) == f"{LINE} {LINE}"


@pytest.mark.parametrize("name", ["werbung", "kommentare", "anzeige-box", "commentaires", "publicidad", "fusszeile", "barra"])
def test_names_in_other_languages(name):
    assert extract(f'<div><p>{LINE}</p></div><div class="{name}"><p>Something else that is long enough to look like the text of an article, if it were one.</p></div>', TREE) == LINE
