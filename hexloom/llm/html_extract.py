"""Main text of web pages: flat text blocks classified by a small decision tree.

A page becomes a flat list of text blocks, cut at block-level tags. A block has
its word count, its link density (words inside links over words), the same two
numbers of its neighbours, and what its open elements say: whether one of them stands for
something other than the article, by its tag, by a plain name in its class, id, role or label
(``site-footer``) or by a name that only has such a word in it (``more-space``), and whether one of them is
a container of the article.

Names of elements around everything say little: ``layout no-sidebar`` or a form around the whole
page are no sidebar and no form. So where no long block with few links stands free of such
names, the outermost elements that have them and hold an article's container or stand in one, or have
them by half or as a form, lose them, until one does. A page about reviews or a form so keeps its text.

A decision tree keeps or drops each block. It is trained on the blocks of the labelled
pages of ``labelled_pages``, where ``data-keep`` marks the main text.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import small_batches

# Element names by their part in a page.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = set("head title script style noscript template svg math object select option button textarea iframe noembed noframes canvas audio video datalist xmp".split())
OUTSIDE = set("nav header footer aside menu dialog fieldset".split())
INSIDE = set("article main".split())
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Words in a class, id, role or label that name something other than the article.
OUTSIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adbox banner banners sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination toc topbar masthead header footer foot sidebar sidebars aside rail "
    "widget widgets related recommended recommendations more popular trending share sharing social follow subscribe subscription newsletter signup login register "
    "comment comments commentlist discussion disqus reply replies respond reviews notice notices cookie cookies consent gdpr alert alerts popup modal overlay "
    "dialog disclaimer copyright legal form search searchbox tags taglist byline meta skip hidden contentinfo complementary "
    "werbung anzeige anzeigen kommentar kommentare seitenleiste fusszeile kopfzeile navigationsleiste hinweis hinweise teilen "
    "publicite commentaire commentaires partager entete pied anuncio anuncios publicidad comentario comentarios compartir barra pubblicita commenti".split()
)
#: Words in a class, id or role that name the article.
INSIDE_WORDS = set("article articlebody content main maincontent post postbody entry story body text storybody".split())
#: Words that say nothing beside one of the words above, and words before a word that turn it into a property of what is around.
NEUTRAL_WORDS = set("site page block box bar area wrap wrapper container inner outer list item items section group row col column left right top bottom primary secondary global the s".split())
PROPERTY_WORDS = set("no has with without is not hide show js tag category".split())
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "outside", "inside")
#: Elements whose own name says nothing unless it is a plain one: they are text, not a part of the page.
TEXT = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
#: How an element stands for something other than the article: not, by half a name, by a plain name, by its tag.
FREE, HALF_NAMED, NAMED, TAGGED = range(4)
#: Words of a block from which it is long, and the link density below which it has few links.
LONG, FEW_LINKS = 10, 0.3
#: Labelled pages that the tree is trained on, blocks of a leaf at least, and its depth.
LABELLED_PAGES, LEAST_LEAF, DEPTH = 160, 3, 10


_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # a comment, up to the end of the page if it is not closed
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</[^a-zA-Z>][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^\s/>]*((?:[^>\"']|(?<![=\s])[\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN_ATTRIBUTE = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none""", re.I)


@functools.lru_cache(4096)
def part_of_page(name: str, attributes: str) -> tuple[bool, int, bool]:
    """Whether an element is hidden, how it stands outside the article by what it says, and whether it is the article's container."""
    outside, inside = TAGGED if name in OUTSIDE else HALF_NAMED if name == "form" else FREE, name in INSIDE
    if outside < TAGGED and "=" in attributes and name not in ("body", "html", "main"):  # their classes describe the whole page
        found = FREE
        for token in (t for v in _NAMES.findall(attributes) for t in v.strip("\"'").split()):
            words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
            if not words or words[0] in PROPERTY_WORDS:
                continue
            if any(w in OUTSIDE_WORDS for w in words):
                plain = all(w in OUTSIDE_WORDS or w in NEUTRAL_WORDS or w in INSIDE_WORDS for w in words)
                last = next((w for w in reversed(words) if w not in NEUTRAL_WORDS), "")
                if plain and last in INSIDE_WORDS:  # the last word is what it is: the content below a header
                    plain = False
                found = max(found, NAMED if plain else FREE if name in INSIDE or name in TEXT else HALF_NAMED)
            elif any(w in INSIDE_WORDS for w in words):
                inside = True
        if inside and found == NAMED and name not in INSIDE:  # two names that do not agree
            found = HALF_NAMED
        outside = max(outside, found)
    return name in HIDDEN or bool(_HIDDEN_ATTRIBUTE.search(attributes)), outside, inside and outside < NAMED


class Block(NamedTuple):
    """A text block: its text, words, words inside links, how it stands outside the article, whether it is in the article's container, and whether it is labelled as main text."""

    text: str
    words: int
    links: int
    outside: int
    inside: bool
    keep: bool


class _Open(NamedTuple):
    """An open element; all but the name holds if it holds for an open element around it."""

    name: str
    hidden: bool = False
    outside: tuple[int, ...] = ()  # the numbers of the elements that stand outside
    inside: bool = False
    link: bool = False
    keep: bool = False


def text_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    found_blocks: list[tuple[str, int, int, _Open]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack = [_Open("")]
    kinds: list[int] = []  # how each element that stands outside does so
    holds: list[bool] = []  # whether it may lose its name: it has it by half or as a form, or holds an article's container

    def end_block() -> None:
        if parts:
            words = entities.unescape("".join(parts)).split()
            if words:
                links = len(entities.unescape(" ".join(linked)).split()) if linked else 0
                found_blocks.append((" ".join(words), len(words), min(links, len(words)), stack[-1]))
            parts.clear()
            linked.clear()

    opened: Counter[str] = Counter()

    def close(name: str) -> None:
        last = ""
        while last != name:
            last = stack.pop().name
            opened[last] -= 1

    at, n = 0, len(page)
    while at < n:
        found = _TAG.search(page, at)
        start = found.start() if found else n
        if start > at and not stack[-1].hidden:
            piece = page[at:start]
            parts.append(piece)
            if stack[-1].link:
                linked.append(piece)
        if found is None:
            break
        at = found.end()
        named = _NAME.match(page, start)
        if named is None:
            continue
        closing, name = page[start + 1] == "/", named[1].lower()
        if page[at - 1] != ">":  # the page ends inside this tag
            break
        if name not in INLINE:
            end_block()
        if closing:
            if opened[name]:
                close(name)
            continue
        attributes = found[1] or ""
        if name not in INLINE and name not in VOID and opened["p"] and not opened["table"]:
            close("p")  # a block ends an open paragraph
        if name in SIBLINGS and opened[name]:
            for e in reversed(stack):
                if e.name in SIBLINGS[name] or e.name == "":
                    break
                if e.name == name:
                    close(name)
                    break
        if name in VOID or attributes.endswith("/") and name not in INLINE | OUTSIDE | INSIDE | RAW:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        hidden, outside, inside = part_of_page(name, attributes)
        around, marks = stack[-1], stack[-1].outside
        if inside:
            for e in marks:
                holds[e] = holds[e] or kinds[e] < TAGGED
        if outside:
            marks = (*marks, len(kinds))
            kinds.append(outside)
            # A part of an article's container may be what the page is about: its reviews, its form.
            holds.append(outside == HALF_NAMED or inside or around.inside and (outside == NAMED or name == "fieldset"))
        opened[name] += 1
        stack.append(_Open(name, around.hidden or hidden, marks, around.inside or inside, around.link or name == "a", around.keep or "data-keep" in attributes))
    end_block()

    # The outermost names go while no long block is free.
    free = lambda e: not any(kinds[m] for m in e.outside)
    long = [e for _, words, links, e in found_blocks if words >= LONG and links < FEW_LINKS * words]
    while long and not any(free(e) for e in long):
        outermost = {next(m for m in e.outside if kinds[m]) for e in long}
        lost = [m for m in outermost if holds[m]]
        if not lost:
            break
        for m in lost:
            kinds[m] = FREE
    return [Block(text, words, links, max((kinds[m] for m in e.outside), default=FREE), e.inside, e.keep) for text, words, links, e in found_blocks]


def features(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` for each block; there is nothing before the first and after the last."""
    out = np.zeros((len(blocks), len(FEATURES)))
    if blocks:
        words = np.array([b.words for b in blocks], float)
        density = np.array([b.links for b in blocks]) / words
        out[:, 0], out[:, 1] = words, density
        out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
        out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
        out[:, 6] = [b.outside for b in blocks]
        out[:, 7] = [b.inside for b in blocks]
    return out


def train_tree(rows: np.ndarray, keep: np.ndarray, depth: int = DEPTH) -> tuple:
    """A decision tree by Gini impurity: ``(feature, threshold, left, right)`` or a leaf ``(keep,)``. Ties: lowest feature, lowest threshold."""
    share = keep.mean()
    if depth == 0 or share in (0, 1):
        return (bool(share >= 0.5),)
    best = (2 * share * (1 - share) - 1e-12, None, 0.0)
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= t
            if min(low.sum(), (~low).sum()) < LEAST_LEAF:
                continue
            a, b = keep[low].mean(), keep[~low].mean()
            impurity = low.mean() * 2 * a * (1 - a) + (~low).mean() * 2 * b * (1 - b)
            if impurity < best[0] - 1e-12:
                best = (impurity, f, t)
    if best[1] is None:
        return (bool(share >= 0.5),)
    low = rows[:, best[1]] <= best[2]
    below, above = train_tree(rows[low], keep[low], depth - 1), train_tree(rows[~low], keep[~low], depth - 1)
    return below if below == above and len(below) == 1 else (best[1], best[2], below, above)


def classify(tree: tuple, rows: np.ndarray) -> np.ndarray:
    """The tree's answer for each row of features."""
    if len(tree) == 1:
        return np.full(len(rows), tree[0])
    low = rows[:, tree[0]] <= tree[1]
    out = np.zeros(len(rows), bool)
    out[low], out[~low] = classify(tree[2], rows[low]), classify(tree[3], rows[~low])
    return out


def labelled_pages(pages: int = LABELLED_PAGES, seed: int = 5) -> list[str]:
    """Pages made by a rule, the same for the same seed; what is main text is in elements with ``data-keep``.

    The article stands in an element that says so, in one that only has a class for its looks, in a form around the page or in none.
    Menus, notices, sidebars, adverts and comments have tags or names or, as lists and lines of links with a heading,
    nothing but their links.
    """
    r = random.Random(seed)
    sentence = "the council met on tuesday to talk about a new bridge over the river which nobody has seen for more than ten years".split()

    def words(n: int) -> str:
        return " ".join(r.choice(sentence) for _ in range(n))

    def links(n: int, most: int = 4) -> list[str]:
        return [f"<a href=/{k}>{words(r.randint(1, most))}</a>" for k in range(n)]

    def menu() -> str:
        return f"<ul>{''.join(f'<li>{x}' for x in links(r.randint(2, 7)))}</ul>"

    def paragraph(keep: bool) -> str:
        n = r.choice([1, 2, 3, 5, 8, 9, 12, 18, 25, 40, 70, 150])
        linked = int(n * r.choice([0, 0, 0, 0, 0, 0.1, 0.2, 0.35, 0.45]))
        tag = r.choice(["p", "p", "p", "h2", "li", "blockquote"]) if linked == 0 else "p"
        text = words(n - linked)
        return f"<{tag}{' data-keep' * keep}>" + (f"{text} {f'<a href=x>{words(linked)}</a>'}" if linked else text) + f"</{tag}>"

    def named(text: str) -> str:
        tag, name = r.choice([("div", x) for x in ("ad", "sidebar", "site-footer", "cookie-notice", "comment-list", "related", "share", "newsletter", "promo-7b", "ad-slot-x")] + [(t, "") for t in ("nav", "aside", "footer", "header")])
        return f"<{tag} class='{name}'>{text}</{tag}>"

    def beside(marked: bool) -> str:
        kind = r.randrange(6)
        if kind < 3:
            return named("".join(paragraph(False) for _ in range(r.randint(1, 4))) if kind else menu())
        if kind == 3:
            return f"<div><p>{words(r.randint(1, 3))}</p>{menu()}</div>"
        if kind == 4:
            return f"<div>{' | '.join(links(r.randint(2, 5)))}</div>"
        return "<div>" + "".join(f"<p>{x}</p>" for x in links(r.randint(2, 5), 8)) + "</div>"

    def article(marked: bool) -> str:
        parts = [f"<h1 data-keep>{words(r.randint(2, 9))}</h1>"] * (r.random() < 0.7)
        for _ in range(r.randint(1, 9)):
            parts.append(paragraph(True))
            if r.random() < 0.15:
                parts += [f"<p data-keep>{words(40)}</p>", f"<p data-keep>{links(1)[0]}</p>", f"<p data-keep>{words(30)}</p>"]
            if r.random() < 0.25:
                parts.append(named(r.choice([paragraph(False), menu(), links(1, 9)[0]])))
            if r.random() < 0.05:
                parts += [f"<p data-keep>{words(40)}</p>", named(links(1, 6)[0]), f"<p data-keep>{words(50)}</p>"]
            if marked and r.random() < 0.1:
                parts.append(menu())
        return "".join([*parts, f"<p data-keep>{words(r.randint(10, 60))}</p>"])

    out = []
    for _ in range(pages):
        tag, name = r.choice([("article", ""), ("main", "post"), ("div", "content"), ("div", "entry-body"), ("div", "layout no-sidebar"), ("div", "content has-comments"), ("div", "more-space"), ("div", "post tag-form"), ("form", ""), ("div", ""), ("div", "")])
        marked = tag in INSIDE or any(w in INSIDE_WORDS for w in _WORDS.findall(name))
        body = f"<{tag} class='{name}'>{article(marked)}</{tag}>"
        out.append("<body>" + "".join(beside(marked) for _ in range(r.randint(0, 3))) + body + "".join(beside(marked) for _ in range(r.randint(0, 3))))
    return out


def labelled_table(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The features of the blocks of labelled pages, and whether each is main text."""
    blocks = [text_blocks(p) for p in pages]
    return np.concatenate([features(b) for b in blocks]), np.array([x.keep for b in blocks for x in b])


def labelled_tree(pages: list[str] | None = None) -> tuple:
    """The tree of labelled pages."""
    return train_tree(*labelled_table(labelled_pages() if pages is None else pages))


def extract(page: str, tree: tuple) -> str:
    """The main text of one page: kept blocks in page order, joined by one space."""
    blocks = text_blocks(page)
    keep = classify(tree, features(blocks))
    return " ".join(b.text for b, k in zip(blocks, keep) if k)


def extract_pages(pages: DataFrame, html: str = "html", labelled: list[str] | None = None) -> DataFrame:
    """Every row of ``pages`` with its main text (text, empty if there is none) and its number of code points (n_chars).

    ``labelled`` replaces the labelled pages; their number is the caller's, a few hundred
    blocks are meant. The column ``html`` is not returned; columns named text or
    n_chars are replaced.

    A null or empty page has an empty text. A page is read whole; an unclosed
    comment, script or tag reaches to its end. Repeated rows each get a result.
    """
    small_batches(pages.sparkSession)
    tree = labelled_tree(labelled)
    own = [f for f in pages.schema.fields if f.name not in {html, "text", "n_chars"}]
    schema = StructType([*own, *StructType.fromDDL("text string, n_chars bigint").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [extract(page or "", tree) for page in batch["\0html"]]
            yield batch.drop(columns="\0html").assign(text=texts, n_chars=[len(t) for t in texts])

    return pages.select(*[f.name for f in own], pages[html].alias("\0html")).mapInPandas(run, schema)
