"""Main text extraction: the labelled table, broken markup, the given pages."""

import html
import re

from salesloom.llm import webtext as W
from tests.conftest import SF_SMALL


def plain(page):
    """The given pages' article, read off their own fixed layout."""
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    body = re.sub(r"<[^>]*>?", " ", re.sub(r"</?(?:h1|p)>", "\x01", m.group(1)))
    return "\n\n".join(x for x in (" ".join(html.unescape(y).split()) for y in body.split("\x01")) if x)


def test_tree_fits_its_table_and_an_unseen_page():
    x, y = W.labelled_blocks()
    tree = W.train_tree()
    assert [W.is_main(tree, r) for r in x] == [v == 1 for v in y]
    page = ("<html><head><title>no</title><style>p{}</style></head><body><div class='top-menu'><a href=/>Start</a></div>"
            "<script>if (a<b) document.write('<p>no</p>')</script><article><header><h2>A &amp; B</h2></header><p>One  two\n three"
            "<p>Fo&#117;r<br>five &nbsp;<b>six</b></p><!-- <p>no</p> --><div class=ad>no advert</div><p>End</article>"
            "<section id='comments'><article><p>A reader writes a long comment about the article and its author.</p></article></section>"
            "<aside><p>no</p></aside><form><p>no form</p></form><footer><p>no footer</p></footer>")
    assert W.main_text(page, tree) == "A & B\n\nOne two three\n\nFour five six\n\nEnd"


def test_edge_pages(spark):
    pages = [None, "", "   ", "<", "<p", "<!-- open", "<script>x", "</p></div>", "a < b &am", "<p>" * 2000 + "deep",
             "<article><p>" + "long word " * 60_000]
    df = spark.createDataFrame([(i, "u", p, 3) for i, p in enumerate([*pages, pages[-1]])], "page_id long, url string, html string, n_chars int")
    got = {r["page_id"]: r for r in W.extract(df).collect()}
    assert len(got) == len(pages) + 1 and W.extract(df.limit(0)).collect() == []
    assert got[0]["text"] == got[1]["text"] == "" and got[0]["n_chars"] == 0
    assert got[10]["text"] == ("long word " * 60_000).strip() == got[11]["text"]


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    for r in W.extract(pages).collect():
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_skipped_elements_lose_no_text_behind_them():
    tree = W.train_tree()
    story = "It's said that the council voted on Tuesday to repair the old bridge before winter, after a long debate."
    whole = f"<article><p>{story}</p></article>"

    def same(page):
        got = W.main_text(page, tree)
        assert got == story, (page, got)

    for head in ("<head><title>no</title><meta charset=utf-8>", "<head><script>no</script><noscript><link href=x>",
                 "<head><noscript><img src=x></noscript><style>p{}</style>", "<HEAD><template><p>no"):
        same(f"<html>{head}<body>{whole}")
        same(f"<html>{head}</head>{whole}")
    same(f"<head><title>no</title>{whole}")
    same(f"<head><noscript><link href=x>{whole}")
    same(f"<script>for(i=0;i<n;i++){{}} // don't</script>{whole}")
    same(f"<script>x = '<!--'; y < z</script >{whole}<style>a<b 'x</style foo>")
    for tag in ("noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio", "video"):
        same(f"<article><div><{tag} class=c>no <g>no</g></div><p>{story}</p></article>")
        same(f"<article><p>{story} <{tag}>no <g>no</g><title>no</title></{tag}></article>")
        same(f"<article><p>{story.replace('after', f'<{tag}><title>no</title><g>no</g></{tag}>after')}</p></article>")
    for tag in ("svg", "math"):
        same(f"<article><{tag}><g>no<title>no</title><![CDATA[ <p>no ]]><p>{story}</p></article>")
        same(f"<article><{tag}><desc><p>no</p></desc></{tag}><p>{story}</p></article>")
    same(f"<article><p><video src=x><p>{story}</article>")
    same(f"<article><noscript><style>p{{}}</noscript><p>{story}</p></article>")
    for tag in ("script", "style", "textarea", "title"):
        same(f"{whole}<{tag}>no <p>{story}</p>")


STORY = "It's said that the council voted on Tuesday to repair the old bridge before winter, after a long debate."
MORE = "Nobody spoke against it, though two members left early and one of them wrote a letter."

# Held-out pages in frames of common publishing systems: (markup, 1 for main text) pieces.
HELD_OUT = [
    [("<body class='single no-sidebar'>", 0), (f"<article><p>{STORY}</p><p>Yes.</p></article>", 1)],
    [(f"<div class='content-sidebar-wrap'><main><p>{STORY}</p><p>{MORE}</p></main>", 1),
     (f"<aside class='sidebar sidebar-primary'><p>{MORE}</p></aside></div>", 0)],
    [(f"<article class='post type-post tag-politics'><h1>Bridge</h1><p>{STORY}</p></article>", 1),
     (f"<div class='comments-area'><p>{STORY}</p></div>", 0)],
    [("<html class='js no-touch search'><body class='left-sidebar menu-open header-fixed'><div class='site-header'><a href=/>Start</a></div>", 0),
     (f"<div class='page with-sidebar'><div class=entry-content><p>{STORY}</p><p>{MORE}</p></div>", 1),
     (f"<div class='entry-footer post-tags'><a href=/t>bridges</a></div><div id=sidebar><p>{MORE}</p></div></div>", 0)],
    [("<div class='cookie-banner'><p>We use cookies on this site.</p></div>", 0),
     (f"<div class='layout--has-header'><article class='story category-legal'><p>{STORY}</p><ul><li>One</li><li>Two</li></ul></article></div>", 1),
     (f"<div class='related-articles'><article class='related'><p>{MORE}</p></article></div>", 0)],
    [("<nav class=main-nav><a href=/>Home</a></nav>", 0), (f"<main class='content no-comments'><p>{MORE}</p><p>{STORY}</p></main>", 1),
     (f"<footer class=site-footer><p>{MORE}</p></footer>", 0)],
]


def test_held_out_pages_in_common_frames():
    tree, right, found, truth = W.train_tree(), 0, 0, 0
    for pieces in HELD_OUT:
        page = "".join(m for m, _ in pieces)
        kinds = [k for m, k in pieces for _ in W.blocks_of(m + "</aside></article></main></div>")]
        blocks = W.blocks_of(page)
        assert len(blocks) == len(kinds)
        for (_, features), kind in zip(blocks, kinds, strict=True):
            got = W.is_main(tree, features)
            right, found, truth = right + (got and kind), found + got, truth + kind
    print(f"precision {right}/{found}, recall {right}/{truth}")
    assert right == found == truth


def test_references_stay_within_their_text_and_inline_tags_take_linear_time():
    tree = W.train_tree()
    assert W.main_text(f"<article><p>{STORY} AT&am<b>p;</b> T&amp;T &lt<b>x</b></p></article>", tree) == f"{STORY} AT&amp; T&T <x"
    assert W.main_text(f"<article><p>&#32;<b>&nbsp;</b>{STORY}</p></article>", tree) == STORY
    n = 100_000                                     # 2.7 MB in one paragraph; quadratic time would be hours
    text = W.main_text("<article><p>" + "<b>word</b> <i> </i><b></b>" * n + "</p></article>", tree)
    assert text == " ".join(["word"] * n)
