"""Main text of HTML pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks in page order (a block ends where a
block-level element starts or ends).  A block's features are its number of words
and share of words in links, the same two of the block before and after it, and
what markup encloses it (article or main, navigation and the like, names in class
or id, list or table or form parts, heading).  A small decision tree over these
features, trained on the labelled pages of ``LABELLED``, says which blocks are
main text.  Class and id names count by whole words; names that say what a page has
(``no-sidebar``), what an article is filed under (``tag-legal``) or that a frame
holds the content (``content-sidebar-wrap``) mark nothing, nor do names of html and body,
and a main element is out of whatever frame it stands in.

Pages are read by one forward scan; markup that is cut off, unclosed or wrongly
nested is closed where its parent closes.  Of skipped elements, those of raw text
(script, style, title, textarea) run to their end tag, else to the page's end; the
others are read as markup, so they close with their parent, and svg and math also
at a tag of HTML.  A head ends at its end tag, at the body or at the first tag that
cannot stand in it; text straight in a head is text.  Defined cases: null or empty
html and pages without main text give an empty text; repeated pages give repeated rows;
character references are decoded as browsers do (also without semicolon; one that markup
cuts in two stays as it is); long blocks with much inline markup take linear time; text
outside any element is a block.  Every row is independent: no shuffle, and memory
is bounded by one page.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
from pyspark.sql import DataFrame

from salesloom.llm.common import map_chunks, texts_of
from salesloom.llm.trees import Node, fit_tree

# Fixed values of the HTML language.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul button""".split())
RAW_TAGS = frozenset(["script", "style", "textarea", "title"])                  # what they hold is no markup
SKIPPED_TAGS = frozenset(["noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio", "video"])
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
FOREIGN_TAGS = frozenset(["svg", "math"])
# HTML may stand in these parts of svg and math; anywhere else the second list's tags end them.
HTML_PARTS = frozenset(["foreignobject", "desc", "title", "annotation-xml", "mi", "mo", "mn", "ms", "mtext"])
HTML_ONLY = frozenset("""article aside b big blockquote body br center code dd div dl dt em embed footer h1 h2 h3 h4 h5 h6
head header hr i img li listing main menu meta nav nobr ol p pre ruby s section small span strike strong sub sup table
tt u ul var""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
AWAY_TAGS = frozenset(["nav", "aside", "footer", "form", "menu", "dialog", "select", "button", "fieldset"])
MAIN_TAGS = frozenset(["article", "main"])
LIST_TAGS = frozenset(["li", "td", "th", "dd", "dt", "option"])
OPTIONAL_END = frozenset(["p", "li", "td", "th", "tr", "dt", "dd", "option"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# Words of class and id names that mark parts beside the article, and the article.
AWAY_WORDS = re.compile(
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|comments?|commentlist|replies|reply|respond|disqus|cookies?"
    r"|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|sidebar|side|widget|nav\w*|menu|breadcrumbs?"
    r"|pagination|pager|header|masthead|footer|copyright|legal|share|sharing|social|related|recommend\w*|tags?"
    r"|toolbar|login|signup|search|skip|discussion|reactions?)")
MAIN_WORDS = frozenset("article content post entry story main body text".split())
# Words before another that say what a page or frame has or is filed under, not what the element is.
QUALIFIERS = frozenset("no not has have with without hide show is in".split())
FILED_UNDER = frozenset("tag category type format status".split())
LISTED = frozenset("list cloud links link box bar wrap container".split())
FRAMES = frozenset("wrap wrapper container layout grid row outer inner frame".split())
# Of an article element's own names only these say that it is no article of the page.
NO_ARTICLE = re.compile(r"(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|replies|reply|related|recommend\w*)")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                   r"|<[!?][^>]*(?:>|\Z)|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)|[^<]+|<", re.S)
NAME = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


def names_away(name: str, words: re.Pattern = AWAY_WORDS) -> bool:
    """Whether one class or id name marks a part beside the article: by a whole word of it that is neither
    qualified (no-sidebar), nor a file mark (tag-politics), nor part of a frame's name (content-sidebar-wrap)."""
    parts = [w for w in re.split(r"[-_]+", name.lower()) if w]
    if len(parts) > 1 and (parts[0] in FILED_UNDER and not LISTED & set(parts[1:])
                           or FRAMES & set(parts) and MAIN_WORDS & set(parts)):
        return False
    return any(words.fullmatch(w) and not QUALIFIERS & set(parts[:i]) for i, w in enumerate(parts))


def names_main(name: str) -> bool:
    return any(w in MAIN_WORDS for w in re.split(r"[-_]+", name.lower()))


FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after",
            "in_main", "away", "away_name", "main_name", "in_list", "heading", "page_header"]


def blocks_of(page: str) -> list[tuple[str, list[float]]]:
    """The page's text blocks with their features, in order."""
    found: list[tuple[str, float, list[float]]] = []
    stack: list[tuple[str, list[float]]] = []
    # of the open elements: main, away, away_name, main_name, in_list, heading, page_header, in a link, skipped
    state = [0.0] * 9
    pieces: list[str] = []
    filled = False                # whether the pieces hold more than white space
    linked = 0
    block_state = state

    def end_block() -> None:
        nonlocal linked, pieces, filled
        text = " ".join("".join(pieces).split())
        if text:
            n = len(text.split())
            found.append((text, n, min(1.0, linked / n), block_state[:7]))
        pieces, linked, filled = [], 0, False

    def close(tag: str) -> None:
        nonlocal state
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                state = stack[i][1]
                del stack[i:]
                return
            if stack[i][0] in ("article", "main", "body", "table") and tag not in ("html", "body", "article", "main", "table"):
                return                      # a stray end tag does not close what holds it

    def close_from(i: int) -> None:
        nonlocal state
        state = stack[i][1]
        del stack[i:]

    def foreign() -> int:
        """Where the svg or math begins that the scan is straight in, else -1."""
        at = -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in HTML_PARTS:
                break
            if stack[i][0] in FOREIGN_TAGS:
                at = i
        return at

    ends: dict[str, tuple[int, int]] = {}

    def end_tag(tag: str, at: int) -> tuple[int, int]:
        """Where the next end tag of ``tag`` stands (kept, as ``at`` only grows), else the page's end."""
        if ends.get(tag, (-1, 0))[0] < at:
            m = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            ends[tag] = m.span() if m else (len(page), len(page))
        return ends[tag]

    position = 0
    while position < len(page):
        m = TOKEN.match(page, position)
        position = m.end()
        tag = m.group(2)
        if tag is None:
            text = m.group(0)
            if state[8]:
                if text.startswith("<![CDATA[") and foreign() >= 0:
                    position = page.find("]]>", m.start()) + 3
                    position = position if position > 2 else len(page)
            elif text[0] != "<" or text == "<":
                text = entities.unescape(text)      # of this text alone: markup ends a reference
                if not filled:
                    block_state = state
                    filled = not text.isspace() and text != ""
                pieces.append(text)
                if state[7]:
                    linked += len(text.split())
            continue
        tag, attributes = tag.lower(), m.group(3) or ""
        if m.group(1):
            close(tag)
            if tag in BLOCK_TAGS and not state[8]:
                end_block()
            continue
        alone = attributes.rstrip().endswith("/")
        if tag == "body":
            heads = [i for i, (t, _) in enumerate(stack) if t == "head"]
            if heads:
                close_from(heads[0])
        elif tag not in HEAD_TAGS and stack:
            if stack[-1][0] == "head":
                close_from(len(stack) - 1)
            elif [t for t, _ in stack[-2:]] == ["head", "noscript"] and end_tag("noscript", position)[0] == len(page):
                close_from(len(stack) - 2)
        if state[8]:
            at = foreign() if tag in HTML_ONLY else -1
            if at >= 0:
                close_from(at)
            elif tag in OPTIONAL_END and len(stack) > 1 and stack[-2][0] == tag \
                    and stack[-1][0] in ("iframe", "canvas", "audio", "video"):
                close_from(len(stack) - 1)          # and its parent below, whose end tag may be left out
        if tag in RAW_TAGS and not (state[8] and foreign() >= 0):
            if tag in BLOCK_TAGS and not state[8]:
                end_block()
            if not alone:
                start, end = end_tag(tag, position)
                out = end_tag("noscript", position)[0] if any(t == "noscript" for t, _ in stack) else len(page)
                position = out if out < start else end
            continue
        if state[8] or tag in SKIPPED_TAGS or tag == "head":
            if tag == "head" and not state[8]:
                end_block()
            if tag not in VOID_TAGS and not alone:
                stack.append((tag, state))
                if tag in SKIPPED_TAGS:
                    state = [*state[:8], 1.0]
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK_TAGS:
            end_block()
            if tag == "p" and stack and stack[-1][0] != "p":
                while stack and stack[-1][0] in ("b", "i", "em", "strong", "span", "a", "u", "font", "small") \
                        and any(s[0] == "p" for s in stack):
                    state = stack.pop()[1]  # inline markup left open in an unclosed paragraph
            if tag in OPTIONAL_END and stack and stack[-1][0] == tag:
                state = stack.pop()[1]      # its end tag may be left out
        if tag in VOID_TAGS or alone:
            continue
        stack.append((tag, state))
        state = list(state)
        names = [n for a in NAME.findall(attributes) for v in a[1:] for n in v.split()]
        state[0] = max(state[0], float(tag in MAIN_TAGS))
        hidden = HIDDEN.search(attributes) is not None
        state[1] = max(state[1], float(tag in AWAY_TAGS or hidden))
        if tag in ("html", "body", "main"):         # they hold the article, whatever the frame is called
            state[2] = 0.0
        else:
            words = NO_ARTICLE if tag == "article" else AWAY_WORDS
            state[2] = max(state[2], float(any(names_away(n, words) for n in names)))
        state[3] = max(state[3], float(any(names_main(n) for n in names)))
        state[4] = float(tag in LIST_TAGS) if tag in BLOCK_TAGS and tag != "p" else state[4]
        state[5] = float(tag in HEADINGS) if tag in BLOCK_TAGS else state[5]
        state[6] = max(state[6], float(tag == "header" and not state[0]))
        state[7] = max(state[7], float(tag == "a"))
    end_block()

    out = []
    for i, (text, words, links, where) in enumerate(found):
        before = found[i - 1][1:3] if i else (0, 0.0)
        after = found[i + 1][1:3] if i + 1 < len(found) else (0, 0.0)
        out.append((text, [float(words), links, float(before[0]), before[1], float(after[0]), after[1], *where]))
    return out


_LONG = "The council voted on Tuesday to repair the old bridge before winter, after a long debate about its cost and safety."
_MID = "Work will begin in the spring and last about nine weeks."

# The labelled table: pages as (markup, what its text blocks are) pieces; 1 is main text.
LABELLED: list[list[tuple[str, int]]] = [
    [("<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>About us</a></li></ul></nav>", 0),
     ("<div class=ad>Buy the best shoes in town today.</div>", 0),
     (f"<article><h1>Bridge to be repaired</h1><p>{_LONG}</p><p>Yes.</p><p>{_MID}</p><p>{_LONG} {_LONG}</p></article>", 1),
     ("<footer>&copy; city news &middot; all rights are reserved.</footer>", 0)],
    [("<header><a href=/>The Daily</a><p>News for the whole valley, every day</p></header>", 0),
     (f"<main><h1>Rain</h1><p>Short.</p><p>{_LONG}</p><ul><li>One bridge</li><li>Two roads that were closed</li></ul>"
      f"<blockquote>{_MID}</blockquote></main>", 1),
     (f"<aside><h3>Related</h3><p>{_MID}</p><a href=/x>More stories from the valley</a></aside>", 0),
     ("<form><label>Your name</label><button>Send</button></form>", 0)],
    [("<div id=header><div class=logo>The Valley Paper</div></div>", 0),
     ("<div class=menu><a href=/1>World</a> <a href=/2>Sport</a> <a href=/3>Culture</a></div>", 0),
     (f"<div class=content><h2>A new mill</h2><p>{_LONG}</p><p>No.</p><p>{_LONG}</p><p><a href=/m>The mill</a> opened in May with "
      f"a small party.</p><p>{_MID}</p></div>", 1),
     (f"<div class=comments><h3>Comments</h3><p>I do not agree with this at all, the mill is ugly.</p><p>{_LONG}</p></div>", 0),
     ("<div id=footer><p>Contact us at the office on Mill Road.</p></div>", 0)],
    [(f"<article><h1>Snow</h1><p>{_LONG}</p>", 1), ("<div class=advert>Half price winter coats, only this week.</div>", 0),
     (f"<p>{_MID}</p><p>So it goes.</p>", 1), (f"<section id=comments><p>{_MID}</p><p>First!</p><p>{_LONG}</p></section></article>", 0),
     ("<div class='cookie-notice'>We use cookies to make this site better for you and for us.</div>", 0)],
    [("<div class=sidebar><p>Follow us</p><p>Weather: rain in the morning, sun in the afternoon, ten degrees.</p></div>", 0),
     (f"<div><p>{_LONG}</p><p>{_MID}</p><p>{_LONG}</p></div>", 1), ("<p><a href=/a>Next</a> <a href=/b>Previous</a></p>", 0),
     (f"<div class='newsletter-signup'><p>{_MID}</p></div>", 0)],
    [("<table><tr><td><a href=/>Home</a></td><td><a href=/n>News</a></td></tr></table>", 0),
     (f"<p>{_LONG} {_MID}</p><p>{_LONG}</p>", 1), ("<p><a href=/x>Read all stories about bridges in the valley here</a></p>", 0)],
    [(f"<article><header><h1>Storm</h1></header><p>{_MID}</p><pre>wind 40 gusts 70</pre><table><tr><td>Town</td><td>12</td></tr>"
      f"</table><p>It <a href=/p>passed</a>.</p><p>Then.</p></article>", 1),
     (f"<div class='related-posts'><p>{_LONG}</p><ul><li><a href=/z>Floods</a></li></ul></div>", 0),
     (f"<footer><p>{_LONG}</p></footer>", 0)],
    [(f"<div role=alert class=notice><p>{_LONG}</p></div>", 0), ("<div class=share><a href=/s>Share</a></div>", 0),
     (f"<article><p>{_LONG}</p><p>End.</p></article>", 1), ("<div class=promo><p>Win a trip to the sea.</p></div>", 0)],
    [(f"<main><article><h1>Fish</h1><p>{_LONG}</p><p>Ok.</p></article>", 1),
     (f"<aside class=widget><p>{_LONG}</p></aside><form><p>{_MID}</p></form></main>", 0)],
    [(f"<nav><p>{_LONG}</p></nav>", 0), (f"<article><p><a href=/whole>{_MID}</a></p><h2>Why</h2><p>{_MID}</p></article>", 1),
     (f"<ul class=tags><li>{_MID}</li></ul>", 0)],
    [("<div class=site-header><a href=/>Valley News</a></div>", 0),
     (f"<div class='content-sidebar-wrap'><main class='site-main'><h1>Ice</h1><p>{_LONG}</p><p>No more.</p><p>{_MID}</p></main>", 1),
     (f"<div class='sidebar widget-area'><p>{_MID}</p><p>Most read</p></div></div>", 0),
     ("<div class=site-footer><p>Printed in the valley since the last war.</p></div>", 0)],
    [("<ul class='breadcrumb'><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul>", 0),
     (f"<div class='layout has-sidebar'><article class='post type-post status-publish tag-legal category-social'><h2>Court</h2><p>{_MID}</p>"
      f"<ol><li>First</li><li>Second</li></ol><p>{_LONG}</p></article>", 1),
     (f"<div id=respond><p>{_LONG}</p></div></div>", 0)],
]


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table's blocks; both as they are and in the
    frame of a whole document, so the tree sees pages with and without it."""
    rows, labels = [], []
    for page in LABELLED:
        marks = [len(blocks_of(f"{markup}</article></main></section></div>")) for markup, _ in page]
        kinds = [kind for (_, kind), n in zip(page, marks, strict=True) for _ in range(n)]
        for frame in ("{}", "<html><head><title>x</title></head><body>{}</body></html>"):
            blocks = blocks_of(frame.format("".join(markup for markup, _ in page)))
            assert len(blocks) == len(kinds)
            rows += [features for _, features in blocks]
            labels += kinds
    return np.array(rows), np.array(labels, dtype=float)


def train_tree() -> Node:
    """The block classifier, fitted on the labelled table."""
    x, y = labelled_blocks()
    return fit_tree(x, y, depth=8, min_rows=1)


def is_main(node: Node, features: list[float]) -> bool:
    while node.feature >= 0:
        node = node.low if features[node.feature] <= node.cut else node.high
    return node.value >= 0.5


def main_text(page: str, tree: Node) -> str:
    return "\n\n".join(text for text, features in blocks_of(page) if is_main(tree, features))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    tree = train_tree()

    def start():
        def work(batch):
            texts = [main_text(page, tree) for page in texts_of(batch, html_col)]
            return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
                    "n_chars": [len(t) for t in texts]}

        return work

    kinds = dict(pages.dtypes)
    return map_chunks(pages.select("page_id", "url", html_col), html_col,
                      f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint", start)
