"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags.  Each block has its word count and link
density, those of its neighbours, and whether it stands inside an article and inside
boilerplate (a menu, header, footer, sidebar, notice, advert, form or reader comments,
by tag, role, class or id).  A decision tree, trained with Spark ML on the labelled
table below, tells main text from the rest; its splits then run where the blocks are
made, so a page is read once and nothing is shuffled.

Defined cases: null or empty html gives an empty text; unclosed tags, comments, scripts
and a cut-off tag at the end are tolerated, and a value whose quote never closes ends with
its tag; character references are decoded; pages without an article are judged by words
and links alone; very long and broken pages take time in step with their length; repeated
rows are read row by row; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Tags of HTML by what they do to text.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
optgroup option p pre section select summary table tbody td tfoot th thead tr ul""".split())
UNSEEN_TAGS = frozenset("head iframe math noscript object script style svg template textarea title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())   # no tags inside
HEAD_TAGS = frozenset("base link meta noscript script style template title".split())
CELLS = frozenset("td th".split())
# Open elements that an opening tag closes, where they are the innermost block.
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "td": CELLS, "th": CELLS,
             "tr": CELLS | {"tr"}, "tbody": CELLS | {"tr", "thead", "tbody"}, "tfoot": CELLS | {"tr", "thead", "tbody"}}
LAYOUT_TAGS = frozenset("nav footer menu button select".split())
FORM_TAGS = frozenset("form fieldset".split())
ASIDE_TAGS = frozenset("aside dialog".split())
LAYOUT_ROLES = frozenset("navigation banner contentinfo menu menubar".split())
FORM_ROLES = frozenset("search form".split())
ASIDE_ROLES = frozenset("complementary dialog alert alertdialog".split())
# Names of classes and ids.  The word a name ends in says what the element is ("site-footer"), after words for
# boxes and places ("share-buttons", "sidebar-left"); a first word of STATE_WORDS makes it a state ("with-sidebar").
LAYOUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent
cookie cookies copyright footer form gdpr login masthead menu modal nav navbar navigation newsletter notice pager
pagination popup promo search share sharing signup social sponsor sponsors subscribe subscription toolbar topbar
""".split())
ASIDE_WORDS = frozenset("""aside comment commentlist comments disqus discussion related replies reply respond sidebar
widget widgets""".split())
ASIDE_LEADS = frozenset("promoted recommended related sponsored".split())
HEADER_WORDS = frozenset("header head top".split())
BOX_WORDS = frozenset("""area bar block bottom box button buttons col column container group icons inner item items left
link links list outer panel primary right row secondary section top wrap wrapper""".split())
STATE_WORDS = frozenset("can hide has is no not show with without".split())
ARTICLE_NAMES = frozenset("""article article-body article-content articlebody content entry entry-content main
main-content post post-body post-content story story-body""".split())

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "in_article", "boilerplate")
# The labelled table: pages as rows of blocks, each block of a kind with (link density,
# in_article, boilerplate, sizes in words, 1 for main text).  in_article is 1 inside, 0 outside
# the article of a page that has one, 0.5 on pages without.
ANY_SIZE, SHORT, LONG = (1, 9, 60, 3, 250, 15, 2, 30, 5), (1, 4, 7, 2, 5, 3), (25, 60, 18, 120, 40, 250)
KINDS = {
    "t": (0.0, 1.0, 0, ANY_SIZE, 1), "k": (0.4, 1.0, 0, ANY_SIZE, 1), "s": (1.0, 1.0, 0, ANY_SIZE, 1),
    "l": (1.0, 1.0, 0, SHORT, 0), "c": (0.0, 1.0, 1, ANY_SIZE, 0), "g": (1.0, 1.0, 1, SHORT, 0),
    "m": (1.0, 0.0, 1, SHORT, 0), "f": (0.0, 0.0, 1, ANY_SIZE, 0), "o": (0.0, 0.0, 0, ANY_SIZE, 0),
    "p": (1.0, 0.0, 0, SHORT, 0), "q": (0.5, 0.0, 0, ANY_SIZE, 0),
    "T": (0.0, 0.5, 0, LONG, 1), "K": (0.2, 0.5, 0, LONG, 1), "h": (0.0, 0.5, 0, SHORT, 1),
    "x": (0.0, 0.5, 0, SHORT, 0), "L": (1.0, 0.5, 0, SHORT, 0), "R": (0.8, 0.5, 0, LONG, 0),
    "F": (0.0, 0.5, 1, ANY_SIZE, 0), "M": (1.0, 0.5, 1, SHORT, 0),
}
LAYOUTS = ("mmmftttttttf", "ftktcttkttff", "ooptstttqttoo", "tttllllt", "mtccccctgggf", "fotttkttsttppf", "t", "tt",
           "MMMFTThTKhTTF", "LLLxLTTTKhTTRLLx", "hTTKThT", "xLLxxLLx", "FTTTFF", "LLhTTTxLL", "FhKF",
           "LLThTKTL", "LTL", "LThTLx", "LKhTLL", "MThTF", "st", "stt", "sk", "ts", "s", "mstf", "mttsf")


def labelled_table() -> list[tuple[float, ...]]:
    """Rows of FEATURES and the label: every layout with the sizes of its blocks shifted in turn."""
    rows = []
    for shift in range(len(ANY_SIZE)):
        for layout in LAYOUTS:
            kinds = [KINDS[k] for k in layout]
            size = [(k[3][(shift + i) % len(k[3])], k[0]) for i, k in enumerate(kinds)]
            around = [(0, 0.0), *size, (0, 0.0)]
            rows += [(*size[i], *around[i], *around[i + 2], k[1], k[2], k[4]) for i, k in enumerate(kinds)]
    return rows


# One pass, as the states of the HTML tokenizer: a quote opens a value only after "=".  Possessive throughout, and a
# tag without an end runs to the end of the page, so no place is scanned twice.
_WS = r"[ \t\n\f\r]"
_VALUE = r""""[^"]*+"|'[^']*+'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+"""
_TOKEN = re.compile(rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(/?)([a-zA-Z][^\ \t\n\f\r/>]*+)((?:(?:{_WS}|/)++|=?[^\ \t\n\f\r/>=]++(?:{_WS}*+={_WS}*+(?:{_VALUE})?+)?+|=)*+)(?:>|\Z)
    |<[!?/][^>]*+>?""".replace("[ ", "[\\ ").replace("[^ ", "[^\\ "), re.S | re.X)
_ATTRIBUTE = re.compile(rf"(=?[^ \t\n\f\r/>=]++)(?:{_WS}*+={_WS}*+({_VALUE})?+)?+")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(maxsize=len(RAW_TAGS))
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[ \t\n\f\r/>])[^>]*+>?|\Z", re.I)


@lru_cache(maxsize=4096)
def _role(name: str) -> str:
    """What the name of a class or id says: "layout", "aside", "header" or nothing."""
    words = [w.lower() for w in _NAME_PART.findall(name)]
    if not words or words[0] in STATE_WORDS:
        return ""
    if words[0] in ASIDE_LEADS:
        return "aside"
    while len(words) > 1 and words[-1] in BOX_WORDS:
        words.pop()
    last = words[-1]
    return ("layout" if last in LAYOUT_WORDS else "aside" if last in ASIDE_WORDS
            else "header" if last in HEADER_WORDS else "")


class _Place:
    """What the open elements say of the text inside them."""

    __slots__ = ("tag", "link", "unseen", "layout", "form", "aside", "article", "weak")

    def __init__(self, tag="", link=False, unseen=False, layout=False, form=False, aside=False, article=False, weak=False):
        self.tag, self.link, self.unseen = tag, link, unseen
        self.layout, self.form, self.aside, self.article, self.weak = layout, form, aside, article, weak


def _place(tag: str, attributes: str, up: _Place) -> _Place:
    """The place inside an opening tag that stands in ``up``.

    An article ends what a page-wide layout or form says of it, but not what a sidebar or
    reader comments say; so does main, and an element named as content ends a form."""
    layout, form, aside, header = tag in LAYOUT_TAGS, tag in FORM_TAGS, tag in ASIDE_TAGS, tag == "header"
    article, main, unseen, roles, content = tag == "article", tag == "main", tag in UNSEEN_TAGS, set(), False
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name = name.lower()
        if name not in ("class", "id", "role", "itemprop", "hidden", "aria-hidden", "style"):
            continue
        value = entities.unescape(value[1:-1] if value[:1] in ("'", '"') else value)
        low = value.lower().strip()
        if name in ("class", "id"):
            if tag not in ("html", "body"):
                names = value.split()
                content = content or not ARTICLE_NAMES.isdisjoint(low.split())
                roles.update(map(_role, names))
        elif name == "role":
            layout, form, aside = layout or low in LAYOUT_ROLES, form or low in FORM_ROLES, aside or low in ASIDE_ROLES
            main = main or low == "main"
        elif name == "itemprop":
            article = article or low == "articlebody"
        elif name == "hidden" or name == "aria-hidden" and low == "true":
            unseen = True
        elif name == "style" and "display:none" in low.replace(" ", ""):
            unseen = True
    if not content and not main:                    # "content sidebar" is the content
        aside = aside or "aside" in roles
        if not article:                             # what an article is called does not make it layout
            layout, header = layout or "layout" in roles, header or "header" in roles
    outer = not up.article
    frame = article or main and outer
    return _Place(tag, up.link or tag == "a", up.unseen or unseen,
                  layout or (header and outer and not article) or (up.layout and not frame),
                  form or (up.form and not frame and not (content and outer)),
                  up.aside or aside, up.article or article, up.weak or main or content)


class _Open:
    """The open elements.  Places of each name and of the blocks are kept in lists, so that an end
    tag without an open element costs nothing."""

    def __init__(self):
        self.stack, self.at, self.scopes = [_Place()], defaultdict(list), []

    @property
    def top(self) -> _Place:
        return self.stack[-1]

    def push(self, place: _Place) -> None:
        self.at[place.tag].append(len(self.stack))
        if place.tag in BLOCK_TAGS or place.tag in UNSEEN_TAGS:
            self.scopes.append(len(self.stack))
        self.stack.append(place)

    def scope(self) -> str:
        """The tag of the innermost block."""
        return self.stack[self.scopes[-1]].tag if self.scopes else ""

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            self.at[self.stack.pop().tag].pop()
        while self.scopes and self.scopes[-1] >= k:
            self.scopes.pop()

    def close(self, tag: str) -> None:
        """An inline element is not closed across a block that opened in it."""
        if self.at[tag]:
            k = self.at[tag][-1]
            if tag in BLOCK_TAGS or tag in UNSEEN_TAGS or not self.scopes or k > self.scopes[-1]:
                self.cut(k)

    def make_room(self, tag: str) -> None:
        """Close what ``tag`` closes by opening."""
        if self.scope() == "head" and tag not in HEAD_TAGS:
            self.close("head")
        if tag in BLOCK_TAGS and self.scope() == "p":
            self.close("p")
        while self.scope() in CLOSED_BY.get(tag, ()):
            self.cut(self.scopes[-1])


def blocks(page: str) -> list[dict]:
    """Text blocks in page order: text, words, link words, boilerplate, article, weak."""
    out, pieces, link_words = [], [], 0
    tree = _Open()

    def flush():
        nonlocal pieces, link_words
        words = "".join(pieces).split()
        if words:
            p = tree.top
            out.append({"text": " ".join(words), "words": len(words), "links": min(link_words, len(words)),
                        "boilerplate": p.layout or p.form or p.aside, "article": p.article, "weak": p.weak})
        pieces, link_words = [], 0

    def say(raw):
        nonlocal link_words
        if tree.scope() == "head" and raw.strip():
            tree.close("head")
        p = tree.top
        if raw and not p.unseen:
            text = entities.unescape(raw)
            pieces.append(text)
            if p.link:
                link_words += len(text.split())

    at = 0
    for m in iter(lambda: _TOKEN.search(page, at), None):
        say(page[at:m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag or not m.group().endswith(">"):      # a comment, or cut off
            continue
        if tag in BLOCK_TAGS:
            flush()
        if m.group(1):
            tree.close(tag)
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in VOID_TAGS:
            continue
        if tag in RAW_TAGS:
            end = _raw_end(tag).search(page, at)
            if tag == "xmp":
                pieces.append(page[at:end.start()] if not tree.top.unseen else "")
            at = end.end()
            continue
        tree.make_room(tag)
        tree.push(_place(tag, m.group(3), tree.top))
    say(page[at:])
    flush()
    return out


def features(found: list[dict]) -> list[tuple[float, ...]]:
    """FEATURES of each block of a page."""
    strong, weak = any(b["article"] for b in found), any(b["weak"] for b in found)
    size = [(b["words"], b["links"] / b["words"]) for b in found]
    around = [(0, 0.0), *size, (0, 0.0)]
    rows = []
    for k, b in enumerate(found):
        inside = b["article"] if strong else b["weak"]
        rows.append((*size[k], *around[k], *around[k + 2],
                     float(inside) if strong or weak else 0.5, float(b["boilerplate"])))
    return rows


@lru_cache(maxsize=4)
def train(spark: SparkSession) -> tuple:
    """The tree as nested (feature, threshold, at most, above) tuples with 0.0 or 1.0 as leaves."""
    table = spark.createDataFrame([(float(r[-1]), Vectors.dense(r[:-1])) for r in labelled_table()], ["label", "features"])
    model = DecisionTreeClassifier(maxDepth=8, seed=1).fit(table.coalesce(1))
    lines = iter(x.strip() for x in model.toDebugString.splitlines()[1:])

    def node():
        line = next(lines)
        if line.startswith("Predict:"):
            return float(line.split()[1])
        index, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        at_most = node()
        next(lines)                                  # the matching Else
        return int(index), float(threshold), at_most, node()

    return node()


def is_main(tree: tuple | float, row: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree == 1.0


def main_text(page: str | None, tree: tuple) -> str:
    found = blocks(page) if page else []
    return "\n\n".join(b["text"] for b, row in zip(found, features(found)) if is_main(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` plus text and n_chars (its code points)."""
    tree = train(pages.sparkSession)

    @F.arrow_udf(StringType())
    def text(batch: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py(), tree) for page in batch], pa.string())

    return pages.withColumn("text", text("html")).withColumn("n_chars", F.length("text").cast("bigint"))
