"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by themselves: parts that a page
marks as not being the article (menus, headers, footers, asides, forms, scripts, adverts, notices, reader comments, hidden
parts) and blocks made of links are out; blocks that are long and have a normal share of stop words are in. Long ones without are out beside an
``article`` or ``main`` element, else left open like short blocks. The second pass gives each open
block the label of the nearest decided block on its side, within such elements or outside of all (equally near ones: a heading that of the block after it,
others are in if one of the two is). Parts that are marked out say nothing about their neighbours. Where no block within is decided, those within are in unless the text that is in outside is longer;
outside, open blocks are then in on a page without such elements. An article in a part that is out is out too, unless only a form holds it.

Scale. One narrow pass over whole pages in Arrow batches, no shuffle; memory is bounded by the longest page, time is linear in it
whatever its markup (end tags of nothing, elements that are never closed).

Defined results. NULL, empty and unmarked html: the text of the latter is one block. Unclosed and misplaced tags never fail: an end tag
closes the nearest open element of its name, else nothing. White space is any Unicode white space. Repeated rows each get the same result. Empty
tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import ship

#: A block of fewer characters is left open in the first pass.
SHORT = 70
#: A block with a larger share of its characters in links is out.
MAX_LINKS = 0.5
#: A long block with at least this share of stop words is in. Measured on 600 given pages: nine tenths of the long blocks of
#: articles have more, a quarter of them less than 0.25.
STOP_SHARE = 0.12

# Frequent words of the languages that are told apart by stop words.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with his they at be this from have or by one had not but what all were when"
    " your can said there use an each which she do how their if will up other about out many then them these so some her would"
    " le la les de des du un une et à est que qui dans en pour par sur au aux avec ce se pas plus ne son sa ses il elle nous vous"
    " der die das und ist in den von zu mit sich des auf für nicht ein eine im dem auch als an es er sie wie nach bei oder aus"
    " el los las del y por con no una su para al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre".split()
)
# Tags that begin or end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody"
    " td tfoot th thead title tr ul".split()
)
# Elements whose text is never part of the article.
OUT_TAGS = frozenset(
    "head nav footer aside form noscript template svg iframe object canvas button select datalist dialog menu audio video map".split()
)
# Elements whose content is not markup.
RAW_TAGS = frozenset(("script", "style", "textarea", "title", "xmp", "noembed", "noframes"))
# Elements that are kept on the stack of open ones: those that decide about what they hold.
OPEN_TAGS = (BLOCK_TAGS | OUT_TAGS | {"a", "span"}) - {"hr", "p", "br", "li", "td", "th", "tr", "dd", "dt", "option", "html", "body"}
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class names, ids and roles of such parts.
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " notices alert popup modal overlay sidebar aside nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer comment"
    " comments respond replies disqus discussion share sharing social related recommended newsletter subscribe signup login search"
    " pagination pager widget toolbar contentinfo complementary copyright legal disclaimer".split()
)
# The head of an article is part of it, whatever it is named.
ARTICLE_NAMES = frozenset(("article", "entry", "post", "story"))
# Names that begin with one of these say what a part has or lacks.
BESIDE = frozenset(("no", "has", "with", "without", "is", "not", "hide", "show"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    #: Characters of the text that stand in links.
    linked: int
    #: Whether the page marks it as something else than the article.
    out: bool
    #: Whether it stands in an article or main element.
    inside: bool
    heading: bool


def marked_out(tag: str, attributes: str) -> bool:
    """Whether the names of an element say that it is not part of the article."""
    if not attributes.strip():
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id", "role"):
            for word in value.split():
                parts = [p for p in re.split(r"[-_:]+", word) if p]
                if parts and parts[0] in ARTICLE_NAMES and parts[-1] in ("header", "banner"):
                    continue
                if parts and parts[0] not in BESIDE and (parts[0] in OUT_NAMES or parts[-1] in OUT_NAMES):
                    # The article itself may be named after its place, but not after comments.
                    if tag not in ("article", "main") or parts[0].startswith(("comment", "repl")):
                        return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; blank ones are left out."""
    found: list[Block] = []
    parts: list[tuple[str, bool]] = []
    # Open elements: tag, whether out (1: only by a form), whether inside an article.
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    # How many elements of each tag are open: an end tag of none is passed over without a look at the stack.
    opened: Counter[str] = Counter()
    links = 0
    heading = False

    def close() -> None:
        nonlocal parts
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            linked = len(" ".join("".join(t for t, is_link in parts if is_link).split()))
            _, out, inside = stack[-1]
            found.append(Block(text, linked, out > 0, inside, heading))
        parts = []

    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        end = token.start() if token else len(page)
        if end > at:
            parts.append((html.unescape(page[at:end]), links > 0))
        if not token:
            break
        at = token.end()
        closing, tag, attributes = token[1], (token[2] or "").lower(), token[3] or ""
        if not tag:
            continue
        if tag in RAW_TAGS and not closing:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag in BLOCK_TAGS or tag in OUT_TAGS:
            close()
            heading = not closing and tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif tag == "br" or tag == "wbr":
            parts.append((" " if tag == "br" else "", links > 0))
        if tag in VOID_TAGS or tag not in OPEN_TAGS:
            continue
        if closing:
            if opened[tag]:
                # Each element that is passed is closed with it, so all end tags together take one pass.
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                if any(s[1] != stack[depth - 1][1] for s in stack[depth:]):
                    close()
                for name, _, _ in stack[depth:]:
                    opened[name] -= 1
                    links -= name == "a"
                del stack[depth:]
            continue
        if tag == "a" and stack[-1][0] == "a":
            # Links do not nest: a new one ends the one before.
            stack.pop()
            opened["a"] -= 1
            links -= 1
        _, out, inside = stack[-1]
        named = marked_out(tag, attributes)
        here = tag in ("article", "main") and not named
        if named or (tag in OUT_TAGS and tag != "form") or (tag == "header" and not inside):
            out = 2
        elif out < 2:
            # A form may hold the whole page.
            out = 0 if here else max(out, int(tag == "form"))
        if out != stack[-1][1]:
            close()
        stack.append((tag, out, inside or here))
        opened[tag] += 1
        links += tag == "a"
    close()
    return found


def labels(found: list[Block]) -> list[bool]:
    """Whether each block is part of the article."""
    marked = any(b.inside and not b.out for b in found)
    first: list[bool | None] = []
    for block in found:
        size = len(block.text)
        linked = block.linked / size
        if block.out:
            first.append(False)
        elif linked > MAX_LINKS and (size < 2 * SHORT or not block.inside):
            first.append(False)
        elif size < SHORT:
            first.append(None)
        else:
            words = LETTERS.findall(block.text.lower())
            density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            if density >= STOP_SHARE:
                first.append(True)
            elif marked and not block.inside:
                first.append(False)
            else:
                first.append(None)
    if all(x is None for x in first) and not any(b.inside for b in found):
        # Nothing to inherit from: a page of short blocks only is its own text.
        return [True] * len(found)
    result = [x is True for x in first]
    for side in (True, False):
        # Parts that are marked out say nothing about what stands next to them.
        places = [i for i, b in enumerate(found) if b.inside == side]
        usable = [None if found[i].out else first[i] for i in places]
        if any(x is not None and (not side or x) for x in usable):
            chosen = _inherited(usable, [found[i].heading for i in places])
        elif side:
            within = sum(len(found[i].text) for i in places if not found[i].out and first[i] is None)
            outside = sum(len(b.text) for b, x in zip(found, first, strict=True) if x and not b.inside)
            chosen = [within >= outside] * len(places)
        else:
            chosen = [not marked] * len(places)
        for i, x in zip(places, chosen, strict=True):
            if first[i] is None:
                result[i] = x
    return result


def _inherited(first: list[bool | None], headings: list[bool]) -> list[bool]:
    """The labels, open ones from the nearest decided block; at least one is decided."""
    before: list[int | None] = []
    last = None
    for i, x in enumerate(first):
        last = i if x is not None else last
        before.append(last)
    result, nearest = [x is True for x in first], None
    for i in range(len(first) - 1, -1, -1):
        if first[i] is not None:
            nearest = i
            continue
        left, right = before[i], nearest
        if left is None or right is None:
            result[i] = bool(first[right if left is None else left])
        elif i - left == right - i:
            result[i] = bool(first[right]) if headings[i] else bool(first[left]) or bool(first[right])
        else:
            result[i] = bool(first[left if i - left < right - i else right])
    return result


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(found, labels(found), strict=True) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", content: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kept = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(content).cast("string").alias("html"),
    )
    return kept.mapInArrow(each, "page_id long, url string, text string, n_chars long")


ship(__name__)
