"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. For every block the length, the density of stop
words, the share of its characters inside links, and the kind of the elements around it are known.

First pass, decided blocks: those inside menus, headers, footers, sidebars, notices, adverts,
forms and reader comments (by tag, role, class or id) are boilerplate; so are blocks that are
mostly links. On pages that mark their article (``article``, ``main``, ``role=main``, a ``div`` or
``section`` named article), the blocks inside it are content and those outside are boilerplate. On
other pages long blocks are content if they have enough stop words or nearly no links, and short
ones stay open.

Second pass: every open block takes the label of its nearest decided neighbour, before or after it
by the characters between them (blocks that their element rules out do not vote); on a tie content
wins, an open heading looks ahead first, and without any decided neighbour the block is content.

A class or id may name a part of what the element holds (``layout-sidebar-left`` around the whole page):
``main`` inside such an element is content, and so is an ``article`` (not in reader comments) if it
has more text than all that the page gives without. If the page gives nothing, elements whose
name is neither the whole class word nor its last part are not ruled out by it.

Defined cases: null or empty html, and pages without content, give the empty text; broken, cut or
unclosed markup is read as far as it goes; texts of any length are kept whole; other columns are
kept by ``extract`` unless they have the name of an output.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import read, slices

# Elements whose content is never text, and elements that end a block.
SILENT = "script|style|noscript|template|svg|iframe|object|canvas|math|select|textarea|button|video|audio|head|title"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("hr img input meta link wbr source area col embed base track param".split())
NESTED = BLOCK - frozenset("p li dd dt tr td th option optgroup h1 h2 h3 h4 h5 h6 hr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements, roles and name parts of what is not the article.
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog search fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription share sharing "
    "social sidebar widget widgets related recommended recommendations menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager masthead topbar footer comment comments commentlist reply replies respond "
    "disqus discussion login signin signup register search searchform toolbar copyright disclaimer alert".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
OTHERWISE = frozenset("no with has without".split())   # what follows is not the element itself
# Zones of what is ruled out: by tag, role or style; by comment names; by other names; by a name inside a word.
RULED_OUT = frozenset("out comment named weak".split())
# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that for it was on are as with be this by at from or an not have but they his her you we "
    "le la les de des du et en un une est que qui dans pour par sur pas au avec ne se ce il elle nous vous "
    "der die das und ist den dem ein eine zu mit von auf für im nicht auch sich als er sie es an werden aus "
    "el los las y del una por con para su al lo como más pero sus ya o este sí porque esta entre cuando muy sin".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SILENT})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

LONG, MANY_LINKS, ONLY_LINKS, FEW_LINKS, STOP_DENSITY = 70, 0.33, 0.8, 0.1, 0.2


class Block:
    __slots__ = ("parts", "linked", "zone", "heading")

    def __init__(self, zone: str, heading: bool):
        self.parts, self.linked, self.zone, self.heading = [], 0, zone, heading


def _outside(tag: str, attributes: str, in_article: bool) -> str:
    """Zone of ``RULED_OUT`` if this element holds something else than the article, or nothing."""
    if tag in OUTSIDE_TAGS or tag == "header" and not in_article:
        return "out"
    if "=" not in attributes and "hidden" not in attributes:
        return ""
    found = ""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "out"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "out"
        if name == "role" and value.lower() in OUTSIDE_ROLES:
            return "out"
        if name in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in NAME_PART.findall(word)]
                parts = parts[:next((i for i, p in enumerate(parts) if p in OTHERWISE), len(parts))]
                if not COMMENT_NAMES.isdisjoint(parts):
                    found = "comment"
                elif found in ("", "weak") and tag not in ("body", "html", "main", "article"):
                    last = {*parts[-1:], "".join(parts)}
                    if not OUTSIDE_NAMES.isdisjoint(last) or not in_article and "header" in last:
                        found = "named"
                    elif not OUTSIDE_NAMES.isdisjoint(parts) or not in_article and "header" in parts:
                        found = "weak"
    return found


def _marks_main(tag: str, attributes: str) -> bool:
    return tag == "main" or "role" in attributes.lower() and any(
        name.lower() == "role" and value.strip("\"'").lower() == "main" for name, value in ATTRIBUTE.findall(attributes))


def _marks_article(tag: str, attributes: str) -> bool:
    if tag not in ("div", "section", "td") or "=" not in attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        parts = [p.lower() for p in NAME_PART.findall(value)]
        if name.lower() == "role" and parts == ["main"] or name.lower() in ("class", "id") and "article" in parts:
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks in page order; zone is ``article``, ``open``, one of ``RULED_OUT``, or ``inner`` with a number:
    an article inside an element that its name rules out."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []            # open elements, with the zone around each
    names = Counter()                            # how many of each are open
    zone, in_link, breaks, at, inside = "open", False, 0, 0, 0
    block = Block(zone, False)

    def end_block(heading: bool = False):
        nonlocal block, breaks
        if block.parts:
            out.append(block)
        block, breaks = Block(zone, heading), 0

    def say(text: str):
        nonlocal breaks
        if not text or zone in RULED_OUT and block.zone not in RULED_OUT:      # an advert inside a line is passed over
            return
        block.parts.append(entities.unescape(text))
        if in_link:
            block.linked += len("".join(text.split()))
        if not text.isspace():
            breaks = 0

    for m in TOKEN.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "br":                           # one is white space, two end the block
            breaks += 1
            block.parts.append(" ")
            if breaks == 2:
                end_block()
        elif m[2]:                                # closing tag
            if tag == "a":
                in_link = False
            if names[tag]:
                while True:
                    name, zone = stack.pop()
                    names[name] -= 1
                    if name == tag:
                        break
            if tag in BLOCK:
                end_block()
        else:
            if tag == "a":
                in_link = True
            if tag in BLOCK:
                in_link = False
                if stack and (stack[-1][0] == "p" or stack[-1][0] == tag == "li"):
                    name, zone = stack.pop()      # an unclosed paragraph or item ends here
                    names[name] -= 1
            if tag in VOID:
                if tag in BLOCK:
                    end_block()
                continue
            inner = zone
            if zone != "out":
                attributes = m[4] or ""
                by_name = zone in RULED_OUT
                ruled = _outside(tag, attributes, zone == "article" or zone.startswith("inner"))
                if ruled:
                    inner = ruled if not by_name or ruled == "out" or zone == "weak" or ruled == "comment" else zone
                elif by_name and _marks_main(tag, attributes):
                    inner = "article"
                elif tag in ("article", "main") or _marks_article(tag, attributes):
                    if not by_name and not zone.startswith("inner"):
                        inner = "article"
                    elif by_name and zone != "comment":
                        inside += 1
                        inner = f"inner{inside}"
            if tag in NESTED or inner != zone or names[tag]:
                stack.append((tag, zone))
                names[tag] += 1
            zone = inner
            if tag in BLOCK:
                end_block(tag in HEADINGS)
    say(page[at:])
    end_block()
    return out


def main_text(page: str | None) -> str:
    """Content blocks, white space inside as one space, joined by line breaks."""
    found = [(b, " ".join("".join(b.parts).split())) for b in blocks(page or "")]
    found = [(b, text) for b, text in found if text]
    kept = _content(found)
    sizes = Counter()
    for b, text in found:
        if b.zone.startswith("inner") and (b.heading or _linked(b, text) < ONLY_LINKS):
            sizes[b.zone] += len(text)
    if max(sizes.values(), default=0) > sum(map(len, kept)):
        for b, _ in found:
            b.zone = "article" if b.zone.startswith("inner") else b.zone
        kept = _content(found)
    if not kept:
        for b, _ in found:
            b.zone = "open" if b.zone == "weak" else b.zone
        kept = _content(found)
    return "\n".join(kept)


def _linked(block: Block, text: str) -> float:
    return block.linked / max(1, len(text.replace(" ", "")))


def _content(found: list[tuple[Block, str]]) -> list[str]:
    """Texts of the content blocks; an article inside a named element counts as ruled out."""
    marked = any(b.zone == "article" for b, _ in found)
    labels: list[bool | None] = []
    for b, text in found:
        size = len(text)
        linked = _linked(b, text)
        if b.zone in RULED_OUT or b.zone.startswith("inner"):
            label = False
        elif marked:
            label = b.zone == "article" and (b.heading or linked < ONLY_LINKS)
        elif linked > MANY_LINKS:
            label = False
        elif size < LONG or b.heading:
            label = None
        else:
            words = text.lower().split()
            dense = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) >= STOP_DENSITY * len(words)
            label = True if dense or linked < FEW_LINKS else None
        labels.append(label)
    return [text for (_, text), label in zip(found, _settle(found, labels), strict=True) if label]


def _settle(found, labels):
    """Second pass: open blocks take the label of the nearest decided one."""
    n = len(labels)
    before: list[tuple[float, bool] | None] = [None] * n
    after: list[tuple[float, bool] | None] = [None] * n
    for side, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        near = None
        for i in order:
            side[i] = near
            if found[i][0].zone in RULED_OUT or found[i][0].zone.startswith("inner"):
                continue
            if labels[i] is not None:
                near = (0, labels[i])
            elif near:
                near = (near[0] + len(found[i][1]), near[1])
    out = []
    for i, label in enumerate(labels):
        if label is None:
            choices = [x for x in (before[i], after[i]) if x]
            if found[i][0].heading and after[i]:
                label = after[i][1]
            else:
                label = min(choices, key=lambda x: (x[0], not x[1]))[1] if choices else True
        out.append(label)
    return out


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Append the main text and its number of code points (``n_chars``)."""
    keep = [f for f in pages.schema.fields if f.name not in (text, "n_chars")]
    schema = T.StructType([*keep, T.StructField(text, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, html):
                texts = [main_text(page) for page in batch.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
