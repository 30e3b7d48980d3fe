"""Main text of web pages by two passes over their blocks.

Markup cuts a page into blocks of text. Elements that are menus, headers, footers, side bars,
notices, adverts, forms or comments by their tag are left out, and those that a class, id or role names so. A class that
says what a page has or in which state it is ("with-sidebar", "comments-open") names nothing. Pass one decides the other blocks by
length, stop-word density and link density; short ones and unclear ones stay open. Pass two gives an open block the
label of its nearest decided neighbour in the same article, or in the page outside articles; where there is none,
blocks of an article are kept, and others follow the nearest decided block of the page.

The name of a frame such as a side bar or a banner is evidence only: where a page has no text outside elements so named, the articles
inside these are read. Where no block of a page has the share of stop words, as in a
language that the list does not know, long blocks are decided by their links alone.

Defined cases: null and empty pages have an empty text; markup that is never closed ends with the page;
pages without any decided block keep what markup does not exclude; repeated rows are read each by itself;
extra columns are kept, and an output name that is taken raises an error. Time is linear in the page: after a tag that never ends, tags
end at the next ">", and where none is left the rest is text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import map_arrow, untaken

#: Characters from which a block can be decided by its words.
LONG = 70
#: Share of stop words that makes a long block text, and below which it is none (outside articles).
MANY_STOPS, FEW_STOPS = 0.2, 0.05
#: Share of characters inside links above which a block is a menu.
MANY_LINKS = 0.5

# Common words of the four languages.
STOP_WORDS = frozenset(
    """
    a about all also an and are as at be been but by can for from had has have he her his if in into is it its more
    not of on one or our she so that the their there they this to was we were which who will with you
    aber als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich
    im ist mit nach nicht noch nur oder sich sie sind so um und uns von vor war was wie wir zu zum zur über
    al con como de del el en era es esta este fue la las lo los más muy no para pero por que se ser si sin sobre
    son su sus también un una y ya
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous ou où par pas
    plus pour qu que qui sa se ses son sont sur un une vous à été être
    """.split()
)
# Words in class, id and role by which elements say what they are.
BOILERPLATE = frozenset(
    """
    ad ads adbox adslot advert adverts advertisement advertising alert announcement banner breadcrumb breadcrumbs comment
    comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus feedback footer
    form gdpr header legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification
    overlay pager pagination popup privacy promo promoted promotion recommended recommendations related replies reply
    respond responses search share sharing sidebar sidebars signin signup social sponsor sponsored subscribe subscription
    toolbar topbar warning widget widgets
    """.split()
)
ARTICLE = frozenset("article content entry main post story".split())
_OUT = frozenset("nav footer aside form menu dialog button select textarea fieldset".split())
_HIDDEN = frozenset("head script style noscript template svg iframe object canvas math audio video".split())
_BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table
    tbody td tfoot th thead title tr ul
    """.split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SELF_CLOSING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_RAW = re.compile(r"<(script|style|noscript|template|iframe|textarea)\b[^>]*+>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ANY_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_OTHER = re.compile(r"<[/!?][^>]*>?")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Words that make a class say what is there or in which state, not what the element is.
_STATE = frozenset("no not has have with without is hide hidden show open opened closed enabled disabled active allow allowed off on".split())


class Block(NamedTuple):
    text: str
    links: float
    article: int  # number of the article it is in, 0 outside
    doubt: bool  # left out for the name of a frame only


def _named(attributes: dict[str, str]) -> set[str]:
    """Words by which the element says what it is: of each class, id or role that is no state, the first and the last."""
    found = set()
    for name in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).split():
        words = [w.lower() for w in _NAME.findall(name)]
        if words and not _STATE.intersection(words):
            found |= {words[0], words[-1], "".join(words)}
    return found


def _says(tag: str, rest: str, in_article: bool) -> tuple[bool, bool, bool]:
    """(left out, left out for its name, an article) by what the element says of itself."""
    attributes = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest.strip() else {}
    names = _named(attributes) if attributes else set()
    hidden = re.search(r"\bhidden\b", re.sub(r"""=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", "", rest)) or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    named = names & BOILERPLATE
    if in_article or names & ARTICLE:
        named = named - {"header"}
    if tag in ("html", "body", "article", "main") and not named & _REMARKS or tag in ("html", "body"):
        named = set()
    left_out = tag in _OUT or (tag == "header" and not in_article) or bool(hidden) or attributes.get("aria-hidden") == "true"
    return left_out or bool(named - _FRAMES), bool(named), tag in ("article", "main") or bool(names & ARTICLE)


# Names of frames, which may hold a whole page.
_FRAMES = frozenset(
    """
    banner complementary contentinfo dialog footer form header masthead menu menubar modal nav navbar navigation overlay popup search
    share sharing sidebar sidebars social toolbar topbar widget widgets
    """.split()
)
# What readers say, also where each remark is an article of its own.
_REMARKS = frozenset("comment comments reply replies response discussion".split())


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("", text, ""), (tag, "", attributes) or (tag, "/", "") in page order."""
    at, size, last, tags = 0, len(page), page.rfind(">"), _TAG
    while at < size:
        low = page.find("<", at)
        if low != at:
            yield "", page[at : low if low >= 0 else size], ""
        if low < 0:
            return
        if page.startswith("<!--", low):
            at = _COMMENT.match(page, low).end()
            continue
        if low > last:  # no tag ends any more
            yield "", page[low:], ""
            return
        if m := _RAW.match(page, low):
            at = m.end()
            continue
        m = tags.match(page, low)
        if m is None and tags is _TAG and page[low + 1 : low + 3].lstrip("/")[:1].isalpha():
            tags = _ANY_TAG  # a quote or the page ended first: from here on quotes do not count
            m = tags.match(page, low)
        if m:
            yield m[2].lower(), m[1], m[3]
        elif m := _OTHER.match(page, low):
            pass
        else:
            yield "", "<", ""
        at = m.end() if m else low + 1


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, without what markup excludes; those left out for a name only are marked."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool, int]] = []  # tag, left out, in doubt, article
    opened: Counter[str] = Counter()
    at_blocks: list[int] = []  # places of block elements in the stack
    parts: list[str] = []
    linked = articles = 0

    def finish() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            _, _, doubt, article = stack[-1] if stack else ("", False, False, 0)
            found.append(Block(text, min(1.0, linked / len(text)), article, doubt))
        parts.clear()
        linked = 0

    def close(at: int) -> None:
        if at_blocks and at_blocks[-1] >= at:
            finish()
        while at_blocks and at_blocks[-1] >= at:
            at_blocks.pop()
        for tag, *_ in stack[at:]:
            opened[tag] -= 1
        del stack[at:]

    for tag, text, rest in _tokens(page):
        if not tag:
            if not (stack and stack[-1][1]):
                text = html.unescape(text)
                parts.append(text)
                if opened["a"]:
                    linked += len(" ".join(text.split()))
            continue
        if text:  # an end tag
            if tag == "br" and not (stack and stack[-1][1]):
                parts.append(" ")
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            elif tag in _BLOCK:
                finish()
            continue
        if tag in _BLOCK:
            last = at_blocks[-1] if at_blocks else -1
            if last >= 0 and (stack[last][0] == "p" or stack[last][0] in _SELF_CLOSING.get(tag, ())):
                close(last)
            else:
                finish()
        if tag in _VOID:
            if tag == "br" and not (stack and stack[-1][1]):
                parts.append(" ")
            continue
        if rest.rstrip().endswith("/") and tag not in _BLOCK:
            continue
        _, out, doubt, article = stack[-1] if stack else ("", False, False, 0)
        left_out, named, is_article = _says(tag, rest, article > 0)
        if is_article and not article and not out:
            articles += 1
            article = articles
        if tag in _BLOCK:
            at_blocks.append(len(stack))
        stack.append((tag, out or left_out or tag in _HIDDEN, doubt or named, article))
        opened[tag] += 1
    finish()
    return found


def _stop_share(block: Block) -> float:
    words = [w.strip(".,;:!?\"'()") for w in block.text.lower().split()]
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _first_pass(parts: list[Block]) -> list[bool | None]:
    """For each block True: text, False: none, None: open."""
    long = [b.links <= MANY_LINKS and len(b.text) >= LONG for b in parts]
    stops = [_stop_share(b) if is_long else 0.0 for b, is_long in zip(parts, long)]
    labels: list[bool | None] = [False if b.links > MANY_LINKS else True if share >= MANY_STOPS else None for b, share in zip(parts, stops)]
    if True not in labels:  # no language of the list
        return [True if is_long else label for label, is_long in zip(labels, long)]
    articles = any(b.article and label for b, label in zip(parts, labels))
    few = [is_long and share < FEW_STOPS and articles and not b.article for b, is_long, share in zip(parts, long, stops)]
    return [False if none else label for label, none in zip(labels, few)]


def _nearest(labels: list[bool | None]) -> list[tuple[int, bool] | None]:
    """(distance, label) of the nearest decided one for each; of two as near, the one that is text."""
    best: list[tuple[int, bool] | None] = [None] * len(labels)
    for order in (range(len(labels)), range(len(labels) - 1, -1, -1)):
        last = None
        for k in order:
            if labels[k] is not None:
                last = k
            if last is not None:
                here = (abs(k - last), bool(labels[last]))
                if best[k] is None or (here[0], not here[1]) < (best[k][0], not best[k][1]):
                    best[k] = here
    return best


def _kept(parts: list[Block]) -> list[Block]:
    labels = _first_pass(parts)
    final = list(labels)
    if None in labels:
        page_wide = _nearest(labels)
        zones: dict[int, list[int]] = {}
        for k, b in enumerate(parts):
            zones.setdefault(b.article, []).append(k)
        for article, members in zones.items():
            own = [labels[k] for k in members]
            whole = article and True not in own
            for k, found in zip(members, _nearest(own)):
                if labels[k] is None:
                    if whole or (article and found is None):
                        final[k] = True
                    else:
                        found = found or page_wide[k]
                        final[k] = found[1] if found else True
    return [b for b, label in zip(parts, final) if label]


def main_text(page: str | None) -> str:
    """The kept blocks in page order, joined by line feeds."""
    parts = blocks(page or "")
    kept = _kept([b for b in parts if not b.doubt])
    if not any(len(b.text) >= LONG for b in kept):
        # Nothing that reads like a text is left without what was left out for a name.
        more = _kept([b for b in parts if b.doubt and b.article])
        if any(len(b.text) >= LONG for b in more) and not any(b.article for b in kept):
            kept = more
    return "\n".join(b.text for b in kept)


def with_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page."""
    untaken(pages, text_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, html_col)):
            texts = pa.array([main_text(p) for p in batch.column(html_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, text_col])

    return map_arrow(pages, extract, T.StructType([*pages.schema.fields, T.StructField(text_col, T.StringType())]))
