"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by stop-word density,
length, link density and the element they stand in; the second gives each undecided, mostly short
block the label of its nearest decided neighbours. Kept blocks are joined by one space.

First pass, in this order:
  bad        the block stands in a menu, header, footer, sidebar, notice, advert, form, reader
             comment or the like; or links make up more than MOST_LINKS of it, in an article or main
             element nearly all of it or a labelled list of links; or it is a copyright line outside
             an article. A single name of NOT_MAIN as class, id or role does not count for a block
             of an article or main element that is LONG with a share of STOP_HIGH
  good       at least LONG characters, and a share of stop words of at least STOP_HIGH; or LONG
             and inside an article or main element; or LONG, on a page where no block shows that its
             language is one of those whose stop words are known
  bad        LONG outside of these, with a share of stop words below STOP_LOW, if blocks with known
             stop words surround it on the page and it is written in the same letters
  undecided  everything else
Second pass: the nearer decided neighbour gives its label; of two that are equally near, a good one
does. Blocks of an article or main element only look at neighbours inside of it. Blocks that are bad
for the element they stand in say nothing about what follows them and are no neighbours; a block
without any neighbour is good.

Scripts, styles, comments and other elements without text are dropped; an unfinished tag, comment
or script takes the rest of the page, as in browsers. A tag ends at the first ">" that stands in no
quoted value, whatever stray quotes it has; a quote that is never closed holds nothing. Character references are decoded once.
A null or empty page gives an empty text. Every row comes back once, repeated rows too; an empty
table gives none. Pages of any length are read whole, in time proportional to their length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import STOP_WORDS, each_batch

LONG = 90
STOP_LOW, STOP_HIGH = 0.05, 0.12
MOST_LINKS, ALL_LINKS = 0.34, 0.9

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp
    small span strike strong sub sup time tt u var wbr img""".split()
)
SILENT = frozenset(
    """head title script style noscript template iframe object svg math select textarea button
    canvas audio video datalist""".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu header fieldset".split())
MAIN = frozenset("article main".split())
#: Names in class, id or role that tell an element is not part of the article, whole ones only.
NOT_MAIN = frozenset(
    """banner breadcrumb breadcrumbs contentinfo copyright footer masthead menu modal nav navbar
    navigation newsletter notice notices pagination popup promo promoted related share sharing sidebar
    signup social sponsor sponsored subscribe toolbar widget""".split()
)
#: Adverts and readers' comments, and in class or role also these: no length makes them the article.
#: As an id the latter are the topic of a section just as often.
NEVER_MAIN = frozenset(
    """ad ads advert adverts advertisement advertisements comment comments disqus replies respond""".split()
)
NEVER_CLASS = frozenset("advertising consent cookie cookies gdpr".split())
#: What may stand beside such a name, as in ad-box or site-footer. Modifiers such as has- and no-, and
#: topics as in related-work, may not.
BESIDE = frozenset(
    """area article articles bar block bottom box button buttons c container entry form global inner
    item items js label link links list panel post posts primary reader readers secondary site slot
    stories thread threads top unit user wrap wrapper""".split()
)
KNOWN = {"main-nav": 1, "main-menu": 1, "main-navigation": 1, "page-footer": 1, "page-nav": 1}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Only after "name=" quotes hold a value together, up to their counterpart; any other quote is a
#: character like others, as in browsers.
_NAME, _VALUE = r"[^\s/>][^\s/>=]*+", r"""(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""
_ATTRIBUTE = re.compile(rf"[\s/]*+({_NAME})(?:\s*+=\s*+({_VALUE})?+)?+")
_TAG = re.compile(
    rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]*+{_NAME}(?:\s*+=\s*+{_VALUE}?+)?+)*+)([\s/]*+)>"
)
_NOTED = re.compile(r"class|id|role|hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")
#: Headings above readers' comments, in the four languages, and the label of a list of links.
_COMMENTS = re.compile(
    r"\(?\d+\)? +(comments?|responses?|replies|reply|kommentare?|antworten|commentaires?|réponses?"
    r"|comentarios?|respuestas?)( (on|to|zu|sur|à|a|en|sobre)\b.*)?",
    re.I | re.S,
)
_LABEL = re.compile(r"[^.:!?]{1,30}:")


@dataclass
class Block:
    scope: int = 0  # number of the article that it stands in; 0: none
    bad: bool = False
    named: bool = False  # bad for a name only, so that its text may show otherwise
    heading: bool = False
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


@dataclass
class Open:
    """An open block-level element, or an inline one that is cut out or stands in one of its name."""

    name: str
    scope: int
    bad: int  # 1 for a name of NOT_MAIN, 2 for any other reason
    own: int = 0  # bad by itself, not by what it stands in
    outer: Block | None = None  # what an inline element is cut out of


def blocks(page: str) -> list[tuple[Block, str]]:
    """Blocks with text, in page order."""
    out: list[tuple[Block, str]] = []
    stack: list[Open] = []
    now, scopes, links, at = Block(), 0, 0, 0
    cuts = 0  # inline elements on the stack
    held: list[Open] = []  # those of them whose outer block may go on
    ends: dict[str, dict[int, int]] = {}  # by name of a silent element, where each of them ends

    def add(block: Block) -> None:
        if block.parts and (text := block.text()):
            block.bad |= block.named and not _shown(block, text)
            if block.heading and len(text) < LONG and _COMMENTS.fullmatch(text):
                # What else stands in its element are the comments.
                block.bad = True
                k = len(stack) - 1
                while k >= 0 and stack[k].name in HEADINGS:
                    k -= 1
                if k >= 0 and stack[k].name not in ("html", "body"):
                    stack[k].bad = 2
            out.append((block, text))

    def begun() -> Block:
        top = stack[-1] if stack else Open("", 0, 0)
        return Block(top.scope, top.bad > 1, top.bad == 1, any(x.name in ("h1", "h2", "h3") for x in stack[-2:]))

    def close() -> None:
        nonlocal now
        flush()
        add(now)
        now = begun()

    def flush() -> None:
        """End the blocks that inline elements are cut out of."""
        for x in held:
            add(x.outer)
            x.outer = None
        held.clear()

    def drop(k: int) -> None:
        nonlocal cuts
        flush()
        cuts -= sum(x.name in INLINE for x in stack[k:])
        del stack[k:]

    def end_inline(k: int) -> None:
        nonlocal now, cuts
        ended = stack.pop(k)
        cuts -= 1
        if not ended.own:
            return
        inside = stack[k:]
        del stack[k:]
        for x in inside:  # what it left open no longer stands in it
            x.bad = max(x.own, _inherited(stack, x))
            stack.append(x)
        if ended.outer and ended is held[-1] and not (now.named and _shown(now, now.text())):
            now = held.pop().outer  # the block goes on as if the element were not there
        else:
            close()

    while at < len(page):
        mark = page.find("<", at)
        text = page[at:] if mark < 0 else page[at:mark]
        if text:
            now.parts.append(text)
            now.linked += len(text) if links else 0
        if mark < 0:
            break
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = len(page) if end < 0 else end + 1
            continue
        tag = _TAG.match(page, mark)
        if tag is None:
            if re.match(r"</?[a-zA-Z]", page[mark : mark + 3]):
                break  # an unfinished tag
            now.parts.append("<")
            at = mark + 1
            continue
        at, name, closing = tag.end(), tag[2].lower(), bool(tag[1])
        if name == "br":
            now.parts.append(" ")
            continue
        if name in INLINE:
            links = 0 if closing and name == "a" else 1 if name == "a" else links
            same = _last(stack, name) if cuts and name not in VOID else -1
            if closing:
                if same >= 0:
                    end_inline(same)
                continue
            if name in VOID:
                continue
            top = stack[-1] if stack else Open("", 0, 0)
            # An inline element of its own, such as an advert in a span, is cut out of its block.
            if top.bad < 2 and (own := _badness(name, _notes(tag[3]), top.scope)) > top.bad:
                stack.append(Open(name, top.scope, own, own, now))
                held.append(stack[-1])
                cuts += 1
                now = begun()
            elif same >= 0:  # so that its end is not taken for the end of the one around it
                stack.append(Open(name, top.scope, top.bad))
                cuts += 1
            continue
        if closing:
            if (k := _last(stack, name)) >= 0:
                drop(k)
            links = 0
            close()
            continue
        if name in SILENT and not tag[4].endswith("/"):
            if name not in ends:
                ends[name] = _ends(page, name)
            at = ends[name].get(mark, len(page) if name in RAW else at)
            if name != "button":
                continue
        if name in VOID or tag[4].endswith("/"):
            links = 0
            close()
            continue
        if name == "p":
            k = len(stack) - 1
            while k >= 0 and stack[k].name in INLINE:
                k -= 1
            if k >= 0 and stack[k].name == "p":
                drop(k)
        top = stack[-1] if stack else Open("", 0, 0)
        outside = name in BOILERPLATE and not (name == "header" and top.scope and not top.bad)
        own = 2 if outside else _badness(name, _notes(tag[3]), top.scope)
        new = Open(name, top.scope, 0, own if name not in ("html", "body") else 0)
        if name in MAIN and own < 2 and not new.scope:
            scopes += 1
            new.scope = scopes
        new.bad = max(new.own, _inherited(stack, new))
        stack.append(new)
        links = 0
        close()
    close()
    return out


def _last(stack: list[Open], name: str) -> int:
    """The place of the last open element of this name, or -1."""
    return next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), -1)


def _inherited(stack: list[Open], new: Open) -> int:
    """How bad an element is for those it stands in. An article only is in menus and the like."""
    if new.name in MAIN and new.own < 2 and not any(x.bad and x.name in BOILERPLATE for x in stack):
        return 0
    return stack[-1].bad if stack else 0


def _notes(attributes: str) -> dict[str, str]:
    """class, id, role, hidden and aria-hidden of a tag; of repeated ones the first, as in browsers."""
    found: dict[str, str] = {}
    if attributes and _NOTED.search(attributes):
        for name, value in _ATTRIBUTE.findall(attributes):
            if (name := name.lower()) in ("class", "id", "role", "hidden", "aria-hidden"):
                quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
                value = value[1:-1] if quoted else value
                found.setdefault(name, value.strip().lower())
    return found


def _badness(element: str, notes: dict[str, str], scope: int) -> int:
    """0, 1 for a name of NOT_MAIN, or 2. A heading's id in an article is its topic."""
    if not notes:
        return 0
    if "hidden" in notes or notes.get("aria-hidden") == "true":
        return 2
    skip = "id" if scope and element in HEADINGS else ""
    return max((_named(k, v) for k, v in notes.items() if k != "aria-hidden" and k != skip), default=0)


@lru_cache(4096)
def _named(attribute: str, value: str) -> int:
    worst = 0
    for name in value.split():
        name = name.partition("--")[0].replace("_", "-")  # block__element--modifier
        parts = [x for x in (p.rstrip("0123456789") for p in name.split("-")) if x and not x[0].isdigit()]
        never = NEVER_MAIN if attribute == "id" else NEVER_MAIN | NEVER_CLASS
        told = [p for p in parts if p in NOT_MAIN or p in NEVER_MAIN or p in NEVER_CLASS]
        if told and all(p in BESIDE for p in parts if p not in told):
            # Two names together leave no doubt; one alone may be what the text is about.
            worst = max(worst, 2 if any(p in never for p in told) or len(parts) > 1 else 1)
        worst = max(worst, KNOWN.get(name, 0))
    return worst


def _shown(block: Block, text: str) -> bool:
    """Whether a text of an article is long and has enough stop words to leave it to the passes."""
    return bool(block.scope) and len(text) >= LONG and _share(text) >= STOP_HIGH


def _ends(page: str, name: str) -> dict[int, int]:
    """By place of a start tag, the place after its end tag: the first one of a raw element, else the
    one that balances it. All are found in one pass over the page.

    An unfinished script takes the rest of the page; of other elements only the tag is dropped.
    """
    tags = re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I)
    out: dict[int, int] = {}
    begun: list[int] = []
    for tag in tags.finditer(page, 0, page.rfind(">") + 1):
        if not tag[1]:
            begun.append(tag.start())
        elif name in RAW:
            out.update(dict.fromkeys(begun, tag.end()))
            begun.clear()
        elif begun:
            out[begun.pop()] = tag.end()
    return out


def decide(block: Block, text: str, share: float = 0.0, known: bool = True) -> int:
    """1 good, -1 bad, 0 undecided. `share`: of stop words, asked for in a LONG text only; `known`:
    whether some block shows that the page's language is a known one."""
    if block.bad:
        return -1
    size = sum(map(len, block.parts))
    if block.linked > (ALL_LINKS if block.scope else MOST_LINKS) * size:
        return -1
    if block.scope and block.linked > MOST_LINKS * size and _LABEL.match(text):
        return -1
    if "©" in text and not block.scope and len(text) < 2 * LONG:
        return -1
    if len(text) < LONG:
        return 0
    if share >= STOP_HIGH or block.scope or not known:
        return 1
    return -1 if share < STOP_LOW else 0


def _same_letters(text: str, shown: list[str]) -> bool:
    """Whether most letters of a text are letters of the others."""
    own = {c for c in text.lower() if c.isalpha()}
    return 2 * len(own.intersection("".join(shown).lower())) > len(own)


def _share(text: str) -> float:
    """The share of stop words."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    shares = [_share(t) if len(t) >= LONG and not b.bad else 0.0 for b, t in found]
    shown = [t for (_, t), share in zip(found, shares, strict=True) if share >= STOP_HIGH]
    for k, (block, text) in enumerate(found):
        # Known words can only be missed in a text in letters that have them.
        if shown and shares[k] < STOP_LOW and len(text) >= LONG and not _same_letters(text, shown):
            shares[k] = STOP_LOW
    labels = [decide(b, t, share, bool(shown)) for (b, t), share in zip(found, shares, strict=True)]
    before, after = _nearest(found, labels), _nearest(found[::-1], labels[::-1])[::-1]
    kept = []
    for (block, text), label, left, right in zip(found, labels, before, after, strict=True):
        if not label:
            if left[0] == right[0]:
                label = max(left[1], right[1])
            else:
                label = min(left, right)[1]
            label = label or 1
        if label > 0:
            kept.append(text)
    return " ".join(kept)


def _nearest(found: list[tuple[Block, str]], labels: list[int]) -> list[tuple[float, int]]:
    """Distance and label of the nearest decided block before each, within the same article."""
    out: list[tuple[float, int]] = []
    last: dict[int, tuple[int, int]] = {}
    for k, ((block, _), label) in enumerate(zip(found, labels, strict=True)):
        at = last.get(block.scope)
        out.append((k - at[0], at[1]) if at else (float("inf"), 0))
        if label and not block.bad:
            last[block.scope] = (k, label)
    return out


def extracted(
    rows: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """id, url, text, n_chars (code points) for every row."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
        columns.append(pa.array([len(t) for t in texts], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["id", "url", "text", "n_chars"])

    source = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    made = each_batch(source, make, "id long, url string, text string, n_chars long")
    return made.withColumnsRenamed({"id": id_col, "url": url_col})
