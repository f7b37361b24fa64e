"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each under its root-to-leaf path of
tags (with classes and ids).  Text length and punctuation are added up per
path and divided by the path's blocks; the two ratios of each block are
smoothed with a Gaussian window along the page, not across the bounds of an
article element, and multiplied; a path whose
mean fused ratio reaches a threshold (a share of the page's standard
deviation) holds content, and so does what one element holds between two such
blocks.  The fused ratio of a block inside an article or
main element grows with that element's share of the page's text, so a teaser
card gains nothing; no element is content by its name.  Parts that the page's
own markup names as navigation, forms, comments and so on are left out before,
from the smallest on, unless they hold most of the text that is left.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import pick

#: Share of the standard deviation that a content path reaches.
THRESHOLD = 0.5
#: Growth of the fused ratio inside an article element that holds all text.
ARTICLE_GAIN = 1.0
#: A named part with this share of the text that is left stays ...
NAMED_SHARE = 0.5
#: ... unless it holds no article element and one beside it has this share.
BESIDE_SHARE = 0.2
#: Parts that are no article wherever a page has one, or this share of other text.
_NEVER = frozenset("nav footer aside button menu dialog".split())
_TALK = frozenset("comment comments discussion disqus replies reply respond".split())
NEVER_SHARE = 0.05
#: Gaussian window over neighbouring blocks (five places, sigma 1).
_WINDOW = np.exp(-np.arange(-2, 3) ** 2 / 2)

_SKIPPED = frozenset("script style noscript template iframe object svg math canvas select datalist textarea title".split())
_RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
_OUTER = frozenset("nav footer aside form button menu dialog fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br".split())
_MAIN = frozenset(("article", "main"))
#: Start tags that end an open element of the second kind.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    **dict.fromkeys(
        "p div article aside section header footer nav main ul ol dl table form fieldset figure blockquote pre hr h1 h2 h3 h4 h5 h6 address details".split(), ("p",)
    ),
}
#: Elements beyond which a start tag ends nothing.
_SCOPE = frozenset("html body table td th ul ol dl div article section aside main nav header footer form blockquote".split())
#: Words of class and id tokens of parts that are not the article.  A token
#: tells of such a part if one of its words is among these and the others
#: only say where or what kind of box it is: "sidebar", "main-nav" and
#: "related-posts" do, "side-effects", "related-work" and "notice-period" are
#: names of the article's own.
_NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navigation navbar menu menubar breadcrumb breadcrumbs"
    " sidebar side rail widget footer header masthead topbar cookie cookies consent gdpr notice notification alert popup modal overlay"
    " comment comments discussion disqus replies reply respond form login signup subscribe newsletter search share sharing social related"
    " recommended pagination pager toolbar copyright skip".split()
)
_BOX = frozenset(
    "top bottom left right middle center upper lower first last main primary secondary global site page blog web mobile desktop sticky fixed floating"
    " inner outer wrap wrapper container content area section block box panel pane column col row grid group list item items link links button"
    " buttons icon icons bar strip unit slot zone region inline large small big mini new old js the of and in to for on us my your our"
    " post posts article articles story stories news media thread title heading label text body image img video user".split()
)
#: A token such as "article-with-sidebar" tells of a layout.
_LAYOUT = frozenset(("with", "without", "has", "no"))
#: A short block that stands directly in a box and begins like this asks the
#: reader for something.
_CALL = re.compile(
    r"(?:please |join |click (?:here )?(?:to )?|tap (?:here )?(?:to )?)?(?:subscribe|sign up|sign in|log in|register (?:now|today)|follow us|share (?:this|on)|"
    r"advertisement|sponsored|we use cookies|this (?:web)?site uses cookies|accept (?:all )?cookies|abonnieren|abonnez-vous|suscr[ií]bete)\b", re.I
)
CALL_LENGTH = 160
_BOXES = frozenset("div section span body main article".split())
#: Elements whose own text blocks make up one run of text.
_HOLDS = frozenset("article main section div body td blockquote details".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
#: Quotes open a value only after the equals sign.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_TAG = re.compile(rf"<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+{_VALUE}?+)*+)>")
_ATTRIBUTE = re.compile(rf"([^\s=/]++)(?:\s*=\s*({_VALUE}))?")
_WORDS = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _attributes(text: str) -> dict[str, str]:
    """Attributes by name, the first of equals."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        value = m[2] or ""
        out.setdefault(m[1].lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


def _names_other(words: list[str]) -> bool:
    """Whether the words of one class or id token name a part beside the
    article (a word may carry a number)."""
    plain = [w for w in words if len(w) > 1]
    return any(w in _NOT_ARTICLE for w in plain) and all(w in _NOT_ARTICLE or w in _BOX for w in plain)


class _Block:
    __slots__ = ("path", "parts", "main", "holder", "leaf")

    def __init__(self, path: int, main: int, holder: int, leaf: str):
        # Path: its number.  Parts: text, innermost named part, inside a link.
        # Holder: number of the element of `_HOLDS` that the block is in.
        self.path, self.parts, self.main, self.holder, self.leaf = path, [], main, holder, leaf


def _left_out(found: list[_Block], around: list[int], main_in: list[int], named_up: list[int], never: list[bool]) -> list[bool]:
    """By number, whether a named part is left out: it and those around it
    are taken from the smallest on while they hold less than ``NAMED_SHARE``
    of the text outside links that is left.  Of the others, those without an
    article element go if one beside them has ``BESIDE_SHARE`` of that text;
    those of ``_NEVER`` and ``_TALK`` go if there is any beside them, or ``NEVER_SHARE`` of
    other text, unless one article element inside has most of the text."""
    size, total = [0] * len(named_up), 0
    pieces = [(sum(len(t.strip()) for t, n, link in b.parts if n == named and not link), named, b.main) for b in found for named in {n for _, n, _ in b.parts}]
    for k, named, _ in pieces:
        total += k
        if named >= 0:
            size[named] += k
    # A part comes after those around it.
    for i in range(len(named_up) - 1, -1, -1):
        if named_up[i] >= 0:
            size[named_up[i]] += size[i]
    out, gone = [False] * len(named_up), [0] * len(named_up)
    kept = []
    for i in sorted(range(len(named_up)), key=lambda i: (size[i], -i)):
        left = size[i] - gone[i]
        if left == 0 or left < NAMED_SHARE * total:
            out[i] = True
            total -= left
            gone[i] = size[i]
        else:
            kept.append(i)
        if named_up[i] >= 0:
            gone[named_up[i]] += gone[i]
    for i in range(len(named_up)):
        out[i] |= named_up[i] >= 0 and out[named_up[i]]
    # Parts are numbered as they open, so those inside one follow it.
    last = list(range(len(named_up)))
    for i in range(len(named_up) - 1, -1, -1):
        if named_up[i] >= 0:
            last[named_up[i]] = max(last[named_up[i]], last[i])

    for i in kept:
        if out[i]:
            continue
        # Text of each article element inside the part and beside it.
        inside, beside, other = [0] * len(around), [0] * len(around), 0
        for k, n, main in pieces:
            if n < 0 or not out[n]:
                here = i <= n <= last[i]
                other += 0 if here else k
                if main >= 0:
                    (inside if here else beside)[main] += k
        for m in range(len(around) - 1, -1, -1):
            own = i <= main_in[m] <= last[i]
            inside[m] *= own
            if around[m] >= 0:
                inside[around[m]] += inside[m]
                beside[around[m]] += beside[m]
        most, near = max(inside, default=0), max(beside, default=0)
        if never[i]:
            leave = most < NAMED_SHARE * total and (near > 0 or other >= max(NEVER_SHARE * total, 1))
        else:
            leave = most == 0 and near >= max(BESIDE_SHARE * total, 1)
        if leave:
            out[i : last[i] + 1] = [True] * (last[i] + 1 - i)
            total = other
    return out


def blocks(page: str) -> tuple[list[tuple[int, str, int, int, int, str]], list[int]]:
    """Text blocks in page order: number of the path, text, characters inside
    links, number of the innermost article element (-1: none), number of the
    element that holds the block among others, and name of the innermost
    element; and by number, the article element around it.  Parts that the markup names as not of the
    article are left out."""
    out: list[_Block] = []
    # By number: the article element around one, the named part around it,
    # and the named part around a named part.
    around: list[int] = []
    main_in: list[int] = []
    named_up: list[int] = []
    never: list[bool] = []
    # Open elements: name, number of the path, left out, innermost main, link,
    # innermost named part, holder.
    stack: list[tuple[str, int, bool, int, bool, int, int]] = []
    # Paths are numbered as they are met: a step from one by an element.
    paths: dict[tuple[int, str], int] = {}
    open_now: dict[str, int] = {}
    holders = 0
    now: _Block | None = None
    at, n = 0, len(page)

    def add(text: str) -> None:
        nonlocal now
        if not text or (stack and stack[-1][2]):
            return
        if now is None:
            if text.isspace():
                return
            leaf = next((e[0] for e in reversed(stack) if e[0] not in _INLINE), "")
            now = _Block(stack[-1][1] if stack else 0, stack[-1][3] if stack else -1, stack[-1][6] if stack else 0, leaf)
            out.append(now)
        now.parts.append((text, stack[-1][5] if stack else -1, bool(stack) and stack[-1][4]))

    def close_from(i: int) -> None:
        for e in stack[i:]:
            open_now[e[0]] -= 1
        del stack[i:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if page.startswith("<!--", lt):
            add(page[at:lt])
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", lt):
            add(page[at:lt])
            end = page.find("]]>", lt + 9)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(page, lt)
        if m is None:
            second = page[lt + 1 : lt + 2]
            if second and (second in "!?/" or second.isalpha()):
                add(page[at:lt])
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                add(page[at : lt + 1])
                at = lt + 1
            continue
        if lt > at:
            add(page[at:lt])
        at = m.end()
        closing, name, rest = m[1], m[2].lower(), m[3]
        inline = name in _INLINE
        if not inline:
            now = None
        if closing:
            for i in range(len(stack) - 1, -1, -1) if open_now.get(name) else ():
                if stack[i][0] == name:
                    close_from(i)
                    break
                if inline and stack[i][0] not in _INLINE:
                    break
            continue
        if name == "br":
            add(" ")
            continue
        if name in _VOID:
            continue
        ends = _ENDS.get(name)
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close_from(i)
                    break
                if stack[i][0] in _SCOPE:
                    break
        _, path, left_out, main, link, named, holder = stack[-1] if stack else ("", 0, False, -1, False, -1, 0)
        words: set[str] = set()
        tokens: list[list[str]] = []
        not_article = name in _OUTER or (name == "header" and main < 0)
        attributes = _attributes(rest) if rest.strip(" /") else {}
        label = name
        if attributes:
            names = f"{attributes.get('class', '')} {attributes.get('id', '')} {attributes.get('role', '')}"
            tokens = [[w.lower() for w in _WORDS.findall(_CAMEL.sub(" ", token))] for token in names.split()]
            words = {w for token in tokens for w in token}
            label += "." + ".".join(sorted(words)) if words else ""
            if name not in ("html", "body"):
                not_article |= any(map(_names_other, tokens)) and not (words & _LAYOUT) and not (main >= 0 and inline)
                left_out |= "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
        if name in _SKIPPED or name == "head":
            left_out = True
        if name == "body":
            left_out, named = False, -1
        if name in _RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            at = n if close is None else close.start()
        if not_article and not left_out:
            named_up.append(named)
            never.append(name in _NEVER or any(_names_other(t) and set(t) & _TALK for t in tokens))
            named = len(named_up) - 1
        if name in _MAIN:
            around.append(main)
            main_in.append(named)
            main = len(around) - 1
        if not inline:
            path = paths.setdefault((path, label), len(paths) + 1)
        if name in _HOLDS:
            holders += 1
            holder = holders
        open_now[name] = open_now.get(name, 0) + 1
        stack.append((name, path, left_out, main, link or name == "a", named, holder))
    done = []
    gone = _left_out(out, around, main_in, named_up, never)
    for b in out:
        parts = [(t, link) for t, n, link in b.parts if n < 0 or not gone[n]]
        linked = sum(len(t.strip()) for t, link in parts if link)
        text = "".join(t for t, _ in parts)
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            done.append((b.path, text, linked, b.main, b.holder, b.leaf))
    return done, around


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of a whole page: blocks in page order, joined by an
    empty line; null and empty pages, and pages without text, give an empty
    text."""
    found, around = blocks(page or "")
    if not found:
        return ""
    # Totals per path: blocks, characters outside links, punctuation.
    of = {p: i for i, p in enumerate(dict.fromkeys(b[0] for b in found))}
    at = np.array([of[b[0]] for b in found])
    count = np.bincount(at)
    own = np.array([max(len(b[1]) - b[2], 0) for b in found])
    length = np.bincount(at, own) / count
    marks = np.bincount(at, [len(_PUNCTUATION.findall(b[1])) for b in found]) / count

    main = np.array([b[3] for b in found])

    def smooth(x: np.ndarray) -> np.ndarray:
        """Over neighbours inside the same article element, or outside all."""
        value, weight = _WINDOW[2] * x, np.full(len(x), _WINDOW[2])
        for k in (1, 2):
            near = (main[k:] == main[:-k]) * _WINDOW[2 + k]
            value[k:] += near * x[:-k]
            value[:-k] += near * x[k:]
            weight[k:] += near
            weight[:-k] += near
        return value / weight

    fused = smooth(length[at]) * (1 + smooth(marks[at]))
    # A path of links only stays at its own ratio, whatever its neighbours.
    fused = np.where(length[at] > 0, fused, 0.0)
    # Text inside each article element, nested ones included; the last place
    # is that of blocks outside all of them.
    inside = np.bincount(np.where(main < 0, len(around), main), own, len(around) + 1)
    for i in range(len(around) - 1, -1, -1):
        if around[i] >= 0:
            inside[around[i]] += inside[i]
    inside[-1] = 0.0
    gained = fused * (1 + ARTICLE_GAIN * inside[main] / max(own.sum(), 1))
    per_path = np.bincount(at, gained) / count
    content = (per_path > 0) & (per_path >= threshold * fused.std())
    keep = content[at]
    # A block between two content blocks that one element holds is inside that
    # element, among its text: list items, a linked line, a short heading.
    before = np.maximum.accumulate(np.where(keep, np.arange(len(found)), -1))
    after = np.minimum.accumulate(np.where(keep, np.arange(len(found)), len(found))[::-1])[::-1]
    for i in np.flatnonzero(~keep & (before >= 0) & (after < len(found))):
        keep[i] = found[before[i]][4] == found[after[i]][4]
    return "\n\n".join(b[1] for b, k in zip(found, keep) if k and not _asks(b))


def _asks(block: tuple) -> bool:
    return block[5] in _BOXES and len(block[1]) <= CALL_LENGTH and bool(_CALL.match(block[1]))


def _main_texts(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in pages:
        yield pa.array([main_text(p) for p in batch.to_pylist()], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` → one row per input row: ``page_id, url, text, n_chars``.

    Null and empty pages, and pages without content, give an empty text;
    null ids and urls stay; repeated rows give equal rows; an empty table
    gives no rows; other columns are ignored.
    """
    pages = pick(pages, "page_id", "url", "html")
    return pages.select("page_id", "url", F.arrow_udf(_main_texts, "string")("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
