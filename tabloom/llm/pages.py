"""Web pages as trees of blocks: a forgiving reader of HTML, and what names say about elements."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import xxhash

# HTML's own kinds of elements, and words that sites name their page furniture by.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
SKIPPED = frozenset("script style noscript template iframe object svg canvas audio video select textarea title noembed noframes".split())
HEAD = frozenset("base link meta noscript script style template title".split())
FURNITURE = frozenset("nav footer aside dialog menu head fieldset datalist".split())
CONTROLS = frozenset(["button", "label"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an open element of the first kind ends at the latest, and where the search for it stops.
ENDED_BY_ITS_LIKE = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "tbody": ("thead tbody tfoot", ("table",)),
    "thead": ("thead tbody tfoot", ("table",)),
    "tfoot": ("thead tbody tfoot", ("table",)),
}
FURNITURE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
    notification alert popup modal overlay lightbox nav navi navigation navbar menu menubar breadcrumb breadcrumbs sidebar aside rail footer
    masthead topbar toolbar comment comments commentlist disqus respond reply replies discussion share sharing social related recommended
    recommendations newsletter subscribe subscription signup signin login search pagination pager widget widgets skip copyright complementary
    contentinfo navigation form""".split()
)
#: Names of a page's head; inside an article they name the article's own.
HEADER_NAMES = frozenset(["header", "head"])

BY_FORM, BY_NAME, BY_TAG = 1, 2, 4
DEEPEST = 512
PAGE = 1 << 64

TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<[!?][^>]*(?:>|\Z)
    |</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)
    |<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>
    |<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|href)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"\d+")


def number(text: str) -> int:
    """A 64-bit hash as a long."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - PAGE if value >> 63 else value


@lru_cache(50_000)
def described(tag: str, attributes: str) -> tuple[str, frozenset[str], str, str]:
    """Signature (tag, classes and id, digits alike), words of the names, role or item property, link."""
    found = {name.lower(): value.strip("\"'") for name, value in reversed(ATTRIBUTE.findall(attributes))}
    names = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}"
    signature = DIGITS.sub("0", f"{tag}.{' '.join(sorted(found.get('class', '').split()))}#{found.get('id', '')}")
    words = frozenset(w.lower() for w in NAME.findall(names))
    return signature, words, f"{found.get('role', '')} {found.get('itemprop', '')}".lower(), found.get("href", "")


@lru_cache(200_000)
def child_key(parent: int, signature: str) -> int:
    return number(f"{parent}/{signature}")


class Element:
    """A block of the page, or an inline element whose name says that it is furniture.

    ``key`` stands for the path of signatures from the root, ``noise`` for why the element, or one
    around it, is furniture by what HTML or its names declare."""

    __slots__ = ("tag", "parent", "key", "depth", "inline", "noise", "article", "main", "plain", "children", "features")

    def __init__(self, tag: str, parent: Element | None, key: int, inline: bool = False) -> None:
        self.tag, self.parent, self.key, self.inline = tag, parent, key, inline
        self.depth = parent.depth + 1 if parent else 0
        self.noise = parent.noise if parent else 0
        self.article = parent.article if parent else False
        self.main = parent.main if parent else False
        self.plain = False
        self.children: list[str] = []
        self.features: list[int] = []

    def declare(self, words: frozenset[str], kind: str) -> None:
        """Take in what the tag, the names and the role declare."""
        inside = self.article
        if self.tag in ("html", "body"):
            return
        if self.tag == "main" or "main" in kind.split():
            self.main, self.noise = True, self.noise & BY_TAG
            return
        if self.tag == "article" or "articlebody" in kind:
            self.noise &= ~BY_FORM
            if self.tag == "article" and inside:
                self.noise |= BY_TAG  # articles in an article are its readers' comments
        if self.tag == "form":
            self.noise |= BY_FORM
        if self.tag in FURNITURE or (self.tag == "header" and not inside):
            self.noise |= BY_TAG
        # An article's own names say what it is about, and whether comments are open.
        if self.tag != "article" and "articlebody" not in kind and (words & FURNITURE_NAMES or (words & HEADER_NAMES and not inside)):
            self.noise |= BY_NAME
        if not self.noise and (self.tag == "article" or "articlebody" in kind):
            self.article = True
        # Unnamed parts of an article are its text by declaration.
        self.plain = self.article and (not inside or (self.parent.plain and not words))


def parsed(html: str, root: int) -> tuple[list[Element], list[tuple[Element, str]]]:
    """All block elements, parents first, and the blocks of text in page order."""
    at = Element("", None, root)
    elements, blocks, buffer = [at], [], []
    position, length, over, seen_body = 0, len(html), 0, False

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                owner = at
                while owner.inline:
                    owner = owner.parent
                blocks.append((owner, text))

    def say(text: str) -> None:
        if not at.inline:
            buffer.append(unescape(text) if "&" in text else text)

    while position < length:
        start = html.find("<", position)
        if start < 0:
            say(html[position:])
            break
        if start > position:
            say(html[position:start])
        match = TAG.match(html, start)
        if not match:
            say("<")
            position = start + 1
            continue
        position = match.end()
        closing, name, attributes, loose, rest = match.groups()
        if closing:
            closing = closing.lower()
            if closing in INLINE or closing in CONTROLS:
                if at.inline and at.tag == closing:
                    at = at.parent
                continue
            if over and closing not in VOID:
                over -= 1
                continue
            if closing == "br":
                say(" ")
                continue
            found = at
            while found and found.tag != closing:
                found = found.parent
            if found and closing not in ("html", "body"):
                flush()
                at = found.parent
            elif closing == "p":
                flush()
            continue
        name = (name or loose or "").lower()
        if not name:
            continue  # a comment or a declaration
        attributes = attributes or rest or ""
        if name in SKIPPED:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, position)
            position = end.end() if end else length
            if name not in HEAD:
                flush()
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                say(" ")
            continue
        if at.tag == "head" and name not in HEAD:
            flush()
            at = at.parent
        if name in CONTROLS or (at.inline and name == at.tag):
            at = Element(name, at, at.key, inline=True)
            continue
        if name in INLINE:
            if attributes:
                signature, words, kind, link = described(name, attributes)
                if link:
                    owner = at
                    while owner.inline:
                        owner = owner.parent
                    owner.features.append(number("link " + DIGITS.sub("0", link)))
                if words & FURNITURE_NAMES:
                    at = Element(name, at, at.key, inline=True)
            continue
        flush()
        while at.inline:
            at = at.parent
        if name == "html" or (name == "body" and seen_body):
            continue
        seen_body = seen_body or name == "body"
        if at.tag == "p" or (name in HEADINGS and at.tag in HEADINGS):
            at = at.parent
        like, stops = ENDED_BY_ITS_LIKE.get(name, ("", ()))
        if like:
            found = at
            while found and found.tag not in stops and found.tag not in like.split():
                found = found.parent
            if found and found.tag in like.split():
                at = found.parent
        if at.depth >= DEEPEST:
            over += 1
            continue
        signature, words, kind, _ = described(name, attributes)
        if not at.children or at.children[-1] != signature:
            at.children.append(signature)
        at = Element(name, at, child_key(at.key, signature))
        at.declare(words, kind)
        elements.append(at)
    flush()
    return elements, blocks
