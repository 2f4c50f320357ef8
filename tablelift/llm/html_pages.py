"""Pages as a walk over tags and text: paths of elements, their roles, blocks of text. No Spark here."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

TAGS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|math|object|canvas|textarea|select|xmp)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")

# Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
# Of these, the ones that are no part of a path: they hold text side by side in one container.
FLAT = frozenset("p hr h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element that begins ends an open one of its group, up to the container named.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"})}
# Elements and names of boilerplate, and of the main text.
DROPPED = frozenset("nav footer aside form button head menu dialog fieldset search".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments disqus "
    "reply replies respond discussion related recommended share sharing social widget toolbar pagination pager login search complementary contentinfo".split()
)
MAIN = frozenset("article main".split())
MAIN_NAMES = frozenset("article articlebody article-body article-content article-text post post-body post-content entry entry-content entry-body story story-body main main-content maincontent".split())

PLAIN_ROLE, DROP_ROLE, MAIN_ROLE = 0, 1, 2


def label(name: str, attributes: str) -> tuple[str, set[str]]:
    """An element with its classes and id, numbers as 0; and these names alone."""
    if "=" not in attributes:
        return name, set()
    names = []
    for _, value in NAMES.findall(attributes):
        names += value.strip("\"'").lower().split()
    told = re.sub(r"\d+", "0", ".".join(names)).replace("/", "-")
    if len(told) > 40:
        told = f"{zlib.crc32(told.encode()):08x}"
    return f"{name}.{told}" if told else name, set(names)


def role(name: str, names: set[str], above: int) -> int:
    """The role of an element below another role."""
    if above == DROP_ROLE:
        return above
    if name in ("html", "body", "main", "article"):  # their classes tell of what lies inside, too
        parts = names if name == "article" else set()
    else:
        parts = names | {w for n in names for w in WORDS.findall(n)} if names else names
    inside = above == MAIN_ROLE
    if name in DROPPED or name == "header" and not inside or parts & DROPPED_NAMES - ({"header", "search"} if inside else set()):
        return DROP_ROLE
    return MAIN_ROLE if inside or name in MAIN or names & MAIN_NAMES else PLAIN_ROLE


@dataclass
class Block:
    """A run of text between two tags that end blocks."""

    path: str
    role: int
    last: str  # the last template tag before it, with its path
    text: str
    letters: int
    linked: int
    constant: bool  # every word is part of the template


def walk(page: str):
    """(path, tag, text, linked, role, breaks) of every tag or text, in order; of a tag or a text the other is None. ``breaks``: the tag
    ends a block. A path names the open containers; elements left open end with their container. Other elements are containers only
    where their names say that their text is to be dropped."""
    stack: list[tuple[str, str, int]] = []
    path, now, at, link = "", PLAIN_ROLE, 0, -1
    for m in TAGS.finditer(page):
        if m.start() > at:
            yield path, None, page[at : m.start()], link >= 0, now, False
        at = m.end()
        name = m[3] or m[6]
        if name is None:
            continue
        name, closing, attributes = name.lower(), m[2] or m[5], m[4] or m[7] or ""
        if name == "a":
            link = -1 if closing else len(stack)
        breaks, depth = name in BLOCKS, len(stack)
        tag, names = ("</" + name, ()) if closing else label(name, attributes)
        holds = breaks and name not in FLAT or names and name not in VOID and now != DROP_ROLE and role(name, names, now) == DROP_ROLE
        if breaks and stack and stack[-1][0] in FLAT:  # ended by any other block
            depth -= 1
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), depth)
        elif name in ENDS:
            group, until = ENDS[name]
            i = depth
            while i and stack[i - 1][0] not in until:
                i -= 1
                if stack[i][0] in group:
                    depth = i
        elif breaks and name != "title" and stack and stack[-1][0] in ("head", "title"):
            depth = next(i for i, s in enumerate(stack) if s[0] in ("head", "title"))
        if depth < len(stack):
            del stack[depth:]
            path, now = stack[-1][1:] if stack else ("", PLAIN_ROLE)
            if link > depth:
                link = -1
        yield path, tag if closing else "<" + tag, None, link >= 0, now, breaks
        if holds and not closing:
            now = role(name, names, now)
            path = f"{path}/{tag}"
            if len(path) > 2000:  # of very deep pages
                path = f"/{zlib.crc32(path.encode()):08x}"
            stack.append((name, path, now))
    if at < len(page):
        yield path, None, page[at:], link >= 0, now, False


def blocks(page: str, template: dict[str, frozenset[str]]) -> list[Block]:
    """The blocks of text of a page, entities decoded and white space as one space. ``template``: tokens of the template by path."""
    found: list[Block] = []
    texts: list[str] = []
    linked, constant, last = 0, True, ""
    where = ("", PLAIN_ROLE, "")
    none: frozenset[str] = frozenset()
    for path, tag, text, link, now, breaks in walk(page):
        if tag is None:
            if texts and now != where[1] and DROP_ROLE in (now, where[1]):  # dropped text inside of a block
                if now == DROP_ROLE:
                    continue
                texts.clear()
            if not texts:
                where, linked, constant = (path, now, last), 0, True
            texts.append(text)
            if link:
                linked += len("".join(text.split()))
            constant = constant and template.get(path, none).issuperset(text.split())
            continue
        if breaks and texts:
            _end(found, where, texts, linked, constant)
        elif texts and tag == "<br":
            texts.append(" ")
        if tag in template.get(path, none):
            last = f"{path} {tag}"
    if texts:
        _end(found, where, texts, linked, constant)
    return found


def _end(found: list[Block], where: tuple[str, int, str], texts: list[str], linked: int, constant: bool) -> None:
    text = "".join(texts)
    texts.clear()
    text = " ".join((html.unescape(text) if "&" in text else text).split())
    if text:
        found.append(Block(*where, text, len(text) - text.count(" "), linked, constant))
