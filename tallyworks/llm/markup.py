"""Lines of text in HTML pages, and what the markup says about each."""

from __future__ import annotations

import html
import re
from collections import Counter

#: What the markup says of a line: page furniture, nothing, or part of the main text.
FURNITURE, PLAIN, MAIN = 0, 1, 2

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>?|<!--(?:(?:.*?-->)|.*\Z)|<[!?][^>]*+>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_HIDDEN = frozenset("audio button canvas datalist head math noscript object option select svg template video".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: A new one of these ends the last one, unless one of the containers opened since.
_IMPLIED = {
    "p": ({"p"}, _BLOCK - {"p"}),
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_FURNITURE_TAGS = frozenset("aside dialog fieldset footer form menu nav search".split())
_FURNITURE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words in the class or id of furniture.
_FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement advertisements advertising adverts aside banner breadcrumb breadcrumbs comment commentlist comments consent"
    " cookie cookies copyright disclaimer discussion disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification pager pagination popup promo promotion recommendations recommended related replies reply respond share sharing"
    " sidebar signup social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
#: Words that tell a frame by what it has or lacks, as in "has-sidebar".
_FRAME_WORDS = frozenset("has no with without".split())
_MAIN_NAMES = frozenset("articlebody articlecontent articletext entrycontent entrytext maincontent postbody postcontent posttext storybody".split())
_WORD = re.compile(r"[a-z0-9]+")


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


def _says(tag: str, attributes: str, now: int) -> int | None:
    """What an element makes of the lines in it, given what holds around it; None where it isn't shown."""
    if tag in _HIDDEN:
        return None
    if now == FURNITURE:
        return FURNITURE
    found = _attributes(attributes) if attributes.strip() else {}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return None
    names = [n.lower() for n in (found.get("class", "").split() + found.get("id", "").split())]
    words = {w for n in names for w in _WORD.findall(n)}
    role = found.get("role", "").lower()
    frame = tag in ("html", "body", "main") or role == "main" or words & _FRAME_WORDS
    if tag in _FURNITURE_TAGS or role in _FURNITURE_ROLES or (words & _FURNITURE_WORDS and not frame):
        return FURNITURE
    if now == PLAIN and (tag == "header" or "header" in words) and not frame:
        return FURNITURE
    if tag in ("article", "main") or role in ("article", "main") or found.get("itemprop") == "articleBody":
        return MAIN
    return MAIN if any(re.sub(r"[^a-z0-9]", "", n) in _MAIN_NAMES for n in names) else now


def page_lines(page: str) -> tuple[list[str], list[int]]:
    """The text of each block of a page, in order, and what the markup says of it.

    Character references are decoded, white space is one space, and blocks without text are left out. Text in scripts,
    styles, hidden elements and comments is no block.
    """
    lines: list[str] = []
    said: list[int] = []
    pieces: list[str] = []
    stack: list[tuple[str, int | None]] = []
    open_tags: Counter[str] = Counter()
    now: int | None = PLAIN

    def end_line() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                lines.append(text)
                said.append(now)

    def close(depth: int) -> int | None:
        for tag, _ in stack[depth:]:
            open_tags[tag] -= 1
        del stack[depth:]
        return stack[-1][1] if stack else PLAIN

    at = 0
    while True:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text and now is not None:
            pieces.append(html.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        if not (tag := found[2]):
            continue
        tag, ends = tag.lower(), bool(found[1])
        block = tag in _BLOCK
        if block or tag == "br":
            end_line()
        if ends:
            if open_tags[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag and (block or stack[depth][0] not in _BLOCK):
                    depth -= 1
                if stack[depth][0] == tag:
                    if not block:
                        changed = close(depth)
                        if changed != now:
                            end_line()
                        now = changed
                    else:
                        now = close(depth)
            continue
        if tag in _VOID:
            continue
        if tag in _RAW:
            gone = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = gone.start() if gone else len(page)
            continue
        ended, within = _IMPLIED.get(tag, _IMPLIED["p"] if block else ((), ()))
        for name in ended:
            if open_tags[name]:
                depth = len(stack) - 1
                while depth >= 0 and stack[depth][0] not in ended and stack[depth][0] not in within:
                    depth -= 1
                if depth >= 0 and stack[depth][0] in ended:
                    now = close(depth)
                    break
        says = None if now is None else _says(tag, found[3], now)
        if says != now and not block:
            end_line()
        if block or says != now or open_tags[tag]:
            stack.append((tag, says))
            open_tags[tag] += 1
            now = says
    end_line()
    return lines, said
