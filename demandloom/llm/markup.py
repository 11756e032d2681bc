"""A page's text as blocks: what its main element holds, and what lies outside."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of HTML and words that sites put into class, id or role.
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "nav footer aside menu noscript template svg math canvas object audio video button select "
    "datalist dialog head".split()
)
MAIN = frozenset(("article", "main"))
HINTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar sidebar rail widget "
    "related recommended footer colophon copyright contentinfo complementary ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe signup login search form share sharing "
    "social skip hidden".split()
)
HEADER_HINTS = frozenset("header masthead banner topbar".split())
COMMENT_HINTS = frozenset("comment comments commentlist disqus respond replies discussion".split())
CLOSES_ITSELF = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
UNSEEN = re.compile(
    r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE
)
WORDS = re.compile(r"[a-z0-9]+")

KEEP, WEAK, FIRM = 0, 1, 2  # how an element drops what is in it


@dataclass
class Page:
    """Block texts in page order; ``main`` only if there is a main element."""

    has_main: bool = False
    main: list[str] = field(default_factory=list)
    outside: list[str] = field(default_factory=list)
    dropped: list[bool] = field(default_factory=list)  # for each block of ``outside``


def dropping(name: str, attributes: str, in_article: bool) -> int:
    """Whether an element is no content: ``WEAK`` if a main element inside lifts that."""
    if name in DROPPED or attributes and UNSEEN.search(attributes):
        return FIRM
    if name == "header":
        return KEEP if in_article else FIRM
    if name == "form":
        return WEAK
    if not attributes or name in ("html", "body", "main"):
        return KEEP
    given = {w for m in NAMED.finditer(attributes) for w in WORDS.findall(m[m.lastindex].lower())}
    if given & COMMENT_HINTS:
        return FIRM
    if name == "article":
        return KEEP
    hints = HINTS if in_article else HINTS | HEADER_HINTS
    return WEAK if given & hints else KEEP


def read(source: str) -> Page:
    """Text of a page without markup, scripts and styles, block by block.

    Unclosed and stray tags are dealt with as browsers do: a block ends an open
    paragraph, an end tag closes what is open inside, one without a start is ignored.
    What begins like a tag at the end of a cut-off page is markup.
    """
    page = Page()
    stack: list[tuple[str, int, bool]] = []
    text: list[str] = []
    state = [False, KEEP]  # inside a main element, and how the text is dropped

    def flush():
        if text:
            block = " ".join("".join(text).split())
            text.clear()
            if block:
                if state[0] and not state[1]:
                    page.main.append(block)
                else:
                    page.outside.append(block)
                    page.dropped.append(state[1] > 0)

    def settle():
        inside, drop = False, KEEP
        for _, how, is_main in stack:
            if is_main and drop < FIRM:
                inside, drop = True, KEEP
            drop = max(drop, how)
        if [inside, drop] != state:
            flush()
            state[:] = inside, drop

    def close(names, within):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                settle()
                return
            if within and stack[i][0] in BLOCKS and stack[i][0] not in ("tbody", "thead", "tfoot"):
                return

    at = 0
    while (m := TAG.search(source, at)) is not None:
        if m.start() > at:
            piece = source[at : m.start()]
            text.append(html.unescape(piece) if "&" in piece else piece)
        at = m.end()
        slash, name, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            text.append(" ")
        if slash:
            close((name,), False)
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE).search(source, at)
            at = end.start() if end else len(source)
        elif name not in VOID:
            if name in BLOCKS:
                close(("p",), True)
            if name in CLOSES_ITSELF:
                close(CLOSES_ITSELF[name], True)
            if name == "body":
                stack.clear()
            in_article = any(is_main and tag == "article" for tag, _, is_main in stack)
            how = dropping(name, attributes, in_article)
            is_main = name in MAIN and how < FIRM or 'role="main"' in attributes
            stack.append((name, how, is_main))
            if how or is_main:
                settle()
            page.has_main |= is_main and state[0]
    if at < len(source):
        piece = source[at:]
        text.append(html.unescape(piece) if "&" in piece else piece)
    flush()
    return page
