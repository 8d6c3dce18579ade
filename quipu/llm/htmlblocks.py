"""Web pages as trees of elements with blocks of text, for the extraction of main text."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

# fixed values: element names of HTML
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup "
    "option p pre search section select summary svg table tbody td template tfoot th thead tr ul video audio canvas object".split()
)
#: a start tag ends open elements of the second set, as far as the next of the third
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# fixed values: what element names, roles and the words of class and id say about the text inside
NEVER, REPLACEABLE, SILENT, LIKELY, MAIN = -2, -1, 0, 1, 2
TAGS = {
    **dict.fromkeys("nav footer aside dialog menu button select optgroup option noscript template svg video audio canvas object label legend head".split(), NEVER),
    **dict.fromkeys("header form fieldset search".split(), REPLACEABLE),
    **dict.fromkeys("article main".split(), MAIN),
}
ROLES = {
    **dict.fromkeys("navigation contentinfo complementary search dialog alertdialog alert banner menu menubar toolbar".split(), NEVER),
    "form": REPLACEABLE,
    **dict.fromkeys("main article".split(), MAIN),
}
NEVER_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs sidebar aside rail footer colophon masthead topbar toolbar cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login signin register paywall share sharing social follow related recommended recommendations trending teaser "
    "widget widgets pagination pager comment comments commentlist reply replies respond disqus discussion feedback copyright "
    "disclaimer legal privacy outbrain taboola skip hidden".split()
)
REPLACEABLE_WORDS = {"header", "form", "search"}
LIKELY_WORDS = set("article articles content main post entry story body text prose".split())
NEGATING = {"has", "with", "no", "without", "not", "is", "category", "tag", "topic"}  # before a word
NEGATED = {"open", "closed", "off", "disabled"}  # behind it

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>\x00]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?/][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?=[\s/]|$))""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@lru_cache(1 << 14)
def own_evidence(name: str, attrs: str) -> int:
    """What an element's own name and attributes say."""
    said = TAGS.get(name, SILENT)
    if not attrs or name in ("body", "html") or said == NEVER:
        return said
    words = []
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), next(filter(None, values), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDING.search(value):
            return NEVER
        if key == "role":
            said = ROLES.get(value.strip().lower(), said)
        elif key in ("class", "id"):
            for term in value.split():
                parts = [x.lower() for x in NAME_PART.findall(term)]
                if said == MAIN and len(parts) > 1:
                    continue  # classes of a topic or state
                words += [w for w, before, after in zip(parts, ["", *parts], [*parts[1:], ""]) if before not in NEGATING and after not in NEGATED]
    if said == NEVER or any(w in NEVER_WORDS for w in words):
        return NEVER
    if said == SILENT and any(w in LIKELY_WORDS for w in words):
        return LIKELY
    return REPLACEABLE if said == SILENT and any(w in REPLACEABLE_WORDS for w in words) else said


def inherited(above: int, own: int, name: str) -> int:
    """Evidence of an element below one with evidence `above`."""
    if NEVER in (above, own):
        return NEVER
    if own == REPLACEABLE:
        return above if above == MAIN and name != "form" else REPLACEABLE
    return max(own, above) if own > 0 or above != REPLACEABLE else REPLACEABLE


class Page:
    """Elements (`parent`, `evidence`) and text blocks in page order (`owner`, `tag`, `text`, `linked`)."""

    def __init__(self, html: str) -> None:
        self.parent, self.evidence, self.names = [-1], [SILENT], [""]
        self.owner: list[int] = []
        self.tag: list[str] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self._stack, self._open = [0], {}
        self._pieces: list[tuple[str, bool]] = []
        self._link = 0  # depth of the element that holds an open link, from 1
        self._read(html)

    def _read(self, html: str) -> None:
        at, whole = 0, html.rfind(">") + 1
        while (tag := TAG.search(html, at, whole)) is not None:
            if tag.start() > at:
                self._pieces.append((html[at : tag.start()], self._link > 0))
            at = tag.end()
            if tag["name"]:
                name = tag["name"].lower()
                if tag["end"]:
                    self._close(name)
                else:
                    self._begin(name, tag["attrs"])
                    if name in RAW:
                        after = raw_end(name).search(html, at)
                        at = after.start() if after else len(html)
            elif tag[0].startswith("<!--") and not tag[0].endswith("-->"):
                at = len(html)
        rest = html[at:]
        cut = re.search(r"<[a-zA-Z!?/]", rest)  # a tag that never ends
        self._pieces.append((rest[: cut.start()] if cut else rest, self._link > 0))
        self._flush()

    def _flush(self) -> None:
        if not self._pieces:
            return
        pieces, self._pieces = self._pieces, []
        text = "".join(p for p, _ in pieces)
        text = " ".join((unescape(text) if "&" in text else text).split())
        if text:
            self.owner.append(self._stack[-1])
            self.tag.append(self.names[self._stack[-1]])
            self.text.append(text)
            self.linked.append(sum(len(p.strip()) for p, linked in pieces if linked))

    def _pop(self) -> None:
        self._open[self.names[self._stack.pop()]] -= 1
        if self._link > len(self._stack):
            self._link = 0

    def _begin(self, name: str, attrs: str) -> None:
        if name == "br":
            self._pieces.append((" ", False))
        if name == "a":
            self._link = len(self._stack)
        if name not in BLOCKS:
            return
        self._flush()
        if name in VOID:
            return
        top = self.names[self._stack[-1]]
        if top == "p" or name in HEADINGS and top in HEADINGS:
            self._pop()
        ends, scope = IMPLIED.get(name, ((), ()))
        if any(self._open.get(x) for x in ends):
            for depth in range(len(self._stack) - 1, 0, -1):
                here = self.names[self._stack[depth]]
                if here in scope:
                    break
                if here in ends:
                    while len(self._stack) > depth:
                        self._pop()
                    break
        above = self._stack[-1]
        self._stack.append(len(self.parent))
        self._open[name] = self._open.get(name, 0) + 1
        self.parent.append(above)
        self.names.append(name)
        self.evidence.append(inherited(self.evidence[above], own_evidence(name, attrs), name))

    def _close(self, name: str) -> None:
        if name == "a":
            self._link = 0
        if name not in BLOCKS:
            return
        self._flush()
        if self._open.get(name):
            while self.names[self._stack[-1]] != name:
                self._pop()
            self._pop()


@lru_cache(len(RAW))
def raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])", re.I)
