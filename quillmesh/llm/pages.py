"""The structure of a stored page: its text blocks, its element tree, and the part of the tree that holds the page's own text.

Tree scoring: a text block passes points for its length and its commas on to the elements above it, less at each step, discounted by
the share of its text that is links. The first heading's element gets points of its own; elements that are known or seen to hold
other things - by their tag, class, first heading, buttons or fact lists - are discounted. The best element and those of its siblings
that are built like it or score nearly as high make up the main part.
"""

from __future__ import annotations

import re
from html import unescape

from quillmesh.functions.html import _TOKEN, INLINE, VOID, clean

# Class words of containers, and tags by their role.
_NEGATIVE = re.compile(r"(?:^|[\s_-])(?:nav|menu|breadcrumb|sidebar|side|footer|foot|header|comments?|consent|cookie|gdpr|banner|notice|promo|related|teaser|share|social|advert|ad|popup|modal|widget|login|signup)(?:$|[\s_-])", re.I)
_POSITIVE = re.compile(r"(?:^|[\s_-])(?:entry|article|body|bodycopy|content|main|post|text|story|gallery)(?:$|[\s_-])", re.I)
_NEGATIVE_TAGS = frozenset("nav aside footer header form dl".split())
_TRANSPARENT = frozenset("font center header hgroup".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NOT_CANDIDATES = frozenset("html body head table tbody thead tr ul ol dl p font center figcaption li".split())
_SILENT = _HEADINGS | frozenset("dt dd button option label legend head".split())
_CLOSES_P = frozenset("p div ul ol dl table blockquote figure section article aside main nav footer header h1 h2 h3 h4 h5 h6 pre form hr fieldset".split())
_IMPLIED = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")), "tr": ("tr", ("table", "tbody")), "option": ("option", ("select",))}
_CLASS = re.compile(r"class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_META = re.compile(r"property\s*=\s*[\"']og:title[\"'][^>]*?content\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_SUFFIX = re.compile(r"\s+[|–—-]\s+[^|–—-]+$")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)

# How calls to action, consent notices and imprints begin on any site. What else stands around the texts of a site is told by
# where its sentences stand on other pages (see boilerplate), not by phrases.
NOTICE_START = re.compile(
    r"(?:share (?:this|on)\b|follow us|sign up\b|subscribe|join (?:the|our|us)\b|log ?in\b|register\b|create an account|become a (?:member|patron|supporter)|download (?:the|our) app|get (?:the|our) (?:\w+ )?(?:newsletter|digest|app)"
    r"|take (?:the|our) \S* ?survey|advertisement\b|sponsored\b|like what you read|want more\?|you have read \d+ of|(?:this|our) (?:web)?site uses cookies|cookies? (?:help|policy|settings|notice)|your privacy|accept (?:all|cookies)|reject all"
    r"|©|copyright|all rights reserved|terms of (?:use|service)|privacy policy|legal notice)", re.I,
)
#: By how much less the last block of a page counts than its first: what closes a page is less likely its text than what opens it.
LATE = 0.6
_META_BLOCK = re.compile(r"^(?:@?[\w.-]+|\d{1,2}\.? [^\W\d]+(?: \d{4})?|[^\W\d]+ \d{1,2}(?:, \d{4})?|\d+ (?:minutes?|hours?|days?|weeks?|months?|years?) ago|(?:[^.!?·|»]{1,24}[·|»] ?){1,12}[^.!?·|»]{0,24})$")


def is_notice(text: str) -> bool:
    return bool(NOTICE_START.match(text))


def is_aside(text: str) -> bool:
    """A notice, or a name, a date or a row of buttons and links."""
    return bool(_META_BLOCK.match(text)) or is_notice(text)


class Page:
    """One parsed page. blocks: (text, element, share of link characters); elements have a tag, class, parent and child tags."""

    __slots__ = ("aside", "blocks", "classes", "children", "h1", "main", "og_title", "parent", "penalty", "tags", "title")

    def __init__(self, html: str):
        self.tags, self.classes, self.parent, self.children = ["#"], [""], [0], [[]]
        self.blocks: list[tuple[str, int, float]] = []
        tags, classes, parent, children, blocks = self.tags, self.classes, self.parent, self.children, self.blocks
        stack, parts, pos, link, links, in_link = [0], [], 0, 0, 0, False
        self.h1 = 0

        def flush() -> None:
            nonlocal links
            text = "".join(parts)
            parts.clear()
            if text and not text.isspace():
                text = clean(text)
                if text:
                    blocks.append((text, stack[-1], min(1.0, links / len(text))))
            links = 0

        for m in _TOKEN.finditer(html):
            start = m.start()
            if start > pos:
                piece = html[pos:start]
                parts.append(piece)
                if in_link:
                    links += len(piece)
            pos = m.end()
            name = m[3]
            if name is None:
                # Comments vanish; an element dropped with its content ends a block.
                if m[1] is not None:
                    flush()
                continue
            name = name.lower()
            if name in INLINE:
                if name == "a":
                    in_link = not m[2]
                continue
            if parts:
                flush()
            if m[2]:
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == name:
                        del stack[k:]
                        break
                continue
            if name in _CLOSES_P:
                for k in range(len(stack) - 1, max(0, len(stack) - 4), -1):
                    if tags[stack[k]] == "p":
                        del stack[k:]
                        break
                    if tags[stack[k]] not in _TRANSPARENT:
                        break
            elif name in _IMPLIED:
                same, bounds = _IMPLIED[name]
                for k in range(len(stack) - 1, 0, -1):
                    t = tags[stack[k]]
                    if t in same.split():
                        del stack[k:]
                        break
                    if t in bounds:
                        break
            if name in VOID:
                continue
            raw = m[4]
            c = _CLASS.search(raw) if raw else None
            node = len(tags)
            tags.append(name)
            classes.append((c[1] or c[2] or c[3] or "") if c else "")
            parent.append(stack[-1])
            children.append([])
            children[stack[-1]].append(node)
            stack.append(node)
            if name == "h1" and not self.h1:
                self.h1 = node
        parts.append(html[pos:])
        flush()
        t, o = _TITLE.search(html), _META.search(html)
        self.title = clean(t[1]) if t else ""
        self.og_title = clean(unescape(o[1] or o[2] or "")) if o else ""
        self.aside = [tags[e] in _SILENT or is_aside(text) for text, e, _ in blocks]
        self.main: set[int] = set()
        self.penalty: list[float] = []
        self._score()

    def _heading(self) -> int:
        """The element whose heading the first h1 is."""
        p = self.parent[self.h1]
        while self.tags[p] in _TRANSPARENT:
            p = self.parent[p]
        return p

    def _signature(self, node: int) -> tuple:
        return self.tags[node], tuple(self.tags[c] for c in self.children[node])

    def _score(self) -> None:
        n, tags, parent = len(self.tags), self.tags, self.parent
        points, penalty, first = [0.0] * n, [1.0] * n, [""] * n
        direct: dict[int, int] = {}
        for _, e, _ in self.blocks:
            direct[e] = direct.get(e, 0) + 1
        holds_h1 = set()
        e = self.h1
        while e:
            holds_h1.add(e)
            e = parent[e]
        for e in range(1, n):
            t, c = tags[e], self.classes[e]
            if t in _NEGATIVE_TAGS or (c and _NEGATIVE.search(c) and not _POSITIVE.search(c)):
                penalty[e] = 0.1
            if e in holds_h1:
                penalty[e] = 1.0
            elif t in ("h3", "h4", "h5", "h6", "button") or t == "dl":
                # What begins with a minor heading, or holds a button or a fact list, and not the page's heading, stands beside its text.
                p = parent[e]
                if p not in holds_h1 and tags[p] not in ("html", "body") and (t in ("dl", "button") or self.children[p][0] == e):
                    penalty[p] = min(penalty[p], 0.1)
        inherited = list(penalty)
        for e in range(1, n):
            inherited[e] = min(penalty[e], inherited[parent[e]]) if e not in holds_h1 else penalty[e]
        self.penalty = inherited
        last = max(1, len(self.blocks) - 1)
        for at, ((text, e, ld), aside) in enumerate(zip(self.blocks, self.aside, strict=True)):
            t = tags[e]
            if aside:
                continue
            p = (1.0 + text.count(",") + min(len(text) / 100.0, 3.0)) * (1.0 - ld) * inherited[e] * (1.0 - LATE * at / last)
            x = e if direct[e] > 1 or t in ("td", "body", "main", "article", "section") else parent[e]
            for share in (1.0, 0.5, 0.25):
                if not x:
                    break
                points[x] += p * share
                x = parent[x]
        top = self._heading() if self.h1 else 0
        if top and tags[top] not in ("body", "html"):
            points[top] += 3.0
        best, most = 0, 0.0
        for e in range(1, n):
            if tags[e] in _NOT_CANDIDATES:
                continue
            s = points[e] * inherited[e]
            if s > most:
                best, most = e, s
        if not best:
            return
        # An element that only wraps the best one's text loses to it, as it gets half; one that adds as much again wins.
        self.main = {best}
        like = self._signature(best)
        for s in self.children[parent[best]]:
            if s != best and inherited[s] == 1.0 and s not in holds_h1:
                if (self.classes[s] == self.classes[best] or not self.classes[s]) and self._signature(s) == like and points[s] > 0 and len(like[1]) > 1:
                    self.main.add(s)
                elif tags[s] not in _SILENT and points[s] >= 0.3 * most and points[s] > 2.0 and tags[s] == tags[best]:
                    self.main.add(s)

    def titles(self) -> set[str]:
        """The first heading and the page's title without the site's name, as far as they have text."""
        heading = next((t for t, e, _ in self.blocks if e == self.h1), "") if self.h1 else ""
        return {heading, _SUFFIX.sub("", self.title)} - {""}

    def main_text(self) -> list[str]:
        """The running text of the main part: without headings, labels, notices, dates, names and buttons."""
        return self.running_text()[0]

    def running_text(self) -> tuple[list[str], list[str]]:
        """(main text, text of the blocks outside of the main part, without headings, labels and buttons)."""
        inside = [False] * len(self.tags)
        for e in range(1, len(self.tags)):
            inside[e] = e in self.main or inside[self.parent[e]]
        main, outside = [], []
        for (text, e, ld), aside in zip(self.blocks, self.aside, strict=True):
            if inside[e] and self.penalty[e] == 1.0:
                if not aside and not (ld > 0.95 and text.count(" ") < 3):
                    main.append(text)
            elif self.tags[e] not in _SILENT:
                outside.append(text)
        return main, outside
