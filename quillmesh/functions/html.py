"""HTML without a browser: a tag tokenizer, text blocks and an element tree.

Everything here is plain Python over one page's text, made to be called from Arrow batches. The tokenizer is a single compiled
pattern, so that a page costs one pass over its text and one step for each tag.
"""

from __future__ import annotations

import re
from html import unescape

# Elements that vanish from running text, elements dropped with their content, elements without content.
INLINE = frozenset("a b i em strong span sup small code".split())
DROPPED = ("script", "style", "noscript", "template", "title")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*|/)?)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_CLASS = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")


def clean(text: str) -> str:
    """Entities decoded, white space (the no-break space is one) as single blanks, trimmed."""
    if "&" in text:
        text = unescape(text)
    return " ".join(text.split())


def attributes(raw: str) -> dict[str, str]:
    """The attributes of one tag; the first of a repeated name holds, names in lower case, values decoded."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def tags(html: str):
    """(start, end, closing, name, raw attributes) of each tag; name is '' for what is dropped with its content."""
    for m in _TOKEN.finditer(html):
        name = m[3]
        yield m.start(), m.end(), m[2] == "/", name.lower() if name else "", m[4] or ""
