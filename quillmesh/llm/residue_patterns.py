"""A short list of what error pages, script and browser checks, filler and unfilled placeholders say on any site.

These are the standard phrases: the reasons of the HTTP statuses, the requests for scripts in five languages, the usual filler and the
syntax of template languages. Sentences that begin with one of them are trusted as residue; all else is found from these by the
operator. The patterns are anchored, so a sentence that talks about such a text or quotes it isn't one.
"""

from __future__ import annotations

import re

STATUS = (
    r"(?:error|http)\s*[:#]?\s*[1-5]\d\d\b", r"(?:0|[1-5]\d\d) (?:error|not found|forbidden|unauthorized|bad request|bad gateway|gateway time-?out|service unavailable|internal server error|too many requests)\b", r"(?:internal server|fatal|unexpected|application|gateway) error\b",
    r"(?:bad gateway|service (?:temporarily )?unavailable|access denied|forbidden|too many requests|gateway time-?out)\b", r"(?:the )?(?:page|file|url|site|entry) (?:you (?:were looking for|requested) )?(?:was |could |can )?not (?:be )?found\b", r"not found[.!]?$", r"error(?: code)?[:!.]?(?: \d+)?$",
    r"(?:page introuvable|seite nicht gefunden|página no encontrada|página não encontrada)\b",
)
SCRIPTS = (
    r"(?:please |bitte |veuillez |por favor,? )?(?:enable|activate|turn on|aktivieren sie|activer|active|activa|ative|habilite|habilita) java ?script\b", r"[\w' ]{1,40}\b(?:requires|needs|without) java ?script\b", r"java ?script (?:is|must be) (?:required|disabled|enabled|needed)\b", r"checking your browser", r"(?:please )?(?:verify|confirm|prove) (?:that )?you are (?:not a robot|human)\b", r"just a moment\b",
)
FILLER = (r"(?:content )?coming soon[.!]?$", r"content coming soon\b", r"(?:sample|placeholder|dummy|filler) (?:text|copy|paragraph|content)\b", r"your (?:text|title|heading|paragraph)\b.{0,12}\bhere\b", r"lorem ipsum\b", r"blah blah\b", r"asdf\b", r"under construction[.!]?$")
#: Words of the usual Latin filler; a text of four or more words of which most are these is filler.
LATIN = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud vestibulum porttitor lacinia egestas fringilla facilisi curabitur mauris nulla pretium ornare vitae pellentesque".split())
#: Gaps of template languages, format strings and hand-made templates.
PLACEHOLDER = re.compile(
    r"\{\{[^{}]*\}\}|\{%[^{}]*%\}|<%[^<>]*%>|\$!?\{[^{}]*\}|#\{[^{}]*\}|\{(?:\d+|[a-z_.]+)\}|%\(\w+\)[sd]|%\d+\$[sd]|%[A-Z][A-Z_]{2,}%|@@[A-Z_]+@@|__[A-Z][A-Z_]*__|\bXX_\w+_XX\b"
    r"|\[\[?[A-Z][A-Z ]*(?:TEXT|NAME|TITLE|HERE|DESCRIPTION)[A-Z ]*\]\]?|<(?:insert|your|enter)\b[^<>]*>|\bTODO: ?\w+(?: \w+)?"
)
#: One of these words anywhere before a placeholder, or one of those right after it, speaks of the placeholder or quotes it.
MENTION_BEFORE = re.compile(r"\b(?:jok\w+|wrote|writes?|prints?|printed|literally|reads?|called|phrase|captioned|quot\w+|named|spell\w*|parod\w+|typed|text)\b|[\"\u201c\u201d\u00ab\u00bb]$", re.I)
MENTION_AFTER = re.compile(r"^(?:(?:is|was|are|means|stands|became)\b|[\"\u201c\u201d\u00ab\u00bb]|\W*(?:on purpose|where a|as a joke|is the true))", re.I)

NOTICES = STATUS + SCRIPTS
_NOTICE, _FILLER = re.compile(rf"(?:{'|'.join(NOTICES)})", re.I), re.compile(rf"(?:{'|'.join(FILLER)})", re.I)
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_WORD = re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"[{<%@\[#$]|__|XX_|TODO")


def sentences(text: str) -> list[str]:
    return _SENTENCE.split(text)


def is_latin(sentence: str) -> bool:
    w = _WORD.findall(sentence.lower())
    return len(w) >= 4 and 2 * sum(x in LATIN for x in w) > len(w)


def has_open_placeholder(sentence: str) -> bool:
    """Whether a placeholder stands in the sentence as a gap, not as its subject matter."""
    if not _GAP.search(sentence):
        return False
    for m in PLACEHOLDER.finditer(sentence):
        if not MENTION_BEFORE.search(sentence[: m.start()].rstrip()) and not MENTION_AFTER.match(sentence[m.end() :].strip()):
            return True
    return False


def trusted(sentence: str) -> str:
    """notice, filler or placeholder for a sentence that is trusted to be one, else ''."""
    if _NOTICE.match(sentence):
        return "notice"
    if _FILLER.match(sentence) or is_latin(sentence):
        return "filler"
    if has_open_placeholder(sentence):
        return "placeholder"
    return ""
