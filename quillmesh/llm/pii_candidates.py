"""Candidates for personal data in free text: high-recall patterns, the features of each candidate, and the fixed cues that label some."""

from __future__ import annotations

import re
from dataclasses import dataclass

KINDS = ("email", "phone", "id_number", "address", "person_name")

# Words of the formats, in the languages of the corpus.
_STREET = "Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Court|Ct|Close|Drive|Dr|Way|Place|Crescent|Terrace|Boulevard|Blvd|Square|Hill|Row|Gardens|Grove"
_PLACE = r"[^\W\d_]{3,}(?:-[^\W\d_]+)*"
_AT = r"(?:\s?[@\uff20]\s?|\s?[(\[{]\s?at\s?[)\]}]\s?)"
_DOT = r"(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)"
_SPLIT_AT = re.compile(rf"{_AT}|\sat\s", re.I)
PATTERNS = {
    "email": [
        re.compile(rf"(?<![\w.+%-])\w[\w.+%-]*{_AT}[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)*{_DOT}[a-z]{{2,8}}(?![\w-])", re.I),
        re.compile(r"(?<![\w.+%-])\w[\w.+%-]*\sat\s[a-z0-9-]+(?:\sdot\s[a-z0-9-]+)*\sdot\s[a-z]{2,8}(?![\w-])", re.I),
    ],
    "phone": [re.compile(r"(?<![\w.#@/:,+-])(?:\+|\()?\d(?:[ .()/-]{0,2}\d){6,15}(?![\w]|[.,:/-]\d)")],
    "id_number": [
        re.compile(r"(?<![\w.#@/:,+-])\d{3}([ -])\d{2}\1\d{4}(?![\w]|[.,:/-]\d)"),
        re.compile(r"(?<![\w.#@/:,+-])\d{6}[-+]\d{4}(?![\w]|[.,:/-]\d)"),
        re.compile(r"(?<![\w.#@/:,+-])[a-z]{2}([ -]?)\d{2}\1\d{2}\1\d{2}\1[a-z](?![\w]|[.,:/-]\d)", re.I),
        re.compile(r"(?<![\w.#@/:,+-])[a-z]{1,2}\d{6,9}[a-z]?(?![\w]|[.,:/-]\d)", re.I),
        re.compile(r"(?<![\w.#@/:,+-])\d{8,11}[a-z]?(?![\w]|[.,:/-]\d)", re.I),
    ],
    "address": [
        re.compile(rf"\b(?:P\.? ?O\.? ?Box|Postfach|Apartado|Bo[iî]te postale|Caixa postal) \d{{1,6}}, (?:\d{{4,5}} )?{_PLACE}(?: \d{{4,5}}\b)?", re.I),
        re.compile(rf"\b\d{{1,4}}[a-z]? (?:[^\W\d_][\w'’-]* ){{1,3}}(?:{_STREET})\.?(?:, (?:Apt|Apartment|Unit|Flat|Suite|No)\.? ?\w{{1,5}})?, {_PLACE}(?: \d{{4,5}}\b)?", re.I),
        re.compile(rf"\b\d{{1,4}}(?: bis| ter)?,? (?:rue|avenue|boulevard|chemin|impasse|allée|quai|route|cours) [^,\n\d]{{2,40}}, \d{{5}} {_PLACE}", re.I),
        re.compile(rf"\b(?:Calle|Avenida|Avda\.?|Plaza|Paseo|Carrer|Camino|Rua|Travessa|Praça|Via|Viale|Piazza) [^,\n\d]{{2,40}},? \d{{1,4}}[a-z]?, \d{{4,5}} {_PLACE}", re.I),
        re.compile(rf"\b(?:(?:Am|An der|An den|Auf dem|Auf der|Im|In der|Zum|Zur|Unter den|Alte|Alter|Neue|Große) )?[^\W\d_][\w-]+ \d{{1,4}}[a-z]?, \d{{5}} {_PLACE}", re.I),
    ],
}
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_TAIL = re.compile(r"([^\W\d_]+)\W*$")
_INITIAL = re.compile(r" [^\W\d_]\. ?")

# Labels that forms, letters and signatures put before personal data, in the languages of the corpus. They label rows of the
# training sample, and are a feature that training often hides.
CUES = {
    "email": re.compile(r"(?:e-?mail|mail to|write to|contact|cc|kontakt|contacto|contato|<)\s*:?\s*$", re.I),
    "phone": re.compile(r"(?:(?:tele)?phone|telefon|tel[ée]fono|t[ée]l[ée]phone|tel|mobile|handy|fax|whatsapp|call|llama al|appelez le)\s*[.:]?:?\s*$", re.I),
    "id_number": re.compile(r"(?:passport|licen[cs]e|security|insurance|identity|personal|ssn|dni|documento|ausweis(?:nummer)?|pièce d'identité)(?:/id)?(?: card)?(?: number| no\.?| nr\.?)?\s*:?\s*$", re.I),
    "address": re.compile(r"(?:address|adresse|dirección|direccion|endereço|(?:lives?|living|resid(?:es|ing)) (?:at|in)|wohnhaft|vive en)\s*:?\s*$", re.I),
    "person_name": re.compile(r"(?:\b(?:mr|mrs|ms|dr|prof)\.?|\b(?:name(?: is)?|named|contact|kontakt|contacto|credit|from|attn|signed(?: by)?|(?:reported|filed|written|taken|sent) by|ask for|speak to|issued to|ausgestellt auf|nombre de)\s*:?|-- ?)\s*$", re.I),
}
#: What names a number as something else: a post, a version, a hash, a score.
DECOYS = re.compile(r"(?:hash|build|version|post|score|code|tag|ratio|ping|no\.|nr\.|#)\s*:?\s*$", re.I)
#: A count: a number, then white space and a word in lower case.
_COUNTED = re.compile(r"\s[^\W\d_A-Z]*[a-zà-ÿ]+")


def checked(kind: str, found: str, after: str) -> int:
    """1 or 0 where the form of a candidate tells by itself whether it is what its kind says, else -1: a mail address with a proper domain, a
    phone number with a country's prefix, an address with a postcode and a place in capitals; a bare number that counts the word after
    it, an image's file name, a street or place whose words are all in lower case."""
    if kind == "email":
        domain = found.rpartition("@")[2]
        return 0 if re.match(r"\d+x\.", domain) else 1 if re.fullmatch(r"[\w-]+(?:\.[\w-]+)*\.[a-z]{2,8}", domain, re.I) and "@" in found[1:] else -1
    if kind == "phone":
        return 1 if re.match(r"\+\d{1,3}[ .(-]", found) else 0 if found.isdigit() and _COUNTED.match(after) else -1
    if kind == "id_number":
        return 0 if found.isdigit() and _COUNTED.match(after) else -1
    if kind == "address":
        words = re.findall(r"[^\W\d_]{2,}", found)
        capital = sum(w[0].isupper() for w in words)
        return 0 if not capital else 1 if capital == len(words) and re.search(r"\b\d{4,5}\b", found) else -1
    return -1


@dataclass
class Lexicon:
    """Statistics over all documents. given: word -> share of its name-shaped occurrences after a person cue, for words frequent there;
    family: the same for the last four letters of the second word; common: word -> share of its occurrences in lower case."""

    given: dict[str, float]
    family: dict[str, float]
    common: dict[str, float]


def words_of(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text)]


class Sketch:
    """A Bloom filter of the entries that are given names, of a fixed number of bits: whatever is one passes, and of other words few do."""

    BITS, BYTES = 1 << 23, 1 << 20

    def __init__(self, bits: bytes):
        self.bits = bits

    @classmethod
    def place(cls, word: str) -> int:
        """The bit of a word: its entry's hash as the engine computes it."""
        import xxhash

        h = xxhash.xxh64_intdigest("w" + word, seed=42)
        return (h - (1 << 64) if h >> 63 else h) % cls.BITS

    def __contains__(self, word: str) -> bool:
        k = self.place(word)
        return bool(self.bits[k >> 3] >> (k & 7) & 1)


def spans(text: str, given) -> list[tuple]:
    """(kind, start, end, first word, second word, reversed) of all spans that may be candidates: those of the formats, and the name-shaped pairs
    of words, in lower or upper case if the given word is in `given`."""
    out: list[tuple] = []
    digits, at = any(map(str.isdigit, text)), "@" in text or "\uff20" in text or " at " in text.lower() or "at" in text.lower()
    for kind, patterns in PATTERNS.items():
        if at if kind == "email" else digits:
            out += [(kind, m.start(), m.end(), "", "", False) for p in patterns for m in p.finditer(text)]
    out += [("person_name", *pair) for pair in name_pairs(text, given)]
    return out


def lookups(text: str, found: list[tuple]) -> set[str]:
    """The entries of the statistics that the features of spans take: w and a word, f and the last four letters of a part of a family name."""
    out = set()
    for kind, s, e, first, last, _ in found:
        if kind == "person_name":
            f, l = first.lower(), last.lower()
            parts = l.split("-")
            out.update(("w" + f, "w" + l, *("w" + p for p in parts), *("f" + p[-4:] for p in parts)))
            continue
        if tail := _TAIL.search(text, max(0, s - 64), s):
            out.add("w" + tail[1].lower())
        if kind == "email":
            out.add("w" + _SPLIT_AT.split(text[s:e], maxsplit=1)[0].lower())
    return out


def _case(w: str) -> int:
    return 2 if w.islower() else 1 if w.isupper() and len(w) > 1 else 0 if w[:1].isupper() else 3


def name_pairs(text: str, given: dict[str, float] | None):
    """(start, end, given word, family word, reversed) of name-shaped pairs of words: both capitalised; or, if the given word is in the
    lexicon, both in lower or both in upper case. An initial may stand between them or after a reversed pair."""
    ws = words_of(text)
    for k in range(len(ws) - 1):
        s1, e1, w1 = ws[k]
        c1 = _case(w1)
        if len(w1) < 2 or c1 == 3:
            continue
        if c1 and given is None:
            continue
        s2, e2, w2 = ws[k + 1]
        gap = text[e1:s2]
        if gap == " " and len(w2) == 1 and text[e2 : e2 + 2] in (". ", ".") and k + 2 < len(ws) and ws[k + 2][0] - e2 <= 2:
            s2, e2, w2 = ws[k + 2]
            gap = " "
        if len(w2) < 2 or _case(w2) != c1 or "'" in w1 + w2:
            continue
        if gap == " ":
            if c1 and w1.lower() not in given:
                continue
            yield s1, e2, w1, w2, False
        elif gap == ", " and (c1 == 0 or w2.lower() in given):
            end = e2
            m = _INITIAL.match(text, e2)
            if m and m[0][1].isupper() == (c1 != 2):
                end = e2 + 3
            yield s1, end, w2, w1, True


def name_features(text: str, s: int, e: int, first: str, last: str, turned: bool, lex: Lexicon) -> list[float]:
    found, before, after = text[s:e], text[max(0, s - 30) : s], text[e : e + 12]
    f, l = first.lower(), last.lower()
    parts = l.split("-")
    return [
        lex.given.get(f, 0.0), min(lex.family.get(p[-4:], 0.0) for p in parts), lex.common.get(f, 0.0), max(lex.common.get(p, 0.0) for p in parts), float(_case(first)), float("." in found), float(len(parts)), float(turned),
        float(bool(CUES["person_name"].search(before))), float(before[-1:] in ("", "\n")), float(before[-2:-1].isalpha() and before.split()[-1:] != [] and before.split()[-1][:1].isupper()), float(after[1:2].isupper() and after[:1] == " "), float(after[:2] in (" (", " <", " /", ", ")), float(len(last)), float(lex.given.get(l, 0.0)),
    ]


NAME_CUE = 8


def format_features(kind: str, text: str, s: int, e: int, lex: Lexicon) -> list[float]:
    """Of a candidate of the other kinds; the first feature is the cue before it."""
    found, before, after = text[s:e], text[max(0, s - 64) : s], text[e : e + 16]
    groups = re.findall(r"\d+", found)
    sizes = [len(g) for g in groups] or [0]
    letters = re.sub(r"[\W\d_]", "", found)
    tail = _TAIL.search(before)
    out = [
        float(bool(CUES[kind].search(before))), float(bool(DECOYS.search(before))), float(len(found)), float(sum(sizes)), float(len(sizes)), float(sizes[0]), float(max(sizes)), float(min(sizes)), float(sizes[-1]), float(found[:1] in "+("), float(found[:1] == "0"), float("." in found), float("-" in found), float("/" in found), float(" " in found), float(len(letters)), float(letters.isupper()), float(found[-1:].isalpha()),
        lex.common.get(tail[1].lower(), 0.0) if tail else 0.0, float(after[:1].isspace() and after[1:2].islower()), float(before[-2:] in ("/ ", ", ")),
    ]
    if kind == "email":
        local, domain = _SPLIT_AT.split(found, maxsplit=1)
        out += [float(bool(re.match(r"\d+x\.", domain, re.I))), float(len(local)), float(any(c in local for c in "._+-")), float(local.lower() in lex.common), float(bool(re.search(r"[@\uff20(\[{]", found)))]
    return out


def candidates(text: str, lex: Lexicon, found: list[tuple] | None = None):
    """(kind, start, end, features) of all candidates; they may overlap. found: what spans gives with a superset of the given names."""
    for kind, s, e, first, last, turned in spans(text, lex.given) if found is None else found:
        if kind != "person_name":
            yield kind, s, e, format_features(kind, text, s, e, lex)
        elif found is None or _case(first) == 0 or first.lower() in lex.given:
            yield kind, s, e, name_features(text, s, e, first, last, turned, lex)
