"""Text functions that need Unicode normalisation, HTML parsing or sequence matching: Python functions, fed few rows at a time."""

from __future__ import annotations

import difflib
import functools
import html
import re
import unicodedata
from collections.abc import Iterable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lexicon

# Number words and Greek letters that normalisation spells out (fixed values).
NUMBERS = {"one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}
GREEK = {"Γ": "gamma", "γ": "gamma", "Δ": "delta", "δ": "delta", "Θ": "theta", "θ": "theta", "Ρ": "rho", "ρ": "rho", "Ν": "nu", "ν": "nu"}
_GREEK = str.maketrans({k: f" {v} " for k, v in GREEK.items()} | {"’": "'", "‘": "'"})
_POSSESSIVE = re.compile(r"(?<=\w)'s\b", re.I)


#: What patterns that ignore case take for an ASCII letter, besides its capital.
_LIKE_ASCII = (("İ", "i"), ("ı", "i"), ("ſ", "s"), ("\u212a", "k"))


def holds(text: str, stems: Iterable[str]) -> bool:
    """Whether one of some lower-case literals is in a text, case aside as patterns see it: a quick look before slow patterns."""
    if not text.isascii():
        for a, b in _LIKE_ASCII:
            text = text.replace(a, b)
    low = text.lower()
    return any(s in low for s in stems)


def _bare(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def title_key(text: str | None) -> str:
    folded = _bare(html.unescape(text or "").replace("\xa0", " ").replace("&", " and ").casefold())
    return " ".join(NUMBERS.get(w, w) for w in re.findall(r"[a-z0-9]+", folded))


def search_words(text: str | None) -> list[str]:
    plain = _POSSESSIVE.sub("", unicodedata.normalize("NFKC", text or "").translate(_GREEK)).replace("&", " and ")
    return re.findall(r"[a-z0-9]+", unicodedata.normalize("NFKD", plain).encode("ascii", "ignore").decode().casefold())


def taxonomy_text(text: str | None) -> str:
    return " ".join(re.findall(r"[a-z0-9]+", _bare((text or "").casefold())))


def identity_text(text: str | None) -> str:
    return " ".join(unicodedata.normalize("NFKC", text or "").split()).casefold()


# Tags that end a line where they open or close; br has no end (fixed values).
BLOCKS = frozenset("p br div h1 h2 h3 h4 h5 li tr".split())


class _Text(HTMLParser):
    """Collects text; block tags end lines, script and style are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], False

    def handle_starttag(self, tag, attrs):
        self.hidden |= tag in self.CDATA_CONTENT_ELEMENTS
        if tag in BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden &= tag not in self.CDATA_CONTENT_ELEMENTS
        if tag in BLOCKS and tag != "br":
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


_OPEN_REFERENCE = re.compile(r"&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[Xx][0-9A-Fa-f]+);)")


def visible_text(page: str | None, closed: bool = False) -> str:
    """Text by lines. Of blank lines in a row one stays, as it parts paragraphs, and of spaces one. References escaped twice are decoded twice; with closed only those that end in a semicolon are, and once."""
    parser = _Text()
    parser.feed(_OPEN_REFERENCE.sub("&amp;", page or "") if closed else page or "")
    parser.close()
    text = "".join(parser.out) if closed else html.unescape("".join(parser.out))
    return re.sub(r"\n{3,}| {2,}", lambda m: m[0][:2] if m[0][0] == "\n" else " ", text).strip()


_TOKEN = re.compile(r"(?P<cut>[,;:!?()\[\]{}|/\n—–]+)|[A-Za-z][A-Za-z0-9]*(?:[.'’][A-Za-z0-9]+)*|&")
_BLOCKED, _LINKS, _GENERIC, _SUFFIXES = (frozenset(x) for x in (lexicon.BLOCKED_CAPITALS, lexicon.CONNECTORS, lexicon.GENERIC_CAPITALS, lexicon.ORGANISATION_SUFFIXES))
_ALIASES = frozenset(tuple(search_words(a)) for names in lexicon.ENTITIES.values() for a in names)


def _shape(token: re.Match) -> str:
    """One letter for a token: C capitalised, l a link between capitals, a dot for what ends a name."""
    word = token[0]
    if token["cut"] or not _BLOCKED.isdisjoint(search_words(word)):
        return "."
    if word.casefold() in _LINKS:
        return "l"
    return "C" if word[0].isupper() or word.isupper() else "."


def _is_organisation(words: tuple[str, ...]) -> bool:
    own = set(words) - _LINKS
    grams = {words[i:j] for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
    return len(words) in (2, 3) and words[-1] in _SUFFIXES and not own <= _GENERIC and grams.isdisjoint(_ALIASES)


def organisations(text: str | None) -> list[str]:
    """Names of two or three words, all capitalised, that end in an organisation's word and hold no known alias: found as runs in the text's shape."""
    tokens = list(_TOKEN.finditer(text or ""))
    shape = "".join(map(_shape, tokens))
    names = (tuple(search_words(" ".join(t[0] for t in tokens[m.start() : m.end()]))) for m in re.finditer("C(?:[Cl]*C)?", shape))
    return sorted({name for words in names if _is_organisation(words) and len(name := "-".join(words)) <= 64})


def _each(fn, kind):
    """A function of single values. Not by Arrow: its batches have thousands of rows, which of whole texts are hundreds of MB, in several copies; pickled ones have a hundred."""
    return F.udf(fn, kind, useArrow=False)


def _clean(fn):
    return lambda v: fn(v if isinstance(v, str) else None)


normalize_title = _each(_clean(title_key), T.StringType())
normalized_words = _each(_clean(search_words), T.ArrayType(T.StringType()))
normalize_taxonomy = _each(_clean(taxonomy_text), T.StringType())
normalize_identity = _each(_clean(identity_text), T.StringType())
strip_html = _each(_clean(visible_text), T.StringType())
strip_html_closed = _each(_clean(functools.partial(visible_text, closed=True)), T.StringType())
capitalised_names = _each(_clean(organisations), T.ArrayType(T.StringType()))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; the heuristic for popular characters is on from 200 characters."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])
