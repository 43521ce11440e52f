"""HTML as a stream of events, shared by the operators that read pages."""

from __future__ import annotations

import re
from collections.abc import Iterator

TEXT, START, END, RAW = "text", "start", "end", "raw"

# Tags of HTML by how they are read (fixed values).
#: Their content is no markup of the page: it runs to the end tag.
RAW_TAGS = frozenset("script style textarea title noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW_TAGS}
_HEAD_END = re.compile(r"</head\s*>", re.I)


def events(page: str, raw: frozenset[str] = RAW_TAGS) -> Iterator[tuple[str, str, str, str]]:
    """(kind, tag, attributes, text) of a page in order. Comments and declarations give nothing; a raw element comes whole.

    A raw element that is never closed runs to the end of the head it stands in, or else of the page.
    """
    pos, size, find = 0, len(page), _TOKEN.search
    while pos < size:
        m = find(page, pos)
        at = m.start() if m else size
        if at > pos:
            yield TEXT, "", "", page[pos:at]
        if not m:
            return
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            yield END, tag, "", ""
        elif tag in raw and not m[3].endswith("/"):
            end = _ENDS[tag].search(page, pos)
            stop = end.start() if end else found.start() if (found := _HEAD_END.search(page, pos)) else size
            yield RAW, tag, m[3], page[pos:stop]
            pos = end.end() if end else stop
        else:
            yield START, tag, m[3], ""


def attributes(text: str) -> dict[str, str]:
    """Attributes by name in lower case; of several with one name the first counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out
