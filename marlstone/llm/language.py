"""Language identification by cross-parsing entropy.

Every language has a bounded sample of labelled text, and of that a suffix automaton over letters. A text is parsed against each
language into phrases, each the longest stretch from where the last one ended that occurs anywhere in the language's sample, as the
automaton says; a letter the sample lacks is a phrase of its own. Phrases times log2 of the sample's length, by letter of the text,
estimate the cross entropy in bits; the language that needs least wins, of equals the one whose name comes first.

Texts are put in lower case, and whatever ASCII has besides letters separates like one space; other letters are read as their UTF-8
bytes. Whole texts are parsed, in stretches of STRETCH letters, so that all stretches of a batch advance together in NumPy: a phrase
ends at the end of its stretch, alike for all languages. Automata are packed into two arrays each (rows of transitions laid into each
other's gaps).

Sample: of each of the LANGUAGES most frequent labels, ROWS different texts at most, drawn by a hash of the text, and of each one
window of PIECE characters at a place drawn by that hash. So the models have a size bound (about 1.5 MB a language) and can be broadcast.

Defined results: null texts and texts without a letter are `und`, score 0; otherwise a learned label is given, however strange the
text; without any labelled text all are `und`. The score is how much less the winner needs than the next, as a share of the latter
(1 if there is no other). Null labels are not learned from; repeated rows are judged each and drawn once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, free_name, with_struct

LANGUAGES, ROWS, PIECE = 128, 100, 600
STRETCH = 1024
#: Letters that are parsed in one go.
LETTERS = 2_000_000
UNKNOWN = "und"

RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())])
MODEL = "lang string, size long, base binary, cells binary"

_LETTER = re.compile(r"[^\W\d_]")
#: Symbols: 0 a space, 1 to 26 letters, 27 to 154 bytes of other characters, 155 between pieces of a sample.
_SYMBOLS = bytes(b - 0x60 if 0x61 <= b <= 0x7A else b - 0x80 + 27 if b >= 0x80 else 0 for b in range(256))
_APART, _ALPHABET = 155, 156
_GAPS = re.compile(rb"\0\0+")


def symbols(text: str) -> bytes:
    """The text as symbols, with one space before and behind."""
    return _GAPS.sub(b"\0", b"\0" + text.lower().encode("utf-8", "surrogatepass").translate(_SYMBOLS) + b"\0")


def automaton(pieces: list[bytes]) -> list[dict[int, int]]:
    """Transitions by state of the suffix automaton of the pieces, which no phrase crosses; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in bytes([_APART]).join(pieces):
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return nxt


def packed(nxt: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(base, cells): the transition of state s by symbol c, if there is one, is at base[s] + c of cells, which says (s, target)."""
    base = np.zeros(len(nxt), np.int32)
    owner = [-1] * (2 * _ALPHABET)
    target = [0] * (2 * _ALPHABET)
    used = 0  # no cell from here on is taken
    tried: dict[tuple[int, ...], int] = {}  # where a row of that shape was laid last: no place before it is free for another
    for s in sorted(range(len(nxt)), key=lambda s: -len(nxt[s])):
        row = {c: t for c, t in nxt[s].items() if c != _APART}
        if not row:
            continue
        first = min(row)
        shape = tuple(sorted(c - first for c in row))
        at = tried.get(shape, _ALPHABET)
        tries = 0
        while any(at + c < len(owner) and owner[at + c] >= 0 for c in shape):
            tries += 1
            at = at + 1 if tries < 500 or len(row) < 3 else max(at + 1, used)
        tried[shape] = at
        used = max(used, at + shape[-1] + 1)
        at -= first
        if at + _ALPHABET > len(owner):
            more = len(owner) + _ALPHABET
            owner += [-1] * more
            target += [0] * more
        base[s] = at
        for c, t in row.items():
            owner[at + c], target[at + c] = s, t
    size = int(base.max()) + _ALPHABET
    return base, np.stack([np.array(owner[:size], np.int32), np.array(target[:size], np.int32)], 1)


class Models:
    """The automata of all languages, laid end to end, and the parse of many texts against all of them at once."""

    def __init__(self, models: list[tuple[str, int, bytes, bytes]]):
        self.langs = [m[0] for m in models]
        self.cost = np.array([math.log2(m[1] + 1) for m in models])
        bases, cells = [np.frombuffer(m[2], np.int32) for m in models], [np.frombuffer(m[3], np.int32).reshape(-1, 2) for m in models]
        states = np.cumsum([0, *map(len, bases)])
        places = np.cumsum([0, *map(len, cells)])
        self.roots = states[:-1].astype(np.int32)
        self.base = np.concatenate([b + p for b, p in zip(bases, places)]).astype(np.int32)
        joint = np.concatenate([np.where(c[:, :1] < 0, [[-1, 0]], c + s) for c, s in zip(cells, states)])
        self.cells = joint[:, 0] << 32 | joint[:, 1]

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases by text and language."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        of, cuts = [], []
        for t, text in enumerate(texts):
            of += [t] * -(-len(text) // STRETCH)
            cuts += [text[a : a + STRETCH] for a in range(0, len(text), STRETCH)]
        order = sorted(range(len(cuts)), key=lambda i: -len(cuts[i]))
        most = max(LETTERS // (STRETCH * max(len(self.langs), 1)), 64)
        for a in range(0, len(order), most):
            own = order[a : a + most]
            np.add.at(out, np.array([of[i] for i in own]), self._parsed([cuts[i] for i in own]))
        return out

    def _parsed(self, cuts: list[bytes]) -> np.ndarray:
        """Phrases by stretch and language; the stretches come longest first."""
        sizes = np.array([len(c) for c in cuts])
        longest = int(sizes[0])
        letters = np.frombuffer(b"".join(c.ljust(longest, b"\0") for c in cuts), np.uint8).reshape(-1, longest).T.copy()
        alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # stretches that have a letter there
        state = np.repeat(self.roots[:, None], len(cuts), 1)
        count = np.zeros(state.shape, np.int32)
        roots = self.roots[:, None]
        fresh = self.cells.take(self.base[roots] + np.arange(_ALPHABET))
        fresh = np.where(fresh >> 32 == roots, fresh & 0xFFFFFFFF, roots).astype(np.int32)  # where a phrase that begins with a symbol stands after it
        for k in range(longest):
            n = alive[k]
            now, c = state[:, :n], letters[k, :n]
            cell = self.cells.take(self.base.take(now) + c)
            ends = cell >> 32 != now
            to = cell.astype(np.int32)  # the lower half
            if ends.any():
                anew = fresh.take(c, 1)
                # the phrase before ends, and a symbol the sample lacks is one of its own
                count[:, :n] += ends & (now != roots)
                count[:, :n] += ends & (anew == roots)
                to = np.where(ends, anew, to)
            state[:, :n] = to
        return (count + (state != roots)).T


def judged(models: Models, texts: list[str | None]) -> list[list]:
    """lang, score and bits of several texts."""
    known = [i for i, t in enumerate(texts) if t and models.langs and _LETTER.search(t)]
    made = [[UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)]
    at = 0
    while at < len(known):
        some, size = [], 0
        while at < len(known) and (not some or size + len(texts[known[at]]) <= LETTERS):
            some.append(known[at])
            size += len(texts[known[at]])
            at += 1
        letters = [symbols(texts[i]) for i in some]
        bits = models.phrases(letters) * models.cost / np.array([[len(x)] for x in letters])
        best = bits.argmin(1)
        for row, i, b in zip(bits, some, best.tolist()):
            next_best = np.delete(row, b).min() if len(row) > 1 else math.inf
            made[0][i], made[1][i], made[2][i] = models.langs[b], float(1 - row[b] / next_best), float(row[b])
    return made


def sample(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", languages: int = LANGUAGES, rows: int = ROWS, piece: int = PIECE) -> DataFrame:
    """(lang, text): the pieces to learn from; a row a piece, at most languages * rows of them."""
    text = col(text_col)
    h = F.xxhash64(text)
    labelled = docs.where(col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(col(lang_col).cast("string").alias("lang"), text.alias("text"), h.alias("h"))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("texts")).orderBy(F.desc("n"), "lang").limit(languages)
    # about twice the rows asked for lie below the share; of those, exactly `rows` are taken
    share = sizes.select("lang", F.least(F.lit(1.0), 2.0 * rows / F.col("texts")).alias("share"))
    below = F.pmod("h", F.lit(1 << 40)) < F.col("share") * (1 << 40)
    at = 1 + F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - piece + 1, F.lit(1)))
    drawn = labelled.join(F.broadcast(share), "lang").where(below).select("lang", "h", F.substring("text", at.cast("int"), F.lit(piece)).alias("text"))
    once = drawn.groupBy("lang", "h").agg(F.min("text").alias("text"))
    return once.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h"))).where(F.col("nth") <= rows).select("lang", "text")


def train(pieces: DataFrame) -> Models:
    """Models of (lang, text), built by language in tasks; their size is bounded by that of the sample."""

    def build(group: pa.Table) -> pa.Table:
        texts = sorted(symbols(t) for t in group.column("text").to_pylist())
        base, cells = packed(automaton(texts))
        size = sum(map(len, texts))
        return pa.table([pa.array([group.column("lang")[0].as_py()]), pa.array([size], pa.int64()), pa.array([base.tobytes()], pa.binary()), pa.array([cells.tobytes()], pa.binary())], names=["lang", "size", "base", "cells"])

    found = pieces.groupBy("lang").applyInArrow(build, MODEL).collect()
    return Models(sorted((r.lang, r.size, bytes(r.base), bytes(r.cells)) for r in found)) if found else None


def identify(docs: DataFrame, models: Models | None, text_col: str = "text", out: str = "language") -> DataFrame:
    """docs with a struct column: lang, score and the winner's bits a letter."""
    given = docs.sparkSession.sparkContext.broadcast(models)

    def run(texts: list[str | None]) -> list[list]:
        if given.value is None:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)]
        return judged(given.value, texts)

    return with_struct(docs, free_name(docs, out), [col(text_col)], run, RESULT)


def remainder(id_col: str = "doc_id", parts: int = 4) -> Column:
    """The checksum of an id as text, modulo parts."""
    return F.crc32(col(id_col).cast("string").cast("binary")) % parts
