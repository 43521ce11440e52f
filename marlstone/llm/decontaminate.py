"""Benchmark decontamination by a generalised suffix automaton.

The normalised benchmark items are put into one automaton (a bounded block of them at a time). Training texts are streamed
through it word by word; the automaton's state gives the longest match that ends at each word. Spans of matches that reach
the window length, or that are a whole shorter item, are hits. Texts are never shuffled. A benchmark of more than one block is
read once, block by block; the texts are streamed through each block's automaton in turn, and only the rows with hits are joined.
No machine ever holds more than one block or one automaton.

Defined results: null text has no words and is clean; an item with no words (or a null text) matches nothing; the words of an item
without id are found like any other's, but there is no id to list or count; repeated items and repeated rows are kept, each judged
for itself; items under one id are one item in the counts.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, col, free_name, with_struct

WINDOW = 13
#: Words of the benchmark that one automaton may hold (about 1 KB each); larger benchmarks are taken in blocks, longer items in parts.
BLOCK_WORDS = 200_000

_TO_WORDS = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def normalised(text: str | None) -> bytes:
    """The text's UTF-8, of the same length: A-Z in lower case, all ASCII but letters and digits as spaces."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS) if text else b""


class Automaton:
    """A generalised suffix automaton over words, with what is needed to find windows of a given length.

    After each word, state and length describe the longest suffix that occurs in an item. tops[s] is the state that stands
    for the last window words of any string of s, and items[s] holds the items in which that string occurs.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.own: list[set[str | None]] = [set()]
        ends: list[tuple[int, int, str | None]] = []
        for name, words in items:
            if not words:
                continue
            last = 0
            for w in words:
                last = self._add(last, self.ids.setdefault(w, len(self.ids)))
                self.own[last].add(name)
            if len(words) < window:
                ends.append((last, len(words), name))
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        for s in reversed(order[1:]):
            self.own[self.link[s]] |= self.own[s]
        self.own[0] = set()
        #: whole short items: by state, (length, item), for the state itself and all its suffixes
        whole: dict[int, list[tuple[int, str | None]]] = {}
        for s, n, name in ends:
            whole.setdefault(s, []).append((n, name))
        self.tops, self.short = [0] * len(self.len), [()] * len(self.len)
        for s in order[1:]:
            up = self.link[s]
            self.tops[s] = s if self.len[up] < window else self.tops[up]
            self.short[s] = self.short[up] + tuple(sorted(set(whole.get(s, ())), key=str))
        self.least = min([window, *(n for _, n, _ in ends)])

    def _add(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:  # the string is there already, from another item
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.own.append(set())
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """Parts the strings of q up to one word longer than p's from the longer ones."""
        copy = len(self.len)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.own.append(set())
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of words inside an occurrence of a window, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        items: set[str | None] = set()
        nxt, link, length, window, least = self.next, self.link, self.len, self.window, self.least
        state = n = 0
        for i, c in enumerate(map(self.ids.get, words)):
            if c is None:
                state = n = 0
                continue
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(c)
            if to is None:
                continue
            state = to
            n += 1
            if n < least:
                continue
            back = 0
            if n >= window:
                back = window
                found.add(self.tops[state])
            for m, name in self.short[state]:
                if m <= n:
                    back = max(back, m)
                    items.add(name)
            if back:
                start = i + 1 - back
                if spans and start <= spans[-1][1]:
                    while spans and start <= spans[-1][1]:
                        start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for s in found:
            items |= self.own[s]
        return spans, items - {None}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int, window: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The normalised items in blocks of at most about `most` words, streamed. An item of more is cut into parts that overlap by all but one word of a window."""
    items = benchmark.where(col(text_col).isNotNull()).select(col(item_col).cast("string").alias("item"), col(text_col).alias("text"))
    block: list[tuple[str | None, bytes]] = []
    size = 0
    for r in items.toLocalIterator():
        words = normalised(r.text).split()
        for at in range(0, max(1, len(words) - window + 1), most):
            part = words[at : at + most + window - 1]
            block.append((r.item, b" ".join(part)))
            size += len(part)
            if size >= most:
                yield block
                block, size = [], 0
    if block:
        yield block


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, out: str = "hits") -> DataFrame:
    """docs with a struct column: n_words, spans of hit words (start, end), and the items whose windows occur (sorted as strings)."""
    sc = docs.sparkSession.sparkContext
    out = free_name(docs, out)
    blocks = _blocks(benchmark, item_col, item_text_col, block_words, window)
    first, second = next(blocks, []), next(blocks, None)

    def hits_of(shared):
        def run(texts):
            sam = _compiled(shared.value, window)
            ns, spans, items = [], [], []
            for text in texts:
                words = normalised(text).split()
                at, names = sam.hits(words)
                ns.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in at])
                items.append(sorted(names))
            return [ns, spans, items]

        return run

    if second is None:
        return with_struct(docs, out, [col(text_col)], hits_of(sc.broadcast(first)), RESULT)
    scratch, row = Scratch(docs.sparkSession), free_name(docs, "__row")
    kept = scratch.write(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    parts = []
    for block in itertools.chain([first, second], blocks):
        shared = sc.broadcast(block)
        found = with_struct(kept.select(row, col(text_col).alias("text")), "x", [F.col("text")], hits_of(shared), RESULT).where(F.size("x.spans") > 0)
        parts.append(scratch.write(found.select(row, "x.spans", F.col("x.items").alias("names")), "hits"))
        shared.destroy()
    both = functools.reduce(DataFrame.unionByName, parts).groupBy(row).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))

    def merged(texts, spans, names):
        joined = [_merged([(x["start"], x["end"]) for x in s or []]) for s in spans]
        return [[len(normalised(t).split()) for t in texts], [[{"start": a, "end": b} for a, b in s] for s in joined], [sorted(n or []) for n in names]]

    both = both.select(F.col(row), F.struct("spans", "names").alias(out))
    return with_struct(kept.join(both, row, "left").withColumnRenamed(out, held := free_name(kept, out + "_found")), out, [col(text_col), F.col(held).spans, F.col(held).names], merged, RESULT).select(*docs.columns, out)


_LAST: list = [None, None]


def _compiled(block: list[tuple[str | None, bytes]], window: int) -> Automaton:
    """The automaton of a block; a worker keeps the last one."""
    if _LAST[0] is not block or _LAST[1].window != window:
        _LAST[:] = [block, Automaton(((name, text.split()) for name, text in block), window)]
    return _LAST[1]


def hit_words(spans) -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x.end - x.start)


def remove_spans(docs: DataFrame, text_col: str = "text", hits: str = "hits", longest: int = 0, coverage: float = 0.05, out: str = "clean_text") -> DataFrame:
    """docs with the text less its hit spans: those longer than `longest` words, or all where hits cover `coverage` of the words or more.

    Texts without such spans are returned as they are; null stays null.
    """
    out = free_name(docs, out)

    def run(texts, found):
        made = []
        for text, h in zip(texts, found):
            spans = [(x["start"], x["end"]) for x in h["spans"]] if text else []
            if sum(b - a for a, b in spans) < coverage * (h["n_words"] or 1):
                spans = [x for x in spans if longest and x[1] - x[0] > longest]
            if spans:
                raw = text.encode("utf-8", "surrogatepass")
                at = [m.span() for m in re.finditer(rb"[^ ]+", normalised(text))]
                kept, pos = [], 0
                for a, b in spans:
                    kept.append(raw[pos : at[a][0]])
                    pos = at[b - 1][1]
                text = b"".join([*kept, raw[pos:]]).decode("utf-8", "surrogatepass")
            made.append(text)
        return [made]

    tmp = free_name(docs, "__clean")
    cut = with_struct(docs, tmp, [col(text_col), col(hits)], run, T.StructType([T.StructField("text", T.StringType())]))
    return cut.withColumn(out, F.col(tmp).text).drop(tmp)


def contaminated(hits) -> F.Column:
    """The rule of the query: any hit, and one word in twenty or more."""
    n = hit_words(hits.spans)
    return (n > 0) & (20 * n >= hits.n_words)
