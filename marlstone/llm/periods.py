"""Periodic runs of words, by power-of-two names (Karp, Miller, Rosenberg).

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least max(LEAST, 2 * q) words that
no neighbouring word extends keeping period q. Level k names each stretch of 2 ** k words, equal names for equal stretches of one
text: a name of level k + 1 stands for two names of level k. A stretch that does not recur in its text needs no name, so the levels
thin out fast. The longest common extension of two places follows by descending through the levels, one step each (the top level
is repeated). For every period q the places 0, q, 2q, ... form a grid; a run of two periods or more holds two neighbouring grid
places, which are extended to both sides. A pair whose predecessor on the grid matches through to it gives the same run and is
left out. No hashes of words decide anything, no suffixes are sorted.

Texts are independent of each other: no shuffle. A task names many short texts at once; it holds at most WORDS words, or one text.

Defined results: null and empty texts have no words and no runs; repeated rows are judged each; of the periods of one stretch only
the smallest counts (a stretch of twice q words with a smaller period p has q as a multiple of p); words are compared as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import col, free_name, with_struct, words_of

LEAST = 12
#: Words that are named together; a longer text is named alone.
WORDS = 100_000
#: Levels of names, that is stretches of up to 2 ** (LEVELS - 1) words; longer extensions repeat the top level.
LEVELS = 20
#: Grid pairs looked at in one go.
PAIRS = 1_000_000

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
])


def names_of(first: np.ndarray, ends: np.ndarray, levels: int = LEVELS) -> list[np.ndarray]:
    """Names by level and place; -1 where the stretch does not recur or leaves its text. first has names of single words, different between texts; ends has the end of the text of each place."""
    n = len(first)
    _, where, counts = np.unique(first, return_inverse=True, return_counts=True)
    names = [np.where(counts[where] > 1, where, -1).astype(np.int32)]
    for k in range(1, levels):
        half, low = 1 << (k - 1), names[-1]
        at = np.flatnonzero(low[: max(n - half, 0)] >= 0)
        at = at[low[at + half] >= 0]
        at = at[at + 2 * half <= ends[at]]
        _, where, counts = np.unique(low[at].astype(np.int64) << 32 | low[at + half], return_inverse=True, return_counts=True)
        again = counts[where] > 1
        if not again.any():
            break
        level = np.full(n, -1, np.int32)
        level[at[again]] = where[again]
        names.append(level)
    return names


def _extended(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from i and j on (or before them) are equal, i < j, within the text."""
    n = len(names[0])
    length = np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        step, level = 1 << k, names[k]
        live = np.arange(len(i))
        while len(live):
            a, b = (i[live] + length[live], j[live] + length[live]) if forward else (i[live] - length[live] - step, j[live] - length[live] - step)
            inside = (b < n) if forward else (a >= 0)
            live, a, b = live[inside], a[inside], b[inside]
            same = (level[a] >= 0) & (level[a] == level[b])
            live = live[same]
            length[live] += step
            if k < len(names) - 1:
                break
    return length


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all neighbouring grid places of all texts, in bounded pieces."""
    texts, periods, counts, held = [], [], [], 0
    for t in np.flatnonzero(sizes >= 2):
        q = np.arange(1, sizes[t] // 2 + 1)
        per = (sizes[t] - 1) // q  # grid places that have a successor
        at = 0
        while at < len(q):
            more = int(np.searchsorted(np.cumsum(per[at:]), PAIRS - held, "right")) or (0 if held else 1)
            texts.append(np.full(more, starts[t])), periods.append(q[at : at + more]), counts.append(per[at : at + more])
            held += int(per[at : at + more].sum())
            at += more
            if at < len(q):
                yield _pairs(texts, periods, counts)
                texts, periods, counts, held = [], [], [], 0
    if held:
        yield _pairs(texts, periods, counts)


def _pairs(texts: list, periods: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    begin, q, per = map(np.concatenate, (texts, periods, counts))
    which = np.repeat(np.arange(len(q)), per)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(per) - per, per)
    return begin[which] + nth * q[which], q[which]


def runs_of(first: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = LEAST, levels: int = LEVELS) -> np.ndarray:
    """(start, end, period) of all runs of several texts laid end to end, by start, then period."""
    names = names_of(first, np.repeat(starts + sizes, sizes), levels)
    found = [np.zeros((0, 3), np.int64)]
    lows = np.repeat(starts, sizes)
    for i, q in _grid(starts, sizes):
        hit = (names[0][i] >= 0) & (names[0][i] == names[0][i + q])
        i, q = i[hit], q[hit]
        # the predecessor on the grid, if its q words are those that stand here, as two names that overlap say
        k = np.minimum(np.frexp(q.astype(float))[1] - 1, len(names) - 1)
        before = (i - q >= lows[i]) & (q < 2 << k)
        for level in np.unique(k[before]):
            s = np.flatnonzero(before & (k == level))
            a, b, name = i[s] - q[s], i[s] - (1 << level), names[level]
            before[s] = (name[a] >= 0) & (name[a] == name[a + q[s]]) & (name[b] >= 0) & (name[b] == name[b + q[s]])
        i, q = i[~before], q[~before]
        ahead, behind = _extended(names, i, i + q, True), _extended(names, i, i + q, False)
        long = q + ahead + behind >= np.maximum(least, 2 * q)
        i, q, ahead, behind = i[long], q[long], ahead[long], behind[long]
        found.append(np.stack([i - behind, i + q + ahead, q], 1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbered(words: list[bytes], offset: int) -> list[int]:
    ids: dict[bytes, int] = {}
    return [ids.setdefault(w, offset + len(ids)) for w in words]


def judged(texts: list[str | None], least: int = LEAST) -> list[list]:
    """n_words, runs and collapsed texts of several texts."""
    out: list[list] = [[], [], []]
    group: list[list[bytes]] = []

    def flush() -> None:
        sizes = np.array([len(w) for w in group], np.int64)
        starts = np.cumsum(sizes) - sizes
        first = np.fromiter((x for w, s in zip(group, starts.tolist()) for x in _numbered(w, s)), np.int64, int(sizes.sum()))
        runs = runs_of(first, starts, sizes, least)
        step = np.zeros(len(first) + 1, np.int64)
        np.add.at(step, runs[:, 0] + runs[:, 2], 1)
        np.add.at(step, runs[:, 1], -1)
        gone = np.cumsum(step) > 0
        cuts = np.searchsorted(runs[:, 0], np.append(starts, len(first)))
        for t, words in enumerate(group):
            s = int(starts[t])
            own = runs[cuts[t] : cuts[t + 1]].tolist()
            out[0].append(len(words))
            out[1].append([{"start": a - s, "length": b - a, "period": q} for a, b, q in own])
            kept = [w for w, g in zip(words, gone[s : s + len(words)].tolist()) if not g] if own else words
            out[2].append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        group.clear()

    held = 0
    for text in texts:
        words = words_of(text)
        if group and held + len(words) > WORDS:
            flush()
            held = 0
        group.append(words)
        held += len(words)
    if group:
        flush()
    return out


def runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, out: str = "periods") -> DataFrame:
    """docs with a struct column: n_words, runs (start, length, period; by start, then period) and collapsed: the words joined by one space, less those that a run holds after its first period."""
    return with_struct(docs, free_name(docs, out), [col(text_col)], lambda texts: judged(texts, least), RESULT)
