"""Removal of repeated passages with sharded Aho-Corasick automata.

Confirming. Texts are dealt into buckets of about equal size, row by row. A bucket sends the distinct 48-bit hashes of its windows
(WINDOW consecutive words) to shards by their upper bits; a shard tells each bucket, by one bit a window, which of its hashes come
from another bucket too or twice from its own. These are candidates. Of each the bucket sends 128 bits, two independent hashes of
the window's words; what recurs in them is confirmed. A window in very many texts is one number a bucket, so no key is hot.

Locating. In each bucket the first window of every confirmed hash stands for it; runs of such windows are the bucket's recurring
passages. Any window of a passage holds a whole block of BLOCK words that starts at a multiple of BLOCK, as WINDOW is 2 * BLOCK - 1, so
the blocks of all passages are compiled into Aho-Corasick automata of bounded size (shards of the bucket's phrases), and all
texts of the bucket are streamed through each. A hit fixes how text and passage lie against each other; both are compared word
by word along it, and every common run of WINDOW words or more is covered.

Texts are shuffled once, to their buckets; the three passes read that shuffle. Within a bucket words themselves are compared. Across
buckets two windows that differ are taken for one with a chance of 3e-39 for each pair: 4e-13 in all for 1.6e13 windows, which is
what 100 TB hold.

Defined results: null text has no words; texts shorter than a window are left whole; repeated rows are repeats of each other, so all
their windows go; an empty table gives no rows. Removal is judged on the input, never on what is left.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col, free_name
from .near_dedup import mixed

WINDOW, BLOCK = 35, 18
#: Bytes of text in a bucket and in a partition of the shuffle; bytes of window hashes in a shard; characters of an automaton.
BUCKET, PARTITION, SHARD, AUTOMATON = 4 << 20, 16 << 20, 32 << 20, 1_000_000

_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_POWERS: list[list[np.ndarray]] = [[np.ones(1, np.uint64), np.ones(1, np.uint64)] for _ in _BASES]
_LENGTHS = np.uint64(0xC2B2AE3D27D4EB4F)
_IS_WORD = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
#: Bytes that are hashed in one go, and bytes from which on a word is hashed by itself.
PIECE, LONG_WORD = 1 << 18, 512
_CANDIDATE = np.uint64(64 - 48)


def _powers(n: int, base: int) -> list[np.ndarray]:
    """Powers of a base and of its inverse, modulo 2 ** 64."""
    own = _POWERS[base]
    if len(own[0]) < n:
        m = max(n, 2 * len(own[0]))
        for k, b in enumerate((_BASES[base], pow(_BASES[base], -1, 1 << 64))):
            factors = np.full(m, b, np.uint64)
            factors[0] = 1
            own[k] = np.cumprod(factors, dtype=np.uint64)
    return own


def window_hashes(h: np.ndarray, window: int = WINDOW, base: int = 0) -> np.ndarray:
    """A hash of each run of window words, from word hashes, by differences of a running sum."""
    n = len(h)
    if n < window:
        return np.zeros(0, np.uint64)
    up, down = _powers(n + 1, base)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:n], dtype=np.uint64)])
    return mixed((run[window:] - run[: n - window + 1]) * down[: n - window + 1])


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 bytes start and end."""
    inside = np.concatenate([[False], _IS_WORD[np.frombuffer(raw, np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """A hash of each word, all at once: differences of a running sum over bytes, piece by piece. Long words are hashed by themselves."""
    out = np.zeros(len(starts), np.uint64)
    data = np.frombuffer(raw, np.uint8)
    up, down = _powers(PIECE + 1, base)
    sizes = ends - starts
    done = 0
    while done < len(starts):
        lo = starts[done]
        end = max(int(np.searchsorted(ends, lo + PIECE, side="right")), done + 1)
        s, e = starts[done:end] - lo, ends[done:end] - lo
        if e[-1] <= PIECE:
            part = data[lo : lo + e[-1]].astype(np.uint64) + np.uint64(1)
            run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
            out[done:end] = mixed((run[e] - run[s]) * down[s] + sizes[done:end].astype(np.uint64) * _LENGTHS)
        done = end
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]], base)
    return out


def _pack(h: np.ndarray, width: int = 8) -> bytes:
    """The upper bytes of sorted numbers as byte planes: the upper planes of neighbours are alike and compress."""
    return np.ascontiguousarray(h.astype(">u8").view(np.uint8).reshape(len(h), 8).T[:width]).tobytes()


def _unpack(b: bytes, width: int = 8) -> np.ndarray:
    planes = np.zeros((8, len(b) // width), np.uint8)
    planes[:width] = np.frombuffer(b, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64)


def _bits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


def _has(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which numbers of x a sorted array has."""
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x if len(sorted_) else np.zeros(len(x), bool)


class Windows:
    """The windows of a bucket's texts, as one stream of words; windows across two texts are left out."""

    def __init__(self, texts: list[str | None], window: int):
        self.window = window
        self.raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.stream = b"\n".join(self.raws)
        self.starts, self.ends = word_spans(self.stream)
        begins = np.cumsum([0, *(len(r) + 1 for r in self.raws)])
        self.first = np.searchsorted(self.starts, begins)  # each text's first word, and the end
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.at = np.flatnonzero(self.text[: 1 - window or None] == self.text[window - 1 :]) if len(self.text) >= window else np.zeros(0, np.int64)
        self.h = self._hashes(0)

    def _hashes(self, base: int) -> np.ndarray:
        return window_hashes(word_hashes(self.stream, self.starts, self.ends, base), self.window, base)[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def words(self) -> list[list[bytes]]:
        return [r.split() for r in self.raws]

    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct 48-bit hashes, sorted, and their counts."""
        return np.unique(self.h >> _CANDIDATE, return_counts=True)

    def pairs(self, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both hashes of the distinct windows whose 48-bit hash is a candidate, sorted, and their counts."""
        yes = _has(candidates, self.h >> _CANDIDATE)
        return distinct_pairs(self.h[yes], self._hashes(1)[yes] if yes.any() else self.h[yes])


def distinct_pairs(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((g, h))
    h, g = h[order], g[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])) if len(h) else np.zeros(0, np.int64)
    return h[first], g[first], np.diff(np.append(first, len(h)))


def recurring(keys: list[list[np.ndarray]], more: list[np.ndarray]) -> list[np.ndarray]:
    """Which elements recur: another part has them too, or they are marked in their part's `more`. Parts have no repeats; an element is one value of each key."""
    flat = [np.concatenate(k) for k in keys]
    order = np.lexsort(flat[::-1])
    same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in flat])
    yes = np.concatenate(more)
    yes[order[1:]] |= same
    yes[order[:-1]] |= same
    return np.split(yes, np.cumsum([len(x) for x in more])[:-1])


def automata(passages: list[list[bytes]], block: int = BLOCK, most: int = AUTOMATON) -> Iterator[ahocorasick.Automaton]:
    """Automata over the blocks of all passages, each of at most about `most` characters; a block's value lists (passage, word)."""
    at: dict[str, list[tuple[int, int]]] = {}
    size = 0

    def compiled():
        a = ahocorasick.Automaton()
        for phrase, where in at.items():
            a.add_word(phrase, where)
        a.make_automaton()
        return a

    for p, words in enumerate(passages):
        for k in range(0, len(words) - block + 1, block):
            phrase = b" ".join(words[k : k + block]).decode("utf-8", "surrogatepass")
            own = at.setdefault(f" {phrase} ", [])
            if not own:
                size += len(phrase)
            own.append((p, k))
        if size >= most:
            yield compiled()
            at, size = {}, 0
    if at:
        yield compiled()


def covered_by(texts: list[list[bytes]], passages: list[tuple[int, int, int]], window: int = WINDOW, block: int = BLOCK) -> list[np.ndarray]:
    """Of each text, which words lie in a window that a passage (text, start, end) has."""
    covered = [np.zeros(len(w), bool) for w in texts]
    joined = [" " + b" ".join(w).decode("utf-8", "surrogatepass") + " " if len(w) >= window else "" for w in texts]
    ids: dict[bytes, int] = {}
    new = itertools.count()
    numbers: dict[int, np.ndarray] = {}

    def spelled(t: int) -> np.ndarray:
        """Numbers that stand for the words of a text; only texts with hits need them."""
        if t not in numbers:
            numbers[t] = np.fromiter(map(ids.setdefault, texts[t], new), np.int32, len(texts[t]))
        return numbers[t]

    for a in automata([texts[t][s:e] for t, s, e in passages], block):
        for d, text in enumerate(joined):
            hits = list(a.iter(text)) if text else []
            if not hits:
                continue
            done: dict[tuple[int, int], int] = {}
            own = spelled(d)
            sizes = np.fromiter(map(len, text[1:-1].split(" ")), np.int64, len(own))
            starts = np.cumsum(sizes + 1) - sizes
            # the hit ends with the space behind its last word
            last = np.searchsorted(starts, np.fromiter((end for end, _ in hits), np.int64, len(hits)), side="left") - 1
            for i, (_, where) in zip(last.tolist(), hits):
                first = i - block + 1
                for p, k in where:
                    shift = first - k
                    if done.get((p, shift), -1) >= i:
                        continue
                    t, s, e = passages[p]
                    lo, hi = max(0, shift), min(len(own), shift + e - s)
                    done[p, shift] = hi
                    same = own[lo:hi] == spelled(t)[s + lo - shift : s + hi - shift]
                    if same.all():  # most are copies from end to end
                        if hi - lo >= window:
                            covered[d][lo:hi] = True
                        continue
                    cuts = np.concatenate([[-1], np.flatnonzero(~same), [hi - lo]])
                    for g in np.flatnonzero(cuts[1:] - cuts[:-1] > window).tolist():
                        covered[d][lo + cuts[g] + 1 : lo + cuts[g + 1]] = True
    return covered


def removed_words(own: Windows, texts: list[list[bytes]], h: np.ndarray, g: np.ndarray, block: int = BLOCK) -> list[np.ndarray]:
    """Of each text of a bucket, the words in windows that are confirmed (sorted first hashes, with the second)."""
    mine = np.flatnonzero(_has(h, own.h))
    if not len(mine):
        return [np.zeros(len(w), bool) for w in texts]
    # of one first hash there may be several second ones
    mine = mine[_has_pair(h, g, own.h[mine], own._hashes(1)[mine])]
    _, first = np.unique(own.h[mine], return_index=True)
    at = np.sort(own.at[mine[first]])
    breaks = np.flatnonzero((at[1:] - at[:-1] != 1) | (own.text[at[1:]] != own.text[at[:-1]])) + 1
    passages = []
    for a, b in itertools.pairwise([0, *breaks.tolist(), len(at)]) if len(at) else ():
        t = int(own.text[at[a]])
        s = int(at[a] - own.first[t])
        passages.append((t, s, s + b - a - 1 + own.window))
    return covered_by(texts, passages, own.window, block)


def _has_pair(h: np.ndarray, g: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs (x, y) are among the sorted pairs (h, g): a run of one h is looked through step by step."""
    at = np.searchsorted(h, x)
    out = np.zeros(len(x), bool)
    step = 0
    while True:
        k = np.minimum(at + step, len(h) - 1)
        same = (at + step < len(h)) & (h[k] == x)
        if not same.any():
            return out
        out |= same & (g[k] == y)
        step += 1


#: What buckets send to shards and get back.
SENT = {"shard": pa.int64(), "bucket": pa.int64(), "hashes": pa.binary(), "more": pa.binary()}
FOUND = {"bucket": pa.int64(), "shard": pa.int64(), "found": pa.binary()}
PAIRS = {"shard": pa.int64(), "bucket": pa.int64(), "first": pa.binary(), "second": pa.binary(), "more": pa.binary()}
KNOWN = {"bucket": pa.int64(), "first": pa.binary(), "second": pa.binary()}


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "repeats", bucket_bytes: int = BUCKET, window: int = WINDOW) -> DataFrame:
    """docs with a struct column: n_words, spans of removed words (start, end), and kept, the other words joined by one space."""
    out = free_name(docs, out)
    bucket = free_name(docs, "__bucket")
    block = (window + 1) // 2
    size = docs.agg(F.coalesce(F.sum(F.octet_length(col(text_col))), F.lit(0)).alias("n")).first().n
    n_buckets = max(1, -(-size // bucket_bytes))
    shard_bits = max(0, int(size // SHARD).bit_length())
    # by row, so that equal rows don't meet in one bucket
    dealt = docs.withColumn(bucket, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_buckets))).repartition(max(1, -(-size // PARTITION)), bucket)
    ti, n_columns = docs.columns.index(text_col), len(docs.columns)
    windows_of = lambda table: Windows([t.as_py() for t in table.column(ti)], window)

    def cut(h: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
        """The parts of sorted hashes of so many bits that go to each shard."""
        ends = np.searchsorted(h >> np.uint64(bits - shard_bits), np.arange(1 << shard_bits), side="right").tolist() if shard_bits else [len(h)]
        return ((i, slice(a, b)) for i, (a, b) in enumerate(itertools.pairwise([0, *ends])) if b > a)

    def rows(kind: dict[str, pa.DataType], made: list[tuple]) -> pa.Table:
        return pa.table({name: pa.array([r[i] for r in made], t) for i, (name, t) in enumerate(kind.items())})

    def sent(table: pa.Table) -> pa.Table:
        h, n = windows_of(table).short()
        where = table.column(n_columns)[0].as_py()
        return rows(SENT, [(shard, where, _pack(h[part] << _CANDIDATE, 6), np.packbits(n[part] > 1).tobytes()) for shard, part in cut(h, 48)])

    def candidates(table: pa.Table) -> pa.Table:
        parts = [_unpack(b.as_py(), 6) for b in table.column("hashes")]
        more = [_bits(b.as_py(), len(x)) for b, x in zip(table.column("more"), parts)]
        found = [np.packbits(x).tobytes() for x in recurring([parts], more)]
        return rows(FOUND, list(zip(table.column("bucket").to_pylist(), table.column("shard").to_pylist(), found)))

    def asked(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return rows(PAIRS, [])
        own = windows_of(texts)
        h, _ = own.short()
        bits = dict(zip(known.column("shard").to_pylist(), known.column("found").to_pylist()))
        yes = np.concatenate([np.zeros(0, bool), *(_bits(bits[shard], part.stop - part.start) for shard, part in cut(h, 48))])
        h, g, n = own.pairs(h[yes])
        where = texts.column(n_columns)[0].as_py()
        return rows(PAIRS, [(shard, where, _pack(h[part]), _pack(g[part]), np.packbits(n[part] > 1).tobytes()) for shard, part in cut(h, 64)])

    def confirmed(table: pa.Table) -> pa.Table:
        hs, gs = ([_unpack(b.as_py()) for b in table.column(c)] for c in ("first", "second"))
        more = [_bits(b.as_py(), len(x)) for b, x in zip(table.column("more"), hs)]
        made = zip(table.column("bucket").to_pylist(), hs, gs, recurring([hs, gs], more))
        return rows(KNOWN, [(where, _pack(h[yes]), _pack(g[yes])) for where, h, g, yes in made if yes.any()])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))), T.StructField("kept", T.StringType())]))])
    arrow = to_arrow_schema(schema)

    def located(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in arrow.types], schema=arrow)
        own = windows_of(texts)
        h, g = (np.concatenate([np.zeros(0, np.uint64), *(_unpack(b.as_py()) for b in known.column(c))]) for c in ("first", "second"))
        order = np.lexsort((g, h))
        made = []
        words = own.words()
        for w, gone in zip(words, removed_words(own, words, h[order], g[order], block)):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).tolist()
            spans = list(zip(edge[::2], edge[1::2]))
            kept, pos = [], 0
            for a, b in [*spans, (len(w), len(w))]:
                kept += w[pos:a]
                pos = b
            made.append({"n_words": len(w), "spans": [{"start": a, "end": b} for a, b in spans], "kept": b" ".join(kept).decode("utf-8", "surrogatepass")})
        return pa.Table.from_arrays([*(c.cast(t) for c, t in zip(texts.columns[:n_columns], arrow.types)), pa.array(made, arrow.types[-1])], schema=arrow)

    # all columns go along here too: the passes then have one and the same exchange, which is written once and reused
    spelled = lambda kind: ", ".join(f"{n} {'binary' if t == pa.binary() else 'long'}" for n, t in kind.items())
    found = dealt.groupBy(bucket).applyInArrow(sent, spelled(SENT)).groupBy("shard").applyInArrow(candidates, spelled(FOUND))
    pairs = dealt.groupBy(bucket).cogroup(found.groupBy("bucket")).applyInArrow(asked, spelled(PAIRS))
    known = pairs.groupBy("shard").applyInArrow(confirmed, spelled(KNOWN))
    return dealt.groupBy(bucket).cogroup(known.groupBy("bucket")).applyInArrow(located, schema)
