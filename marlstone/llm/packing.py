"""Best-fit-decreasing packing of tokenised texts into sequences.

Texts longer than a window are first cut into full windows, each a sequence of its own. What is left of each text is held,
longest first, against a segment tree indexed by remaining capacity, which finds the tightest open sequence in O(log length).
Each task packs its own rows in groups of bounded size, so no row is shuffled and no task needs more than a group in memory.

Defined results: null or empty text is the end token alone; repeated rows are packed each; an empty table gives no pieces.
A group is sorted by length, id and start, so ties and the order of rows don't matter within it.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col, release, sliced, words_of

LENGTH = 2048
END_ID = 1
#: Tokens, and pieces, that a task holds before it packs them.
GROUP_TOKENS, GROUP_PIECES = 8_000_000, 200_000
#: Words whose ids a worker remembers before it starts anew.
CACHE_WORDS, CACHE_PLAIN = 600_000, 300_000


# What a tokenizer file must say for its texts to be taken word by word (fixed values).
_BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "post_processor": None, "truncation": None, "padding": None,
}


class WordTokenizer:
    """Ids of texts from a tokenizer file, as little-endian unsigned 32-bit bytes.

    Where the file's pre-tokenizer drops white space and its pattern can't cross it (_BY_WORD), the ids of a text are those of its
    words in turn; each word's bytes are remembered, and a plain word goes straight to the model, in the runs that the pre-tokenizer
    would cut. Whatever else a file says, its texts are given to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        said = json.loads(self.tok.to_str())
        self.by_word = said["model"]["type"] == "BPE" and all(said[k] == v for k, v in _BY_WORD.items())
        self.cache: dict[bytes, bytes] = {}
        self.plain: dict[str, bytes] = {}

    def _of(self, text: str) -> bytes:
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str | None) -> bytes:
        if not self.by_word:
            return self._of(text or "")
        words = words_of(text)
        try:
            return b"".join(map(self.cache.__getitem__, words))
        except KeyError:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            if len(self.plain) > CACHE_PLAIN:
                self.plain.clear()
            for w in set(words).difference(self.cache):
                self.cache[w] = self._word(w)
            return b"".join(map(self.cache.__getitem__, words))

    def _word(self, w: bytes) -> bytes:
        if _PLAIN(w):
            parts = _PARTS(w)
            return self._part(w) if len(parts) == 1 else b"".join(map(self._part, parts))
        return self._of(w.decode("utf-8", "surrogatepass"))

    def _part(self, raw: bytes) -> bytes:
        """What the pre-tokenizer gives of a plain word: a run of letters, a digit, or a run of signs. The model takes bytes as letters of its own."""
        low = raw.decode().lower()
        if (ids := self.plain.get(low)) is None:
            letters = low if raw.isascii() else low.encode().decode("latin-1").translate(_LETTERS)
            ids = self.plain[low] = array("I", [t.id for t in self.tok.model.tokenize(letters)]).tobytes()
        return ids


#: ASCII signs but ' and <, which may start more than a run, and the letters of Latin-1.
_PLAIN = re.compile(rb"(?:[!-&(-;=-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
_PARTS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+|[0-9]|[^A-Za-z0-9\xc3]+").findall
# Bytes that have no letter of their own in Latin-1 stand for those from 256 on, in their order.
_LETTERS = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}
_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """A worker keeps its tokenizers."""
    return _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, WordTokenizer(path))


class OpenWindows:
    """Open sequences by remaining capacity; a segment tree over the capacities finds the least that suffices."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.tree = [0] * (2 * self.size)
        self.at: list[list] = [[] for _ in range(length + 1)]

    def _count(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def put(self, capacity: int, window) -> None:
        self.at[capacity].append(window)
        self._count(capacity, 1)

    def take(self, need: int):
        """The tightest open window with room for need, and its capacity; None if there is none."""
        tree, i = self.tree, need + self.size
        while not tree[i]:
            while i & 1:  # a right child: everything above need under its parent has been seen
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i *= 2
            if not tree[i]:
                i += 1
        capacity = i - self.size
        self._count(capacity, -1)
        return capacity, self.at[capacity].pop()


def best_fit_decreasing(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; lengths must be in decreasing order and at most `length`."""
    open_, out, n = OpenWindows(length), [], 0
    for x in lengths:
        got = open_.take(x)
        if got is None:
            got, n = (length, n), n + 1
        capacity, seq = got
        out.append((seq, length - capacity))
        if capacity > x:
            open_.put(capacity - x, seq)
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: the id (under a longer name where it is named like another column), start, length, doc_tokens, sequence_id, offset, and token_bytes (little-endian unsigned 32-bit ids).

    sequence_id is unique over the table: the task's partition in the upper bits, its own count in the lower 40.
    """
    fed = docs.select(col(id_col), col(text_col))
    given = fed.schema.fields[0]
    name = given.name
    while name.lower() in ("start", "length", "doc_tokens", "sequence_id", "offset", "token_bytes"):
        name += "_"
    schema = T.StructType([
        T.StructField(name, given.dataType, given.nullable), *(T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")), T.StructField("token_bytes", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path)
        base, used = TaskContext.get().partitionId() << 40, 0
        held: list[tuple] = []
        tokens = 0
        ready: list[tuple] = []
        size = 0

        def flush():
            nonlocal held, tokens, used
            held.sort(key=lambda p: (-p[2], p[0] is None, 0 if p[0] is None else p[0], p[1]))
            for p, (seq, at) in zip(held, best_fit_decreasing([p[2] for p in held], length)):
                yield (*p[:4], base + used + seq, at, p[4])
            used += len(held)
            held, tokens = [], 0

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

        for batch in sliced(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tok(text) + end
                n = len(ids) // 4
                full = n - n % length
                for s in range(0, full, length):
                    ready.append((key, s, length, n, base + used, 0, ids[4 * s : 4 * (s + length)]))
                    used += 1
                    size += length
                if n > full:
                    held.append((key, full, n - full, n, ids[4 * full :]))
                    tokens += n - full
                if size >= 2_000_000:
                    yield table(ready)
                    ready, size = [], 0
                if tokens >= GROUP_TOKENS or len(held) >= GROUP_PIECES:
                    for row in flush():
                        ready.append(row)
                        size += row[2]
                        if size >= 2_000_000:
                            yield table(ready)
                            ready, size = [], 0
        for row in flush():
            ready.append(row)
            size += row[2]
            if size >= 2_000_000:
                yield table(ready)
                ready, size = [], 0
        if ready:
            yield table(ready)
        ready = held = None
        release()

    return fed.mapInArrow(run, schema)
