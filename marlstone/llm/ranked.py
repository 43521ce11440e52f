"""Ranked lexical search by windowed bucket scoring.

`index` numbers documents as they are read and cuts the numbers into windows of at most WINDOW. It writes, by window, one row of
its documents (ids and term counts) and one posting row a term (places in the window and occurrences). `search` takes items in
blocks. The postings of a block's terms are dealt by window; a task traverses the windows one after another. A term's
contributions are computed once a window, whatever number of items ask for it; for each item they are added up in one array of
window size, which stays in cache, with a bitset of the places that were touched. The touched places alone are harvested into the
item's heap, which goes on over all windows of the task, and the heaps of all tasks are merged at the end.

Term weights are floor(1000 * ln((2N + 2) / (2df + 1))) in doubles, all else is done in integers: with
m = 100 - B + B * n * N div L, a term adds weight * ((10**9 * tf) div (1000 * tf + 8 * m)).

Scale: texts are read once and never shuffled; of the postings only those of terms that are asked for are, dealt by window, and
windows are alike in size. A task holds one window, or the block of items with their heaps. The driver sees the items of one block
and one count for each of its terms.

Defined results: null and empty texts are in no result and count nowhere; equal scores are ordered by id, a null id last; repeated
documents are documents each; each row of items is an item, so repeated items have repeated results; items without a known term
have none; an item's terms count as often as they stand in it. Ids of documents must be integers; ids of items may be of any type.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, col, release, sliced
from .decontaminate import normalised

WINDOW, B, TOP = 8192, 75, 10
#: Postings after which a window ends early: what a task holds while it inverts a window.
POSTINGS = 2_000_000
#: Different terms, and items, of one block of items.
BLOCK_TERMS, BLOCK_ITEMS = 50_000, 1_000
#: Posting rows handed on at once.
_OUT = 20_000

INDEX = "window long, term binary, places binary, counts binary"
_SCHEMA = pa.schema([("window", pa.int64()), ("term", pa.binary()), ("places", pa.binary()), ("counts", pa.binary())])
_NO_ID = -(1 << 63)


class _Window:
    """Postings of consecutive documents, by place; inverted when the window is full."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.of: list[int] = []
        self.tf: list[int] = []
        self.sizes: list[int] = []
        self.ids: list[int] = []
        self.n: list[int] = []

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        counts, terms = Counter(words), self.terms
        self.of += [terms.setdefault(t, len(terms)) for t in counts]
        self.tf += counts.values()
        self.sizes.append(len(counts))
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.n.append(len(words))

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        head = [pa.array([number]), pa.array([None], pa.binary()), pa.array([np.array(self.ids, "<i8").tobytes()], pa.binary()), pa.array([np.array(self.n, "<i8").tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(head, schema=_SCHEMA)
        of = np.array(self.of, np.int32)
        order = np.argsort(of, kind="stable")
        places = np.repeat(np.arange(len(self.sizes), dtype="<u2"), self.sizes)[order]
        counts = np.array(self.tf, "<i8")[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(self.terms)))])
        names = list(self.terms)
        for a in range(0, len(names), _OUT):
            b = min(a + _OUT, len(names))
            cut = ends[a : b + 1]
            packed = [pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(((cut - cut[0]) * v.itemsize).astype(np.int32).tobytes()), pa.py_buffer(v[cut[0] : cut[-1]].tobytes())]) for v in (places, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, number)), pa.array(names[a:b], pa.binary()), *packed], schema=_SCHEMA)


def index(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, postings: int = POSTINGS) -> DataFrame:
    """The index, written once: by window a row without term (ids and term counts of its documents), and a row a term (places and occurrences)."""
    if window > 1 << 16:
        raise ValueError("places in a window are 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now = TaskContext.get().partitionId() << 32, _Window()
        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if words := normalised(text).split():
                    now.add(doc_id, words)
                    if len(now.ids) == window or len(now.of) >= postings:
                        yield from now.rows(number)
                        number, now = number + 1, _Window()
        if now.ids:
            yield from now.rows(number)
        del now
        release()

    return scratch.write(docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).mapInArrow(run, INDEX), "index")


def _blocks(items: DataFrame, most_terms: int, most_items: int) -> Iterator[list[tuple[int, Counter]]]:
    """The items' terms in blocks of bounded size, streamed."""
    block: list[tuple[int, Counter]] = []
    held: set[bytes] = set()
    for r in items.toLocalIterator():
        terms = Counter(normalised(r.text).split())
        if block and (len(block) == most_items or len(held | terms.keys()) > most_terms):
            yield block
            block, held = [], set()
        if terms:
            block.append((r.item, terms))
            held |= terms.keys()
    if block:
        yield block


class Scorer:
    """The items of a block over one window after another; each item keeps its best documents in a heap."""

    def __init__(self, items: list[tuple[int, Counter]], weights: dict[bytes, int], n_docs: int, n_terms: int, top: int = TOP, window: int = WINDOW):
        self.weights, self.n_docs, self.n_terms, self.top = weights, n_docs, n_terms, top
        self.items = [(item, [(t, q) for t, q in terms.items() if weights.get(t)]) for item, terms in items]
        self.scores = np.zeros(window, np.int64)
        self.heaps: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def window(self, ids: np.ndarray, n: np.ndarray, postings: dict[bytes, tuple[np.ndarray, np.ndarray]]) -> None:
        m = np.array([100 - B + B * k * self.n_docs // self.n_terms for k in n.tolist()], np.int64)
        parts: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for term, (places, tf) in postings.items():
            places = places.astype(np.int64)
            touched = np.zeros(len(self.scores), bool)
            touched[places] = True
            parts[term] = places, self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[places])), np.packbits(touched)
        scores, empty = self.scores, np.zeros(len(self.scores) + 7 >> 3, np.uint8)
        for item, terms in self.items:
            occupied = None
            for term, times in terms:
                if (part := parts.get(term)) is None:
                    continue
                places, adds, bits = part
                scores[places] += adds if times == 1 else times * adds
                if occupied is None:
                    occupied = empty
                    occupied[:] = 0
                occupied |= bits
            if occupied is not None:
                at = np.flatnonzero(np.unpackbits(occupied, count=len(scores)))
                self._harvest(item, ids[at], scores[at])
                scores[at] = 0

    def _harvest(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """The best of what is found and what the heap holds; a worst score that is kept shuts out all lower ones at once."""
        if (held := self.heaps.get(item)) is not None and len(held[0]) == self.top:
            good = scores >= held[1][-1]
            ids, scores = ids[good], scores[good]
        good = scores > 0
        ids, scores = ids[good], scores[good]
        if len(scores) > self.top:
            good = scores >= np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            ids, scores = ids[good], scores[good]
        if not len(scores):
            return
        if held is not None:
            ids, scores = np.concatenate([held[0], ids]), np.concatenate([held[1], scores])
        order = np.lexsort((ids, ids == _NO_ID, -scores))[: self.top]
        self.heaps[item] = ids[order], scores[order]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, window: int = WINDOW, postings: int = POSTINGS, block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The top documents of each item: the item's id, rank from 1, the document's id and its score. Columns are named as in the inputs."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    stored = index(docs, scratch, id_col, text_col, window, postings)
    kept = scratch.write(items.select(F.monotonically_increasing_id().alias("item"), col(item_col).alias("item_id"), col(item_text_col).alias("text")), "items")
    sizes = stored.where(F.col("term").isNull()).select(F.col("counts").alias("n")).mapInArrow(_sums, "n long, terms long").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms")).first()
    found = spark.createDataFrame([], "item long, id long, score long")
    for block in _blocks(kept.select("item", "text"), block_terms, block_items):
        found = found.unionByName(scratch.write(_scored(stored, block, sizes.n or 0, sizes.terms or 1, top, window), "heaps"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("id", F.when(F.col("id") != _NO_ID, F.col("id"))).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(kept.select("item", "item_id"), "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "score")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [np.frombuffer(x, "<i8") for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in n], pa.int64()), pa.array([int(x.sum()) for x in n], pa.int64())], names=["n", "terms"])


def _scored(stored: DataFrame, block: list[tuple[int, Counter]], n_docs: int, n_terms: int, top: int, window: int) -> DataFrame:
    """(item, id, score): the heaps of each task."""
    spark = stored.sparkSession
    asked = sorted({t for _, terms in block for t in terms})
    terms = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in asked], "term binary"))
    df = stored.where(F.col("term").isNotNull()).select("term", (F.length("places") / 2).cast("long").alias("df")).join(terms, "term").groupBy("term").agg(F.sum("df").alias("df"))
    weights = {bytes(r.term): math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in df.collect()}
    given = spark.sparkContext.broadcast((block, weights))
    heads = stored.where(F.col("term").isNull())
    dealt = stored.join(terms, "term").select(*heads.columns).unionByName(heads).repartition("window").sortWithinPartitions("window", F.col("term").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*given.value, n_docs, n_terms, top, window)
        now, head, lists = None, None, {}
        for batch in sliced(batches):
            for number, term, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if number != now:
                    if head:
                        scorer.window(*head, lists)
                    now, head, lists = number, (np.frombuffer(places, "<i8"), np.frombuffer(counts, "<i8")), {}
                else:
                    lists[term] = np.frombuffer(places, "<u2"), np.frombuffer(counts, "<i8")
        if head:
            scorer.window(*head, lists)
        made = [(item, i, s) for item, (ids, scores) in scorer.heaps.items() for i, s in zip(ids.tolist(), scores.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in made], pa.int64()) for k in range(3)], names=["item", "id", "score"])

    return dealt.mapInArrow(run, "item long, id long, score long")
