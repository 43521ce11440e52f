"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is its weighted set of five-word shingles. Each shingle sends a Poisson process of arrivals, with its weight as rate,
to uniformly drawn registers; a register keeps the shingle that came first. Arrivals are drawn in rounds for all shingles that
can still win, and the process ends when the next arrival of each would come after the slowest register's. Two signatures agree
in a register with the probability Jaccard similarity of their sets. Signatures are cut into bands of ROWS registers; texts that
share a band are candidates, and candidates are verified on their texts: a link holds at THRESHOLD or more. Weights are a
parameter: 1 + log of a shingle's count ("log"), or 1 ("binary", with which probability Jaccard is Jaccard similarity).

Classes are the connected components of the links. Exact copies (same words) are one node from the start. No bucket is
expanded into its pairs: in each round every node of a bucket is tested against one centre, first the node that shares most
bands with others, and nodes that have joined the centre's component are done. Then buckets of SMALL nodes or fewer have their
last pairs tested. Nodes of larger buckets that are still in different components meet by a prefix join, which is exact for any
weights (see prefix_pairs). Components are found by contraction with pointer jumping; all state is written to the shared folder
between rounds and deleted when its successor stands.

Defined results: null text has no words; texts without words are copies of each other; a text of fewer than five words is one
shingle; repeated rows are copies; rows with null or repeated ids get a class each by their words like any other.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, col, free_name, sliced, words_of

WIDTH, THRESHOLD = 5, 0.8
#: At a similarity of 0.8 a pair is missed by all bands with probability (1 - 0.8 ** ROWS) ** BANDS = 3e-6.
BANDS, ROWS = 24, 4
STAR_ROUNDS, SMALL = 2, 8
#: Words whose hashes a worker remembers before it starts anew.
CACHE_WORDS = 120_000

_GOLD, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = [np.uint64(x | 1) for x in (0x8D8F1D0B5A3C9E17, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_HASHES: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    try:
        return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in set(words).difference(_HASHES):
            _HASHES[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingles(words: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text as sorted 64-bit hashes, and their counts."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = word_hashes(words)
    k = min(width, len(h))
    n = len(h) - k + 1
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = mixed(out * _ODD[i % 5] + h[i : i + n])
    return np.unique(out, return_counts=True)


#: Weights of shingles by their counts in a text.
WEIGHTS = {"binary": lambda n: np.ones(len(n)), "log": lambda n: 1 + np.log(n)}


def signature(elements: np.ndarray, w: np.ndarray, m: int) -> np.ndarray:
    """For each of m registers the element whose arrival came first."""
    first = np.full(m, np.inf)
    won = np.zeros(m, np.uint64)
    h, rate, t, i = elements, w, np.zeros(len(elements)), 0
    while len(h):
        n = max(1, min(m, -(-2 * m // len(h))))
        x = mixed(h[:, None] + _GOLD * np.arange(i + 1, i + n + 1, dtype=np.uint64)[None, :])
        gaps = -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[:, None]
        at = t[:, None] + np.cumsum(gaps, 1)
        to = (mixed(x ^ _GOLD) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
        flat, to = at.ravel(), to.ravel().astype(np.int64)
        sooner = np.flatnonzero(flat < first[to])
        if len(sooner):
            sooner = sooner[np.argsort(-flat[sooner], kind="stable")]  # of several arrivals the earliest is written last
            first[to[sooner]] = flat[sooner]
            won[to[sooner]] = h[sooner // n]
        going = at[:, -1] < first.max()
        h, rate, t, i = h[going], rate[going], at[going, -1], i + n
    return won


def bands_of(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.arange(1, bands + 1, dtype=np.uint64) * _GOLD
    for i in range(rows):
        out = mixed(out * _ODD[i % 5] + sig[i * bands : (i + 1) * bands])
    return out.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weigh: str = "binary") -> float:
    """Probability Jaccard similarity of two weighted sets of (elements, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    if weigh == "binary" or len(a[0]) == a[1].sum() and len(b[0]) == b[1].sum():  # all weights are 1
        return len(i) / (len(a[0]) + len(b[0]) - len(i))
    wa, wb = WEIGHTS[weigh](a[1]), WEIGHTS[weigh](b[1])
    # for each common element d: 1 / sum over elements of max(x / x_d, y / y_d), by order of the ratios y / x
    x, y = wa[i], wb[j]
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    below, above = np.cumsum(x), y.sum() - np.cumsum(y)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    return float((1 / ((below + only_a) / x + (above + only_b) / y)).sum())


def _signed(weigh: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, text) with the 128-bit hash of the words and the bands."""
        for batch in sliced(batches):
            h1, h2, bands = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                d = xxhash.xxh128_intdigest(b" ".join(words))
                h1.append((d >> 64) - (1 << 63))
                h2.append((d & (1 << 64) - 1) - (1 << 63))
                e, n = shingles(words)
                bands.append(bands_of(signature(e, WEIGHTS[weigh](n), BANDS * ROWS)) if len(e) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), _lists(bands)], names=["row", "h1", "h2", "bands"])

    return run


def _lists(arrays: list[np.ndarray], kind: type = np.int64) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays).astype(kind, copy=False) if arrays else np.zeros(0, kind))


def _verified(weigh: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of pairs (a, b, text_a, text_b), those that are linked; the shingles of a centre are kept while its pairs pass by."""
        last, held = None, None
        for batch in sliced(batches):
            a, b = [], []
            for x, y, s, t in zip(*[batch.column(n).to_pylist() for n in ("a", "b", "text_a", "text_b")]):
                if t is not last and t != last:
                    last, held = t, shingles(words_of(t))
                if similarity(shingles(words_of(s)), held, weigh) >= THRESHOLD - 1e-9:
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, weigh: str, s: Scratch) -> DataFrame:
    """The pairs that hold. Texts of a side a lie dealt by node; those of the centres are written apart, so that their join is split where one centre has very many pairs."""
    left = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    centres = s.write(texts.join(pairs.select(F.col("b").alias("node")).distinct().hint("merge"), "node", "left_semi"), "centres")
    both = left.join(centres.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    held = s.write(both.select("a", "b", "text_a", "text_b").mapInArrow(_verified(weigh), "a long, b long"), "links")
    s.drop(centres)
    return held


def _masses(weigh: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, label, text) with its shingles, the share of each in the text's weight, and that weight."""
        for batch in sliced(batches):
            hs, ps, total = [], [], []
            for text in batch.column("text").to_pylist():
                h, n = shingles(words_of(text))
                w = WEIGHTS[weigh](n)
                hs.append(h.view(np.int64))
                total.append(float(w.sum()))
                ps.append(w / total[-1] if len(w) else w)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), pa.array(total, pa.float64()), _lists(hs), _lists(ps, np.float64)], names=["node", "label", "total", "hs", "ps"])

    return run


def prefix_pairs(nodes: DataFrame, s: Scratch, weigh: str, t: float = THRESHOLD) -> DataFrame:
    """(a, b) of (node, label, text) rows of different labels that may have similarity t or more; none that has is left out.

    If the shingles that two texts share make up P of the weight of one and Q of the other's, their similarity is 1 / (1/P + 1/Q - 1)
    at most: a term is 1 / ((1-P)/p + (1-Q)/q + max(P/p, Q/q)) at most, p and q being the shares of its shingle, and that is concave
    and homogeneous in p and q, so the sum is largest where all are in proportion. Shingles are ordered by how many of these rows
    have them, the rarest first; what is at and behind the first shingle that a pair shares bounds P and Q, and so does the smaller
    number of shingles there, as each of the others weighs 1 at least. So a text is known by its shingles down to where t of its
    weight is left, and a meeting counts where the remainders allow t. Shingles that only one label has can't join two and aren't
    shuffled on.
    """
    lists = s.write(nodes.select("node", "label", "text").mapInArrow(_masses(weigh), "node long, label long, total double, hs array<long>, ps array<double>"), "shingles")
    each = lists.select("node", "label", "total", F.size("hs").alias("n"), F.explode(F.arrays_zip("hs", "ps")).alias("x")).select("node", "label", "total", "n", F.col("x.hs").alias("h"), F.col("x.ps").alias("p"))
    df = s.write(each.groupBy("h").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("df > 1"), "frequencies")
    from_here = Window.partitionBy("node").orderBy(F.desc("df"), F.desc("h")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = each.join(df, "h").withColumns({"behind": F.sum("p").over(from_here), "m": F.count("*").over(from_here)})
    prefix = s.write(shared.where((F.col("behind") >= t - 1e-9) & (F.col("lo") < F.col("hi"))).select("h", "node", "label", "total", "n", "behind", "m"), "prefix")
    s.drop(lists, df)
    x, y = (prefix.select("h", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "label", "total", "n", "behind", "m"))) for k in "ab")
    m = F.least("m_a", "m_b")
    most = [F.least(F.col(f"behind_{k}"), 1 - (F.col(f"n_{k}") - m) / F.col(f"total_{k}")) for k in "ab"]
    enough = (most[0] > 0) & (most[1] > 0) & (1 / most[0] + 1 / most[1] - 1 <= 1 / t + 1e-9)
    return x.join(y, (x.h == y.h) & (F.col("label_a") < F.col("label_b")) & enough).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def contract(labels: DataFrame, links: DataFrame, s: Scratch) -> DataFrame:
    """(node, label) after joining the components that links (a, b) of nodes connect; a component's label is its least old label. The state of the old labels goes."""
    name = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias("l" + side))
    edges = s.write(links.join(name("a"), "a").join(name("b"), "b").where("la <> lb").select("la", "lb").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("lb").alias("la"), F.col("la").alias("lb")))
        least = s.write(both.groupBy("la").agg(F.min("lb").alias("to")).where("to < la"), "least")
        up = least
        for _ in range(3):
            step = up.select(F.col("la").alias("to"), F.col("to").alias("next"))
            up = up.join(step, "to", "left").select("la", F.coalesce("next", "to").alias("to"))
        up = s.write(up, "up")
        old, labels = labels, s.write(labels.join(up.withColumnRenamed("la", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        new = lambda side: up.select(F.col("la").alias(side), F.col("to").alias("n" + side))  # noqa: E731,B023
        left = s.write(edges.join(new("la"), "la", "left").join(new("lb"), "lb", "left").select(F.coalesce("nla", "la").alias("la"), F.coalesce("nlb", "lb").alias("lb")).where("la <> lb").distinct(), "edges")
        s.drop(old, least, up, edges)
        edges = left
    s.drop(edges)
    return labels


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "near", weigh: str = "log") -> DataFrame:
    """docs with a struct column: class_id (the least id of the class, or null if all are), class_size, n_verified (tested pairs of its text that hold) and first (of its class, by id)."""
    out = free_name(docs, out)
    row = free_name(docs, "__row")
    s = Scratch(docs.sparkSession)
    # documents are dealt by row once: the join of the texts and the last one read them as they lie
    kept = s.deal(docs.withColumn(row, F.monotonically_increasing_id()), "near-docs", row)
    fed = kept.select(F.col(row).alias("row"), col(text_col).alias("text"))
    signed = s.write(fed.mapInArrow(_signed(weigh), "row long, h1 long, h2 long, bands array<long>"), "signed")
    nodes = s.write(signed.groupBy("h1", "h2").agg(F.min("row").alias("node"), F.min_by("bands", "row").alias("bands")), "nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    # states are written before they are joined: Spark splits a hot key only where both sides of a join come fresh from a shuffle
    shared = s.write(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    buckets = s.write(keys.join(shared, "key"), "buckets")
    degree = s.write(buckets.groupBy("node").agg(F.sum("size").alias("degree")), "degree")
    # merged at every size: the plan of small inputs is that of large ones, and nothing is broadcast by estimate
    texts = s.deal(fed.join(degree.select(F.col("node").alias("row")).hint("merge"), "row").select(F.col("row").alias("node"), "text"), "texts", "node")
    labels = s.write(degree.select("node", F.col("node").alias("label")), "labels")
    tested, held = [], []

    def test(pairs: DataFrame) -> None:
        """Verifies pairs that haven't been, and joins the components of those that hold."""
        nonlocal labels
        # each pair once, but as it came: b is the centre, and only the join on b may be split
        pairs = pairs.groupBy(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).agg(F.min(F.struct("b", "a")).alias("x")).select("hi", "lo", "x.a", "x.b")
        for before in tested:
            pairs = pairs.join(before.select("hi", "lo"), ["hi", "lo"], "left_anti")
        tested.append(s.write(pairs, "pairs"))
        held.append(_links(tested[-1], texts, weigh, s))
        labels = contract(labels, held[-1], s)

    def split() -> tuple[DataFrame, DataFrame]:
        """Bucket rows with labels, and the buckets whose nodes are in different components."""
        rows = buckets.join(labels, "node")
        return rows, s.write(rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key"), "parted")

    for k in range(STAR_ROUNDS):
        rows = buckets.join(labels, "node")
        first = (-F.col("degree") if k == 0 else F.xxhash64("node", F.lit(k))).alias("p")
        centre = rows.join(degree, "node").groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct(first, F.col("node").alias("b"), F.col("label").alias("lb"))).alias("c")).where("lo < hi")
        centre = s.write(centre.select("key", "c.b", "c.lb"), "centre")
        test(rows.join(centre, "key").where("label <> lb").select(F.col("node").alias("a"), "b"))
        s.drop(centre)
    rows, parted = split()
    small = s.write(rows.where(F.col("size") <= SMALL).join(parted, "key"), "small")
    other = small.select("key", F.col("node").alias("b"), F.col("label").alias("lb"))
    test(small.join(other, "key").where("label < lb").select(F.col("node").alias("a"), "b"))
    s.drop(small)
    rows, parted = split()
    open_ = rows.where(F.col("size") > SMALL).join(parted, "key").select("node", "label").distinct()
    test(prefix_pairs(open_.join(texts, "node"), s, weigh))

    ends = [h.select(F.explode(F.array("a", "b")).alias("node")) for h in held]
    linked = s.write(functools.reduce(DataFrame.unionByName, ends).groupBy("node").agg(F.count("*").alias("n_verified")), "linked")
    where = signed.select("row", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).join(labels, "node", "left").join(linked, "node", "left")
    where = where.select(F.col("row").alias(row), F.coalesce("label", "node").alias("__class"), F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"))
    ids = s.write(kept.select(F.col(row), col(id_col).alias("__id")).join(where.hint("merge"), row), "classes")
    size = ids.groupBy("__class").agg(F.min("__id").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col(row).alias("r"))).alias("f"))
    size = s.write(size.select("__class", "class_id", "class_size", F.col("f.r").alias("__first")), "sizes")
    said = s.write(ids.join(size, "__class").select(row, F.struct("class_id", "class_size", "n_verified", (F.col("__first") == F.col(row)).alias("first")).alias(out)), "said")
    s.drop(*(df for df, _ in s.held if df is not kept and df is not said))
    return kept.join(said.hint("merge"), row).select(*docs.columns, out)
