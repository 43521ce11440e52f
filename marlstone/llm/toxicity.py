"""Toxicity by cumulative-link ordinal regression.

Severity has four grades. One weight vector over sparse text features is shared by the three ordered thresholds:
P(grade >= k) = sigmoid(w x - theta_k). The score is the expected grade, the sum of those probabilities.

Features are a text's words in lower case and their first 4 and 5 letters, each with log(1 + count). The model is fitted on
a bounded sample of labelled rows: the SAMPLE ids with the least hash, of them as many as SAMPLE_BYTES of text allow. Labels may
be grades, 0 to GRADES - 1; where they only say whether a text is toxic, 0 or 1, the grades of toxic texts are the terciles of
their dose, the sum of log(1 + count) over the kept features. Copies and near copies among the sampled rows count once.
Scoring is row by row with the model broadcast. FEATURES bounds its size: of more telling features only the surest are kept, so
rare ones may be missed.

Defined results: null and empty texts score 0 and are not toxic; without labelled rows of both kinds nothing is toxic;
labels that are null or have no text are ignored; repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, free_name, with_struct, words_of

GRADES = 4
#: Labelled rows used for fitting, bytes of their texts on the driver, and features kept.
SAMPLE, SAMPLE_BYTES, FEATURES = 8000, 64 << 20, 256
#: A feature is kept if its log odds between toxic and other texts are this many standard errors above 0; words that only happen
#: to be absent from toxic texts tell nothing.
LEAST_Z = 4.0
#: and if the share of toxic texts that have it is this many times the share of the others; words of one language lift little.
LEAST_LIFT = 8
RESULT = T.StructType([T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType())])
_LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: bytes) -> list[str]:
    """Features of one word as it stands between spaces."""
    out = []
    for w in _LETTERS.findall(word.decode("utf-8", "replace").lower()):
        out.append(w)
        out += [f"^{w[:k]}" for k in (4, 5) if len(w) >= k]
    return out


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self):
        self.known: dict[bytes, tuple[int, ...]] = {}

    def vector(self, text: str | None) -> Counter:
        """Counts of the model's features in a text. Each word is looked up once and remembered."""
        known = self.known
        if len(known) > 1_000_000:
            known.clear()
        words = words_of(text)
        try:
            hits = [x for x in map(known.__getitem__, words) if x]
        except KeyError:
            for w in set(words).difference(known):
                known[w] = tuple(self.index[f] for f in features_of(w) if f in self.index)
            hits = [x for x in map(known.__getitem__, words) if x]
        return Counter(i for x in hits for i in x)

    def at_least(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..GRADES-1, of linear scores."""
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds[None, :], -40, 40)))

    def score(self, texts: list[str | None]) -> list[list]:
        z = np.zeros(len(texts))
        for j, t in enumerate(texts):
            if v := self.vector(t):
                z[j] = sum(self.weights[i] * math.log1p(n) for i, n in v.items())
        p = self.at_least(z)
        blank = np.array([not (t and t.strip()) for t in texts], dtype=bool)
        p[blank] = 0
        return [p.sum(1).tolist(), (p >= 0.5).sum(1).tolist(), (p[:, 0] >= 0.5).tolist()]


def _optimum(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_features: int, l2: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full gradients with Adam; thresholds are a first one and positive gaps, so they can't cross."""
    rows = np.repeat(np.arange(len(x)), [len(i) for i, _ in x])
    cols = np.concatenate([i for i, _ in x]) if x else np.zeros(0, int)
    vals = np.concatenate([v for _, v in x]) if x else np.zeros(0)
    k = GRADES - 1
    above = (y[:, None] > np.arange(k)[None, :]).astype(float)
    par = np.concatenate([np.zeros(n_features), [1.0], np.zeros(k - 1)])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for t in range(1, steps + 1):
        w, gaps = par[:n_features], np.exp(par[n_features + 1 :])
        theta = par[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(rows, vals * w[cols], len(y))
        # the likelihood of a grade is the difference of neighbouring curves
        s = 1 / (1 + np.exp(-np.clip(z[:, None] - theta[None, :], -40, 40)))
        upper = np.concatenate([np.ones((len(y), 1)), s], 1)
        lower = np.concatenate([s, np.zeros((len(y), 1))], 1)
        at = np.arange(len(y)), y
        p = np.maximum(upper[at] - lower[at], 1e-9)
        du, dl = upper[at] * (1 - upper[at]), lower[at] * (1 - lower[at])
        gz = -(du - dl) / p / len(y)
        g_theta = np.zeros(k)
        has_up, has_low = y > 0, y < k
        np.add.at(g_theta, y[has_up] - 1, (du / p)[has_up] / len(y))
        np.add.at(g_theta, y[has_low], -(dl / p)[has_low] / len(y))
        grad = np.concatenate([np.bincount(cols, vals * gz[rows], n_features) + l2 * w, [g_theta.sum()], np.array([g_theta[i + 1 :].sum() * gaps[i] for i in range(k - 1)])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par = par - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(par[n_features + 1 :])
    return par[:n_features], par[n_features] + np.concatenate([[0], np.cumsum(gaps)])


def _unlike(texts: list[str]) -> list[int]:
    """Indices of texts that share none of four least shingle hashes with an earlier one: near copies would pass chance words off as telling."""
    seen, kept = set(), []
    for j, text in enumerate(texts):
        words = words_of(text)
        h = np.array([zlib.crc32(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))], dtype=np.uint64)
        least = {(k, int((h * np.uint64(odd) & np.uint64(0xFFFFFFFF)).min())) for k, odd in enumerate((2654435761, 2246822519, 3266489917, 668265263))}
        if not least & seen:
            kept.append(j)
        seen |= least
    return kept


def fit(rows: list[tuple[str, int]], n_features: int = FEATURES, l2: float = 1e-5, steps: int = 300) -> Model:
    """A model from (text, label) rows; labels are 0 and 1, or grades."""
    rows = [rows[j] for j in _unlike([t for t, _ in rows])]
    if not rows:
        return Model({}, np.zeros(0), np.full(GRADES - 1, 40.0) + np.arange(GRADES - 1))
    cache: dict[bytes, list[str]] = {}
    counts = []
    for text, _ in rows:
        c: Counter = Counter()
        for w, n in Counter(words_of(text)).items():
            for f in cache.get(w) or cache.setdefault(w, features_of(w)):
                c[f] += n
        counts.append(c)
    given = np.array([y for _, y in rows], dtype=int)
    toxic = (given > 0).astype(int)
    if not toxic.any() or toxic.all():
        return Model({}, np.zeros(0), np.full(GRADES - 1, 40.0) + np.arange(GRADES - 1))
    df = [Counter(), Counter()]
    for c, y in zip(counts, toxic):
        df[y].update(c.keys())
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    stat = {}
    for f in df[1].keys() | df[0].keys():
        a, b = df[1][f], df[0][f]
        if a + b >= 3:
            odds = math.log((a + 0.5) / (n1 - a + 0.5)) - math.log((b + 0.5) / (n0 - b + 0.5))
            stat[f] = odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    kept = sorted((f for f in sorted(stat) if stat[f] >= LEAST_Z and df[1][f] * n0 >= LEAST_LIFT * df[0][f] * n1), key=lambda f: -stat[f])[:n_features]
    index = {f: i for i, f in enumerate(kept)}
    dose = np.array([sum(math.log1p(n) for f, n in c.items() if f in index) for c in counts])
    cuts = np.quantile(dose[toxic == 1], [i / (GRADES - 1) for i in range(1, GRADES - 1)])
    y = given if given.max() > 1 else np.where(toxic == 1, 1 + (dose[:, None] > cuts[None, :]).sum(1), 0)
    x = [(np.array([index[f] for f in c if f in index], dtype=int), np.array([math.log1p(n) for f, n in c.items() if f in index])) for c in counts]
    w, theta = _optimum(x, y, len(index), l2, steps)
    return Model(index, w, theta)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from labelled rows: the `sample` ids with the least hash, whatever the size of the tables, less those whose texts, taken in turn, don't fit in what is left of sample_bytes."""
    known = labels.where(col(label_col).between(0, GRADES - 1) & col(id_col).isNotNull()).select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
    ids = F.broadcast(known.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).where(F.col("text").isNotNull())
    # rows of one id are few, but for an id that very many rows have: one of them is enough
    sizes = texts.join(ids, "id").groupBy("id").agg(F.max(F.octet_length("text")).alias("n"), F.count("*").alias("k")).orderBy(F.xxhash64("id"), "id").collect()
    kept, held = [], 0
    for r in sizes:  # a text that doesn't fit is passed over, whatever stands behind it may fit
        if held + r.n <= sample_bytes:
            kept.append(r.id)
            held += r.n
    if not kept:
        return fit([])
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in kept], docs.select(col(id_col).alias("id")).schema))
    got = texts.join(chosen, "id").groupBy("id").agg(F.max("text").alias("text")).join(ids, "id")
    return fit(sorted({(r.text, r.y) for r in got.select("text", "y").toLocalIterator()}))


_MODEL: list = [None, None]


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with a struct column: expected severity, the most severe grade at least as likely as not, and whether that is above 0."""
    shared = docs.sparkSession.sparkContext.broadcast((model.index, model.weights, model.thresholds))

    def run(texts):
        if _MODEL[0] is not shared.value:  # a worker keeps the last model and its words
            _MODEL[:] = [shared.value, Model(*shared.value)]
        return _MODEL[1].score(texts)

    return with_struct(docs, free_name(docs, out), [col(text_col)], run, RESULT)
