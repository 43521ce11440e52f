"""Ranked search, language identification and periodic runs, each against a brute-force version."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import language, periods, queries, ranked
from marlstone.llm.decontaminate import normalised

AWKWARD = [None, "", " \n", "x", "a " * 300, "One  two\tthree one two three one two three one two three", "é" * 5000 + " a", "!!! 123"]


# --- periodic runs


def brute_runs(words, least=12):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, 2 * q):
                best.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(periods, "WORDS", rng.choice([1, 50, 100_000]))
    monkeypatch.setattr(periods, "PAIRS", rng.choice([7, 100, 1_000_000]))
    levels = rng.choice([1, 2, 4, 20])
    monkeypatch.setattr(periods, "runs_of", lambda *a, was=periods.runs_of: was(*a, levels=levels))
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            a, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.choice([0, 1, 5, 12, 13, 40, 100, 200])
            w = [chr(97 + rng.randrange(a)) for _ in range(n)]
            if n > 3 and rng.random() < 0.5:
                p, s = rng.randint(1, n // 2), rng.randrange(n)
                w = [w[i] if i < s else w[min(s + (i - s) % p, n - 1)] for i in range(n)]
            texts.append(" ".join(w))
        least = rng.choice([2, 12])
        n_words, runs, collapsed = periods.judged(texts, least)
        for text, n, own, kept in zip(texts, n_words, runs, collapsed):
            expected = brute_runs(text.split(), least)
            assert n == len(text.split())
            assert [(r["start"], r["length"], r["period"]) for r in own] == expected
            assert kept == brute_kept(text.split(), expected)


def test_runs_awkward_frames(spark):
    docs = spark.createDataFrame([(t, i, "c") for i, t in enumerate(AWKWARD)] + [("a " * 300, None, None)], "text string, doc_id long, periods string")
    got = periods.runs(docs).orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert got[0].__fields__ == ["text", "doc_id", "periods", "periods_"]
    for r in got:
        words = (r.text or "").split()
        assert [tuple(x) for x in r.periods_.runs] == brute_runs(words)
        assert r.periods_.collapsed == brute_kept(words, brute_runs(words)) and r.periods_.n_words == len(words)
    assert periods.runs(docs.limit(0)).collect() == []


def test_planted_documents(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60)))) for i in range(300)] + [(None, "a b c"), (5000, None), (5001, "")]
    for r in queries.planted(spark.createDataFrame(rows, "doc_id long, text string")).join(spark.createDataFrame(rows, "doc_id long, was string"), "doc_id").collect():
        words, h = (r.was or "").split(), zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert (r.text or "").split() == words


# --- ranked search


def brute_search(docs, items, top=10):
    bags = [(i, Counter(normalised(t).split())) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_all, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_all // total
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in normalised(text).split() if b[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i * 7 - 50, " ".join(rng.choices(words, k=rng.randint(0, 30))).replace("w1 ", "W1, ")) for i in range(n)]
    return docs + [(11, docs[3][1])] * 2 + [(-3, docs[3][1]), (99, None), (98, "--"), (97, "Zug ÄÖ zug 3b")], [(f"i{k}", " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(9)]


@pytest.mark.parametrize(("window", "postings", "block"), [(8192, 2_000_000, 1000), (4, 2_000_000, 2), (64, 50, 3)])
def test_search_against_brute_force(spark, window, postings, block):
    docs, items = corpus(window, 120)
    items += [("zug", "ZUG äö"), ("none", "unheard of"), ("null", None), ("empty", ""), (None, "w1 w2"), items[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = ranked.search(d, spark.createDataFrame(items, "item_id string, text string"), window=window, postings=postings, block_items=block)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_search(docs, items)


def test_search_ties_nulls_and_names(spark):
    docs = spark.createDataFrame([("same words here", i, 1) for i in [None, *range(30, 5, -1)]], "body string, key int, score int")
    items = spark.createDataFrame([(5, "words"), (5, "words")], "rank int, text string")
    got = ranked.search(docs, items.withColumnRenamed("rank", "item_id"), "key", "body", top=30).collect()
    by_rank = sorted((r.rank, r.key) for r in got if r.key is not None)
    assert by_rank == sorted((k - 5, k) for k in range(6, 31) for _ in range(2))
    assert [r.rank for r in got if r.key is None] == [26, 26]
    assert ranked.search(docs.limit(0), items.withColumnRenamed("rank", "item_id"), "key", "body").collect() == []
    assert ranked.search(docs, items.withColumnRenamed("rank", "item_id").limit(0), "key", "body").collect() == []


def test_search_without_any_weight(spark):
    """A term of all documents of a large table weighs nothing; what scores 0 is no result."""
    scorer = ranked.Scorer([(1, Counter([b"a"]))], {b"a": 0}, 10, 10)
    scorer.window(np.array([1]), np.array([1]), {b"a": (np.array([0]), np.array([1]))})
    assert scorer.heaps == {}


# --- language identification

DE = "der hund und die katze gehen nicht durch das haus weil es regnet über österreich"
EN = "the dog and the cat do not go through the house because of the rain over england"


def brute_phrases(text, pieces):
    whole, at, n = bytes([155]).join(pieces), 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in whole:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


def models(pieces):
    made = {lang: [language.symbols(t) for t in texts] for lang, texts in pieces.items()}
    return made, language.Models([(lang, sum(map(len, p)), *(x.tobytes() for x in language.packed(language.automaton(p)))) for lang, p in sorted(made.items())])


def test_phrases_against_brute_force(monkeypatch):
    rng = random.Random(2)
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    for stretch, many in ((1024, 2_000_000), (1024, 1)):
        monkeypatch.setattr(language, "STRETCH", stretch)
        monkeypatch.setattr(language, "LETTERS", many)
        pieces, m = models({"x": [text("ab c", 90), text("abé", 40)], "y": [text("aßbc", 70)], "z": ["q"]})
        texts = [language.symbols(text("abcé ß1日q", rng.randint(0, 200))) for _ in range(150)]
        assert m.phrases(texts).tolist() == [[brute_phrases(t, pieces[k]) for k in "xyz"] for t in texts]


def test_stretches_end_phrases():
    pieces, m = models({"x": [EN], "y": [DE]})
    t = language.symbols((EN + " " + DE) * 40)
    assert len(t) > 5 * language.STRETCH
    cuts = [t[a : a + language.STRETCH] for a in range(0, len(t), language.STRETCH)]
    assert m.phrases([t, b"\0", t]).tolist()[::2] == [[sum(brute_phrases(c, pieces[k]) for c in cuts) for k in "xy"]] * 2


def test_languages_and_awkward_texts(spark):
    rows = [(EN, "en"), (DE, "de"), (DE, "de"), ("nothing", None), (None, "en"), ("123", "fr")]
    trained = language.train(language.sample(spark.createDataFrame(rows, "text string, lang string")))
    assert trained.langs == ["de", "en"]
    docs = spark.createDataFrame([(t, "k") for t in ["The house of the cat", "DER HUND UND DIE", None, "", "12 !?", "日本語", "a" * 100_000]], "text string, language string")
    got = [r.language_ for r in language.identify(docs, trained).collect()]
    assert [r.lang for r in got[:5]] == ["en", "de", "und", "und", "und"] and [r.score for r in got[2:5]] == [0.0] * 3
    assert all(r.lang in ("de", "en") and 0 <= r.score <= 1 for r in got[5:])
    assert language.identify(docs, trained).columns == ["text", "language", "language_"]
    assert language.identify(docs.limit(0), trained).collect() == []
    nobody = language.train(language.sample(spark.createDataFrame([("a", None)], "text string, lang string")))
    assert {r.language_.lang for r in language.identify(docs, nobody).collect()} == {"und"}
    alone = language.train(language.sample(spark.createDataFrame([(EN, "en")], "text string, lang string")))
    assert language.judged(alone, ["the cat"])[:2] == [["en"], [1.0]]


def test_sample_is_bounded_and_blind_to_copies(spark):
    rows = spark.range(3000).select(F.concat(F.lit("text "), F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).cast("string"), F.lit(" " + EN)).alias("text"), F.lit("en").alias("lang"))
    got = language.sample(rows, rows=50, piece=40).collect()
    assert len(got) == 50 and max(len(r.text) for r in got) == 40


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries.op12_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
