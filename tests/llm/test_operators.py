"""Each operator against a plain restatement, and on awkward input."""

import gzip
import hashlib
import math
import os
import random
import re
import struct
from collections import Counter
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm import chat, decontaminate, html_main, near_dedup, packing, pii, quality, repeats, toxicity, warc
from marlstone.llm.common import Scratch

from .foreign_pages import PAGES

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("hits", T.StringType()), T.StructField("__row", T.IntegerType())])


def docs_of(spark, texts, ids=None):
    """A table with columns whose names clash with those the operators use."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "mine", 7) for i, t in zip(ids, texts)], DOCS)


def prose(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


AWKWARD = [None, "", " \n\t ", "one", "a b c d e f g h i j k", "x " * 30_000, "word" * 30_000, "é ü 漢字     z", "same same", "same same"]


def awkward(spark):
    return docs_of(spark, AWKWARD, [0, 1, 2, 3, None, 5, 6, 7, 8, 8])


def empty(spark):
    return spark.createDataFrame([], DOCS)


# quality rules


def ledger_by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_matches_a_restatement(spark):
    r = random.Random(1)
    texts = [prose(r, r.randrange(60), r.choice([2, 5, 50])).replace(" w1", "\nw1").replace("w3", "w#3|") for _ in range(60)]
    got = quality.ledger(docs_of(spark, texts + AWKWARD, [*range(60), *range(60, 70)])).collect()
    assert len(got) == 70
    for row in got:
        text = (texts + AWKWARD)[row.doc_id]
        m = row.ledger
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == ledger_by_hand(text)
        assert bool(m.fail_bits & 1) == (m.n_words < 10)


def test_quality_ablations_and_empty(spark):
    bits = spark.createDataFrame([(0,), (1,), (3,), (4,), (64,)], "fail_bits long")
    got = {r.rule: (r.n_failed, r.n_only) for r in quality.ablations(bits).collect()}
    assert got["few_words"] == (2, 1) and got["repeated_words"] == (1, 0) and got["symbols"] == (1, 1)
    assert quality.ledger(empty(spark)).count() == 0
    assert all(r.n_failed == 0 for r in quality.ablations(bits.where("false")).collect())
    assert "ledger_" in quality.ledger(docs_of(spark, ["a"]).withColumn("ledger", F.lit(1))).columns


# decontamination


def hits_by_hand(text, items, width=13):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, names = norm(text), set(), set()
    for name, item in items:
        it = norm(item)
        n = min(width, len(it))
        for k in range(len(it) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == it[k : k + n]:
                    hit.update(range(i, i + n))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_words", [1_000_000, 15])
def test_decontamination_matches_brute_force(spark, block_words):
    r = random.Random(2)
    items = [(1, prose(r, 30, 6)), (2, prose(r, 14, 6)), (3, "short Item here"), (10, prose(r, 13, 6)), (4, None), (5, "?!"), (6, "w1 w2")]
    texts = [prose(r, 40, 6) for _ in range(20)] + [f"{prose(r, 20)} {items[k][1].upper()}, {prose(r, 5)}" for k in (0, 1, 2, 3)] + ["w1 w2"] + AWKWARD
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(docs_of(spark, texts), bench, block_words=block_words, out="found").collect()
    for row in got:
        n, hit, names = hits_by_hand(texts[row.doc_id], items)
        h = row.found
        assert (h.n_words, sum(s.end - s.start for s in h.spans), h["items"]) == (n, hit, names)
    assert decontaminate.find(empty(spark), bench).count() == 0
    assert all(not r.found.spans for r in decontaminate.find(docs_of(spark, texts), bench.where("false"), out="found").collect())


def test_decontamination_removes_spans(spark):
    item = " ".join(f"i{k}" for k in range(15))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [f"Before, {item}! after", "clean text", None, "pad " * 400 + item]
    found = decontaminate.find(docs_of(spark, texts), bench)
    out = [r.clean_text for r in decontaminate.remove_spans(found, hits="hits_").orderBy("doc_id").collect()]
    assert out == ["Before, ! after", "clean text", None, texts[3]]
    assert item not in decontaminate.remove_spans(found, hits="hits_", longest=14).orderBy("doc_id").collect()[3].clean_text


# packing


@pytest.fixture(scope="session")
def tokens_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def test_word_tokenizer_agrees_with_the_library(tokens_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens_path)
    r = random.Random(3)
    pieces = ["Hello,", "it's", "don't", "ABC.", "x1y2", "é", "ÉCOLE", "ΣΑΣ", "á", "<|endoftext|>", "a<|startoftext|>b", " ", "漢字", "...", "'s", "İx", "é̂", "wo‍rd", "ß."]
    pieces += ["".join(map(chr, range(33, 127))), "".join(map(chr, range(0xC0, 0x100))), "ÀÉß×÷ÿÞ", "œŒŸ", "a_b-c", "12x***", "@#$%^&", "\"q\"", "<", "|", "é1.", "x<|y"]
    texts = ["".join(r.choice([*pieces, " ", "\n", "\t", "  "]) for _ in range(30)) for _ in range(600)]
    texts += ["".join(chr(r.choice([r.randrange(33, 127), r.randrange(0xA0, 0x180)])) for _ in range(40)) for _ in range(300)] + [x or "" for x in AWKWARD]
    tok = packing.tokenizer(tokens_path)
    for text in texts:
        ids = t.encode(text, add_special_tokens=False).ids
        assert tok(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_packing_is_whole_and_tight(spark, tokens_path):
    r = random.Random(4)
    texts = [prose(r, int(1.02 ** r.randrange(400))) for _ in range(200)] + AWKWARD
    rows = packing.pack(docs_of(spark, texts).coalesce(1), tokens_path).collect()
    by, seq = {}, {}
    for p in rows:
        assert p.length == len(p.token_bytes) // 4 <= packing.LENGTH
        by.setdefault(p.doc_id, []).append(p)
        seq.setdefault(p.sequence_id, []).append(p)
    tok = packing.tokenizer(tokens_path)
    assert set(by) == set(range(len(texts)))
    for d, ps in by.items():
        ps.sort(key=lambda p: p.start)
        assert [p.start for p in ps] == [sum(q.length for q in ps[:i]) for i in range(len(ps))]
        assert b"".join(bytes(p.token_bytes) for p in ps) == tok(texts[d]) + struct.pack("<I", 1)
        assert all(p.doc_tokens == sum(q.length for q in ps) for p in ps)
    for ps in seq.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:i]) for i in range(len(ps))]
        assert sum(p.length for p in ps) <= packing.LENGTH
    assert sum(p.length for p in rows) > 0.97 * packing.LENGTH * (len(seq) - 1)
    assert packing.pack(empty(spark), tokens_path).count() == 0
    odd = packing.pack(awkward(spark).select(F.col("doc_id").alias("start"), "text", F.lit(1).alias("offset")), tokens_path, id_col="start")
    assert odd.columns[:2] == ["start_", "start"] and {r.start_ for r in odd.collect()} == {0, 1, 2, 3, None, 5, 6, 7, 8}


def test_best_fit_takes_the_tightest_window():
    def plain(lengths, size):
        room, out = [], []
        for x in lengths:
            fit = min((c for c in room if c >= x), default=None)
            if fit is None:
                room.append(size)
                fit = size
            k = room.index(fit)
            out.append(size - fit)
            room[k] -= x
        return sorted(room), out

    r = random.Random(5)
    for _ in range(30):
        lengths = sorted((r.randint(1, 64) for _ in range(80)), reverse=True)
        got = packing.best_fit_decreasing(lengths, 64)
        room, offsets = plain(lengths, 64)
        used = {}
        for (s, at), x in zip(got, lengths):
            assert used.get(s, 0) == at
            used[s] = at + x
        assert sorted(64 - u for u in used.values()) == room and [at for _, at in got] == offsets


# personal data


def base_by_hand(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                s = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
                if not 13 <= len(digits) <= 19 or s % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_patterns_match_plain_regexes():
    r = random.Random(6)
    bits = ["a@b.co", "x.y+z@d-e.org.uk", "@", "a@b", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-2233", "+1", "12", ".", "-", "%", "é", " ", "a", "@c.d@e.f", "00000255.1.1.1", "+44.20.7946.0958"]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 9)))
        assert pii.base_spans(text) == base_by_hand(text), text


def test_patterns_are_quick_on_long_runs():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "+1" + "(" * 200_000, "1." * 100_000, "a@" * 100_000):
        pii.base_spans(text)


def spans_by_hand(texts):
    """All spans of each text: base ones, then terms by their disclosure, counted over sets of document numbers."""
    value = lambda t, s: (s[0], t[s[1] : s[2]].lower() if s[0] in ("email", "ip") else re.sub("[^0-9]", "", t[s[1] : s[2]]))
    words = lambda t: [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", t)]
    base = [base_by_hand(t or "") for t in texts]
    with_e, with_t, outside = {}, {}, []
    for d, t in enumerate(texts):
        for s in base[d]:
            with_e.setdefault(value(t, s), set()).add(d)
        for _, _, w in words(t or ""):
            with_t.setdefault(w, set()).add(d)
        outside.append([(a, b, w) for a, b, w in words(t or "") if not any(x < b and a < y for _, x, y in base[d])])
    beside = {}
    for d, own in enumerate(outside):
        for w in {w for _, _, w in own}:
            beside.setdefault(w, set()).add(d)
    out = []
    for d, t in enumerate(texts):
        mine = {value(t, s) for s in base[d]}
        share = lambda w: max(1 + math.log(len(beside[w] & with_e[e]) / (len(with_t[w]) + 1)) / max(math.log(len(texts) / len(with_e[e])), 1e-9) for e in mine)
        out.append((base[d], [(a, b, share(w)) for a, b, w in outside[d] if share(w) >= 0.85] if mine else []))
    return out


def test_sanitising_matches_brute_force(spark):
    r = random.Random(21)
    values = ["a@b.co", "x.y@d.org", "10.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-2233"]
    texts = []
    for k in range(150):
        t = prose(r, r.randint(0, 40), 300)
        t = re.sub("[0-9]", lambda m: "abcdefghij"[int(m[0])], t)
        if k % 3 == 0:
            t += f" help@desk.com {t[:20]}"  # one entity in a third of all documents
        if k % 7 == 0:
            t = f"{t} zorblax\n{r.choice(values)} q{k}w"
        texts += [t] * r.choice([1, 1, 1, 4])
    texts += [None, "", "a lone b@c.de", *AWKWARD]
    got = pii.sanitise(docs_of(spark, texts), out="hits").orderBy("doc_id").collect()
    want = spans_by_hand(texts)
    assert any(terms for _, terms in want)
    for row, (base, terms) in zip(got, want, strict=True):
        assert [(s.kind, s.start, s.end) for s in row.hits_.base] == base and [(s.start, s.end) for s in row.hits_.terms] == [x[:2] for x in terms]
    assert [r.hits_.text for r in got if r.doc_id == texts.index("a lone b@c.de")] == ["a lo… [EMAIL]"]
    assert pii.sanitise(empty(spark)).count() == 0


def test_disclosure_is_pmi_over_information(spark):
    texts = [f"common zeta a@b.co {k}" for k in range(4)] + ["common"] * 60 + ["zeta"] * 4
    got = pii.sanitise(docs_of(spark, texts), generalise=0.7, remove=0.99, out="found").where("doc_id < 4").collect()
    # zeta: 1 + log(4/9) / log(68/4) = 0.714; common: 1 + log(4/65) / log(17) = 0.016
    assert all([texts[0][s.start : s.end] for s in r.found.terms] == ["zeta"] and r.found.text == f"common ze… [EMAIL] {r.doc_id}" for r in got)
    copies = pii.sanitise(docs_of(spark, ["rare words a@b.co"] * 99 + ["else"] * 500), out="found").where("doc_id < 99").collect()
    # 1 + log(99/100) / log(599/99) = 0.994: taken out
    assert len(copies) == 99 and {r.found.text for r in copies} == {"[…] […] [EMAIL]"}


def test_disclosure_crosses_lines(spark):
    block = ["{} story\nJane Zorblax\nj@x.org\n+1 212 555 0100\nthe end", "{} story Jane Zorblax j@x.org +1 212 555 0100 the end"]
    for form in block:
        texts = [form.format(w) for w in ("red", "blue", "green")] + [f"the story of the end, told by Jane {k}" for k in range(100)]
        got = pii.sanitise(docs_of(spark, texts), out="found").where("doc_id < 3").collect()
        assert len(got) == 3 and all({texts[r.doc_id][s.start : s.end] for s in r.found.terms} == {"Zorblax"} for r in got), form

def test_copies_do_not_unflag(spark):
    texts = ["ask Zorblax at z@x.org now", "or tell Zorblax by z@x.org soon"]
    for n in (1, 300):
        more = texts * n + [f"other words {k}" for k in range(400)]
        got = pii.sanitise(docs_of(spark, more), out="found").where(f"doc_id < {2 * n}").collect()
        assert len(got) == 2 * n and all("zorblax" not in r.found.text.lower() for r in got), n


# toxicity


def test_toxicity_orders_and_holds_out(spark):
    r = random.Random(7)
    clean = [prose(r, r.randint(5, 80), 3000) for _ in range(400)]
    toxic = [prose(r, r.randint(5, 60), 3000) + " scumbag" * k + " loweifer" for k in [1, 2, 4, 8] * 20]
    texts = clean + toxic
    labels = spark.createDataFrame([(i, 1, int(i >= 400)) for i in range(480) if i % 3] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs_of(spark, texts), labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = {x.doc_id: x.toxicity for x in toxicity.score(docs_of(spark, texts), model).collect()}
    held = [i for i in range(480) if i % 3 == 0]
    assert sum(rows[i].toxic == (i >= 400) for i in held) >= 0.98 * len(held)
    assert rows[479].severity > rows[476].severity > rows[0].severity
    odd = toxicity.score(awkward(spark), model).collect()
    assert len(odd) == 10 and not any(x.toxicity.toxic for x in odd) and odd[0].toxicity.severity == 0
    assert toxicity.score(empty(spark), model).count() == 0
    none = toxicity.train(empty(spark), labels)
    assert not any(x.toxicity.toxic for x in toxicity.score(docs_of(spark, texts[:5]), none).collect())


def test_severity_of_graded_labels_is_held_out(spark):
    """Grades come from words of different weight that one text may mix; expected severity must follow them on texts that weren't seen."""
    import numpy as np

    r = random.Random(17)
    words = {1: ["grubble"], 2: ["vexor"], 3: ["obliterax"]}
    texts, grades = [], []
    for _ in range(1500):
        g = r.choice([0, 0, 1, 2, 3])
        telling = [r.choice(words[g])] * r.randint(1, 3) + [r.choice(words[1])] * (g > 1) if g else []
        w = prose(r, r.randint(10, 60), 3000).split() + telling
        r.shuffle(w)
        texts.append(" ".join(w))
        grades.append(g)
    labels = spark.createDataFrame([(i, 1, g) for i, g in enumerate(grades) if i % 3], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs_of(spark, texts), labels)
    rows = {x.doc_id: x.toxicity for x in toxicity.score(docs_of(spark, texts), model).collect()}
    held = [i for i in range(1500) if i % 3 == 0]
    assert sum(rows[i].grade == grades[i] for i in held) >= 0.9 * len(held)
    assert np.corrcoef([rows[i].severity for i in held], [grades[i] for i in held])[0, 1] > 0.9
    means = [np.mean([rows[i].severity for i in held if grades[i] == g]) for g in range(4)]
    assert means == sorted(means)
    assert not toxicity.train(docs_of(spark, texts), labels, sample_bytes=10).index  # nothing fits, nothing is learnt


# near duplicates


def probability_jaccard(x, y):
    """By its definition, over dictionaries of weights."""
    both = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in both) for d in x.keys() & y.keys())


def weighed(text, weigh="log"):
    w = (text or "").encode().split()
    n = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    return {k: 1 + math.log(v) if weigh == "log" else 1 for k, v in n.items()}


def classes_by_hand(texts, weigh="log"):
    sets = [weighed(t, weigh) for t in texts]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i].keys() & sets[j].keys() and probability_jaccard(sets[i], sets[j]) >= 0.8 - 1e-9:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def test_near_duplicates_match_brute_force(spark):
    r = random.Random(8)
    texts = []
    for k in range(12):
        base = prose(r, r.randint(30, 200), 5000).split()
        if k % 3 == 0:
            base += base[: len(base) // 2] * 3  # passages that repeat weigh more
        for _ in range(r.randint(1, 8)):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = f"n{r.randrange(10**6)}"
            texts.append(" ".join(w))
    texts += ["tiny text", "tiny text", "tiny  text", None, "", "x " * 3000]
    for weigh in ("log", "binary"):
        got = near_dedup.classes(docs_of(spark, texts), weigh=weigh).orderBy("doc_id").collect()
        assert [x.near.class_id for x in got] == classes_by_hand(texts, weigh)
        assert all(x.near.first == (x.doc_id == x.near.class_id) for x in got)
    assert near_dedup.classes(empty(spark)).count() == 0
    odd = near_dedup.classes(awkward(spark)).collect()
    assert len(odd) == 10 and sum(x.near.first for x in odd) == 7  # the blanks are copies, and so are the two last


def test_near_duplicates_leave_no_spent_state(spark):
    from marlstone.llm.common import shared_dir

    root = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(root))
    near_dedup.classes(docs_of(spark, ["a b c d e f g"] * 3 + [prose(random.Random(1), 40, 50)])).count()
    assert sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before) == ["near-docs", "said"]


def test_probminhash_estimates_probability_jaccard():
    import numpy as np

    r = np.random.default_rng(9)
    a = np.unique(r.integers(1, 2**63, 300).astype(np.uint64))
    b = np.sort(np.concatenate([a[:250], r.integers(1, 2**63, 60).astype(np.uint64)]))
    na, nb = r.integers(1, 9, len(a)), r.integers(1, 9, len(b))
    log = near_dedup.WEIGHTS["log"]
    wa, wb = dict(zip(a, log(na))), dict(zip(b, log(nb)))
    exact = sum(1 / sum(max(wa.get(e, 0) / wa[d], wb.get(e, 0) / wb[d]) for e in wa | wb) for d in wa if d in wb)
    m = 4096
    same = (near_dedup.signature(a, log(na), m) == near_dedup.signature(b, log(nb), m)).mean()
    assert abs(same - exact) < 5 * (exact * (1 - exact) / m) ** 0.5
    plain = 250 / (len(a) + len(b) - 250)
    assert abs(near_dedup.similarity((a, na), (b, nb)) - plain) < 1e-9 and abs(near_dedup.similarity((a, na), (b, nb), "log") - exact) < 1e-9
    one = near_dedup.signature(a[:1], np.ones(1), 64)
    assert (one == a[0]).all()


@pytest.mark.parametrize("weigh", ["log", "binary"])
def test_prefix_join_leaves_no_link_out(spark, weigh):
    r = random.Random(13)
    common = prose(r, 60, 10**6)
    texts = [f"{common} {prose(r, r.choice([3, 8, 12, 16, 30, 60]), 10**6)}" for _ in range(60)]
    texts = [t + f" {common}" * (k % 4) for k, t in enumerate(texts)]
    texts += [" ".join(w if r.random() > 0.02 else "new" for w in texts[k].split()) for k in range(30)]
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "node long, label long, text string")
    got = {(r.a, r.b) for r in near_dedup.prefix_pairs(df, Scratch(spark), weigh).collect()}
    sets = [weighed(t, weigh) for t in texts]
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if probability_jaccard(sets[i], sets[j]) >= 0.8}
    assert linked and linked <= got and len(got) < 3 * len(linked) + 200


def test_components_of_a_chain(spark):
    labels = spark.range(40).select(F.col("id").alias("node"), F.col("id").alias("label"))
    order = list(range(20))
    random.Random(10).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(19)], "a long, b long")
    got = {r.node: r.label for r in near_dedup.contract(labels, links, Scratch(spark)).collect()}
    assert all(got[i] == 0 for i in range(20)) and all(got[i] == i for i in range(20, 40))


# repeated passages


def kept_by_hand(texts, width):
    words = [(t or "").encode().split() for t in texts]
    at = {}
    for d, w in enumerate(words):
        for i in range(len(w) - width + 1):
            at.setdefault(tuple(w[i : i + width]), []).append((d, i))
    gone = {(d, i + k) for where in at.values() if len(where) > 1 for d, i in where for k in range(width)}
    return [b" ".join(x for i, x in enumerate(w) if (d, i) not in gone).decode() for d, w in enumerate(words)]


@pytest.mark.parametrize("bucket_bytes", [4 << 20, 3000])
def test_repeats_match_brute_force(spark, bucket_bytes):
    r = random.Random(11)
    shared = [prose(r, n, 10**6) for n in (34, 35, 36, 60, 200)]
    texts = [" ".join([prose(r, r.randrange(30), 10**6), r.choice(shared), prose(r, r.randrange(30), 10**6), r.choice(shared)]) for _ in range(40)]
    texts += [prose(r, 90, 2), prose(r, 200, 1), prose(r, 50, 10**6), *AWKWARD]
    got = repeats.remove(docs_of(spark, texts), bucket_bytes=bucket_bytes).orderBy("doc_id").collect()
    assert [x.repeats.kept for x in got] == kept_by_hand(texts, 35)
    assert repeats.remove(empty(spark)).count() == 0


def test_repeats_of_equal_rows_and_null_ids(spark):
    r = random.Random(14)
    texts = [prose(r, 50, 10**6)] * 30 + [prose(r, 50, 10**6), None]
    docs = spark.createDataFrame([(None if i % 2 else 7, t, i, "x") for i, t in enumerate(texts)], "doc_id long, text string, shard int, repeats string")
    got = repeats.remove(docs, bucket_bytes=500).orderBy("shard").collect()
    assert [x.repeats_.kept for x in got] == kept_by_hand(texts, 35) and [x.shard for x in got] == list(range(32))
    assert {x.repeats_.n_words for x in got} == {50, 0}


def test_words_are_hashed_alike_in_any_piece(monkeypatch):
    r = random.Random(16)
    text = "".join(r.choice(["ab", "a", "é", " ", "\n", "\t ", "x" * 40, "y" * 700]) for _ in range(3000)).encode()
    starts, ends = repeats.word_spans(text)
    words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    assert words == text.split() and len(repeats.word_spans(b"")[0]) == len(repeats.word_spans(b" \n")[0]) == 0
    for base in (0, 1):
        whole = repeats.word_hashes(text, starts, ends, base).tolist()
        assert len(set(zip(words, whole))) == len(set(words)) == len(set(whole))
        monkeypatch.setattr(repeats, "PIECE", 64)
        assert repeats.word_hashes(text, starts, ends, base).tolist()[:1] == whole[:1]
        got = repeats.word_hashes(text, starts, ends, base).tolist()
        assert all(g == w for g, w, x in zip(got, whole, words) if len(x) <= 64 or len(x) > repeats.LONG_WORD)
        monkeypatch.undo()


def test_confirmation_by_pairs_of_hashes():
    import numpy as np

    r = np.random.default_rng(15)
    u = lambda a: np.array(a, dtype=np.uint64)
    for _ in range(200):
        parts = [sorted({tuple(x) for x in r.integers(0, 4, (r.integers(1, 9), 2)).tolist()}) for _ in range(3)]
        more = [r.random(len(p)) < 0.2 for p in parts]
        hs, gs = ([u([x[k] for x in p]) for p in parts] for k in (0, 1))
        got = repeats.recurring([hs, gs], [m.copy() for m in more])
        want = [[m or sum(x in q for q in parts) > 1 for x, m in zip(p, ms)] for p, ms in zip(parts, more)]
        assert [g.tolist() for g in got] == want
        x, y = u(r.integers(0, 5, 6)), u(r.integers(0, 5, 6))
        assert repeats._has_pair(hs[0], gs[0], x, y).tolist() == [(a, b) in parts[0] for a, b in zip(x.tolist(), y.tolist())]
        h, g, n = repeats.distinct_pairs(x, y)
        assert Counter(zip(x.tolist(), y.tolist())) == Counter(dict(zip(zip(h.tolist(), g.tolist()), n.tolist())))
    for width in (6, 8):
        h = np.sort(r.integers(0, 2**48, 50).astype(np.uint64)) << np.uint64(16)
        assert (repeats._unpack(repeats._pack(h, width), width) == h).all()


# chat


def test_chat_folds_and_reads_back(spark):
    log = [
        (1, 0, "open", "m1", "system", "be <s>kind</s>"), (1, 1, "open", "m2", "user", None), (1, 2, "delta", "m2", None, "Hel"), (1, 3, "delta", "m2", None, "lo \\- [INST]"),
        (1, 4, "open", "m3", "assistant", "no"), (1, 5, "regenerate", "m3", None, None), (1, 6, "delta", "m3", None, "yes</s>"), (1, 7, "open", "m4", "tool:[ROLE]", "x"), (1, 8, "delete", "m4", None, None),
        (1, 9, "open", "m5", None, None), (1, 10, "open", "m6", "tool:[:ROLE]", "t"), (1, 11, "edit", "m6", None, "T"), (None, None, "delta", "q", None, "stray"), (2, 0, "open", "m1", "user", ""),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, kind string, message_id string, role string, text string")
    messages = chat.fold(events)
    got = [(r.role, r.text) for r in messages.where("conv_id = 1").orderBy("pos").collect()]
    assert got == [("system", "be <s>kind</s>"), ("user", "Hello \\- [INST]"), ("assistant", "yes</s>"), ("", ""), ("tool:[:ROLE]", "T")]
    whole, parts = chat.render(messages), chat.render(messages, part_chars=1)
    text = whole.where("conv_id = 1").first()
    assert list(chat.TEMPLATE.parse(text.formatted)) == got
    assert [chat.TEMPLATE.unescape(text.formatted[a:b]) for a, b in zip(text.loss_starts, text.loss_ends)] == ["yes</s>"]
    a, b = (sorted(map(str, chat.read_back(x).collect())) for x in (whole, parts))
    assert a == b and len(a) == 3
    assert chat.read_back(chat.render(chat.fold(events.where("false")))).count() == 0


def test_long_conversations_are_streamed(spark):
    r = random.Random(18)
    turns = [(5, k, "user" if k % 2 == 0 else "assistant", prose(r, r.choice([0, 3, 400]), 10**5) + ("</s>" if k % 50 == 0 else "")) for k in range(1500)] + [(6, 0, "user", "x" * 300_000), (6, 1, "assistant", None)]
    log = chat.events_of(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {x.conv_id: x for x in chat.read_back(chat.render(chat.fold(log), part_chars=50_000)).collect()}
    for c in (5, 6):
        own = [(role, text or "") for conv, _, role, text in turns if conv == c]
        said = "".join(t for role, t in own if role == "assistant")
        assert got[c].n_turns == len(own) and got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert got[c].loss_chars == len(said) and got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_chat_escape_is_reversible():
    r = random.Random(12)
    bits = [*chat.TEMPLATE.controls, "\\", "-", "<", "/", "s>", "[", "INST]", "a", "\\-"]
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "x" + "".join(r.choice(bits) for _ in range(3)), ""]), "".join(r.choice(bits) for _ in range(r.randrange(8)))) for _ in range(3)]
        assert list(chat.TEMPLATE.parse("".join(chat.TEMPLATE.render(*t)[0] for t in turns))) == turns
        assert not any(c in chat.TEMPLATE.escape(turns[0][1]) for c in chat.TEMPLATE.controls)


def test_chat_keeps_repeated_turns(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.render(chat.fold(chat.events_of(turns)))).collect()
    assert len(row) == 1 and row[0].n_turns == 3


# pages


def test_pages_on_held_out_templates():
    r = random.Random(99)
    wrong = 0
    for _ in range(150):
        page = html_main.training_page(r)
        nodes = html_main.order(html_main.parse(page))
        want = " ".join(b.replace("\x01", "") for b in html_main.blocks_of(nodes, set(range(len(nodes)))) if "\x01" in b)
        wrong += html_main.extract([page.replace("\x01", "")], html_main.trees())[0] != want
    assert wrong <= 7


@pytest.mark.parametrize("name", PAGES)
def test_pages_of_foreign_layouts(name):
    page, want = PAGES[name]
    assert html_main.extract([page], html_main.trees()) == [want]


def test_pages_awkward(spark):
    pages = [
        None, "", "   ", "<", "<p", "no markup &amp; &#233;t&eacute;", "<article><p>One  <b>two</b>three<br>four &lt;x&gt;<p>five<div class='ad'>buy now</div></article><footer>f</footer>",
        "<nav><a href=x>m</a></nav><article>" + "<p>para text here.</p>" * 4000 + "</article>", "<div>" * 5000 + "deep text here" + "</div>" * 5000, "<script>never closed", "<!-- never closed",
    ]
    df = spark.createDataFrame([(i, "u", p, 1) for i, p in enumerate(pages)], "page_id long, url string, html string, main int")
    got = {x.page_id: x.main_.text for x in html_main.main_text(df).collect()}
    assert got[0] == got[1] == got[2] == got[9] == got[10] == ""
    assert got[6] == "One twothree four <x> five"
    assert got[7] == " ".join(["para text here."] * 4000)
    assert got[5] == "no markup & été" and got[8] == "deep text here" and got[3] in ("", "<") and got[4] == ""
    assert html_main.main_text(df.where("false")).count() == 0


def test_decoding_drops_what_lies_under_dropped():
    import numpy as np

    nodes = html_main.order(html_main.parse("<div>aaaa<section>bbbb</section></div><p>cccc</p>"))
    html_main.measure(nodes)
    assert len(html_main.decode(nodes, np.array([0.0, -5.0, 1.0, 1.0]))) == 2  # the root and p
    assert len(html_main.decode(nodes, np.array([0.0, -1.0, 5.0, -1.0]))) == 3  # a good child saves its parent


# archives


def test_text_outside_elements_is_kept():
    for page, want in {
        "no markup &amp; &#233;t&eacute;": "no markup & \u00e9t\u00e9", "<html><head><title>T</title></head>One sentence here.<br>And <b>another</b> one.": "One sentence here. And another one.",
        "<body><p>A para of text here.</p></body>tail text": "A para of text here. tail text", "<p>First paragraph here.</p>bare text between<p>second</p>": "First paragraph here. bare text between second", "<a href=x>only a link</a>": "",
    }.items():
        assert html_main.extract([page], html_main.trees()) == [want], page


def test_same_tag_share_at_every_size():
    at = html_main.FEATURES.index("same_tag_siblings")
    for n in (5, 60):
        nodes = html_main.order(html_main.parse("<main>" + "<p>text</p>" * n + "<div>buy</div></main>"))
        shares = {x.tag: row[at] for x, row in zip(nodes, html_main.measure(nodes))}
        assert shares["div"] == 1 / (n + 1) and shares["p"] == n / (n + 1)


def test_warc_round_trip(spark, tmp_path):
    body = "<html lang=fr><head><title>T &amp; U</title></head><body><p>un</p><p>deux <a href='/x'>trois</a></p><script>no</script></body></html>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(body.encode())
    data = b"".join(warc.serialise("response", f"<urn:uuid:{k}>", http, {"WARC-Target-URI": f"http://h/{k}", "WARC-Date": "2024-01-01T00:00:00Z"}) for k in range(3)) + warc.serialise("request", "<urn:uuid:9>", b"GET", {})
    (tmp_path / "a.warc.gz").write_bytes(data)
    responses = warc.read_responses(spark, str(tmp_path))
    got = warc.derive(responses, "record_id", "payload", "target_uri", "record_id", "warc_date", "headers").orderBy("key", "warc_type").collect()
    assert len(got) == 6 and {r.refers_to for r in got} == {f"<urn:uuid:{k}>" for k in range(3)}
    text, meta = got[0], got[1]
    assert bytes(text.block).decode() == "un\ndeux trois" and text.target_uri == "http://h/0" and text.warc_date == "2024-01-01T00:00:00Z"
    assert b"http-header-content-type: text/html; charset=utf-8\r\n" in bytes(meta.block) and b"title: T & U\r\n" in bytes(meta.block) and b"outlink: /x a/@href\r\n" in bytes(meta.block)
    again = [x for r in warc.members(warc.derive(responses, "record_id", "payload", "target_uri", "record_id")).collect() for x in warc.parse(bytes(r.member))]
    assert len(again) == 6 and all(warc.digest(block) == head["warc-block-digest"] and int(head["content-length"]) == len(block) for head, block in again)
    assert len({head["warc-record-id"] for head, _ in again}) == 6


class Seen(HTMLParser):
    """Visible lines and links of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.links, self.hidden = [], [], None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title", "noscript", "template"):
            self.hidden = self.hidden or tag
        if self.hidden in (None, tag):
            to = dict(reversed(attrs)).get(warc.LINKS.get(tag))
            self.links += [to.strip()] if to else []
            self.out += ["\n"] if tag in warc.BLOCKS else []

    def handle_endtag(self, tag):
        self.hidden = None if tag == self.hidden else self.hidden
        self.out += ["\n"] if tag in warc.BLOCKS and not self.hidden else []

    def handle_data(self, data):
        self.out += [] if self.hidden else [data.replace("\n", " ")]


def test_texts_and_links_match_another_parser():
    r = random.Random(5)
    pages = [html_main.training_page(r).replace("\x01", "") for _ in range(60)] + [p for p, _ in PAGES.values()]
    pages += ["<p>a<!-- <a href=/no> --><script>'<a href=/no>'</script><a data-src=1 data-href=/no href='/yes&amp;1'>b</a> c &lt;<img src=x data-src=y>", "<div>a<br/>b<A HREF=/u>c</A></div>d"]
    for page in pages:
        seen = Seen()
        seen.feed(page)
        seen.close()
        lines = [" ".join(x.replace("\xa0", " ").split()) for x in "".join(seen.out).split("\n")]
        text, fields = warc.read(page)
        assert text == "\n".join(x for x in lines if x), page
        assert [v.rsplit(" ", 1)[0] for k, v in fields if k == "outlink"] == seen.links, page


def test_pages_become_dated_records(spark):
    df = spark.createDataFrame([(1, "http://h/1", "<p>é", "x"), (2, None, None, "x"), (None, "u", "", "x")], "page_id long, url string, html string, payload string")
    records = warc.responses(df, "page_id", "html", "url", "2024-05-06T07:08:09Z")
    got = warc.derive(records, "key", "payload", "target_uri", "record_id", "warc_date", "headers").collect()
    assert len(got) == 6 and {r.warc_date for r in got} == {"2024-05-06T07:08:09Z"} and len({r.refers_to for r in got}) == 3
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}>", r.refers_to) for r in got)
    meta = next(bytes(r.block) for r in got if r.key == 1 and r.warc_type == "metadata")
    assert b"http-status-line: HTTP/1.1 200 OK\r\nhttp-header-content-type: text/html; charset=utf-8\r\nhttp-header-content-length: 5\r\n" in meta
    for r in warc.members(warc.derive(records, "key", "payload", "target_uri", "record_id", "warc_date", "headers")).collect():
        (head, block), *rest = warc.parse(bytes(r.member))
        assert not rest and head["warc-refers-to-payload-digest"] == r.source_digest and head["warc-date"] == r.warc_date and block == bytes(r.block)


def test_headers_and_damaged_members():
    assert warc.headers_of("HTTP/1.1 200 OK\r\nX-A:  two  spaces \r\n folded\r\n") == [("http-status-line", "HTTP/1.1 200 OK"), ("http-header-x-a", "two  spaces folded")]
    good = warc.serialise("response", "<urn:uuid:1>", b"block", {})
    broken = bytearray(warc.serialise("response", "<urn:uuid:2>", os.urandom(200_000), {}))
    broken[150_000] ^= 255
    ids = [h.get("warc-record-id") for h, _ in warc.parse(good + bytes(broken) + good)]
    assert ids.count("<urn:uuid:1>") == 2
    assert [h["warc-record-id"] for h, _ in warc.parse(good + good[:30])][:1] == ["<urn:uuid:1>"]


def test_warc_awkward(spark):
    rows = [(1, None, None, 0), (1, None, None, 0), (2, "u", "", 0), (3, "u", "<p>never <b", 0), (4, "u", "x" * 200_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, block int")
    got = warc.derive(df, "page_id", "html", "url").collect()
    assert len(got) == 10 and sum(r.content_length == 0 for r in got if r.warc_type == "conversion") == 3
    assert warc.derive(df.where("false"), "page_id", "html").count() == 0
    assert list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab")) == [({"content-length": "5"}, b"ab")]


def test_open_heads_hide_no_text():
    for page, want in {
        "<html><head><title>T</title><body><p>one<p>two": "one\ntwo", "<head><meta charset=utf-8><title>T</title><style>p{}</style><p>one": "one", "<head><title>T</title>one <b>two</b>": "one two",
        "<head><script>'<p>no'</script><link href=x></head><body>one": "one", "<head>stray<title>T</title></head><p>one": "stray\none", "<head><title>T</head><p>one": "one", "<head><style>p{}</head><p>one": "one",
        "<HEAD ><!-- <p>no --><title>T</title></HEAD\n><p>one</p>": "one", "<head><title>T</title><p>one</p></head>two": "one\ntwo", "<head><script>never closed <p>no": "", "<header>one</header>": "one", "<head>": "",
    }.items():
        assert warc.text_of(page) == want, page
    assert warc.text_of("<head>" + "<meta x>" * 100_000 + "<head>" * 2000 + "<p>one") == "one"
