"""The pipeline against its stages done by hand on small tables, and on awkward ones."""

import random
import re

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from marlstone.llm import packing, pii, queries
from tests.llm.test_operators import classes_by_hand, hits_by_hand, ledger_by_hand, prose, spans_by_hand

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def written(spark, tmp_path, rows, items):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def by_hand(texts, items):
    """Kept (id, text) pairs after the first four stages."""
    kept = []
    for i, t in enumerate(texts):
        n, chars, symbols, dup, repeat = ledger_by_hand(t)
        lines = len([x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
        if n >= 10 and 100 * repeat <= 20 * n and 10 * symbols <= 3 * n and 10 * dup <= 6 * lines and 2 * n <= chars <= 15 * n and 2 * (t or "").count("!!") <= n:
            kept.append((i, t))
    first = classes_by_hand([t for _, t in kept])
    kept = [x for k, x in enumerate(kept) if first[k] == k]
    clean = []
    for i, t in kept:
        n, hit, _ = hits_by_hand(t, items)
        if not (hit and 20 * hit >= n):
            clean.append((i, without_long_hits(t, items)))
    return [(i, pii.sanitised(t, base, terms)) for (i, t), (base, terms) in zip(clean, spans_by_hand([t for _, t in clean]))]


def without_long_hits(text, items):
    """The text without runs of more than 26 words inside occurrences of windows."""
    found = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)]
    word = lambda k: text[slice(*found[k])].lower()
    hit = set()
    for _, item in items:
        it = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").lower())
        n = min(13, len(it))
        for k in range(len(it) - n + 1 if n else 0):
            for i in range(len(found) - n + 1):
                if [word(i + j) for j in range(n)] == it[k : k + n]:
                    hit.update(range(i, i + n))
    for i in sorted(hit, reverse=True):  # runs from the last to the first
        if i + 1 not in hit:
            first = i
            while first - 1 in hit:
                first -= 1
            if i + 1 - first > 26:
                text = text[: found[first][0]] + text[found[i][1] :]
    return text


def test_pipeline_matches_its_stages(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    r = random.Random(20)
    items = [(1, prose(r, 20, 10**6)), (2, prose(r, 5, 10**6)), (3, None), (4, prose(r, 30, 10**6))]
    texts = [prose(r, r.randrange(1, 80), 10**6) for _ in range(30)] + [None, "", "few words"]
    texts += [f"{prose(r, 30, 10**6)} {items[0][1]} {prose(r, 30, 10**6)}", f"{prose(r, 400, 10**6)} {items[1][1]}", "mail Zorblax at a@b.co now " + prose(r, 20, 10**6), "or call Zorblax, a@b.co " + prose(r, 20, 10**6), f"{prose(r, 400, 10**6)} {items[3][1]}, {prose(r, 400, 10**6)}", "w| " * 30 + prose(r, 10), "same " * 40]
    texts += [t + " tail" for t in texts[10:16] if t] + texts[20:24]
    d = written(spark, tmp_path, [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], items)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.columns == SCHEMA.fieldNames()
    want = by_hand(texts, items)
    got = sorted((x.doc_id, x.text) for x in docs.collect())
    assert got == want and any("Zo…" in t for _, t in got) and not any(items[3][1] in t for _, t in got) and all(x.n_chars == len(x.text) for x in docs.collect())
    tok = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, d).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == {i: len(tok(t)) // 4 + 1 for i, t in want}


def test_pipeline_on_empty_and_extra_columns(spark, tmp_path):
    d = written(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, d).count() == 0
    docs = spark.createDataFrame([(1, "x " * 5 + " ".join(f"w{i}" for i in range(40)), "en", "s", 3, 1, 2, 3, 4)], "doc_id long, text string, lang string, source string, n_chars long, ledger int, near int, hits int, pii int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.columns[-4:] == ["ledger", "near", "hits", "pii"] and docs.first().pii == 4


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_empty_tables(spark, tmp_path, name):
    for t, s in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string"), ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], s).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (1 if "chat" in name else 0)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    rel, df = con.sql(queries.SQL[name]), queries.QUERIES[name](spark, data)
    order = sorted(df.columns)
    assert sorted(rel.columns) == order
    at = [rel.columns.index(c) for c in order]
    assert sorted(repr(tuple(x[i] for i in at)) for x in rel.fetchall()) == sorted(repr(tuple(x)) for x in df.select(*order).collect())
