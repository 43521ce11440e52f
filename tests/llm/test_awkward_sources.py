"""Sources that broke an operator once: damaged archives, lists of very many addresses, one very long labelled text, items without id, other tokenizer files."""

import random
import struct
import time

import pytest
from pyspark.sql import functions as F

from marlstone.llm import decontaminate, packing, pii, toxicity, warc

from .test_operators import docs_of, hits_by_hand, spans_by_hand


def test_archives_with_any_header_bytes_end():
    good = warc.serialise("response", "<urn:1>", b"HTTP/1.1 200 OK\r\n\r\nbody", {}, compress=False)
    for length in (b"-54", b"12x", b"", b"+3", b"1_0", "١٢".encode(), b"9" * 5000, b" 7 "):
        bad = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: " + length + b"\r\n\r\nignored\r\n\r\n"
        got = list(warc.parse(good + bad + good))
        assert [b for h, b in got if h["warc-record-id" if "warc-record-id" in h else "warc-type"] == "<urn:1>"] == [b"HTTP/1.1 200 OK\r\n\r\nbody"] * 2, length
        assert len(got) == (3 if length == b" 7 " else 2)
    rng = random.Random(1)
    whole = good * 3
    for _ in range(3000):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 8)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        for head, block in warc.parse(bytes(data)):
            if head.get("warc-type") == "response":
                warc.payload_of(block)


def test_entities_and_terms_of_several_texts_match_brute_force(spark):
    rng = random.Random(8)
    people = [f"p{k}@x{k % 4}.org" for k in range(25)]
    names = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40)]
    texts = []
    for k in range(60):
        own = rng.sample(range(25), rng.choice([0, 1, 2, 8]))
        texts += [" ".join([*(people[i] for i in own), *(names[i] for i in own if rng.random() < 0.8), *rng.sample(names, 3)])] * rng.choice([1, 1, 3])
    texts += [" ".join(people)] * 2 + [" ".join(people + names[:20]), "unrelated words"] + [f"filler {k}" for k in range(300)]
    want = spans_by_hand(texts)
    got = pii.sanitise(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert sum(len(t) for _, t in want) > 50
    for row, (_, terms) in zip(got, want, strict=True):
        assert [(s.start, s.end) for s in row.pii.terms] == [x[:2] for x in terms]
    twice = pii.sanitise(docs_of(spark, ["zorblax z@x.org", "zorblax said z@x.org", "alone b@c.org", *["else"] * 90]), meetings=2).collect()
    assert [r.pii.text for r in twice[:3]] == ["[…] [EMAIL]" if "[…]" in twice[0].pii.text else "zo… [EMAIL]", twice[1].pii.text, "alone [EMAIL]"]
    assert "said" in twice[1].pii.text and "zorblax" not in twice[1].pii.text


def test_a_list_of_very_many_addresses_is_quick(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(20_000)]
    member_list = " ".join(f"u{k}@m.org {words[k % len(words)]}" for k in range(100_000))
    begun = time.perf_counter()
    got = pii.sanitise(docs_of(spark, [member_list, "short u5@m.org", *["filler"] * 300])).select("doc_id", F.size("pii.base").alias("n"), F.size("pii.terms").alias("t")).orderBy("doc_id").collect()
    assert [r.n for r in got[:3]] == [100_000, 1, 0] and got[0].t > 0
    assert time.perf_counter() - begun < 60


def test_one_long_labelled_text_costs_no_sample(spark):
    rows = [(k, f"you are a vile fool w{k}" if k % 2 else f"a fine day v{k}", k % 2) for k in range(400)]
    long = [(1000 + k, "pad " * 3000, 0) for k in range(8)]
    found = []
    for given in (rows, rows + long):
        docs = spark.createDataFrame(given, "doc_id long, text string, toxic int")
        found.append(toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"), sample_bytes=10_000))
    assert found[0].index and found[0].index == found[1].index and found[0].thresholds.tolist() == found[1].thresholds.tolist()


@pytest.mark.parametrize("block_words", [1_000_000, 6])
def test_items_without_id_hit_but_are_not_listed(spark, block_words):
    items = [(None, "a b c"), (7, "a b c d"), (None, "x y"), (8, None)]
    texts = ["z a b c d", "w x y", "a b c", "q"]
    got = decontaminate.find(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words).orderBy("doc_id").collect()
    for row, text in zip(got, texts):
        n, hit, names = hits_by_hand(text, items)
        assert (row.hits.n_words, sum(s.end - s.start for s in row.hits.spans), row.hits["items"]) == (n, hit, [x for x in names if x != "None"])


def test_other_tokenizer_files_are_not_taken_word_by_word():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        lib, tok = Tokenizer.from_file(path), packing.tokenizer(path)
        for text in ("Hello  World, it's\n\tHERE é1 ", "", "a" * 3000, "  Two  "):
            ids = lib.encode(text, add_special_tokens=False).ids
            assert tok(text) == struct.pack(f"<{len(ids)}I", *ids)
