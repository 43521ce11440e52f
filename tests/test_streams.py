"""Streams: findings that time raises, a keyed store that is run again, a cache that asks nothing twice."""

import os

import pytest
from pyspark.sql import functions as F

from marlstone.streaming import keyed, silence

CHECKS = "source string, checked_at timestamp, status string"


def test_silence_raises_a_finding_without_a_further_check(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    batches = [
        [("a", "2025-01-01 00:00:00", "degraded"), ("b", "2025-01-01 01:00:00", "degraded"), ("c", "2025-01-01 02:00:00", "ok"), ("d", "2025-01-01 03:00:00", "degraded")],
        [("b", "2025-01-02 00:00:00", "ok"), ("d", "2025-01-02 05:00:00", "degraded")],
        [("c", "2025-01-03 01:00:00", "ok")],  # a has been silent for 49 hours
        [("b", "2025-01-03 02:00:00", "degraded"), ("c", "2025-01-03 06:00:00", "ok")],
        [("c", "2025-01-09 00:00:00", "ok")],
        [("a", "2025-01-09 01:00:00", "degraded"), ("c", "2025-01-10 00:00:00", "ok")],  # reported already
    ]
    src, out = tmp_path / "src", tmp_path / "out"
    seen = []
    try:
        for n, rows in enumerate(batches):
            spark.createDataFrame([(s, t, x) for s, t, x in rows], "source string, t string, status string").select("source", F.col("t").cast("timestamp").alias("checked_at"), "status").coalesce(1).write.mode("append").parquet(str(src))
            stream = silence.findings(spark.readStream.schema(CHECKS).parquet(str(src)))
            stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
            seen.append(sorted((r.source, str(r.since), r.n, str(r.raised_at)) for r in spark.read.schema(silence.FINDING).parquet(str(out)).collect()))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    a, b, d = ("a", "2025-01-01 00:00:00", 1, "2025-01-03 00:00:00"), ("b", "2025-01-03 02:00:00", 1, "2025-01-05 02:00:00"), ("d", "2025-01-01 03:00:00", 2, "2025-01-03 03:00:00")
    assert seen[1] == [] and a in seen[2] and len(seen[2]) == 1  # by the watermark alone, the run's last batch without data
    assert seen[3] == [a, d] and seen[4] == [a, b, d] and seen[5] == [a, b, d]


def store_of(spark, path, every=3):
    return keyed.KeyedStore(spark, str(path), "k int, v string", ["k"], every)


def test_keyed_store_merges_compacts_and_is_idempotent(spark, tmp_path):
    store = store_of(spark, tmp_path / "s")
    rows = lambda s: sorted(map(tuple, s.read().collect()))
    assert rows(store) == [] and store.next_number() == 0
    want = {}
    for n in range(8):
        batch = {k: f"{n}:{k}" for k in range(n % 3, 6, 2)}
        want |= batch
        df = spark.createDataFrame(list(batch.items()), "k int, v string")
        store.put(df, n)
        store.put(df, n)  # foreachBatch runs a batch again after a failure
        assert rows(store) == sorted(want.items())
    assert len(os.listdir(tmp_path / "s")) < 8
    # a compaction that dies before it deletes, and one that dies before it is complete
    store.put(spark.createDataFrame([(1, "x")], "k int, v string"), 8)
    spark.createDataFrame([(99, "wreck")], "k int, v string").write.parquet(str(tmp_path / "s" / "base-50"))
    os.remove(tmp_path / "s" / "base-50" / "_SUCCESS")
    want[1] = "x"
    assert rows(store) == sorted(want.items()) and store.next_number() == 9
    store.put(spark.createDataFrame([(2, "old")], "k int, v string"), 3)  # long compacted
    assert rows(store) == sorted(want.items())


def test_labels_are_asked_once_abstentions_kept_outages_asked_again(spark, tmp_path):
    store = keyed.label_store(spark, str(tmp_path / "labels"), 2)
    passages = spark.createDataFrame([(f"d{k % 6}", f"text {k % 6}") for k in range(12)], "digest string, text string")
    asked = []

    def ask(lost):
        def run(wanted):
            asked.append(sorted(r.digest for r in wanted.collect()))
            return wanted.where(~F.col("digest").isin(*lost)).withColumn("label", F.when(F.col("digest") != "d5", F.concat(F.lit("L"), "digest")))

        return run

    got = lambda df: sorted({(r.digest, r.label) for r in df.collect()})
    first = got(keyed.labelled(passages, store, ask(["d1", "d2"]), "2025-01-01"))
    assert first == [("d0", "Ld0"), ("d1", None), ("d2", None), ("d3", "Ld3"), ("d4", "Ld4"), ("d5", None)]
    second = keyed.labelled(passages, store, ask([]), "2025-01-02")
    assert got(second)[1:3] == [("d1", "Ld1"), ("d2", "Ld2")] and second.count() == 12
    keyed.labelled(passages, store, ask([]), "2025-01-03")
    assert asked == [["d0", "d1", "d2", "d3", "d4", "d5"], ["d1", "d2"], []]
    assert {r.digest: r.asked_at for r in store.read().collect()}["d1"] == "2025-01-02"
