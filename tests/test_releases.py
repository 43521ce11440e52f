"""Stored search, digest trees, versions and JSON releases: against plain versions, a second writer, restores and aborted writes."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marlstone.operators import rows, search, search_index, versions
from marlstone.sources import json_lines

FIELDS = {"exact": ["tag"], "subject": ["title"], "mention": ["title", "body"]}


def notes(spark):
    said = ["VIX calls and the basis", "the basis trade", "Rates & vol, at 5.5%", "", None, "basics of vix", "AT&T stock", "unrelated thing"]
    made = [(k * 40_000, said[k % 8], said[(k * 3 + 1) % 8], said[(k * 5 + 2) % 8]) for k in range(24)]
    return spark.createDataFrame(made, "id long, tag string, title string, body string")


@pytest.mark.parametrize("query", ["vix", "basis", "the bas", "at 5.5%", "at&t", "vi", "the vix basis", "nothing at", "", "thing VIX"])
def test_stored_search_has_the_hits_of_the_scan(spark, tmp_path_factory, query):
    path = str(tmp_path_factory.getbasetemp() / "index")
    if not os.path.exists(path):
        search_index.build(notes(spark), "id", FIELDS, path)
    want = sorted((r.id, r.tier_no, r.tier, r.part) for r in search.tiered(notes(spark), query, FIELDS).collect())
    assert sorted(map(tuple, search_index.find(spark, path, query).collect())) == want


def test_stored_search_reads_the_asked_words_alone(spark, tmp_path):
    search_index.build(notes(spark), "id", FIELDS, str(tmp_path))
    plan = search_index.lists_of(spark, str(tmp_path), "vix")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(word,vix)" in plan and "Join" not in plan
    long = search_index.lists_of(spark, str(tmp_path), "basis")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in long and "StringContains(word,basis)" in long


def test_digest_trees(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    a = rows.tree(df, ["id", "v"], "id", 64)
    assert rows.root(a).collect() == rows.root(rows.tree(df.orderBy(F.desc("v")).repartition(5), ["id", "v"], "id", 64)).collect()
    edited = df.withColumn("v", F.when(F.col("id") == 77, "x").otherwise(F.col("v")))
    leaf = [r.leaf for r in rows.changed(a, rows.tree(edited, ["id", "v"], "id", 64)).collect()]
    assert len(leaf) == 1 and rows.root(a).first().digest != rows.root(rows.tree(edited, ["id", "v"], "id", 64)).first().digest
    assert [r.leaf for r in rows.changed(a, rows.tree(df.where("id <> 77"), ["id", "v"], "id", 64)).collect()] == leaf
    assert rows.root(rows.tree(df.limit(0), ["id", "v"], "id")).first().n == 0 and rows.changed(a, a).count() == 0


def folders(root):
    return sorted(os.listdir(os.path.join(root, "data")))


def test_versions_promote_restore_and_clear(spark, tmp_path):
    releases = versions.Releases(spark, str(tmp_path / "r"))
    make = lambda n: {"a": spark.range(n), "b": spark.range(3).withColumn("x", F.lit(n))}
    assert releases.current() is None
    v1 = releases.publish(make(1))
    v2 = releases.publish(make(2))
    assert (v1.number, v2.number, releases.current()) == (1, 2, v2) and releases.table("a").count() == 2
    # the same output again, in other partitions: nothing is promoted and nothing stays
    assert releases.publish({n: df.repartition(3) for n, df in make(2).items()}) == v2 and len(folders(tmp_path / "r")) == 2
    # a writer that began before v2 was there loses cleanly
    with pytest.raises(versions.Conflict):
        releases.publish(make(5), after=v1)
    assert releases.current() == v2 and len(folders(tmp_path / "r")) == 2 and not [f for f in os.listdir(tmp_path / "r" / "log") if f.startswith(".") and not f.endswith(".crc")]
    # broken contracts go to quarantine
    with pytest.raises(ValueError, match="quarantine"):
        releases.publish(make(6), spark.createDataFrame([("rule", "key")], "rule string, key string"))
    assert releases.current() == v2 and len(os.listdir(tmp_path / "r" / "quarantine")) == 1
    v3 = releases.restore()
    assert (v3.number, v3.folder, v3.action) == (3, v1.folder, "restore 1") and releases.table("a").count() == 1 and releases.table("b").first().x == 1
    v4 = releases.publish(make(4))
    assert releases.clear(keep=2) == [v2.folder] and len(folders(tmp_path / "r")) == 2
    with pytest.raises(ValueError, match="cleared"):
        releases.restore(2)
    assert releases.restore(3).folder == v1.folder and [v.number for v in releases.log()] == [1, 2, 3, 4, 5] and v4.number == 4
    with pytest.raises(ValueError, match="no such"):
        releases.restore(99)


def test_json_is_canonical_and_whole_or_nothing(spark, tmp_path):
    df = spark.range(500).select((500 - F.col("id")).alias("z"), F.when(F.col("id") % 9 > 0, F.concat(F.lit("é\n\""), "id")).alias("a"), F.array(F.struct(F.lit(1).alias("q"), F.lit(None).cast("string").alias("p"))).alias("l"))
    path = str(tmp_path / "out")
    json_lines.write(df.repartition(7), path, ["z"])
    back = json_lines.read(spark, path, df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    lines = [line for n in names for line in open(os.path.join(path, n), encoding="utf-8")]
    assert lines[0].startswith('{"a":"é\\n\\"499","l":[{"q":1,"p":null}],"z":1}') and len(lines) == 500
    json_lines.write(df, str(tmp_path / "again"), ["z"])
    assert lines == [line for n in sorted(os.listdir(tmp_path / "again")) if n.startswith("part-") for line in open(tmp_path / "again" / n, encoding="utf-8")]
    before = sorted(os.listdir(tmp_path))
    with pytest.raises(PySparkException):
        json_lines.write(df, path, ["z"])  # it is there already
    for most in (10, 9000):  # a part, or all parts together, of more bytes than are allowed
        with pytest.raises(PySparkException):
            json_lines.write(df, str(tmp_path / "big"), ["z"], most)
    bad = df.withColumn("z", F.when(F.col("z") == 250, F.raise_error(F.lit("lost"))).otherwise(F.col("z")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        json_lines.write(bad, str(tmp_path / "big"), ["a"])
    assert sorted(os.listdir(tmp_path)) == before
    json_lines.write(df.limit(0), str(tmp_path / "none"), ["z"])
    assert [n for n in os.listdir(tmp_path / "none") if n.startswith("part-")] == []
