"""Every registered query of the core against its SQL, and some again with other partitions."""

import os

import duckdb
import pytest

from marlstone.plans import central, landed, passages, records, registry  # noqa: F401

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def bag(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in at)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    got = bag(df.collect(), df.columns)
    if name in registry.SQL:
        rel = duck.sql(registry.SQL[name])
        assert sorted(rel.columns) == sorted(df.columns)
        assert got == bag(rel.fetchall(), rel.columns)


@pytest.mark.parametrize("name", ["q_streaks", "q_related_topk", "q_default_topic", "q_tercile_bands", "q_table_digest"])
def test_partitions_do_not_matter(spark, name):
    seen = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = registry.QUERIES[name](spark, DATA)
        seen.append(bag(df.collect(), df.columns))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_entry_points_import_alone():
    import __spark_entry__ as e

    assert set(registry.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_items_of_any_length(spark, tmp_path):
    long = "one two three four five six seven eight nine ten"
    items = [(1, long), (2, "Six seven, EIGHT"), (3, "alone")]
    docs = [(1, f"x {long} y"), (2, "one two three four five six seven eight nine else"), (3, "six seven eights"), (4, "left alone")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for t in ("benchmark", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    whole = [(1, 1), (2, 1), (2, 2), (3, 4)]
    assert sorted(map(tuple, registry.QUERIES["q_item_contain"](spark, str(tmp_path)).collect())) == whole
    assert sorted(con.sql(registry.SQL["q_item_contain"]).fetchall()) == whole


def test_common_features_count(spark, tmp_path):
    """A word in 25 of 100 documents counts; those asked for are the documents 0 and 20."""
    docs = [(i, "shared word" if i < 25 else f"lone{i} other{i}") for i in range(100)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name, n in {"q_df_idf": 3, "q_related_topk": 10, "q_related_reasons": 10}.items():
        df, rel = registry.QUERIES[name](spark, str(tmp_path)), con.sql(registry.SQL[name])
        got = bag(df.collect(), df.columns)
        assert len(got) == n and got == bag(rel.fetchall(), rel.columns), name


def test_related_reads_whole_texts(spark, tmp_path):
    docs = [(i, f"head{i} line{i}\n" + ("quartz lantern story" if i < 2 else f"tail{i} rest{i}")) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.src, r.dst): r.why for r in registry.QUERIES["q_related"](spark, str(tmp_path)).collect()}
    assert set(got) == {(0, 1)} and "quartz-lantern" in got[0, 1]
