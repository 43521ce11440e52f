import datetime as dt

from pyspark.sql import functions as F

from marlstone.operators import posts


def test_paragraphs(spark):
    df = spark.createDataFrame([("", 1735689600000, [("P", "intro", None), ("H2", "The title", None), ("P", "sub", "https://x.substack.com/p/the-slug?a=1")]), ("T", 1735689600000, [("P", " ", None)])], f"title string, published_millis long, paragraphs {posts.PARAGRAPH}")
    a, b = posts.from_paragraphs(df).collect()
    assert (a.title, a.subtitle, a.mirror_substack_slug, a.post_date) == ("The title", "intro", "the-slug", "2025-01-01T00:00:00.000Z")
    assert (b.title, b.subtitle, b.mirror_substack_slug) == ("T", None, None)


def test_canonical_and_normalised(spark):
    schema = "source_id string, slug string, title string, subtitle string, post_date string, url string, audience string, wordcount int, body_text string, content_status string, body_revision_status string"
    df = spark.createDataFrame([("1", "s", "t", None, "2026-01-01", "u", None, 7, "b", None, None), ("2", "s", "t", None, "2026-01-01", "u", "odd", 7, "b", "current", "prior")], schema)
    a, b = posts.normalised(posts.canonical(df, "medium")).orderBy("source_id").collect()
    assert (a.content_status, a.wordcount, a.subtitle, a.audience) == ("current", 7, "", "everyone") and (b.content_status, b.wordcount, b.audience) == ("excerpt", 0, "only_paid")


def test_bodies_are_preserved(spark):
    new = spark.createDataFrame([("a", "", "t1"), ("b", "", "t2"), ("c", "new", "t1"), ("d", "", None), ("e", "", "t1")], "slug string, body_text string, source_updated_at string")
    old = spark.createDataFrame([("a", "old", "t1"), ("b", "old", "t1"), ("c", "old", "t1"), ("d", "old", "t1")], "slug string, body_text string, source_updated_at string")
    got = {r.slug: (r.body_text, r.body_revision_status) for r in posts.preserved(new, old).collect()}
    assert got == {"a": ("old", "current"), "b": ("old", "prior"), "c": ("new", "current"), "d": ("old", "unverified"), "e": ("", "missing")}


def test_gates(spark):
    ids = lambda n: spark.range(n).withColumnRenamed("id", "k")
    assert posts.refresh_registry(ids(85), ids(100))[1] == "live" and posts.refresh_registry(ids(84), ids(100))[1] == "cached"
    assert not posts.lost_too_many(ids(40), ids(35), "k") and posts.lost_too_many(ids(40), ids(34), "k") and not posts.lost_too_many(ids(100), ids(90), "k")
    assert spark.range(1).select(posts.complete(F.lit(97), F.lit(100)).alias("x"), posts.complete(F.lit(96), F.lit(100)).alias("y")).first() == (True, False)


def test_small_projections(spark):
    s = spark.createDataFrame([("a", "fresh", None), ("b", "cached-fallback", None)], "source string, status string, mode string")
    assert [(r.status, r.mode) for r in posts.status_rows(s).orderBy("source").collect()] == [("ok", "live"), ("degraded", "cache")]
    lines = spark.createDataFrame([(1, 0, "H"), (1, 1, "prose"), (1, 2, "H"), (1, 3, "H"), (1, 4, "prose")], "doc int, pos int, text string")
    assert [r.pos for r in posts.attached(lines, F.col("text") == "H", F.col("text") == "prose").orderBy("pos").collect()] == [0, 3]
    t = spark.createDataFrame([("2026-01-01",), ("2025-01-01",), ("2026-02-01",)], "d string")
    assert [tuple(r) for r in posts.periods(t, "d").collect()] == [("2026", 2), ("2025", 1)]
    at = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "at timestamp")
    assert posts.rebased(at, "at", 60).first().at == dt.datetime(2026, 1, 1, 0, 1)
    dates = spark.createDataFrame([("a", "2026-01-01"), ("a", "2026-01-01T05:00:00+00:00"), ("b", "2025-01-01")], "source string, post_date string")
    assert {r.source: r.newest for r in posts.newest(dates).collect()}["a"] == "2026-01-01T05:00:00+00:00"
    title = spark.createDataFrame([("A long title…", "A long title of things"), ("Other", "Else")], "title string, old_title string")
    assert posts.surface(title).count() == 1
