import datetime as dt
import json

import pytest

from marlstone.schemas import REGISTRY
from marlstone.sources import files
from marlstone.sources.paged import LandedPages
from marlstone.streaming import streaks


def test_strict_json(spark, tmp_path):
    for name, text in (("good", '[{"source_id":"1","title":"t","url":"u","post_date":"2026-01-01"}]'), ("twice", '[{"a":{"b":1,"b":2}}]'), ("nan", '[{"a":NaN}]'), ("extra", '[{"source_id":"1","other":2}]')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.json").write_text(text)
    bad = {r.path.split("/")[-2] for r in files.rejected(spark, f"{tmp_path}/*").collect()}
    assert bad == {"twice", "nan"}
    assert files.registry(spark, f"{tmp_path}/good").first().source_id == "1"
    assert [r.key for r in files.unknown_keys(spark, f"{tmp_path}/extra", REGISTRY).collect()] == ["other"]


def test_overrides_and_curve(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"schema_version": 1, "overrides": [{"medium_id": "m", "substack_slug": "s", "medium_title_key": "k", "substack_title": "t"}]}))
    assert files.overrides(spark, f"{tmp_path}/o.json").first().substack_slug == "s"
    (tmp_path / "c.json").write_text(json.dumps({"observations": {"2026-01-02": {"m3": 4, "y2": 4.0, "y5": 4.2, "y10": 4.3, "y30": 4.8}}}))
    old = files.curve(spark, f"{tmp_path}/c.json")
    entry = "<m:properties><d:NEW_DATE>{}T00:00:00</d:NEW_DATE><d:BC_3MONTH>4.0</d:BC_3MONTH><d:BC_2YEAR>4.1</d:BC_2YEAR><d:BC_5YEAR>4.2</d:BC_5YEAR>{}<d:BC_30YEAR>4.8</d:BC_30YEAR></m:properties>"
    (tmp_path / "c.xml").write_text("<feed>" + entry.format("2026-01-02", "<d:BC_10YEAR>9</d:BC_10YEAR>") + entry.format("2026-01-05", "<d:BC_10YEAR>4.5</d:BC_10YEAR>") + entry.format("2026-01-06", "") + "</feed>")
    got = [(r.day, r.y10) for r in files.merge_curve(old, files.curve_xml(spark, f"{tmp_path}/c.xml")).collect()]
    assert got == [("2026-01-02", 9.0), ("2026-01-05", 4.5)]


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><guid>1</guid><title><![CDATA[A & B]]></title><link>u</link><pubDate>Sat, 22 Aug 2026 10:00:00 GMT</pubDate></item></channel></rss>")
    r = files.feed(spark, f"{tmp_path}/f.xml").first()
    assert r.title == "A & B" and r.published == dt.datetime(2026, 8, 22, 10)
    (tmp_path / "g.xml").write_text("<!DOCTYPE x><rss></rss>")
    with pytest.raises(Exception, match="document type"):
        files.feed(spark, f"{tmp_path}/g.xml").collect()


def test_stable_passes(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "pos int, id string")
    assert files.stable(a, a).count() == 0 and files.stable(a, spark.createDataFrame([(0, "y"), (1, "x")], "pos int, id string")).count() == 4


def test_landed_pages(spark, tmp_path):
    spark.dataSource.register(LandedPages)
    (tmp_path / "page-0.json").write_text(json.dumps({"items": [{"id": 1}, {"id": 2}], "next": "p1.json"}))
    (tmp_path / "p1.json").write_text(json.dumps({"items": [{"id": 3}], "next": None}))
    assert [r.id for r in spark.read.format("landed_pages").load(str(tmp_path)).orderBy("pos").collect()] == ["1", "2", "3"]
    (tmp_path / "p1.json").write_text(json.dumps({"items": [], "next": "page-0.json"}))
    with pytest.raises(Exception, match="page chain broken"):
        spark.read.format("landed_pages").load(str(tmp_path)).collect()


def test_streaks_stream(spark, tmp_path):
    rows = [("a", dt.datetime(2026, 1, 1, h), s) for h, s in enumerate(["ok", "bad", "bad", "ok", "bad"])]
    schema = "source string, checked_at timestamp, status string"
    src = tmp_path / "in"
    for i, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
        q = streaks.streaks(spark.readStream.schema(schema).parquet(str(src))).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None, i
    got = [r.n for r in spark.read.parquet(str(tmp_path / "out")).orderBy("checked_at").collect()]
    assert got == [0, 1, 2, 0, 1]


def test_merged_window_is_idempotent(spark, tmp_path):
    put = streaks.merged_window(str(tmp_path / "t"), ["id"])
    put(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), 0)
    for _ in range(2):
        put(spark.createDataFrame([(2, "c")], "id int, v string"), 1)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t/v=1")).collect())) == [(1, "a"), (2, "c")]


def test_feeds_are_read_as_xml(spark, tmp_path):
    quoted = "<![CDATA[<p>a &amp; b</p> ends </item> not here]]>"
    (tmp_path / "f.xml").write_text(f'<rss xmlns:x="u"><channel><title>The feed</title><item a="1"><guid isPermaLink="false">g&amp;1</guid><title>A &lt;b&gt; &#233; <![CDATA[&amp; c]]></title><link>https://h/p?a=1&amp;b=2</link><pubDate>Wed, 01 Jan 2025 10:00:00 GMT</pubDate><description>{quoted}</description><x:other>no</x:other></item><item><title/></item></channel></rss>')
    a, b = files.feed(spark, str(tmp_path / "f.xml")).orderBy("pos").collect()
    assert (a.guid, a.title, a.link, str(a.published), a.description) == ("g&1", "A <b> é &amp; c", "https://h/p?a=1&b=2", "2025-01-01 10:00:00", "<p>a &amp; b</p> ends </item> not here")
    assert (b.pos, b.guid, b.title, b.published) == (1, "", "", None)
    (tmp_path / "c.xml").write_text('<feed><entry><m:properties xmlns:m="m"><d:NEW_DATE m:type="t">2025-01-02T00:00:00</d:NEW_DATE>' + "".join(f'<d:BC_{t} m:type="n"> {v} </d:BC_{t}>' for t, v in (("3MONTH", 1), ("2YEAR", 2), ("5YEAR", 3), ("10YEAR", "4.5"), ("30YEAR", 5))) + '</m:properties></entry></feed>')
    assert [tuple(r) for r in files.curve_xml(spark, str(tmp_path / "c.xml")).collect()] == [("2025-01-02", 1.0, 2.0, 3.0, 4.5, 5.0)]
    for bad in ("<!DOCTYPE x [<!ENTITY e 'boo'>]><rss><item><title>&e;</title></item></rss>", "<rss><item><title>open</item></rss>"):
        (tmp_path / "bad.xml").write_text(bad)
        with pytest.raises(Exception):
            files.feed(spark, str(tmp_path / "bad.xml")).collect()
