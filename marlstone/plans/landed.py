"""Queries that land files and read them again: sources, and releases published and read back. Each has SQL for the same rows."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import posts, publish, release, rows, search_index, versions
from ..session import landing, table
from ..sources import files, json_lines
from ..streaming import keyed
from .records import POSTS, _posts
from .registry import query


def _file(spark, text, tag):
    """A folder with one text file."""
    path = landing(spark, tag)
    text.coalesce(1).write.text(path)
    return path


def _nations(spark, d):
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(
        k, F.concat(F.lit("id"), k.cast("string")).alias("source_id"), F.col("n_name").alias("title"), F.concat(F.lit("https://h/p/"), k.cast("string"), F.lit("/")).alias("url"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), k), "yyyy-MM-dd").alias("post_date"), F.when(k % 2 == 0, "public").otherwise("member").alias("access"),
    )


_NATIONS = "n AS (SELECT n_nationkey AS k, 'id' || n_nationkey AS source_id, n_name AS title, 'https://h/p/' || n_nationkey || '/' AS url, strftime(DATE '2024-01-01' + n_nationkey, '%Y-%m-%d') AS post_date, CASE WHEN n_nationkey % 2 = 0 THEN 'public' ELSE 'member' END AS access FROM nation)"


@query(f"WITH {_NATIONS} SELECT source_id, title, url, post_date, access FROM n")
def q_landed_registry(spark, d):
    """A registry's JSON array, read under its schema."""
    n = _nations(spark, d)
    text = n.agg(F.to_json(F.collect_list(F.struct("source_id", "title", "url", "post_date", "access"))).alias("value"))
    return files.registry(spark, _file(spark, text, "registry"))


@query(f"WITH {_NATIONS} SELECT source_id AS medium_id, 'slug-' || k AS substack_slug, lower(title) AS medium_title_key, title AS substack_title FROM n")
def q_landed_overrides(spark, d):
    """The list of a versioned file of reviewed pairs."""
    n = _nations(spark, d)
    row = F.struct(F.col("source_id").alias("medium_id"), F.concat(F.lit("slug-"), F.col("n_nationkey").cast("string")).alias("substack_slug"), F.lower("title").alias("medium_title_key"), F.col("title").alias("substack_title"))
    text = n.agg(F.to_json(F.struct(F.lit(1).alias("schema_version"), F.collect_list(row).alias("overrides"))).alias("value"))
    return files.overrides(spark, _file(spark, text, "overrides"))


@query(f"WITH {_NATIONS} SELECT post_date AS day, k / 4.0::DOUBLE AS m3, k / 8.0::DOUBLE AS y2, 1.5::DOUBLE AS y5, 2.5::DOUBLE AS y10, 3.5::DOUBLE AS y30 FROM n WHERE k % 6 <> 5")
def q_landed_curve(spark, d):
    """A yield feed; days that lack a tenor are left out."""
    k = F.col("n_nationkey")
    row = {"3MONTH": k / 4.0, "2YEAR": F.when(k % 6 != 5, k / 8.0), "5YEAR": F.lit(1.5), "10YEAR": F.lit(2.5), "30YEAR": F.lit(3.5)}
    tenors = F.concat(*(F.coalesce(F.concat(F.lit(f"<d:BC_{t}>"), v.cast("string"), F.lit(f"</d:BC_{t}>")), F.lit("")) for t, v in row.items()))
    entry = F.concat(F.lit("<m:properties><d:NEW_DATE>"), "post_date", F.lit("T00:00:00</d:NEW_DATE>"), tenors, F.lit("</m:properties>"))
    text = _nations(spark, d).agg(F.concat(F.lit("<feed>"), F.array_join(F.collect_list(entry), ""), F.lit("</feed>")).alias("value"))
    return files.curve_xml(spark, _file(spark, text, "curve"))


@query(f"WITH {_NATIONS} SELECT source_id, title, url, post_date || 'T10:00:00Z' AS post_date, 'about ' || title AS body_text, 'excerpt' AS content_status, 0 AS wordcount FROM n")
def q_landed_feed(spark, d):
    """Feed items as excerpts."""
    at = F.date_format(F.col("post_date").cast("timestamp") + F.expr("INTERVAL 10 HOURS"), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    item = F.concat(F.lit("<item><guid>"), "source_id", F.lit("</guid><title><![CDATA["), "title", F.lit("]]></title><link>"), "url", F.lit("</link><pubDate>"), at, F.lit("</pubDate><description><![CDATA[<p>about <b>"), "title", F.lit("</b></p>]]></description></item>"))
    text = _nations(spark, d).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("value"))
    return posts.from_feed(files.feed(spark, _file(spark, text, "feed")))


@query(f"WITH {POSTS} SELECT 'articles_index' AS name, count(*) AS n, true AS as_published FROM p UNION ALL SELECT 'latest', 20, true UNION ALL SELECT 'search_index', count(DISTINCT source), true FROM p UNION ALL SELECT 'related', count(*), true FROM p WHERE doc_id % 2 = 0 UNION ALL SELECT 'families', count(DISTINCT content_status), true FROM p UNION ALL SELECT 'manifest', 5, true")
def q_published_endpoints(spark, d):
    """The six endpoints of a release, published twice and read back against their manifest."""
    p = _posts(spark, d).select("doc_id", "source", "source_id", "slug", "title", "post_date", "content_status")
    made = release.endpoints(p, p.groupBy("source").count(), p.where("doc_id % 2 = 0").select("slug"), p.groupBy("content_status").count(), publish.latest(p))
    root = landing(spark, "release")
    publish.publish(spark, {n: df.limit(1) for n, df in made.items()}, root)
    publish.publish(spark, made, root)
    back = {n: publish.current(spark, root, n) for n in made}
    wrong = release.bundle({n: df for n, df in back.items() if n != "manifest"}, back["manifest"]).select(F.col("key").alias("name")).distinct().withColumn("wrong", F.lit(True))
    counts = None
    for n, df in back.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(wrong, "name", "left").select("name", "n", F.col("wrong").isNull().alias("as_published"))


def _digest(rows: str) -> str:
    lanes = " || ':' || ".join(f"coalesce(sum(('0x' || substr(h, {1 + 8 * i}, 8))::UBIGINT::HUGEINT), 0)::VARCHAR" for i in range(4))
    return f"SELECT sha256(count(*) || ':' || {lanes}) AS d FROM (SELECT sha256({rows}) AS h FROM p"


@query(f"""WITH {POSTS},
a AS ({_digest("'{\"slug\":\"' || slug || '\",\"title\":\"' || title || '\",\"post_date\":\"' || post_date || '\",\"content_status\":\"' || content_status || '\"}'")})),
o AS ({_digest("'{\"slug\":\"' || slug || '\",\"title\":\"' || title || '\"}'")} WHERE doc_id % 3 = 0))
SELECT count(*) AS articles, sum(CASE WHEN content_status = 'registry' THEN 1 ELSE 0 END)::BIGINT AS registry, max(post_date) AS latest, (SELECT count(*) FROM p WHERE doc_id % 3 = 0) AS observations, (SELECT sha256(a.d || ':' || o.d) FROM a, o) AS checksum FROM p""")
def q_manifest(spark, d):
    p = _posts(spark, d)
    m = publish.manifest(p.select("slug", "title", "post_date", "content_status"), p.where("doc_id % 3 = 0").select("slug", "title"))
    return m.select("articles", "registry", "latest", "observations", F.col("data_checksum").alias("checksum"))


@query(f"WITH {_NATIONS} SELECT source_id, CASE WHEN k % 3 = 0 THEN title ELSE 'Head ' || title END AS title, 'sub ' || title AS subtitle, 'Head ' || title || chr(10) || chr(10) || 'sub ' || title || chr(10) || chr(10) || 'the end' AS body_text, CASE WHEN k % 2 = 0 THEN 'mirror-' || k END AS mirror_substack_slug, post_date || 'T00:00:00.000Z' AS post_date FROM n")
def q_posts_of_paragraphs(spark, d):
    """Posts given as paragraphs."""
    k = F.col("n_nationkey")
    part = lambda kind, text, href=None: F.struct(F.lit(kind).alias("type"), text.alias("text"), (href if href is not None else F.lit(None).cast("string")).alias("href"))
    n = _nations(spark, d).select(
        "source_id", F.when(k % 3 == 0, F.col("title")).otherwise(" ").alias("title"), (F.unix_timestamp(F.col("post_date").cast("timestamp")) * 1000).alias("published_millis"),
        F.array(part("H1", F.concat(F.lit("Head "), "title")), part("P", F.concat(F.lit("sub "), "title")), part("P", F.lit("the end"), F.when(k % 2 == 0, F.concat(F.lit("https://foo.substack.com/p/mirror-"), k.cast("string"))))).alias("paragraphs"),
    )
    return posts.from_paragraphs(n).select("source_id", "title", "subtitle", "body_text", "mirror_substack_slug", "post_date")


_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"WITH x AS (SELECT doc_id, trim(text, {_B}) AS t FROM documents), y AS (SELECT *, left(t, 800) AS head, regexp_matches(substr(t, 801, 1), '^\\s') OR regexp_matches(substr(t, 800, 1), '^\\s') AS whole, regexp_extract(left(t, 800), '(?s)^(.+)[ \\n\\t]', 1) AS cut FROM x) SELECT doc_id, CASE WHEN length(t) <= 800 THEN t ELSE trim(CASE WHEN whole OR cut = '' THEN head ELSE cut END, {_B}) END AS excerpt FROM y")
def q_excerpts(spark, d):
    return table(spark, d, "documents").select("doc_id", X.excerpt(F.col("text")).alias("excerpt"))


@query(f"SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {_B})), lambda x: length(x) > 50) AS paragraphs FROM documents")
def q_paragraphs(spark, d):
    return table(spark, d, "documents").select("doc_id", X.paragraphs(F.col("text"), "\n").alias("paragraphs"))


@query("SELECT n_regionkey, count(*) FILTER (n_nationkey % 3 = 0) > greatest(5, floor(0.1 * count(*))) AS lost FROM nation WHERE false GROUP BY 1 UNION ALL SELECT 0, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)) > greatest(5, floor(0.1 * (SELECT count(DISTINCT o_custkey) FROM orders)))")
def q_lost_too_many(spark, d):
    """Whether more customers have gone than a refresh may lose."""
    o = table(spark, d, "orders")
    return spark.createDataFrame([(0, posts.lost_too_many(o, o.where("o_orderkey % 2 = 0"), "o_custkey"))], "n_regionkey int, lost boolean")


# Stored search, digest trees, versions, canonical JSON


@query(r"""WITH d AS (SELECT doc_id, lower(coalesce(source, '')) AS e, lower(coalesce(string_split(text, chr(10))[1], '')) AS s, lower(coalesce(text, '')) AS m FROM documents),
h AS (SELECT doc_id, CASE WHEN contains(e, 'licen') AND list_contains(regexp_split_to_array(e, '[^a-z0-9&.%-]+'), 'the') THEN 0 WHEN contains(s, 'licen') AND list_contains(regexp_split_to_array(s, '[^a-z0-9&.%-]+'), 'the') THEN 1
  WHEN contains(m, 'licen') AND list_contains(regexp_split_to_array(m, '[^a-z0-9&.%-]+'), 'the') THEN 3 END AS t FROM d)
SELECT doc_id, t::INTEGER AS tier_no, CASE WHEN t = (SELECT min(t) FROM h) AND t < 3 THEN 'primary' ELSE 'related' END AS part FROM h WHERE t IS NOT NULL""")
def q_indexed_search(spark, d):
    """Whole texts by a stored index: one word and a piece of others, in the first line or anywhere."""
    path = landing(spark, "search")
    docs = table(spark, d, "documents").select("doc_id", "source", F.element_at(F.split("text", "\n"), 1).alias("line"), "text")
    search_index.build(docs, "doc_id", {"exact": ["source"], "subject": ["line"], "mention": ["text"]}, path)
    return search_index.find(spark, path, "The licen").select(F.col("key").alias("doc_id"), "tier_no", "part")


@query("""SELECT o_orderkey, '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":' || CASE WHEN o_orderkey % 9 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' AS line FROM orders""")
def q_json_lines(spark, d):
    """Orders written as canonical JSON, all or none, and read again as the lines they are."""
    k = F.col("o_orderkey")
    path = f"{landing(spark, 'json')}/orders"
    json_lines.write(table(spark, d, "orders").select(k, "o_custkey", F.when(k % 9 != 0, F.col("o_orderpriority")).alias("o_orderpriority")), path, ["o_orderkey"])
    lines = spark.read.text(f"{path}/part-*.json")
    return lines.select(F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"), F.col("value").alias("line"))


@query("SELECT number, action, n FROM (VALUES (1, 'publish', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')), (2, 'publish', (SELECT count(*) FROM orders)), (3, 'restore 1', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')), (4, 'publish', (SELECT count(DISTINCT o_custkey) FROM orders))) t(number, action, n)")
def q_release_log(spark, d):
    """Versions of a release, one of them a restore, with the rows that each gives back; the same output again makes no version."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    releases = versions.Releases(spark, landing(spark, "releases"))
    releases.publish({"orders": o.where("o_orderstatus = 'O'")})
    releases.publish({"orders": o})
    releases.publish({"orders": o.repartition(3)})
    releases.restore()
    releases.publish({"orders": o.dropDuplicates(["o_custkey"])})
    counts = [releases.table("orders", v).agg(F.count("*").alias("n")).select(F.lit(v.number).alias("number"), F.lit(v.action).alias("action"), "n") for v in releases.log()]
    return functools.reduce(lambda a, b: a.unionByName(b), counts)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 = 7")
def q_changed_ranges(spark, d):
    """Of two copies of a table the rows that differ, looked for in the ranges alone whose digests differ."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    other = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 1000 == 7, -1).otherwise(F.col("o_custkey")))
    columns = ["o_custkey", "o_orderkey", "o_orderstatus"]
    ranges = rows.changed(rows.tree(o, columns, "o_orderkey"), rows.tree(other, columns, "o_orderkey"))
    some = lambda df: df.join(ranges, rows.leaf("o_orderkey", 4096) == F.col("leaf"), "left_semi")
    return some(o).exceptAll(some(other)).select("o_orderkey")


@query("""WITH d AS (SELECT DISTINCT sha256(text) AS digest FROM documents WHERE text IS NOT NULL)
SELECT digest, CASE WHEN digest >= '2' THEN 'label ' || left(digest, 1) END AS label, CASE WHEN right(digest, 1) IN ('e', 'f') THEN '2025-01-02' ELSE '2025-01-01' END AS asked_at FROM d""")
def q_label_cache(spark, d):
    """Labels of whole texts by their digest, asked for in two runs: what met an outage in the first is asked again in the second, abstentions are not, and nothing is asked twice."""
    h = F.col("digest")
    docs = table(spark, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("digest"), "text")
    store = keyed.label_store(spark, landing(spark, "labels"), 2)

    def ask(wanted, up=False):
        return wanted.where(F.lit(up) | ~F.substring(h, -1, 1).isin("e", "f")).select("digest", F.when(h >= "2", F.concat(F.lit("label "), F.substring(h, 1, 1))).alias("label"))

    keyed.labelled(docs, store, ask, "2025-01-01")
    keyed.labelled(docs, store, functools.partial(ask, up=True), "2025-01-02")
    keyed.labelled(docs, store, functools.partial(ask, up=True), "2025-01-03")
    return store.read()
