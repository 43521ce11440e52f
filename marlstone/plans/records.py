"""Queries over archive records: the driver's documents, orders and events in the shape of posts, articles and observations, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..functions import urls as U
from ..operators import contracts, health, index, link, observations, posts, publish, release, rows, search, threads
from ..session import table
from .registry import PLAIN, _members, _MEMBERS, plain, query

SOURCES = ("substack", "medium", "patreon", "fxempire")

#: Documents as posts; the SQL of each query starts with the same rows.
POSTS = f"""p AS (SELECT doc_id, ['substack', 'medium', 'patreon', 'fxempire'][doc_id % 4 + 1] AS source, 'id' || doc_id AS source_id, 'slug-' || doc_id AS slug, {PLAIN.format('left(text, 60)')} AS title,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang || ' ' || source END AS subtitle, strftime(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER), '%Y-%m-%d') AS post_date, 'https://example.org/p/' || doc_id AS url,
  CASE WHEN doc_id % 5 = 0 THEN 'only_paid' ELSE 'everyone' END AS audience, n_chars // 6 AS wordcount, ['current', 'excerpt', 'registry'][doc_id % 3 + 1] AS content_status, text AS body_text,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE strftime(DATE '2024-01-02' + CAST(doc_id % 700 AS INTEGER), '%Y-%m-%dT00:00:00Z') END AS updated_at FROM documents)"""


def _posts(spark, d):
    i = F.col("doc_id")
    day = lambda first, form: F.date_format(F.date_add(F.lit(first).cast("date"), (i % 700).cast("int")), form)
    return table(spark, d, "documents").select(
        "doc_id", F.element_at(F.array(*map(F.lit, SOURCES)), (i % 4 + 1).cast("int")).alias("source"), F.concat(F.lit("id"), i.cast("string")).alias("source_id"), F.concat(F.lit("slug-"), i.cast("string")).alias("slug"), plain(F.substring("text", 1, 60)).alias("title"),
        F.when(i % 3 == 0, "").otherwise(F.concat_ws(" ", "lang", "source")).alias("subtitle"), day("2024-01-01", "yyyy-MM-dd").alias("post_date"), F.concat(F.lit("https://example.org/p/"), i.cast("string")).alias("url"),
        F.when(i % 5 == 0, "only_paid").otherwise("everyone").alias("audience"), F.expr("n_chars div 6").alias("wordcount"), F.element_at(F.array(*map(F.lit, ("current", "excerpt", "registry"))), (i % 3 + 1).cast("int")).alias("content_status"), F.col("text").alias("body_text"),
        F.when(i % 7 == 0, "").otherwise(day("2024-01-02", "yyyy-MM-dd'T00:00:00Z'")).alias("updated_at"),
    )


# Projections


@query(f"WITH {POSTS} SELECT slug, title, post_date FROM p ORDER BY post_date DESC, source DESC, slug DESC LIMIT 20")
def q_latest_posts(spark, d):
    return publish.latest(_posts(spark, d)).select("slug", "title", "post_date")


@query(f"WITH {POSTS} SELECT source, max(post_date) AS newest FROM p GROUP BY 1")
def q_newest_posts(spark, d):
    return posts.newest(_posts(spark, d))


@query("SELECT 'o' || o_orderkey AS slug, row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey % 4, 'o' || o_orderkey DESC) - 1 AS pos FROM orders")
def q_catalogue_orders(spark, d):
    """Places of all orders in catalogue order: by date, source and slug."""
    k = F.col("o_orderkey")
    a = table(spark, d, "orders").select(F.element_at(F.array(*map(F.lit, SOURCES)), (k % 4 + 1).cast("int")).alias("source"), F.concat(F.lit("o"), k.cast("string")).alias("slug"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("post_date"))
    return index.catalogue(a, link.PRIORITY).select("slug", F.col("pos").cast("long").alias("pos"))


@query(f"WITH {POSTS} SELECT source, source_id, slug, title, audience, content_status, CASE WHEN content_status <> 'registry' THEN updated_at END AS source_updated_at, 0 AS alternates FROM p")
def q_catalogue_metadata(spark, d):
    p = _posts(spark, d).withColumns({"body_revision_status": F.lit("current"), "source_updated_at": F.col("updated_at"), "observed_source_updated_at": F.col("updated_at"), "alternate_urls": F.lit(None).cast("map<string,string>")})
    return publish.metadata(p).select("source", "source_id", "slug", "title", "audience", "content_status", "source_updated_at", F.size("alternate_urls").alias("alternates"))


@query(f"WITH {POSTS} SELECT source_id, 'patreon' AS source, doc_id::VARCHAR AS slug, '' AS subtitle, 'everyone' AS audience, 0 AS wordcount, 'registry' AS content_status, 'public' AS access FROM p WHERE source = 'patreon'")
def q_registry_posts(spark, d):
    p = publish.from_registry(_posts(spark, d).where("source = 'patreon'").withColumn("access", F.lit("public")), "patreon")
    return p.select("source_id", "source", "slug", "subtitle", "audience", "wordcount", "content_status", "access")


@query(f"WITH {POSTS} SELECT 'a_' || left(sha256(url), 14) AS id, title, url, post_date AS published_at, 'day' AS publication_precision, greatest(1, CASE WHEN 2 * (wordcount % 220) > 220 OR (2 * (wordcount % 220) = 220 AND (wordcount // 220) % 2 = 1) THEN wordcount // 220 + 1 ELSE wordcount // 220 END)::BIGINT AS read_minutes, CASE audience WHEN 'everyone' THEN 'public' ELSE 'member' END AS access FROM p")
def q_reader_rows(spark, d):
    return publish.reader_row(_posts(spark, d))


_WIRE = {"subtitle": "", "audience": "everyone", "wordcount": 0}


@query(f"WITH {POSTS} SELECT slug, subtitle, audience, wordcount, doc_id % 2 = 0 AS b_0, doc_id % 3 = 0 AS b_1, doc_id % 11 = 0 AS b_2 FROM p")
def q_wire_round_trip(spark, d):
    """Rows made compact and hydrated again are the rows they were."""
    p = _posts(spark, d)
    i = F.col("doc_id")
    flags = p.select("slug", "subtitle", "audience", "wordcount", *((i % k == 0).alias(f"f{k}") for k in (2, 3, 11)))
    wire = flags.select(F.struct("slug", "subtitle", "audience", "wordcount").alias("r"), "f2", "f3", "f11").select("r.*", "f2", "f3", "f11")
    compacted = publish.compact(wire, _WIRE, {"b": [F.col("f2"), F.col("f3"), F.col("f11")]})
    return publish.hydrate(compacted, "slug string, subtitle string, audience string, wordcount long, b int", _WIRE, {"b": 3})


@query(f"WITH {POSTS} SELECT slug, CASE WHEN doc_id % 7 = 0 THEN 'excerpt' ELSE content_status END AS content_status, CASE WHEN doc_id % 7 = 0 OR content_status = 'excerpt' THEN 0 ELSE wordcount END AS wordcount, CASE WHEN doc_id % 10 = 0 THEN 'only_paid' WHEN doc_id % 5 = 0 THEN 'only_paid' ELSE 'everyone' END AS audience, sha256(coalesce(body_text, '')) AS body FROM p")
def q_canonical_posts(spark, d):
    """Posts with defaults filled in; stale revisions are excerpts, excerpts declare no words, unknown access counts as paid."""
    i = F.col("doc_id")
    raw = _posts(spark, d).withColumns({"body_revision_status": F.when(i % 7 == 0, "prior").when(i % 2 == 0, "current"), "audience": F.when(i % 10 == 0, "founding").otherwise(F.col("audience"))})
    return posts.normalised(posts.canonical(raw, "substack")).select("slug", "content_status", "wordcount", "audience", F.sha2("body_text", 256).alias("body"))


@query(f"WITH {POSTS} SELECT slug, CASE WHEN doc_id % 4 <> 0 AND body_text <> '' THEN 'current' WHEN doc_id % 6 = 0 OR coalesce(body_text, '') = '' THEN 'missing' WHEN doc_id % 8 = 0 THEN 'prior' ELSE 'current' END AS body_revision_status, CASE WHEN (doc_id % 4 <> 0) THEN coalesce(body_text, '') <> '' ELSE doc_id % 6 <> 0 AND coalesce(body_text, '') <> '' END AS has_body FROM p")
def q_preserved_bodies(spark, d):
    """Bodies kept from the snapshot before where the new one has none."""
    i = F.col("doc_id")
    now = _posts(spark, d).withColumns({"body_text": F.when(i % 4 == 0, "").otherwise(F.col("body_text")), "source_updated_at": F.lit("b")})
    old = _posts(spark, d).where("doc_id % 6 <> 0").withColumn("source_updated_at", F.when(i % 8 == 0, "a").otherwise("b"))
    p = posts.preserved(now, old)
    return p.select("slug", "body_revision_status", (F.coalesce("body_text", F.lit("")) != "").alias("has_body"))


@query(f"WITH {POSTS} SELECT slug, CASE WHEN doc_id % 2 = 0 THEN 'current' ELSE 'excerpt' END AS content_status, CASE WHEN doc_id % 2 = 0 THEN 'current' ELSE 'unverified' END AS body_revision_status, CASE WHEN doc_id % 2 = 0 THEN post_date ELSE '' END AS observed_source_updated_at FROM p")
def q_live_or_carried(spark, d):
    return posts.live_or_carried(_posts(spark, d), F.col("doc_id") % 2 == 0).select("slug", "content_status", "body_revision_status", "observed_source_updated_at")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'degraded' ELSE 'failed' END AS status, CASE WHEN event_id % 5 = 0 THEN 'given' WHEN event_id % 3 = 0 THEN 'live' ELSE 'cache' END AS mode FROM events")
def q_status_rows(spark, d):
    k = F.col("event_id")
    e = table(spark, d, "events").select("event_id", F.when(k % 3 == 0, "fresh").when(k % 3 == 1, "cached-fallback").otherwise("failed").alias("status"), F.when(k % 5 == 0, "given").alias("mode"))
    return posts.status_rows(e)


@query(f"WITH {POSTS} SELECT slug FROM p WHERE audience = 'everyone' AND source <> 'fxempire'")
def q_public_bodies(spark, d):
    return posts.public_body(_posts(spark, d)).where("source <> 'fxempire'").select("slug")


@query("SELECT substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS year, count(*) AS n FROM orders GROUP BY 1")
def q_periods(spark, d):
    return posts.periods(table(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")), "day")


@query(f"WITH {POSTS} SELECT source, max(slug) AS slug FROM p GROUP BY 1")
def q_representatives(spark, d):
    return posts.representatives(_posts(spark, d), "slug", "source").select("source", "slug")


@query("SELECT event_id, epoch_us(ts + INTERVAL 86399 SECOND) AS at FROM events")
def q_rebased(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return posts.rebased(e, "ts", 86399).select("event_id", F.unix_micros("ts").alias("at"))


_CUT = "CASE WHEN length(t) <= 1200 THEN t WHEN NOT contains(left(t, 1200), ' ') THEN '' ELSE rtrim(regexp_extract(left(t, 1200), '(?s)^(.*) ', 1), {b}) || '…' END".format(b="' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


# Catalogue of all sources


@query(f"WITH {POSTS}, m AS (SELECT source_id FROM p WHERE source = 'medium' AND doc_id % 8 = 1) SELECT source, slug, CASE WHEN source = 'patreon' THEN NULL ELSE subtitle END AS subtitle FROM p WHERE source = 'substack' OR source = 'patreon' OR (source = 'medium' AND source_id NOT IN (SELECT source_id FROM m))")
def q_concatenated(spark, d):
    """All posts of one source, the unmatched ones of the next, and a registry with fewer columns."""
    p = _posts(spark, d)
    of = lambda s: p.where(F.col("source") == s).select("source", "source_id", "slug", "subtitle")
    matched = p.where("source = 'medium' AND doc_id % 8 = 1").select("source_id")
    return release.concatenated(of("substack"), (of("medium"), matched), (of("patreon").drop("subtitle"), None)).select("source", "slug", "subtitle")


@query(f"WITH {POSTS} SELECT slug, CASE WHEN doc_id % 8 = 0 THEN 'https://new/' || doc_id WHEN doc_id % 12 = 4 THEN 'https://old' END AS medium, CASE WHEN doc_id % 12 = 4 THEN 'https://x' END AS other, CASE WHEN doc_id % 8 = 0 AND doc_id % 12 = 4 THEN 2 WHEN doc_id % 12 = 4 THEN 2 WHEN doc_id % 8 = 0 THEN 1 ELSE 0 END AS n FROM p WHERE source = 'substack'")
def q_alternate_urls(spark, d):
    """URLs of twins merged into those already known; a new one replaces an old one of its source."""
    i = F.col("doc_id")
    p = _posts(spark, d).where("source = 'substack'").withColumn("alternate_urls", F.when(i % 12 == 4, F.create_map(F.lit("medium"), F.lit("https://old"), F.lit("fxempire"), F.lit("https://x"))))
    links = p.where(i % 8 == 0).select(F.concat_ws(":", F.lit("substack"), "slug").alias("target"), F.lit("medium").alias("source"), F.concat(F.lit("https://new/"), i.cast("string")).alias("url"))
    a = F.col("alternate_urls")
    return release.with_alternates(p, links).select("slug", F.try_element_at(a, F.lit("medium")).alias("medium"), F.try_element_at(a, F.lit("fxempire")).alias("other"), F.size(a).alias("n"))


_TWINS = "o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"


@query(f"""WITH {_TWINS}, posts AS (SELECT 'p' || k AS slug, md5(c::VARCHAR) AS title, day FROM o WHERE k % 3 = 0), recs AS (SELECT 'r' || k AS id, md5(c::VARCHAR) AS title, day, k % 4 = 1 AS public, k FROM o WHERE k % 3 = 1),
j AS (SELECT id, slug, count(*) OVER (PARTITION BY id) AS n FROM recs JOIN posts USING (title) WHERE abs(date_diff('day', recs.day::DATE, posts.day::DATE)) <= 7),
f AS (SELECT id, 'substack:' || slug AS target, CASE WHEN k % 10 = 4 THEN 'reviewed-override' ELSE 'title-and-date' END AS reason FROM j JOIN recs USING (id) WHERE n = 1 AND k % 10 <> 4),
rv AS (SELECT id, 'substack:fixed' AS target, 'reviewed-override' AS reason FROM recs WHERE k % 10 = 4 AND k % 20 <> 4),
every AS (SELECT * FROM f UNION ALL SELECT * FROM rv)
SELECT id AS source_id, target, reason, row_number() OVER (PARTITION BY target ORDER BY public DESC, day DESC, id) = 1 AS alternate FROM every JOIN recs USING (id)""")
def q_crosslinked(spark, d):
    """Registry records linked to posts by reviewed decisions (some say they are distinct), then by title and date; of several for one post the public one, then the newest, stands beside it."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.md5(F.col("o_custkey").cast("string")).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("post_date"))
    named = lambda n: F.concat(F.lit(n), F.col("k").cast("string"))
    p = o.where("k % 3 = 0").select(F.lit("substack").alias("source"), named("p").alias("slug"), "title", "post_date")
    recs = o.where("k % 3 = 1").select(named("r").alias("source_id"), "title", "post_date", F.when(F.col("k") % 4 == 1, "public").otherwise("member").alias("access"), F.lit("https://r").alias("url"))
    reviewed = o.where("k % 3 = 1 AND k % 10 = 4").select(named("r").alias("source_id"), F.when(F.col("k") % 20 == 4, "distinct").otherwise("same").alias("decision"), F.lit("substack").alias("target_source"), F.lit("fixed").alias("target_slug"))
    links, _ = link.crosslink(p, recs, "patreon", reviewed)
    return links.select("source_id", "target", "reason", "alternate")


@query(f"WITH {_TWINS}, r AS (SELECT 'm' || k AS l_id, 'the title of ' || md5(c::VARCHAR) || ' a b c' AS t, day FROM o WHERE st = 'O'), s AS (SELECT 's' || k AS r_id, 'the title of ' || md5(c::VARCHAR) || ' a b c and more of it' AS t, day FROM o WHERE st = 'F'), j AS (SELECT l_id, r_id, count(*) OVER (PARTITION BY l_id) AS n FROM r JOIN s ON starts_with(s.t, r.t) AND abs(date_diff('day', r.day::DATE, s.day::DATE)) <= 7) SELECT l_id, r_id FROM j WHERE n = 1")
def q_prefix_titles(spark, d):
    """Truncated titles matched with the one title of the week that goes on from them."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_orderstatus", F.concat(F.lit("the title of "), F.md5(F.col("o_custkey").cast("string")), F.lit(" a b c")).alias("t"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    left = o.where("o_orderstatus = 'O'").select(F.concat(F.lit("m"), "k").alias("l_id"), F.col("t").alias("title_key"), F.col("day").alias("l_date"))
    right = o.where("o_orderstatus = 'F'").select(F.concat(F.lit("s"), "k").alias("r_id"), F.concat("t", F.lit(" and more of it")).alias("title_key"), F.col("day").alias("r_date"))
    return link.prefix_match(left, right)


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 20 = 0)")
def q_anti_customers(spark, d):
    """Customers without an order of a twentieth of them."""
    old = table(spark, d, "customer").select("c_custkey")
    return rows.disappeared(old, table(spark, d, "orders").where("o_orderkey % 20 = 0").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("(SELECT o_custkey, o_orderstatus, 'left' AS side FROM (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1)) UNION ALL (SELECT o_custkey, o_orderstatus, 'right' FROM (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1 EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0))")
def q_same_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return rows.same_rows(o.where("o_orderkey % 2 = 0").drop("o_orderkey"), o.where("o_orderkey % 2 = 1").drop("o_orderkey"))


# Texts


@query(f"SELECT doc_id, len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}][\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}’''-]*'))::BIGINT AS n FROM documents")
def q_words_of_any_script(spark, d):
    return table(spark, d, "documents").select("doc_id", X.word_count(F.col("text")).cast("long").alias("n"))


@query(f"WITH x AS (SELECT doc_id, trim(text, {_SPACES}) AS t FROM documents) SELECT doc_id, {_CUT} AS excerpt FROM x")
def q_previews(spark, d):
    return table(spark, d, "documents").select("doc_id", X.bounded_excerpt(F.col("text")).alias("excerpt"))


@query("SELECT doc_id, len(string_split(regexp_replace(text, '([.!?])[\\x20\\x09-\\x0D]+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1)))::BIGINT AS n FROM documents")
def q_sentences(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.sentences(F.col("text"))).cast("long").alias("n"))


@query("SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || '_ (' || p_brand || ')'), '[^a-z0-9_\\s-]', '', 'g'), '[\\s_-]+', '-', 'g'), '-') AS slug FROM part")
def q_slugs(spark, d):
    return table(spark, d, "part").select("p_partkey", X.slugify(F.concat("p_name", F.lit("_ ("), "p_brand", F.lit(")"))).alias("slug"))


@query("WITH t AS (SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN '…' WHEN 1 THEN '...' WHEN 2 THEN ' .. ' ELSE '.' END AS a, p_name || ' and more' AS b FROM part) SELECT p_partkey, p_partkey % 4 < 3 AS cut, p_partkey % 4 < 2 OR NOT contains(a, '.') AS fits FROM t")
def q_truncated_titles(spark, d):
    k = F.col("p_partkey") % 4
    a = F.concat("p_name", F.when(k == 0, "…").when(k == 1, "...").when(k == 2, " .. ").otherwise("."))
    return table(spark, d, "part").select("p_partkey", X.truncated_title(a).alias("cut"), X.compatible_surface(a, F.concat("p_name", F.lit(" and more"))).alias("fits"))


_ASCII = "regexp_replace(text, '[^\\x09-\\x7e]', ' ', 'g')"


@query(f"WITH t AS (SELECT doc_id, {PLAIN.format(_ASCII)} AS w FROM documents) SELECT doc_id, array_to_string([CASE w WHEN 'one' THEN '1' WHEN 'two' THEN '2' WHEN 'three' THEN '3' WHEN 'four' THEN '4' WHEN 'five' THEN '5' WHEN 'six' THEN '6' WHEN 'seven' THEN '7' WHEN 'eight' THEN '8' WHEN 'nine' THEN '9' WHEN 'ten' THEN '10' ELSE w END FOR w IN string_split(w, ' ')], ' ') AS title_key, w AS taxonomy, lower(trim(regexp_replace({_ASCII}, '[\\s\\x0B]+', ' ', 'g'))) AS identity FROM t JOIN documents USING (doc_id)".replace(f"{PLAIN.format(_ASCII)} AS w FROM documents", f"{PLAIN.format('regexp_replace(' + _ASCII + ', chr(38), chr(32), chr(103))')} AS w FROM documents"))
def q_normal_forms(spark, d):
    """Keys of titles, taxonomy texts and identity texts, of the ASCII part of texts without ampersands."""
    from ..functions.text_udf import normalize_identity, normalize_taxonomy, normalize_title

    t = F.regexp_replace("text", "[^\\x09-\\x7e]", " ")
    bare = F.regexp_replace(t, "&", " ")
    return table(spark, d, "documents").select("doc_id", normalize_title(bare).alias("title_key"), normalize_taxonomy(bare).alias("taxonomy"), normalize_identity(t).alias("identity"))


_DATES = "strftime(o_orderdate, '%Y-%m-%d')"


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate + INTERVAL 20 YEAR + INTERVAL 123 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS millis, epoch(o_orderdate)::BIGINT AS feed, [strftime(o_orderdate, '%Y-%m-%d')] AS prose, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE epoch(date_trunc('day', o_orderdate))::BIGINT END AS sortable, upper(strftime(o_orderdate, '%d %b %Y')) AS displayed FROM orders")
def q_date_forms(spark, d):
    """Dates as milliseconds, in feeds, in prose, for sorting, and as shown."""
    at, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey")
    millis = F.when(k % 5 == 0, F.lit(5)).otherwise(F.unix_millis(at + F.expr("INTERVAL 20 YEARS")) + 123)
    day = F.date_format(at, "yyyy-MM-dd")
    said = F.concat(F.lit("It closed on "), F.date_format(at, "MMMM d, yyyy"), F.lit(", not on February 30, 2024."))
    return table(spark, d, "orders").select(
        "o_orderkey", D.from_epoch_millis(millis).alias("millis"), F.unix_timestamp(D.from_rfc2822(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))).alias("feed"), D.in_prose(said).cast("array<string>").alias("prose"),
        F.unix_timestamp(D.sortable(F.when(k % 3 == 0, "never").otherwise(day))).alias("sortable"), D.displayed(day).alias("displayed"),
    )


# Contracts


def _broken(rules: dict[str, str], key: str, where: str = "true") -> str:
    """SQL for violations: one row for each rule that a row breaks."""
    return " UNION ALL ".join(f"SELECT '{rule}' AS rule, ({key})::VARCHAR AS key FROM p WHERE ({where}) AND NOT coalesce({ok}, false)" for rule, ok in rules.items())


_SEEN = POSTS.replace("p AS (SELECT", "p0 AS (SELECT", 1)


@query(f"WITH {_SEEN}, p AS (SELECT *, ['current', 'prior', 'unverified', 'lost'][doc_id % 4 + 1] AS st, CASE WHEN doc_id % 3 = 0 THEN updated_at ELSE '2024-05-05T00:00:00Z' END AS seen, CASE WHEN doc_id % 6 = 5 THEN 'full' WHEN doc_id % 2 = 0 THEN 'excerpt' ELSE 'full' END AS kind FROM p0 WHERE doc_id % 13 <> 0) "
       + _broken({"revision status": "st IN ('current', 'prior', 'unverified')", "current times match": "st <> 'current' OR updated_at = seen", "prior times differ": "st <> 'prior' OR (kind = 'excerpt' AND updated_at <> '' AND seen <> '' AND updated_at <> seen)", "unverified is an excerpt": "st <> 'unverified' OR kind = 'excerpt'", "full is current": "kind <> 'full' OR (st = 'current' AND updated_at <> '')"}, "slug"))
def q_provenance(spark, d):
    """Bodies whose revision, status and times don't say the same; rows that only a registry knows have none."""
    i = F.col("doc_id")
    p = _posts(spark, d).withColumns({
        "body_revision_status": F.element_at(F.array(*map(F.lit, ("current", "prior", "unverified", "lost"))), (i % 4 + 1).cast("int")), "source_updated_at": F.col("updated_at"), "observed_source_updated_at": F.when(i % 3 == 0, F.col("updated_at")).otherwise("2024-05-05T00:00:00Z"),
        "content_status": F.when(i % 13 == 0, "registry").when(i % 6 == 5, "full").when(i % 2 == 0, "excerpt").otherwise("full"),
    })
    return release.provenance(p)


@query("SELECT rule, key FROM (SELECT o_orderkey AS k, o_orderstatus AS a, o_custkey % 50 AS b FROM orders WHERE o_orderkey % 7 <> 0) l FULL JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS a, o_custkey % CASE WHEN o_orderkey % 5 = 0 THEN 49 ELSE 50 END AS b FROM orders WHERE o_orderkey % 9 <> 0) r USING (k), LATERAL (SELECT k::VARCHAR AS key, unnest(CASE WHEN l.b IS NULL THEN ['only right'] WHEN r.b IS NULL THEN ['only left'] ELSE list_concat(CASE WHEN l.a IS DISTINCT FROM r.a THEN ['a'] ELSE [] END, CASE WHEN l.b IS DISTINCT FROM r.b THEN ['b'] ELSE [] END) END) AS rule)")
def q_agreement(spark, d):
    """Keys that only one of two tables has, and fields in which they differ."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    left = o.where(k % 7 != 0).select(k.alias("k"), F.col("o_orderstatus").alias("a"), (F.col("o_custkey") % 50).alias("b"))
    right = o.where(k % 9 != 0).select(k.alias("k"), F.when(k % 11 != 0, F.col("o_orderstatus")).alias("a"), (F.col("o_custkey") % F.when(k % 5 == 0, 49).otherwise(50)).alias("b"))
    return release.agreement(left, right, "k", ["a", "b"])


@query("WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_custkey, n + CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END AS n FROM a WHERE o_custkey % 17 <> 0) (SELECT 'counts: not rebuilt' AS rule, o_custkey::VARCHAR AS key FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT 'counts: not published', o_custkey::VARCHAR FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))")
def q_exactness(spark, d):
    """A published aggregate against its rebuilding."""
    a = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    b = a.where("o_custkey % 17 <> 0").withColumn("n", F.col("n") + F.when(F.col("o_custkey") % 10 == 0, 1).otherwise(0))
    return release.exact(a, b, "o_custkey", "counts")


@query("SELECT 'n' AS rule, 'nation' AS key UNION ALL SELECT 'digest', 'nation' UNION ALL SELECT 'digest', 'region'")
def q_bundle(spark, d):
    """Tables read back against a manifest: one is as published, one lost a row, in one a name changed."""
    customers, nations, regions = (table(spark, d, n) for n in ("customer", "nation", "region"))
    none = spark.createDataFrame([], "id int")
    manifest = release.endpoints(customers, nations, regions, none, none)["manifest"]
    manifest = manifest.where("name <> 'families' AND name <> 'latest'").withColumn("name", F.expr("case name when 'articles_index' then 'customer' when 'search_index' then 'nation' else 'region' end"))
    changed = regions.withColumn("r_name", F.when(F.col("r_regionkey") == 1, "?").otherwise(F.col("r_name")))
    return release.bundle({"customer": customers, "nation": nations.where("n_nationkey > 0"), "region": changed}, manifest)


_HASHED = "sum(('0x' || substr(h, {0}, 8))::UBIGINT::HUGEINT)::VARCHAR"


@query("WITH r AS (SELECT sha256('{{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}}') AS h FROM orders) SELECT count(*) AS n, sha256(count(*) || ':' || {} || ':' || {} || ':' || {} || ':' || {}) AS digest FROM r".format(*(_HASHED.format(1 + 8 * i) for i in range(4))))
def q_table_digest(spark, d):
    """A digest of a table that doesn't depend on the order of its rows."""
    return rows.digest(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("WITH p AS (SELECT o_orderkey, 'a_' || left(CASE WHEN o_orderkey % 97 = 0 THEN 'zz' ELSE '' END || sha256(o_orderkey::VARCHAR), 14) AS id, CASE WHEN o_orderkey % 50 = 0 THEN ' ' || o_orderpriority ELSE o_orderpriority END AS title, CASE WHEN o_orderkey % 40 = 0 THEN 'http' ELSE 'https' END || '://h/' || o_orderkey % 14000 AS url, CASE WHEN o_orderkey % 60 = 0 THEN 'blog' ELSE 'medium' END AS source, CASE o_orderkey % 3 WHEN 0 THEN 'member' ELSE 'public' END AS access, CASE WHEN o_orderkey % 4 = 0 THEN 'full' ELSE 'excerpt' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 1300 WHEN o_orderkey % 70 = 1 THEN 5 ELSE 0 END AS chars, o_orderkey % 65 AS mask FROM orders) "
       + _broken({"id": "regexp_full_match(id, 'a_[0-9a-f]{14}')", "title": "title = trim(title) AND title <> ''", "url": "starts_with(url, 'https://')", "source": "source IN ('substack', 'medium')", "preview length": "chars BETWEEN 0 AND 1200", "preview of members only": "access = 'member' OR chars = 0", "member is an excerpt": "access <> 'member' OR status = 'excerpt'", "mask": "mask BETWEEN 0 AND 63", "instruments without repeats": "o_orderkey % 80 <> 0"}, "id")
       + " UNION ALL SELECT 'unique url', url FROM p GROUP BY url HAVING count(*) > 1 UNION ALL SELECT 'unique id', id FROM p GROUP BY id HAVING count(*) > 1")
def q_wire_contract(spark, d):
    """Rows for readers that break a rule of their contract."""
    k = F.col("o_orderkey")
    w = table(spark, d, "orders").select(
        F.concat(F.lit("a_"), F.substring(F.concat(F.when(k % 97 == 0, "zz").otherwise(""), F.sha2(k.cast("string"), 256)), 1, 14)).alias("id"), F.concat(F.when(k % 50 == 0, " ").otherwise(""), "o_orderpriority").alias("title"), F.lit("").alias("subtitle"),
        F.concat(F.when(k % 40 == 0, "http").otherwise("https"), F.lit("://h/"), (k % 14000).cast("string")).alias("url"), F.when(k % 60 == 0, "blog").otherwise("medium").alias("source"), F.when(k % 3 == 0, "member").otherwise("public").alias("publication_access"),
        F.when(k % 4 == 0, "full").otherwise("excerpt").alias("content_status"), F.when(k % 3 == 0, k % 1300).when(k % 70 == 1, 5).otherwise(0).alias("member_preview_chars"), (k % 65).alias("mask"), F.array(F.lit("long")).alias("directions"),
        F.when(k % 80 == 0, F.array(F.lit("bond"), F.lit("bond"))).otherwise(F.array(F.lit("bond"))).alias("instruments"), F.array().cast("array<string>").alias("managers"),
    )
    return release.wire(w)


@query(f"WITH {_SEEN}, p AS (SELECT *, CASE WHEN doc_id % 31 = 0 THEN ' ' || title ELSE title END AS t, CASE WHEN doc_id % 29 = 0 THEN '2024-13-01' ELSE post_date END AS day, CASE WHEN doc_id % 23 = 0 THEN 'founding' ELSE audience END AS aud, CASE WHEN doc_id % 19 = 0 THEN 'draft' ELSE content_status END AS st, 'https://' || CASE WHEN doc_id % 37 = 0 THEN 'x.org' WHEN source = 'substack' THEN 'a.substack.com' ELSE source || '.com' END || '/p/' || doc_id AS u FROM p0) "
       + _broken({"title": "length(trim(t)) > 0 AND trim(t) = t", "url source": "doc_id % 37 <> 0", "date": "doc_id % 29 <> 0", "audience": "aud IN ('everyone', 'only_paid')", "status": "st IN ('current', 'excerpt', 'registry')", "registry without words": "st <> 'registry' OR wordcount = 0", "no link to itself": "doc_id % 41 <> 0"}, "source || ':' || slug")
       + " UNION ALL SELECT 'unique slug', slug FROM p GROUP BY slug HAVING count(*) > 1 UNION ALL SELECT 'unique id', source || ':' || lower(source_id) FROM p GROUP BY ALL HAVING count(*) > 1")
def q_article_contract(spark, d):
    """Articles that break a rule of the catalogue."""
    i = F.col("doc_id")
    host = F.when(i % 37 == 0, "x.org").when(F.col("source") == "substack", "a.substack.com").otherwise(F.concat("source", F.lit(".com")))
    a = _posts(spark, d).withColumns({
        "url": F.concat(F.lit("https://"), host, F.lit("/p/"), i.cast("string")), "title": F.when(i % 31 == 0, F.concat(F.lit(" "), "title")).otherwise(F.col("title")), "post_date": F.when(i % 29 == 0, "2024-13-01").otherwise(F.col("post_date")),
        "audience": F.when(i % 23 == 0, "founding").otherwise(F.col("audience")), "content_status": F.when(i % 19 == 0, "draft").otherwise(F.col("content_status")), "alternate_urls": F.when(i % 41 == 0, F.create_map(F.col("source"), F.lit("https://y"))),
    })
    return contracts.articles(a)


@query(f"WITH {_SEEN}, x AS (SELECT *, trim(body_text, {_SPACES}) AS t FROM p0), y AS (SELECT *, {_CUT} AS e FROM x), p AS (SELECT *, audience = 'only_paid' AND doc_id % 15 <> 0 AS shown FROM y) "
       + _broken({"preview of members only": "(audience = 'only_paid') = shown", "preview length": "NOT shown OR doc_id % 20 <> 0", "preview digest": "NOT shown OR doc_id % 25 <> 0",
                   "preview bound": "NOT shown OR length(e) + (doc_id % 20 = 0)::INTEGER <= 1200", "preview surface": "NOT shown OR (e = '') = (length(e) + (doc_id % 20 = 0)::INTEGER = 0)"}, "slug"))
def q_preview_proof(spark, d):
    """Previews of redacted posts that don't prove themselves: some are taken away, some lengths and digests changed."""
    i, p = F.col("doc_id"), F.col("member_preview")
    r = publish.redacted(_posts(spark, d).withColumn("public_preview_text", F.col("body_text")))
    wrong = p.withField("character_count", F.when(i % 20 == 0, p.character_count + 1).otherwise(p.character_count)).withField("body_sha256", F.when(i % 25 == 0, F.lit("0" * 64)).otherwise(p.body_sha256))
    broken = r.withColumn("member_preview", F.when(i % 15 != 0, wrong))
    return contracts.preview_proof(broken)


@query("WITH p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 30 = 0 THEN '1997-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders) " + _broken({"day": "k % 30 <> 0", "y2": "k % 21 <> 0", "y10": "k % 33 <> 0"}, "day") + " UNION ALL SELECT 'unique day', day FROM p GROUP BY day HAVING count(*) > 1")
def q_curve_contract(spark, d):
    k = F.col("o_orderkey")
    c = table(spark, d, "orders").select(F.when(k % 30 == 0, "1997-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"), *(F.when(k % n == 0, F.lit(None) if n == 21 else F.lit(400.0)).otherwise(4.0).alias(c) if n else F.lit(3.5).alias(c) for c, n in (("m3", 0), ("y2", 21), ("y5", 0), ("y10", 33), ("y30", 0))))
    return contracts.curve(c)


_STATES = "SELECT event_id AS k, event_id::VARCHAR AS source, CASE WHEN event_id % 3 = 0 THEN 'ok' ELSE 'degraded' END AS status, (event_id % 4) AS n, CASE WHEN event_id % 5 > 1 THEN strftime(ts, '%Y-%m-%d') END AS since, '2030-01-01' AS checked FROM events"


@query(f"WITH p AS ({_STATES}) " + _broken({"both or neither": "(since IS NOT NULL) = (n > 0)", "healthy has none": "status <> 'ok' OR n = 0", "degraded has one": "status = 'ok' OR n > 0"}, "source"))
def q_health_contract(spark, d):
    return contracts.health_rows(_states(spark, d))


def _states(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", k.cast("string").alias("source"), F.when(k % 3 == 0, "ok").otherwise("degraded").alias("status"), (k % 4).cast("int").alias("consecutive_degraded_checks"), F.when(k % 5 > 1, F.date_format("ts", "yyyy-MM-dd")).alias("degraded_since"), F.lit("2030-01-01").alias("checked_at"))


@query(f"WITH s AS ({_STATES}) SELECT source, CASE WHEN status = 'ok' THEN NULL WHEN k % 2 = 0 AND n > 0 THEN since ELSE checked END AS degraded_since, CASE WHEN status = 'ok' THEN 0 WHEN k % 2 = 0 AND n > 0 THEN n + 1 ELSE 1 END::INTEGER AS n FROM s")
def q_health_advanced(spark, d):
    """Health of sources after one more check; half of them were not there before."""
    s = _states(spark, d)
    current = s.select("source", "status", "checked_at")
    return health.advance(current, s.where("event_id % 2 = 0").select("source", "degraded_since", "consecutive_degraded_checks")).select("source", "degraded_since", F.col("consecutive_degraded_checks").alias("n"))


@query(f"WITH s AS ({_STATES}), p AS (SELECT *, k % 10 <> 0 AS there, CASE WHEN status = 'ok' THEN NULL WHEN n > 0 THEN since ELSE checked END AS want, CASE WHEN status = 'ok' THEN 0 WHEN n > 0 THEN n + 1 ELSE 1 END AS count FROM s) " + _broken({"source is there": "there", "check moved on": "NOT there OR k % 12 <> 1", "degraded checks": "NOT there OR k % 14 <> 1 OR count = 0", "degraded since": "NOT there OR k % 18 <> 1"}, "source"))
def q_health_monotone(spark, d):
    """Source health that doesn't go on from the snapshot before: sources lost, checks that went back, counts that stood still, days of a first failure that moved."""
    s, k = _states(spark, d), F.col("event_id")
    now = health.advance(s.where(k % 10 != 0).select("event_id", "source", "status", "checked_at"), s.select("source", "degraded_since", "consecutive_degraded_checks"))
    n = F.col("consecutive_degraded_checks")
    changed = now.withColumns({"checked_at": F.when(k % 12 == 1, "2029-01-01").otherwise(F.col("checked_at")), "consecutive_degraded_checks": F.when((k % 14 == 1) & (n > 0), n - 1).otherwise(n), "degraded_since": F.when(k % 18 == 1, "2028-05-05").otherwise(F.col("degraded_since"))})
    return contracts.monotone(changed, s)


@query("""WITH t AS (SELECT user_id::VARCHAR AS u, count(*) AS n, list(event_id ORDER BY ts, event_id) AS own FROM events GROUP BY 1 HAVING count(*) >= 2),
x AS (SELECT *, CASE u::INT % 11 WHEN 2 THEN own[2:] WHEN 3 THEN list_concat(own, own[1:1]) WHEN 4 THEN list_reverse(own) WHEN 5 THEN list_concat(own, [-u::INT - 1]) ELSE own END AS ids, n + CASE WHEN u::INT % 9 = 1 THEN 1 WHEN u::INT % 13 = 6 THEN -n ELSE 0 END AS m FROM t),
each AS (SELECT u, i, ids[i] AS id, e.ts FROM x, unnest(range(1, len(ids) + 1)) AS v(i) LEFT JOIN events e ON e.event_id = ids[i] AND e.user_id::VARCHAR = u)
SELECT 'count' AS rule, u AS key FROM x WHERE m <> len(ids) UNION ALL SELECT 'enough records', u FROM x WHERE m < 2 UNION ALL SELECT 'no repeats', u FROM x WHERE len(list_distinct(ids)) <> len(ids)
UNION ALL SELECT 'missing member', u FROM x WHERE u::INT % 11 = 2 UNION ALL SELECT 'foreign member', u FROM x WHERE u::INT % 11 = 5
UNION ALL SELECT DISTINCT 'order', u FROM (SELECT *, lag(ts) OVER (PARTITION BY u ORDER BY i) AS before FROM each) WHERE before > ts""")
def q_thread_invariants(spark, d):
    """Threads with every rule broken somewhere: counts that are wrong or too low, a record missing, twice, of another thread, or out of order."""
    m = table(spark, d, "events").select(F.col("user_id").cast("string").alias("entity"), F.col("event_id").alias("id"), F.col("ts").alias("at"))
    t, u, ids, n = threads.topics(m).select("entity", "n", "ids"), F.col("entity").cast("int"), F.col("ids"), F.col("n")
    changed = F.when(u % 11 == 2, F.slice(ids, F.lit(2), F.size(ids) - 1)).when(u % 11 == 3, F.concat(ids, F.slice(ids, 1, 1))).when(u % 11 == 4, F.reverse(ids)).when(u % 11 == 5, F.concat(ids, F.array((-u - 1).cast("long")))).otherwise(ids)
    broken = t.select("entity", F.when(u % 9 == 1, n + 1).when(u % 13 == 6, F.lit(0)).otherwise(n).alias("n"), changed.alias("ids"))
    return threads.invariants(broken, m)


@query("SELECT l_orderkey AS thread, l_suppkey AS owner FROM lineitem WHERE l_suppkey % 10 <> 0")
def q_thread_owners(spark, d):
    """Thread members with the catalogue row of their URL."""
    own = table(spark, d, "supplier").where("s_suppkey % 10 <> 0").select(F.concat(F.lit("https://h/"), F.col("s_suppkey").cast("string")).alias("url"), F.col("s_suppkey").alias("id"))
    members = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("thread"), F.concat(F.lit(" https://h/"), F.col("l_suppkey").cast("string"), F.lit("//")).alias("url"))
    return threads.owners(members, own)[0].select("thread", "owner")


@query("SELECT 'private key' AS rule, key FROM (VALUES ('Pass-Word'), ('email'), ('ip'), ('to.ken')) t(key)")
def q_private_keys(spark, d):
    """Private names among keys at any depth of JSON, quoted text aside."""
    nested = F.concat(F.lit('{"a":[{"email":"x"},{"b":{"Pass-Word":1}}],"said":"no \\"phone\\": here","k":'), F.col("event_id").cast("string"), F.lit("}"))
    e = table(spark, d, "events").select(nested.alias("j"), F.create_map(F.lit("to.ken"), F.lit("1"), F.lit("ip"), F.lit("2")).alias("m"))
    return contracts.private_keys(e, ["j", "m"])


# Links


@query(f"WITH {_TWINS}, l AS (SELECT 'm' || k AS l_id, md5(c::VARCHAR) AS t, day FROM o WHERE st = 'O'), r AS (SELECT 's' || k AS r_id, md5(c::VARCHAR) AS t, day FROM o WHERE st = 'F'), j AS (SELECT l_id, r_id, count(*) OVER (PARTITION BY l_id) AS n FROM l JOIN r USING (t) WHERE abs(date_diff('day', l.day::DATE, r.day::DATE)) <= 3) SELECT l_id, r_id FROM j WHERE n = 1")
def q_similar_titles(spark, d):
    """The most similar title within three days, if it leads: of titles alike only in small words none does, of two equal ones neither."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_orderstatus", F.concat(F.lit("on "), F.md5(F.col("o_custkey").cast("string")), F.lit(" now")).alias("title_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    left = o.where("o_orderstatus = 'O'").select(F.concat(F.lit("m"), "k").alias("l_id"), "title_key", F.col("day").alias("l_date"))
    right = o.where("o_orderstatus = 'F'").select(F.concat(F.lit("s"), "k").alias("r_id"), "title_key", F.col("day").alias("r_date"))
    return link.fuzzy_match(left, right)


_EDITED = """SELECT o_orderkey AS k, o_orderstatus AS st, strftime(o_orderdate, '%Y-%m-%d') AS day,
  CASE o_orderkey % 5 WHEN 0 THEN ws WHEN 1 THEN list_transform(ws, lambda w, i: CASE WHEN i = o_orderkey % 8 + 1 THEN 'x' || o_orderkey % 7 ELSE w END) WHEN 2 THEN ws[1:7] WHEN 3 THEN ws[1:6] ELSE list_prepend('new', ws) END AS ws
  FROM (SELECT *, list_distinct(regexp_extract_all(md5((o_custkey % 200)::VARCHAR), '.{4}')) AS ws FROM orders)"""


def _edited_titles(spark, d):
    """Titles of eight words, as they are, with a word changed, shortened or with a word more."""
    k = F.col("o_orderkey")
    ws = F.array_distinct(F.regexp_extract_all(F.md5((F.col("o_custkey") % 200).cast("string")), F.lit(".{4}"), F.lit(0)))
    changed = F.transform(ws, lambda w, i: F.when(i == k % 8, F.concat(F.lit("x"), (k % 7).cast("string"))).otherwise(w))
    said = F.when(k % 5 == 0, ws).when(k % 5 == 1, changed).when(k % 5 == 2, F.slice(ws, 1, 7)).when(k % 5 == 3, F.slice(ws, 1, 6)).otherwise(F.array_prepend(ws, "new"))
    o = table(spark, d, "orders").select(k.alias("k"), "o_orderstatus", F.array_join(said, " ").alias("title_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return o.where("o_orderstatus = 'O'").select(F.col("k").alias("l_id"), "title_key", F.col("day").alias("l_date")), o.where("o_orderstatus = 'F'").select(F.col("k").alias("r_id"), "title_key", F.col("day").alias("r_date"))


@query(f"""WITH t AS ({_EDITED}), p AS (
  SELECT l.k AS l_id, r.k AS r_id, len(list_intersect(l.ws, r.ws))::DOUBLE / len(list_distinct(list_concat(l.ws, r.ws))) AS j
  FROM t l JOIN t r ON abs(date_diff('day', l.day::DATE, r.day::DATE)) <= 3 WHERE l.st = 'O' AND r.st = 'F')
SELECT l_id, r_id, round(j, 6) AS j FROM p WHERE j >= 0.62""")
def q_near_titles(spark, d):
    """Titles within three days of each other that share enough of their words, though few are equal."""
    return link.similar_titles(*_edited_titles(spark, d)).select("l_id", "r_id", F.round("j", 6).alias("j"))


@query(f"""WITH {_TWINS}, m AS (SELECT k, 'm' || k AS l_id, md5(c::VARCHAR) AS t, c, day FROM o WHERE k % 3 = 0), s AS (SELECT k, 's' || k AS r_id, CASE WHEN k % 2 = 0 THEN md5(c::VARCHAR) ELSE md5('x' || k) END AS t, c, day FROM o WHERE k % 3 = 1),
near AS (SELECT l_id, r_id, m.t = s.t AS title, m.c = s.c AS sub, abs(date_diff('day', m.day::DATE, s.day::DATE)) AS days FROM m JOIN s ON (m.t = s.t OR m.c = s.c) WHERE abs(date_diff('day', m.day::DATE, s.day::DATE)) <= 7),
steps AS (SELECT l_id, r_id, 'explicit-link' AS reason, 0 AS prio FROM m JOIN s ON s.k = m.k + 1 WHERE m.k % 5 = 0
  UNION ALL SELECT l_id, r_id, 'normalized-title-and-date', 1 FROM (SELECT *, count(*) OVER (PARTITION BY l_id) AS n FROM near WHERE title) WHERE n = 1
  UNION ALL SELECT l_id, r_id, 'reviewed-override', 3 FROM m JOIN s ON s.k = m.k + 4 WHERE m.k % 7 = 0
  UNION ALL SELECT l_id, r_id, 'subtitle-and-date', 4 FROM (SELECT *, count(*) OVER (PARTITION BY l_id) AS n FROM near WHERE sub) WHERE n = 1),
sure AS (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY l_id ORDER BY prio, r_id) = 1)
SELECT l_id, r_id, reason FROM sure UNION ALL SELECT l_id, r_id, 'title-similarity-and-date' FROM (SELECT *, count(*) OVER (PARTITION BY l_id) AS n FROM near WHERE title AND days <= 3 AND l_id NOT IN (SELECT l_id FROM sure)) WHERE n = 1""")
def q_matched_posts(spark, d):
    """Posts of one publication matched with another's by the whole ladder: link, title, reviewed pair, subtitle, similarity."""
    k = F.col("k")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.md5(F.col("o_custkey").cast("string")).alias("c"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("post_date"))
    key = lambda prefix, n: F.concat(F.lit(prefix), (k + n).cast("string"))
    sub = F.concat(F.lit("A subtitle that has sixty characters, or more, for customer "), "c")
    medium = o.where(k % 3 == 0).select(key("m", 0).alias("medium_id"), "post_date", F.col("c").alias("title"), F.lit(None).cast("string").alias("display_title"), sub.alias("subtitle"), F.when(k % 5 == 0, key("s", 1)).alias("mirror_substack_slug"))
    substack = o.where(k % 3 == 1).select(key("s", 0).alias("slug"), "post_date", F.when(k % 2 == 0, F.col("c")).otherwise(F.md5(F.concat(F.lit("x"), k.cast("string")))).alias("title"), sub.alias("subtitle"))
    reviewed = o.where((k % 3 == 0) & (k % 7 == 0)).select(key("m", 0).alias("medium_id"), key("s", 4).alias("substack_slug"))
    return link.match_posts(medium, substack, reviewed)
