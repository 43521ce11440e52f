"""The registered queries over the driver's tables, each with DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import observe as O
from ..functions import text as X
from ..functions import urls as U
from ..functions.briefs import brief
from ..functions.text_udf import normalize_title, sequence_ratio, strip_html
from ..operators import asof, contracts, health, index, link, publish, rows, search, similarity, taxonomy, threads
from ..session import coded, settled, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# A lexicon drawn from the tables' invented languages, for the lexicon operators.
TAGS = {"the": "(?<![a-z])the(?![a-z])", "und": "(?<![a-z])und(?![a-z])", "les": "(?<![a-z])les(?![a-z])", "para": "(?<![a-z])para(?![a-z])", "mail": "@[a-z]", "license": "licen[cs]e", "digits": "[0-9]{3}"}
# Terms that stand for entities.
TERMS = ("the", "for", "und", "der", "les", "que", "para", "las", "license", "scum")
_TAG_SQL = {n: p.replace("(?<![a-z])", "(?:^|[^a-z])").replace("(?![a-z])", "(?:[^a-z]|$)") for n, p in TAGS.items()}
_SPACE = "\\x20\\x09-\\x0D"


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return put


def plain(c):
    """ASCII words in lower case, one space between."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


PLAIN = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"


# Blocks, tags, scalars


@query(f"""
WITH b AS (SELECT doc_id, lang, trim(unnest(string_split(text, chr(10)))) AS block FROM documents WHERE length(text) >= 200),
t AS (SELECT lang, {", ".join(f"regexp_matches(lower(block), '{p}') AS t_{n}" for n, p in _TAG_SQL.items())} FROM b WHERE length(block) > 50),
u AS ({" UNION ALL ".join(f"SELECT lang, '{n}' AS tag FROM t WHERE t_{n}" for n in TAGS)} UNION ALL SELECT lang, 'unspecified' FROM t WHERE NOT ({" OR ".join(f"t_{n}" for n in TAGS)}))
SELECT lang, tag, count(*) AS n FROM u GROUP BY ALL""")
def q_block_tags(spark, d):
    """Blocks of long texts, tagged by a lexicon, counted by language and tag."""
    docs = table(spark, d, "documents").where(F.length("text") >= 200)
    blocks = docs.select("lang", F.explode(F.filter(F.transform(F.split("text", "\n"), lambda x: F.btrim(x)), lambda x: F.length(x) > 50)).alias("block"))
    return blocks.select("lang", F.explode(O.instruments(F.col("block"), TAGS)).alias("tag")).groupBy("lang", "tag").agg(F.count("*").alias("n"))


@query("SELECT * FROM (SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS pos, trim(unnest(string_split(text, chr(10)))) AS block FROM documents) WHERE length(block) > 50")
def q_block_explode(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "block")).select("doc_id", "pos", F.btrim("block").alias("block")).where(F.length("block") > 50)


@query("SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9]+'))::BIGINT AS n FROM documents")
def q_word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit("[A-Za-z0-9]+")).cast("long").alias("n"))


_EXCERPT = "CASE WHEN trim(text, {b}) = '' THEN '' WHEN length(trim(text, {b})) <= 1200 THEN trim(text, {b}) WHEN NOT contains(left(trim(text, {b}), 1200), ' ') THEN '' ELSE rtrim(regexp_extract(left(trim(text, {b}), 1200), '(?s)^(.*) ', 1), {b}) || '…' END".format(b="' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")


@query(f"SELECT doc_id, {_EXCERPT} AS excerpt, length({_EXCERPT})::BIGINT AS n, sha256({_EXCERPT}) AS digest FROM documents")
def q_bounded_excerpt(spark, d):
    e = X.bounded_excerpt(F.col("text"))
    return table(spark, d, "documents").select("doc_id", e.alias("excerpt")).select("doc_id", "excerpt", F.length("excerpt").cast("long").alias("n"), F.sha2("excerpt", 256).alias("digest"))


@query(f"SELECT doc_id, toxic = 1 AS member, CASE WHEN toxic = 1 THEN {_EXCERPT} ELSE text END AS body, CASE WHEN toxic = 1 THEN sha256({_EXCERPT}) END AS digest, CASE WHEN toxic = 1 THEN length({_EXCERPT}) END AS n, CASE WHEN toxic = 1 THEN CASE WHEN {_EXCERPT} = '' THEN 'metadata-only' ELSE 'anonymous-substack-list' END END AS surface FROM documents JOIN labels USING (doc_id)")
def q_member_redaction(spark, d):
    posts = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", F.when(F.col("toxic") == 1, "only_paid").otherwise("everyone").alias("audience"), F.col("text").alias("body_text"), F.col("text").alias("public_preview_text"))
    p = F.col("member_preview")
    return publish.redacted(posts).select("doc_id", (F.col("audience") == "only_paid").alias("member"), F.col("body_text").alias("body"), p.body_sha256.alias("digest"), p.character_count.cast("long").alias("n"), p.surface.alias("surface"))


@query("WITH m AS (SELECT doc_id, list_concat(regexp_extract_all(text, '[0-9]+%')[1:5], regexp_extract_all(text, '[0-9][0-9.]+')[1:5]) AS x FROM documents), y AS (SELECT doc_id, list_filter(x, lambda v, i: list_position(x, v) = i) AS x FROM m) SELECT doc_id, CASE WHEN len(x) > 0 THEN array_to_string(x[1:20], ', ') END AS found FROM y")
def q_extract_all_top(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", X.joined([X.matches_of(t, "[0-9]+%", 5), X.matches_of(t, "[0-9][0-9.]+", 5)], 20, ", ").alias("found"))


@query("SELECT o_orderkey, greatest(1, CASE WHEN 2 * (w % 220) > 220 OR (2 * (w % 220) = 220 AND (w // 220) % 2 = 1) THEN w // 220 + 1 ELSE w // 220 END)::BIGINT AS minutes FROM (SELECT o_orderkey, (o_orderkey * 7 + o_custkey) % 5000 AS w FROM orders)")
def q_read_minutes(spark, d):
    return table(spark, d, "orders").select("o_orderkey", N.read_minutes((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 5000).alias("minutes"))


_MASK = ["length(text) > 1000", "contains(text, chr(10))", "regexp_matches(text, '[0-9]')", "lang = 'en'", "regexp_matches(text, '@')", "n_chars % 2 = 0"]


@query("SELECT doc_id, (" + " + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(_MASK)) + ")::BIGINT AS mask, regexp_matches(text, '[0-9]') AS bit2 FROM documents")
def q_wire_masks(spark, d):
    t = F.col("text")
    flags = [F.length(t) > 1000, t.contains("\n"), t.rlike("[0-9]"), F.col("lang") == "en", t.contains("@"), F.col("n_chars") % 2 == 0]
    return table(spark, d, "documents").select("doc_id", N.pack(flags).cast("long").alias("mask")).withColumn("bit2", N.unpack(F.col("mask"), 6)[2])


_S = "CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ELSE strftime(o_orderdate, '%Y-13-%d') END"


@query(f"SELECT o_orderkey, {_S} AS s, CASE o_orderkey % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'instant' END AS precision, CASE WHEN o_orderkey % 4 < 2 THEN epoch(o_orderdate)::BIGINT END AS instant FROM orders")
def q_precision_dates(spark, d):
    """Days, instants, naive timestamps and impossible days, read strictly."""
    at, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    s = F.when(k == 0, F.date_format(at, "yyyy-MM-dd")).when(k == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 2, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(at, "yyyy-'13'-dd"))
    return table(spark, d, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", "s", D.precision(F.col("s")).alias("precision"), F.unix_timestamp(D.instant(F.col("s"))).alias("instant"))


@query("SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS canonical, 'a_' || left(sha256(regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '')), 14) AS id FROM pages")
def q_url_identity(spark, d):
    return table(spark, d, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical")).withColumn("id", U.stable_id("a", F.col("canonical")))


@query("SELECT doc_id, '| ' || doc_id || ' | ' || replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '|', '\\|') || ' |' AS line, trim(regexp_replace(regexp_replace(lower(left(text, 60)), '[^a-z0-9 -]', '', 'g'), '[ -]+', '-', 'g'), '-') AS slug FROM documents")
def q_markdown_rows(spark, d):
    slug = F.btrim(F.regexp_replace(F.regexp_replace(F.lower(F.substring("text", 1, 60)), "[^a-z0-9 -]", ""), "[ -]+", "-"), F.lit("-"))
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("| "), F.col("doc_id").cast("string"), F.lit(" | "), X.table_cell(F.col("text")), F.lit(" |")).alias("line"), slug.alias("slug"))


@query("SELECT doc_id, CASE WHEN c <> '' AND left(c, 1) IN ('=', '+', '-', '@') THEN '''' || c ELSE c END AS cell FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '=' || lang WHEN 1 THEN '+' || source ELSE source END AS c FROM documents)")
def q_csv_guard(spark, d):
    k = F.col("doc_id") % 3
    c = F.when(k == 0, F.concat(F.lit("="), "lang")).when(k == 1, F.concat(F.lit("+"), "source")).otherwise(F.col("source"))
    return publish.guarded(table(spark, d, "documents").select("doc_id", c.alias("cell")))


# Dedup and linking


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source, left(text, 150) ORDER BY doc_id) = 1")
def q_dedup_prefix(spark, d):
    return rows.dedup_by_prefix(table(spark, d, "documents").select("doc_id", "source", "text"), "source", "text", 150, "doc_id").select("doc_id", "source")


@query("SELECT sha256(text) AS digest, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def q_exact_dup_groups(spark, d):
    return rows.repeated(table(spark, d, "documents").select(F.sha2("text", 256).alias("digest")), ["digest"])


@query("WITH p AS (SELECT l.o_orderkey AS l_id, r.o_orderkey AS r_id FROM orders l JOIN orders r ON l.o_custkey = r.o_custkey AND abs(date_diff('day', l.o_orderdate, r.o_orderdate)) <= 7 WHERE l.o_orderstatus = 'O' AND r.o_orderstatus = 'F') SELECT l_id, r_id FROM p QUALIFY count(*) OVER (PARTITION BY l_id) = 1")
def q_uniq_title_band_match(spark, d):
    """Orders matched with another state's of the same customer within a week, if there is just one."""
    o = table(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    side = lambda s, n: o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias(f"{n}_id"), F.col("day").alias(f"{n}_date"))
    return link.unique_band_match(side("O", "l"), side("F", "r"), "key")


@query("WITH e AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderpriority AS p, o_orderdate AS t FROM orders), s AS (SELECT k, 'urgent' AS reason, 0 AS prio, k AS r FROM e WHERE p = '1-URGENT' UNION ALL SELECT e.k, 'same-day', 1, min(f.k) FROM e JOIN e f ON e.c = f.c AND e.t = f.t AND e.k <> f.k GROUP BY e.k UNION ALL SELECT k, 'returned', 2, min(l_partkey) FROM e JOIN lineitem ON k = l_orderkey WHERE l_returnflag = 'R' GROUP BY k) SELECT k AS l_id, r AS r_id, reason FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY prio, r) = 1")
def q_priority_ladder(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_id"), "o_custkey", "o_orderdate", "o_orderpriority")
    other = o.select(F.col("l_id").alias("r"), "o_custkey", "o_orderdate")
    same = o.join(other, ["o_custkey", "o_orderdate"]).where("l_id <> r").groupBy("l_id").agg(F.min("r").alias("r_id"))
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("l_id")).agg(F.min("l_partkey").alias("r_id"))
    return link.ladder([("urgent", o.where("o_orderpriority = '1-URGENT'").select("l_id", F.col("l_id").alias("r_id"))), ("same-day", same), ("returned", returned.join(o.select("l_id"), "l_id"))])


@query("WITH n AS (SELECT DISTINCT p_brand, p_name FROM part), p AS (SELECT a.p_brand, a.p_name AS a, b.p_name AS b, string_split(a.p_name, ' ') AS x, string_split(b.p_name, ' ') AS y FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_name < b.p_name) SELECT p_brand, a, b, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) AS jaccard FROM p WHERE len(list_intersect(x, y)) > 0")
def q_fuzzy_jaccard(spark, d):
    """Names of a brand that share words, found by word, with their token Jaccard similarity."""
    n = table(spark, d, "part").select("p_brand", "p_name").distinct().withColumn("t", F.array_distinct(X.tokens(F.col("p_name"))))
    each = n.withColumn("w", F.explode("t"))
    b = each.select("p_brand", "w", F.col("p_name").alias("b"), F.col("t").alias("tb"))
    pairs = each.withColumnRenamed("p_name", "a").join(b, ["p_brand", "w"]).where("a < b").select("p_brand", "a", "b", "t", "tb").dropDuplicates(["p_brand", "a", "b"])
    return pairs.select("p_brand", "a", "b", F.round(X.jaccard(F.col("t"), F.col("tb")), 6).alias("jaccard"))


@query()
def q_fuzzy_ratio(spark, d):
    """Sequence similarity of a brand's names that share a word."""
    return q_fuzzy_jaccard(spark, d).select("p_brand", "a", "b", F.round(sequence_ratio("a", "b"), 6).alias("ratio"))


@query("SELECT coalesce(a.s_suppkey, b.s_suppkey) AS s_suppkey, coalesce(b.s_name, a.s_name) AS s_name, coalesce(b.v, a.v) AS v FROM (SELECT s_suppkey, s_name, 1 AS v FROM supplier WHERE s_suppkey % 3 <> 0) a FULL JOIN (SELECT s_suppkey, upper(s_name) AS s_name, 2 AS v FROM supplier WHERE s_suppkey % 2 = 0) b USING (s_suppkey)")
def q_upsert_merge(spark, d):
    s = table(spark, d, "supplier")
    return rows.upsert(s.where("s_suppkey % 3 <> 0").select("s_suppkey", "s_name", F.lit(1).alias("v")), s.where("s_suppkey % 2 = 0").select("s_suppkey", F.upper("s_name").alias("s_name"), F.lit(2).alias("v")), ["s_suppkey"])


@query("SELECT r_regionkey AS key, n_regionkey IS NOT NULL AS found FROM region LEFT JOIN (SELECT DISTINCT n_regionkey FROM nation WHERE n_nationkey < 3) ON r_regionkey = n_regionkey WHERE n_regionkey IS NULL")
def q_disappeared_keys(spark, d):
    new = table(spark, d, "nation").where("n_nationkey < 3").select(F.col("n_regionkey").alias("key"))
    return rows.disappeared(table(spark, d, "region").select(F.col("r_regionkey").alias("key")), new, ["key"]).withColumn("found", F.lit(False))


# Time


@query("WITH s AS (SELECT user_id, ts, value FROM events WHERE event_type = 'signup'), p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') SELECT event_id, s.value AS value, epoch_us(s.ts) AS as_of FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts >= s.ts")
def q_asof(spark, d):
    e = table(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'signup'").select("user_id", "ts", "value")
    return asof.asof_backward(left, right, "ts", ["user_id"]).select("event_id", "value", F.unix_micros(F.col("as_of").cast("timestamp")).alias("as_of"))


_CURVE = "SELECT day, CAST(sum(v) AS DOUBLE) AS v FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, (o_orderkey * 37 + o_custkey) % 1000 AS v FROM orders) GROUP BY day"


@query(f"WITH c AS ({_CURVE}), l AS (SELECT list_sort(list(v)) AS s, count(*) - 1 AS m FROM c) SELECT day, v, CASE WHEN v <= s[m // 3 + 1] THEN 'low' WHEN v > s[2 * m // 3 + 1] THEN 'high' ELSE 'mid' END AS band FROM c, l")
def q_tercile_bands(spark, d):
    return asof.banded(_daily(spark, d), {"v": "band"})


def _daily(spark, d):
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), ((F.col("o_orderkey") * 37 + F.col("o_custkey")) % 1000).alias("v"))
    return o.groupBy("day").agg(F.sum("v").cast("double").alias("v"))


@query("""
WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT o_custkey) % 7 AS u FROM orders GROUP BY 1),
c AS (SELECT day, (n % 5) / 10.0::DOUBLE AS y2, (u + 3) / 10.0::DOUBLE AS y10, 1.0::DOUBLE AS y30 FROM d WHERE n % 3 <> 0),
q AS (SELECT DISTINCT strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS day FROM orders),
j AS (SELECT q.day, c.day AS as_of, y2, y10, y30, round(y10 - y2, 2) AS s FROM q ASOF JOIN c ON q.day >= c.day),
l AS (SELECT list_sort(list(s)) AS a, list_sort(list(y10)) AS b, count(*) - 1 AS m FROM j)
SELECT day, as_of, y2, y10, y30, CASE WHEN s <= a[m // 3 + 1] THEN 'low' WHEN s > a[2 * m // 3 + 1] THEN 'high' ELSE 'mid' END AS slope_band,
CASE WHEN y10 <= b[m // 3 + 1] THEN 'low' WHEN y10 > b[2 * m // 3 + 1] THEN 'high' ELSE 'mid' END AS level_band FROM j, l""")
def q_rate_context(spark, d):
    """A curve made of daily figures of orders, read as of each following day, with tercile bands."""
    o = table(spark, d, "orders")
    daily = o.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), (F.count_distinct("o_custkey") % 7).alias("u"))
    curve = daily.where("n % 3 <> 0").select("day", ((F.col("n") % 5) / 10.0).alias("y2"), ((F.col("u") + 3) / 10.0).alias("y10"), F.lit(1.0).alias("y30"))
    days = o.select(F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd").alias("day"))
    return asof.rate_context(days, curve)


_HISTORY = "SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM events"


@query(f"SELECT event_id, CASE WHEN event_type = 'error' THEN epoch_us(min(ts) OVER w) END AS since, CASE WHEN event_type = 'error' THEN count(*) OVER w ELSE 0 END AS n FROM ({_HISTORY}) WINDOW w AS (PARTITION BY user_id, run, event_type = 'error' ORDER BY ts)")
def q_streaks(spark, d):
    """Errors of a user in a row: since when, and how many."""
    s = health.streaks(table(spark, d, "events").select("event_id", "user_id", "ts", "event_type"), "user_id", "ts", F.col("event_type") == "error")
    return s.select("event_id", F.unix_micros(F.col("since").cast("timestamp")).alias("since"), "n")


@query(f"SELECT event_id, n FROM (SELECT event_id, event_type, ts, min(ts) OVER w AS since, count(*) OVER w AS n FROM ({_HISTORY}) WINDOW w AS (PARTITION BY user_id, run, event_type = 'error' ORDER BY ts)) WHERE event_type = 'error' AND since + INTERVAL 48 HOURS <= ts")
def q_persistent(spark, d):
    """Errors whose streak was two days old or older by then."""
    s = health.streaks(table(spark, d, "events").select("event_id", "user_id", "ts", "event_type"), "user_id", "ts", F.col("event_type") == "error")
    return health.persistent(s, F.col("ts")).select("event_id", "n")


@query("WITH h AS (SELECT event_id AS id, ts AS t, row_number() OVER (ORDER BY ts DESC) - 1 AS p FROM events WHERE event_id % 5 <> 0), w AS (SELECT event_id AS id, ts + INTERVAL (CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) SECOND AS t, row_number() OVER (ORDER BY ts DESC) - 1 AS pos FROM events WHERE event_id % 7 <> 0), s AS (SELECT w.*, h.p, h.t AS h_at FROM w LEFT JOIN h USING (id)), f AS (SELECT min(pos) FILTER (p IS NOT NULL) AS first FROM s) SELECT id, CASE WHEN first IS NULL THEN 'no overlap' WHEN pos >= first AND p IS NULL THEN 'gap' WHEN p <> pos - first THEN 'order' WHEN t <> h_at THEN 'time' END AS fault FROM s, f WHERE fault IS NOT NULL")
def q_lineage_overlap(spark, d):
    """Faults of a window of events against a history."""
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"))
    placed = lambda df: rows.numbered(df, [rows.Down("at")], "pos")
    moved = F.when(F.col("id") % 11 == 0, F.col("at") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("at"))
    window = placed(e.where("id % 7 <> 0")).withColumn("at", moved)
    return health.lineage(window, placed(e.where("id % 5 <> 0"))).select("id", "fault")


@query("SELECT c AS o_custkey, a AS before, coalesce(b, 0) AS after FROM (SELECT o_custkey AS c, count(*) AS a FROM orders GROUP BY 1) LEFT JOIN (SELECT o_custkey AS c, count(*) AS b FROM orders WHERE o_orderkey % 9 <> 0 GROUP BY 1) USING (c) WHERE coalesce(b, 0) < 0.9 * a")
def q_regression_floor(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return health.regressions(o, o.where("o_orderkey % 9 <> 0"), "o_custkey")


@query("SELECT event_id, row_number() OVER (ORDER BY k, a, event_id) AS turn FROM (SELECT event_id, CASE WHEN event_type = 'signup' THEN 0 WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS k, CASE WHEN event_id % 3 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS a FROM events)")
def q_retry_order(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("event_type") == "signup").alias("is_new"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("attempted_at"), F.col("event_id").alias("idx"))
    return health.retry_order(e).select("event_id", F.col("turn").cast("long").alias("turn"))


# Taxonomy, index, threads, similarity


_LADDER = (("license", "legal"), ("the", "en"), ("der", "de"), ("les", "fr"), ("las", "es"))
_FAMILY = "CASE " + " ".join(f"WHEN contains(' ' || {PLAIN.format('text')} || ' ', ' {t} ') THEN '{f}'" for t, f in _LADDER) + " ELSE 'other' END"


def _families(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", plain(F.col("text")).alias("w")).select("doc_id", "source", F.coalesce(*(F.when(X.has_phrase(F.col("w"), t), f) for t, f in _LADDER), F.lit("other")).alias("family"))


@query(f"SELECT doc_id, {_FAMILY} AS family FROM documents")
def q_family_ladder(spark, d):
    return _families(spark, d).select("doc_id", "family")


@query(f"SELECT f AS family, coalesce(n, 0) AS n FROM (SELECT unnest(['legal', 'en', 'de', 'fr', 'es', 'other', 'none']) AS f) LEFT JOIN (SELECT {_FAMILY} AS f, count(*) AS n FROM documents GROUP BY 1) USING (f)")
def q_families_zero_filled(spark, d):
    domain = spark.createDataFrame([(f,) for f in ("legal", "en", "de", "fr", "es", "other", "none")], "family string")
    return rows.counts_over(_families(spark, d), domain, "family")


_TERM_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS entity, doc_id FROM w WHERE contains(w, ' {t} ')" for t in TERMS)
_WORDS = f"WITH w AS (SELECT doc_id, ' ' || {PLAIN.format('text')} || ' ' AS w FROM documents)"


def _members(spark, d):
    hits = F.filter(F.array(*(F.when(X.has_phrase(F.col("w"), t), F.lit(t)) for t in TERMS)), lambda x: x.isNotNull())
    return table(spark, d, "documents").select("doc_id", plain(F.col("text")).alias("w")).select("doc_id", F.explode(hits).alias("entity"))


@query(f"{_WORDS} SELECT entity, (sum(count(*)) OVER (PARTITION BY entity))::BIGINT AS df, doc_id // 300 AS chunk, sha256(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS postings FROM ({_TERM_ROWS}) GROUP BY entity, doc_id // 300")
def q_inverted_index(spark, d):
    p = index.postings(_members(spark, d), "doc_id", 300)
    return p.select("entity", "df", "chunk", F.sha2(F.array_join(p.postings.cast("array<string>"), ","), 256).alias("postings"))


def _fields(spark, d):
    """Whole texts as records (id, fields): the words of weight, and pairs of neighbours, of the first line, which is the title, and of the rest, the brief."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", 2)
    field = lambda n, c: F.struct(F.lit(n).alias("field"), X.features(F.split(plain(c), " "), TERMS).alias("features"))
    fields = F.array(field("title", F.get(lines, F.lit(0))), field("brief", F.get(lines, F.lit(1))))
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), fields.alias("fields"))


def _asked(spark, d):
    """The query set of the searches for related records, against all records: ids divisible by 20."""
    return table(spark, d, "documents").where("doc_id % 20 = 0").select(F.col("doc_id").alias("id"))


def _kept(c):
    return f"list_filter(string_split({PLAIN.format(c)}, ' '), lambda w: length(w) >= 3 AND NOT regexp_full_match(w, '[0-9]+') AND w NOT IN ({', '.join(map(repr, TERMS))}))"


_TITLE = "string_split(coalesce(text, ''), chr(10))[1]"
_FEATURES = f"""WITH k AS (SELECT doc_id AS id, 'title' AS field, {_kept(_TITLE)} AS ws FROM documents
  UNION ALL SELECT doc_id, 'brief', {_kept(f"substr(text, length({_TITLE}) + 2)")} FROM documents),
f AS (SELECT id, field, unnest(ws) AS feature FROM k UNION ALL SELECT id, field, ws[i] || '-' || ws[i + 1] FROM k, unnest(range(1, len(ws))) AS u(i)),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT feature, count(DISTINCT id) AS df FROM f GROUP BY 1),
idf AS (SELECT feature, df, ln((n + 1.0::DOUBLE) / (df + 1.0)) + 1.0 AS idf FROM df, n WHERE df BETWEEN 2 AND greatest(2, floor({similarity.SHARE}::DOUBLE * n)))"""
_VECTORS = _FEATURES + """,
x AS (SELECT id, field, feature, (1 + ln(count(*)::DOUBLE)) * any_value(idf) AS x FROM f JOIN idf USING (feature) GROUP BY ALL),
v AS (SELECT id, field, feature, x / sqrt(sum(x * x) OVER (PARTITION BY id, field)) AS w FROM x)"""
_LEXICAL = f"""{_VECTORS},
p AS (SELECT a.id AS src, b.id AS dst, feature, sum(CASE field WHEN 'title' THEN {similarity.WEIGHTS['title']} ELSE {similarity.WEIGHTS['brief']} END::DOUBLE * a.w * b.w) AS part FROM v a JOIN v b USING (field, feature) WHERE a.id % 20 = 0 AND a.id <> b.id GROUP BY ALL),
lex AS (SELECT src, dst, sum(part) AS lexical FROM p GROUP BY ALL)"""
_MEMBERS = f"w AS (SELECT doc_id, ' ' || {PLAIN.format('text')} || ' ' AS w FROM documents), m AS ({_TERM_ROWS})"
_COSINES = """e AS (SELECT entity, count(*) AS df, (ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1.0)) + 1.0) ** 2 AS sq FROM m GROUP BY 1),
norms AS (SELECT doc_id, sum(sq) AS norm FROM m JOIN e USING (entity) GROUP BY 1),
cos AS (SELECT a.doc_id AS src, b.doc_id AS dst, sum(sq) / sqrt(any_value(x.norm) * any_value(y.norm)) AS cosine FROM m a JOIN m b USING (entity) JOIN e USING (entity) JOIN norms x ON x.doc_id = a.doc_id JOIN norms y ON y.doc_id = b.doc_id WHERE a.doc_id % 20 = 0 AND a.doc_id <> b.doc_id GROUP BY ALL)"""


@query(f"{_FEATURES} SELECT feature, df, round(idf, 6) AS idf FROM idf")
def q_df_idf(spark, d):
    frequency = similarity.frequency_of(_fields(spark, d).select(F.flatten("fields.features").alias("features")))
    return similarity.idf(frequency, table(spark, d, "documents").count()).select("feature", "df", F.round("idf", 6).alias("idf"))


def _words(spark, d):
    return similarity.coded_records(_fields(spark, d), None, table(spark, d, "documents").count())


@query(f"{_LEXICAL} SELECT src, dst, round(lexical, 4) AS score FROM lex QUALIFY row_number() OVER (PARTITION BY src ORDER BY round(lexical, 4) DESC, dst) <= 5")
def q_related_topk(spark, d):
    """The five records most like each query by the words of their fields."""
    return _nearest_words(spark, d, _words(spark, d))


def _nearest_words(spark, d, words):
    return similarity.nearest_coded(words, 5, _asked(spark, d), 4, positive=False).select("src", "dst", "score")


@query(f"{_LEXICAL}, best AS (SELECT src, dst FROM lex QUALIFY row_number() OVER (PARTITION BY src ORDER BY round(lexical, 4) DESC, dst) <= 5), r AS (SELECT * FROM p JOIN best USING (src, dst) QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY contains(feature, '-') DESC, round(part, 12) DESC, feature) <= 3) SELECT src, dst, string_agg(feature, ',' ORDER BY contains(feature, '-') DESC, round(part, 12) DESC, feature) AS why FROM r GROUP BY ALL")
def q_related_reasons(spark, d):
    """What the five records share with their query that adds most."""
    words = _words(spark, d)
    pairs = settled(_nearest_words(spark, d, words).select("src", "dst"), "pairs")
    return similarity.explained(pairs, words).where("terms is not null").select("src", "dst", F.array_join("terms", ",").alias("why"))


@query(f"WITH {_MEMBERS}, {_COSINES} SELECT src, dst, round(cosine, 4) AS cosine FROM cos")
def q_entity_cosine(spark, d):
    """Cosine of shared entities, each weighted by its squared idf."""
    found = _members(spark, d).withColumnRenamed("doc_id", "id")
    return similarity.entity_cosine(found, table(spark, d, "documents").count(), _asked(spark, d)).select("src", "dst", F.round("cosine", 4).alias("cosine"))


@query(f"""{_LEXICAL}, {_MEMBERS}, {_COSINES},
pairs AS (SELECT src, dst, round(least(1.0, coalesce(lexical, 0) + {similarity.ENTITY_WEIGHT}::DOUBLE * coalesce(cosine, 0)), 6) AS score FROM lex FULL JOIN cos USING (src, dst)),
best AS (SELECT * FROM pairs WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) <= 5),
short AS (SELECT DISTINCT id AS src FROM f WHERE id % 20 = 0 AND id NOT IN (SELECT src FROM best WHERE score > {similarity.FLOOR} GROUP BY 1 HAVING count(*) >= 5)),
flat AS (SELECT DISTINCT id, feature, df FROM f JOIN df USING (feature) WHERE df > 1),
crossed AS (SELECT a.id AS src, b.id AS dst, feature, a.df FROM flat a JOIN flat b USING (feature) WHERE a.id IN (SELECT src FROM short) AND a.id <> b.id AND NOT EXISTS (SELECT 1 FROM pairs WHERE pairs.src = a.id AND pairs.dst = b.id)),
few AS (SELECT * FROM crossed QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY df, contains(feature, '-') DESC, feature) <= 3),
low AS (SELECT src, dst, round(least({similarity.FLOOR}::DOUBLE, sum(1.0::DOUBLE / df) / 100.0), 6) AS score, string_agg(feature, ',' ORDER BY df, contains(feature, '-') DESC, feature) AS why FROM few GROUP BY ALL),
ents AS (SELECT src, dst, entity, df FROM best JOIN m a ON a.doc_id = src JOIN m b ON b.doc_id = dst AND b.entity = a.entity JOIN e ON e.entity = a.entity QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY df, a.entity) <= 3),
ewhy AS (SELECT src, dst, string_agg(entity, ',' ORDER BY df, entity) AS why FROM ents GROUP BY ALL),
terms AS (SELECT * FROM p JOIN best USING (src, dst) QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY contains(feature, '-') DESC, round(part, 12) DESC, feature) <= 3),
twhy AS (SELECT src, dst, string_agg(feature, ',' ORDER BY contains(feature, '-') DESC, round(part, 12) DESC, feature) AS why FROM terms GROUP BY ALL),
every AS (SELECT src, dst, score, coalesce(ewhy.why, twhy.why) AS why FROM best LEFT JOIN ewhy USING (src, dst) LEFT JOIN twhy USING (src, dst) UNION ALL SELECT * FROM low WHERE score > 0)
SELECT *, (row_number() OVER (PARTITION BY src ORDER BY score DESC, dst))::INTEGER AS rnk FROM every QUALIFY rnk <= 5""".replace("SELECT src, dst, entity, df FROM best JOIN m a", "SELECT src, dst, a.entity AS entity, df FROM best JOIN m a"))
def q_related(spark, d):
    """Five related records of each query, by whole texts and entities, with reasons."""
    r = similarity.related(_fields(spark, d), _members(spark, d).withColumnRenamed("doc_id", "id"), table(spark, d, "documents").count(), queries=_asked(spark, d))
    return r.select("src", "dst", "score", F.array_join("why", ",").alias("why"), "rnk")


@query(f"""{_VECTORS}, {_MEMBERS}, {_COSINES.replace("WHERE a.doc_id % 20 = 0 AND", "WHERE")},
lex AS (SELECT a.id AS src, b.id AS dst, sum(CASE field WHEN 'title' THEN {similarity.WEIGHTS['title']} ELSE {similarity.WEIGHTS['brief']} END::DOUBLE * a.w * b.w) AS lexical FROM v a JOIN v b USING (field, feature) WHERE a.id <> b.id GROUP BY ALL),
pairs AS (SELECT src, dst, round(least(1.0, coalesce(lexical, 0) + {similarity.ENTITY_WEIGHT}::DOUBLE * coalesce(cosine, 0)), 6) AS score FROM lex FULL JOIN cos USING (src, dst))
SELECT src, dst, score, (row_number() OVER (PARTITION BY src ORDER BY score DESC, dst))::INTEGER AS rnk FROM pairs WHERE score > 0 QUALIFY rnk <= 5""")
def q_related_all(spark, d):
    """The five records most like every record, by whole texts and entities."""
    n = table(spark, d, "documents").count()
    found = _members(spark, d).withColumnRenamed("doc_id", "id")
    return similarity.nearest_coded(similarity.coded_records(_fields(spark, d), found, n))


@query("SELECT user_id AS entity, count(*) AS n, sha256(string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id)) AS ids FROM events GROUP BY 1 HAVING count(*) >= 2")
def q_threads(spark, d):
    """Events of a user in order of time."""
    t = threads.topics(table(spark, d, "events").select(F.col("user_id").cast("string").alias("entity"), F.col("event_id").alias("id"), F.col("ts").alias("at")))
    return t.select(F.col("entity").cast("long").alias("entity"), "n", F.sha2(F.array_join(t.ids.cast("array<string>"), ","), 256).alias("ids"))


@query(f"{_WORDS}, m AS ({_TERM_ROWS}), t AS (SELECT entity, count(*) AS n FROM m GROUP BY 1 HAVING count(*) >= 2) SELECT doc_id, entity FROM (SELECT m.*, n, contains(' ' || left(w, 40) || ' ', ' ' || entity || ' ') AS in_title FROM m JOIN t USING (entity) JOIN w USING (doc_id)) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY in_title DESC, n, entity) = 1")
def q_default_topic(spark, d):
    """The topic of a text: one of its first words before others, then the narrowest."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("  "), F.substring(F.concat(F.lit(" "), plain(F.col("text")), F.lit(" ")), 1, 40), F.lit(" ")).alias("head"))
    m = _members(spark, d).withColumnRenamed("doc_id", "id").join(docs, "id").withColumn("in_title", F.contains("head", F.concat(F.lit(" "), "entity", F.lit(" "))))
    topics = m.groupBy("entity").agg(F.count("*").alias("n")).where("n > 1").withColumn("label", index.label(F.col("entity")))
    return threads.default_topic(m.select("entity", "id", "in_title"), topics).select(F.col("id").alias("doc_id"), "entity")


@query("WITH m AS (SELECT event_type || '-' || (user_id % 50) AS e, event_id AS id, ts FROM events), b AS (SELECT e, count(*) AS breadth FROM m GROUP BY 1 HAVING count(*) <= 0.07 * (SELECT count(*) FROM events)), p AS (SELECT x.id AS src, y.id AS dst, min(breadth) AS breadth, min(y.ts) AS t FROM m x JOIN b USING (e) JOIN m y USING (e) WHERE y.ts > x.ts GROUP BY ALL) SELECT src, dst, breadth FROM p QUALIFY row_number() OVER (PARTITION BY src ORDER BY breadth, t, dst) <= 5")
def q_follow_ups(spark, d):
    e = table(spark, d, "events")
    m = e.select(F.concat_ws("-", "event_type", (F.col("user_id") % 50).cast("string")).alias("entity"), F.col("event_id").alias("id"), F.col("ts").alias("at"))
    return threads.follow_ups(m, e.count()).select("src", "dst", "breadth")


# Ordering and counts


@query("SELECT n_name AS slug, (row_number() OVER (ORDER BY r_name DESC, n_nationkey % 4, n_name DESC) - 1)::BIGINT AS pos FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_catalogue_order(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = n.select((F.col("n_nationkey") % 4).cast("string").alias("source"), F.col("n_name").alias("slug"), F.col("r_name").alias("post_date"))
    return index.catalogue(a, {str(i): i for i in range(4)}).select("slug", F.col("pos").cast("long").alias("pos"))


@query("SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, max(n_chars) AS longest FROM documents GROUP BY 1")
def q_source_counts(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("lang").alias("langs"), F.max("n_chars").alias("longest"))


@query("SELECT o_custkey, label FROM (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS label, count(*) AS n FROM orders GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, label = lower(label), lower(label), label) = 1")
def q_manager_mode(spark, d):
    """The commonest spelling of a customer's priorities."""
    label = F.when(F.col("o_orderkey") % 3 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return rows.mode_label(table(spark, d, "orders").select("o_custkey", label.alias("label")), "o_custkey", "label").select("o_custkey", "label")


@query("SELECT w AS label, count(*) AS passages, count(DISTINCT p_brand) AS notes FROM (SELECT DISTINCT p_partkey, p_brand, unnest(string_split(p_name || ' ' || p_name, ' ')) AS w FROM part) GROUP BY 1")
def q_underlying_facets(spark, d):
    """Words of names: each counted once in a part, and by brands."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.explode(F.split(F.concat_ws(" ", "p_name", "p_name"), " ")).alias("w"))
    return search.facets(p, "w", F.col("w"), "p_partkey", "p_brand").select("label", "passages", "notes")


@query("SELECT role, count(*) AS passages, count(DISTINCT conv_id) AS notes, count(DISTINCT CASE WHEN regexp_matches(text, '[0-9]') THEN conv_id END) AS notes_with_quant, count(DISTINCT CASE WHEN contains(text, chr(10)) THEN conv_id END) AS notes_with_outcome FROM conversations WHERE role = 'user' GROUP BY 1")
def q_note_cluster(spark, d):
    """Turns of users against the conversations they stand in."""
    c = table(spark, d, "conversations").where("role = 'user'")
    one = c.select("conv_id", F.when(F.col("text").rlike("[0-9]"), "y").alias("quant"), F.when(F.col("text").contains("\n"), "y").alias("outcome"))
    return search.note_summary(one, "conv_id").select(F.lit("user").alias("role"), "*")


# Search and contracts


@query("WITH h AS (SELECT p_partkey, CASE WHEN lower(p_brand) LIKE '%hot%' THEN 0 WHEN contains(lower(p_name), 'ring') AND contains(lower(p_name), 'small') THEN 1 WHEN contains(lower(p_type || ' ' || p_name), 'ring') AND contains(lower(p_type || ' ' || p_name), 'small') THEN 2 END AS t FROM part) SELECT p_partkey, ['exact', 'subject', 'related', 'mention'][t + 1] AS tier, CASE WHEN t = (SELECT min(t) FROM h) AND t < 3 THEN 'primary' ELSE 'related' END AS part FROM h WHERE t IS NOT NULL")
def q_search_tiers(spark, d):
    hits = search.tiered(table(spark, d, "part"), "small ring", {"exact": ["p_brand"], "subject": ["p_name"], "related": ["p_type", "p_name"]})
    return hits.select("p_partkey", "tier", "part")


def _starts(spark, d):
    """(item_id, doc_id, item): documents with an item's first eight words, or all words of a shorter one, found by windows of each length that items have."""
    words = F.split(plain(F.col("text")), " ")
    items = table(spark, d, "benchmark").select("item_id", F.array_join(words, " ").alias("item"), F.slice(words, 1, 8).alias("g")).select("item_id", "item", F.size("g").alias("n"), F.xxhash64("g").alias("h"))
    w = table(spark, d, "documents").select("doc_id", words.alias("w")).crossJoin(F.broadcast(items.select("n").distinct())).where(F.size("w") >= F.col("n"))
    wins = w.select("doc_id", "n", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - F.col("n")), lambda i: F.xxhash64(F.slice(F.col("w"), i + 1, F.col("n"))))).alias("h"))
    return wins.join(items, ["n", "h"]).select("item_id", "doc_id", "item")


@query("SELECT DISTINCT i.item_id, d.doc_id FROM (SELECT item_id, ' ' || {0} || ' ' AS g FROM benchmark) i JOIN (SELECT doc_id, ' ' || {0} || ' ' AS w FROM documents) d ON contains(w, g)".format(PLAIN.format("text")))
def q_item_contain(spark, d):
    """Documents that hold a whole item, word for word; its first words find the candidates."""
    docs = table(spark, d, "documents").select("doc_id", plain(F.col("text")).alias("w"))
    held = F.contains(F.concat(F.lit(" "), "w", F.lit(" ")), F.concat(F.lit(" "), "item", F.lit(" ")))
    return _starts(spark, d).distinct().join(docs, "doc_id").where(held).select("item_id", "doc_id").distinct()


@query("SELECT rule, key FROM (SELECT 'length' AS rule, doc_id::VARCHAR AS key FROM documents WHERE n_chars <> length(text) OR length(text) < 60 UNION ALL SELECT 'language', doc_id::VARCHAR FROM documents WHERE lang NOT IN ('en', 'de', 'fr') UNION ALL SELECT 'label without text', doc_id::VARCHAR FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 10 <> 3) UNION ALL SELECT 'unique text', md5(text) FROM documents GROUP BY text HAVING count(*) > 1)")
def q_violations(spark, d):
    docs = table(spark, d, "documents")
    rules = {"length": (F.col("n_chars") == F.length("text")) & (F.length("text") >= 60), "language": F.col("lang").isin("en", "de", "fr")}
    return contracts.together(
        contracts.violations(docs, F.col("doc_id"), rules), contracts.repeats(docs, F.md5("text"), "unique text"),
        contracts.orphans(table(spark, d, "labels"), docs.where("doc_id % 10 <> 3"), "doc_id", "doc_id", "label without text"),
    )


@query()
def q_briefs(spark, d):
    """Briefs of whole texts, flattened."""
    b = table(spark, d, "documents").select("doc_id", brief("text", F.lit(""), F.lit("2024-01-01")).alias("b"))
    return b.select("doc_id", "b.body_sha256", F.col("b.lead.text").alias("lead"), F.col("b.lead.start").alias("lead_start"), F.size("b.sections").alias("sections"), F.col("b.fallback_evidence.text").alias("evidence"))


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'unspecified' ELSE 'short' END AS direction, turn % 3 < 2 AS negation_risk FROM conversations")
def q_negation(spark, d):
    """Directions of passages; turns of conversations stand in for passages."""
    t = F.concat(F.when(F.col("turn") % 3 == 0, "The fund never went long oil. ").when(F.col("turn") % 3 == 1, "It was not long oil but went short airline stocks. ").otherwise("It bought puts on the index. "), F.coalesce("text", F.lit("")))
    return table(spark, d, "conversations").select("conv_id", "turn", O.direction(t).alias("direction"), O.negation_risk(t).alias("negation_risk"))


