"""Contracts: rules over tables, each broken rule one row (rule, key). Nothing is raised until the caller asks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import observe as O
from ..functions import urls as U

# Allowed values, and names that must never be published (fixed values).
SOURCES = ("substack", "medium", "patreon", "fxempire")
AUDIENCES = ("everyone", "only_paid")
STATUSES = ("current", "excerpt", "registry")
PRIVATE = ("email", "phone", "address", "token", "cookie", "password", "secret", "ip")


def violations(df: DataFrame, key: Column, rules: Mapping[str, Column]) -> DataFrame:
    """One row for each rule that a row of df breaks; a rule that comes out null is broken. One pass over df."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())
    return df.select(F.explode(broken).alias("rule"), key.cast("string").alias("key"))


def repeats(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(name).alias("rule"), "key")


def orphans(df: DataFrame, other: DataFrame, key: str, other_key: str, name: str) -> DataFrame:
    """Keys of df that other lacks."""
    return df.select(F.col(key).alias("key")).join(other.select(F.col(other_key).alias("key")), "key", "left_anti").select(F.lit(name).alias("rule"), F.col("key").cast("string"))


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def article_rules() -> dict[str, Column]:
    c = F.col
    text = lambda n: F.length(F.trim(c(n))) > 0
    return {
        "source": c("source").isin(*SOURCES), "slug": text("slug"), "title": text("title") & (F.trim("title") == c("title")), "url": c("url").startswith("https://"), "url source": U.publication(c("url")) == c("source"),
        "date": D.instant(c("post_date")).isNotNull(), "audience": c("audience").isin(*AUDIENCES), "status": c("content_status").isin(*STATUSES), "wordcount": c("wordcount") >= 0,
        "registry without words": (c("content_status") != "registry") | (c("wordcount") == 0),
        "no link to itself": c("alternate_urls").isNull() | ~F.map_contains_key("alternate_urls", c("source")),
    }


def articles(df: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "source", "slug")
    return together(violations(df, key, article_rules()), repeats(df, F.col("slug"), "unique slug"), repeats(df, F.col("url"), "unique url"), repeats(df, F.concat_ws(":", "source", F.lower("source_id")), "unique id"))


def preview_proof(df: DataFrame, most: int = 1200) -> DataFrame:
    """Members' rows show a bounded preview whose length and digest are its own, under a surface that fits; public rows show none."""
    p, member = F.col("member_preview"), F.coalesce(F.col("audience") == "only_paid", F.lit(False))
    empty = p.character_count == 0
    return violations(df, F.col("slug"), {
        "preview of members only": member == p.isNotNull(), "preview length": p.isNull() | (F.length(p.text) == p.character_count), "preview bound": p.isNull() | p.character_count.between(0, most),
        "preview digest": p.isNull() | (F.sha2(p.text, 256) == p.body_sha256), "preview surface": p.isNull() | ((p.surface == "metadata-only") == empty),
    })


def evidence(observations: DataFrame) -> DataFrame:
    """Fields of observations that their passage doesn't yield again."""
    d = F.col("trade_description")
    same = lambda a, b: a.eqNullSafe(b)
    return violations(observations, F.concat_ws("#", "article_url", F.substring(F.sha2(d, 256), 1, 8)), {
        "instruments": same(F.col("instruments"), O.instruments(d)), "direction": same(F.col("direction"), O.direction(d)), "quantities": same(F.col("any_quant_detail"), O.quantities(d)),
        "outcome": same(F.col("outcome_if_mentioned"), O.outcome(d)), "thesis": same(F.col("edge_or_thesis"), O.thesis(d)), "length": F.length(d).between(51, 800),
        "underlying": same(F.col("underlying"), O.underlying(d)), "fund": same(F.col("fund_name_if_mentioned"), F.coalesce(O.fund(d), O.fund(F.col("article_title")))), "truncated": F.col("description_truncated").isNotNull(),
    })


def spans(briefs: DataFrame, body: str, span: str) -> DataFrame:
    """Spans that aren't the body's text at their offsets, or whose digest is wrong."""
    s = F.col(span)
    return violations(briefs.where(s.isNotNull()), F.col("slug"), {"text": F.expr(f"substring({body}, {span}.start + 1, {span}.end - {span}.start)") == s.text, "sha256": F.sha2(s.text, 256) == s.sha256})


def curve(df: DataFrame) -> DataFrame:
    finite = {n: F.col(n).isNotNull() & ~F.isnan(n) & (F.abs(F.col(n)) < 100) for n in ("m3", "y2", "y5", "y10", "y30")}
    return together(violations(df, F.col("day"), {"day": D.day(F.col("day")).isNotNull(), **finite}), repeats(df, F.col("day"), "unique day"))


def health_rows(df: DataFrame) -> DataFrame:
    bad, n, since = F.col("status") != "ok", F.col("consecutive_degraded_checks"), F.col("degraded_since")
    return violations(df, F.col("source"), {"both or neither": since.isNotNull() == (n > 0), "healthy has none": bad | (n == 0), "degraded has one": ~bad | (n > 0), "since before check": since.isNull() | (D.instant(since) <= D.instant(F.col("checked_at")))})


def fresh(df: DataFrame, now: Column, hours: int = 16) -> DataFrame:
    """Checks from the future or too old."""
    at = D.instant(F.col("checked_at"))
    return violations(df, F.col("source"), {"future": at <= now + F.expr("INTERVAL 10 MINUTES"), "age": at >= now - F.make_interval(hours=F.lit(hours))})


def fresh_manifest(sources: DataFrame, manifest_at: Column, now: Column, hours: int = 16) -> DataFrame:
    """Sources (source, checked_at) of a manifest that were checked after it, ahead of the clock by more than ten minutes, more than an hour before the manifest, or too long ago."""
    at, made = D.instant(F.col("checked_at")), D.instant(manifest_at)
    return violations(sources, F.col("source"), {
        "not after the manifest": at <= made, "future": at <= now + F.expr("INTERVAL 10 MINUTES"), "behind the manifest": at >= made - F.expr("INTERVAL 1 HOUR"), "age": at >= now - F.make_interval(hours=F.lit(hours)),
        "manifest in the future": made <= now + F.expr("INTERVAL 10 MINUTES"),
    })


def private_names(names: Sequence[str]) -> list[str]:
    """Of field names those that speak of persons or access, however they are spelled."""
    bare = lambda n: re.sub("[^a-z0-9]", "", n.lower())
    return [n for n in names if bare(n) in {bare(p) for p in PRIVATE}]


def private_keys(df: DataFrame, maps: Sequence[str]) -> DataFrame:
    """Private names among the keys of map columns, and of objects at any depth in JSON text columns: a string with a colon behind it is a key."""
    kinds = dict(df.dtypes)
    tokens = lambda c: F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(r'"((?:[^"\\]|\\.)*+)"(\s*:)?'), F.lit(0))
    named = lambda c: F.transform(F.filter(tokens(c), lambda t: t.endswith(":")), lambda t: F.regexp_extract(t, r'^"(.*)"\s*:$', 1))
    keys = lambda c: F.map_keys(c) if kinds[c].startswith("map") else named(c)
    every = df.select(F.explode(F.concat(*(keys(c) for c in maps))).alias("key"))
    return every.where(F.regexp_replace(F.lower("key"), "[^a-z0-9]", "").isin(*PRIVATE)).groupBy("key").agg(F.count("*").alias("n")).select(F.lit("private key").alias("rule"), "key")


def monotone(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows of source health (source, checked_at, degraded_since, consecutive_degraded_checks, status) that don't continue the previous ones."""
    old = previous.select("source", F.col("checked_at").alias("__at"), F.col("degraded_since").alias("__since"), F.col("consecutive_degraded_checks").alias("__n"))
    both = old.join(current, "source", "left")
    bad, going = F.col("status") != "ok", F.coalesce(F.col("__n"), F.lit(0)) > 0
    since = F.when(bad, F.when(going, F.col("__since")).otherwise(F.col("checked_at")))
    n = F.when(bad, F.when(going, F.col("__n") + 1).otherwise(1)).otherwise(0)
    there = F.col("status").isNotNull()
    return violations(both, F.col("source"), {
        "source is there": there, "check moved on": ~there | (D.instant(F.col("checked_at")) >= D.instant(F.col("__at"))),
        "degraded since": ~there | F.col("degraded_since").eqNullSafe(since), "degraded checks": ~there | (F.coalesce("consecutive_degraded_checks", F.lit(0)) == n),
    })


def curve_years(df: DataFrame, current_year: int, least: int = 200) -> DataFrame:
    """Years of a curve that are over and have fewer than `least` days."""
    n = df.groupBy(F.substring("day", 1, 4).alias("key")).agg(F.count_distinct("day").alias("n"))
    return n.where((F.col("n") < least) & (F.col("key").cast("int") < current_year)).select(F.lit("days of a full year").alias("rule"), "key")


def member_access(df: DataFrame) -> DataFrame:
    """df with member: whether a post is for paying members, by the words of its own source."""
    c = F.col
    return df.withColumn("member", F.coalesce(((c("source") == "substack") & (c("audience") == "only_paid")) | ((c("source") == "medium") & (F.upper("visibility") == "LOCKED")), F.lit(False)))


def snapshot(posts: DataFrame, share: float = 0.97) -> DataFrame:
    """Posts that aren't published, full ones that hold too few of their declared words, and previews that aren't the body."""
    c, p = F.col, F.col("member_preview")
    words = F.regexp_count(F.coalesce("body_text", F.lit("")), F.lit("\\S+"))
    return violations(posts, c("slug"), {"published": c("is_published"), "captured words": (c("content_status") != "full") | (words >= F.ceil(share * c("wordcount"))), "preview is the body": p.isNull() | (p.text == c("body_text"))})


def empty_briefs(articles: DataFrame) -> DataFrame:
    """Rows that only a registry knows and whose brief isn't the empty one."""
    b = F.col("brief")
    nothing = lambda xs: F.coalesce(F.size(xs), F.lit(0)) == 0
    return violations(articles.where("content_status = 'registry'"), F.col("slug"), {"brief is there": b.isNotNull(), "brief is empty": b.lead.isNull() & b.fallback_evidence.isNull() & nothing(b.sections) & nothing(b.checkpoints), "digest of nothing": b.body_sha256 == F.sha2(F.lit(""), 256)})
