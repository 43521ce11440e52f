"""Posts of each publication in one shape, and what becomes of their bodies from run to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..functions.text_udf import strip_html
from .rows import first_per

# Share of declared words that makes a body complete; share of a previous registry that a refresh must reach; lost rows allowed (fixed values).
COMPLETE, REGISTRY_SHARE, LOST, LOST_SHARE = 0.97, 0.85, 5, 0.10
PARAGRAPH = "array<struct<type:string,text:string,href:string>>"


def public_body(df: DataFrame) -> DataFrame:
    return df.where(F.col("audience") == "everyone")


def canonical(df: DataFrame, source: str) -> DataFrame:
    """Defaults filled in; a post whose body isn't of the current revision counts as an excerpt."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    fresh = F.coalesce(F.col("body_revision_status"), F.lit("current")) == "current"
    status = F.when(fresh, F.coalesce("content_status", F.lit("current"))).otherwise("excerpt").alias("content_status")
    return df.select(F.lit(source).alias("source"), *map(text, ("source_id", "slug", "title", "subtitle", "post_date", "url")), F.coalesce("audience", F.lit("everyone")).alias("audience"), F.coalesce("wordcount", F.lit(0)).alias("wordcount"), F.coalesce("body_text", F.lit("")).alias("body_text"), status)


def normalised(df: DataFrame) -> DataFrame:
    """An excerpt declares no words; unknown access counts as paid."""
    return df.withColumns({"wordcount": F.when(F.col("content_status") == "excerpt", 0).otherwise(F.col("wordcount")), "audience": F.when(F.col("audience").isin("everyone", "only_paid"), F.col("audience")).otherwise("only_paid")})


# What a paragraph says that points to the same work elsewhere (fixed value).
PROMO_MARKER = "read this article free on substack"


def from_paragraphs(df: DataFrame, marker: str = "") -> DataFrame:
    """Posts given as paragraphs (type, text, href): title from the first three if they hold a heading, subtitle from the first eight, body of all.

    With a marker only a paragraph that says it proves a mirror by its link, and none that says it is a subtitle.
    """
    p = F.col("paragraphs")
    heading = F.filter(F.slice(p, 1, 3), lambda x: x.type.isin("H1", "H2", "H3"))
    sub = F.filter(F.slice(p, 1, 8), lambda x: (x.type == "P") & (F.length(F.trim(x.text)) > 0) & (~F.lower(x.text).contains(marker) if marker else F.lit(True)))
    mirror = F.filter(p, lambda x: F.lower(F.coalesce(x.text, F.lit(""))).contains(marker) & x.href.rlike("^https://[a-z0-9-]+\\.substack\\.com/p/"))
    return df.withColumns({
        "title": F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.get(heading, 0).text), "subtitle": F.get(sub, 0).text, "body_text": F.array_join(F.transform(p, lambda x: x.text), "\n\n"),
        "mirror_substack_slug": F.nullif(F.regexp_extract(F.get(mirror, 0).href, "/p/([a-z0-9-]+)", 1), F.lit("")), "post_date": D.from_epoch_millis(F.col("published_millis")),
    })


def from_feed(items: DataFrame) -> DataFrame:
    """Feed items as current excerpts."""
    return items.select(F.col("guid").alias("source_id"), "title", F.col("link").alias("url"), F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("post_date"), strip_html("description").alias("body_text"), F.lit("excerpt").alias("content_status"), F.lit(0).alias("wordcount"))


def live_or_carried(df: DataFrame, live: Column) -> DataFrame:
    """Live rows are current, seen at publication; carried ones are unverified excerpts without times of their own."""
    return df.withColumns({"content_status": F.when(live, "current").otherwise("excerpt"), "body_revision_status": F.when(live, "current").otherwise("unverified"), "observed_source_updated_at": F.when(live, F.col("post_date")).otherwise("")})


def complete(words: Column, declared: Column) -> Column:
    return words >= F.ceil(COMPLETE * declared)


def preserved(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Current metadata with the previous body where the current has none; the status says how the two revisions stand."""
    old = previous.select("slug", F.col("body_text").alias("__body"), F.col("source_updated_at").alias("__at"))
    both = current.join(old, "slug", "left")
    lacks, kept = F.coalesce("body_text", F.lit("")) == "", F.coalesce("__body", F.lit("")) != ""
    same = F.col("source_updated_at") == F.col("__at")
    status = F.when(~lacks, "current").when(kept & same, "current").when(kept & same.isNotNull(), "prior").when(kept, "unverified").otherwise("missing")
    return both.withColumns({"body_revision_status": status, "body_text": F.when(lacks & kept, F.col("__body")).otherwise(F.col("body_text"))}).drop("__body", "__at")


def status_rows(df: DataFrame) -> DataFrame:
    """Old names of states put right, the mode derived from the state where it is missing."""
    state = F.when(F.col("status") == "fresh", "ok").when(F.col("status") == "cached-fallback", "degraded").otherwise(F.col("status"))
    return df.withColumn("status", state).withColumn("mode", F.coalesce("mode", F.when(F.col("status") == "ok", "live").otherwise("cache")))


def newest(df: DataFrame, key: str = "source") -> DataFrame:
    """The latest publication of each source, as it was written."""
    return df.groupBy(key).agg(F.max_by("post_date", D.instant(F.col("post_date"))).alias("newest"))


def representatives(df: DataFrame, key: str, kind: str) -> DataFrame:
    """The row with the greatest key of each kind."""
    return first_per(df, [kind], [F.desc(key)])


def refresh_registry(new: DataFrame, old: DataFrame) -> tuple[DataFrame, str]:
    """The refreshed registry, or the old one if the new has shrunk below the share; and which it is."""
    n, before = new.count(), old.count()
    return (new, "live") if n >= REGISTRY_SHARE * before else (old, "cached")


def lost_too_many(old: DataFrame, new: DataFrame, key: str) -> bool:
    gone = old.select(key).distinct().join(new.select(key), key, "left_anti").count()
    return gone > max(LOST, int(LOST_SHARE * old.select(key).distinct().count()))


def attached(lines: DataFrame, heading: Column, prose: Column) -> DataFrame:
    """Lines (doc, pos, text) that are headings with the next line, where that is prose and no heading."""
    w = Window.partitionBy("doc").orderBy("pos")
    rows = lines.withColumns({"__h": heading, "__p": prose})
    nxt = rows.withColumns({"passage": F.lead("text").over(w), "__np": F.lead("__p").over(w), "__nh": F.lead("__h").over(w)})
    return nxt.where(F.col("__h") & F.col("__np") & ~F.col("__nh")).select("doc", "pos", F.col("text").alias("heading"), "passage")


def periods(df: DataFrame, day: str) -> DataFrame:
    """Rows by year, the newest first."""
    return df.groupBy(F.substring(day, 1, 4).alias("year")).agg(F.count("*").alias("n")).orderBy(F.desc("year"))


def rebased(df: DataFrame, at: str, delta_seconds: int) -> DataFrame:
    """All times moved by one delta."""
    return df.withColumn(at, F.timestamp_add("SECOND", F.lit(delta_seconds), F.col(at)))


def surface(df: DataFrame) -> DataFrame:
    """Rows whose cached title (title, old_title) still fits the listing."""
    return df.where(X.compatible_surface(F.col("title"), F.col("old_title")))
