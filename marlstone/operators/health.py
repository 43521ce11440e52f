"""State from snapshot to snapshot: degradation streaks, persistence, lineage of windows, regression floors, body resolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import sortable
from ..functions.text import compatible_surface
from .rows import numbered

# Policy (fixed values).
PERSISTENT_HOURS, FLOOR, OBSERVATION_FLOOR, COVERAGE = 48, 0.90, 0.50, 0.97


def advance(current: DataFrame, previous: DataFrame) -> DataFrame:
    """One step: a degraded source keeps its since and counts on; a healthy one has neither. Both tables are keyed by source."""
    p = previous.select("source", F.col("degraded_since").alias("__since"), F.col("consecutive_degraded_checks").alias("__n"))
    bad = F.col("status") != "ok"
    going = F.coalesce(F.col("__n"), F.lit(0)) > 0
    return current.join(p, "source", "left").withColumns({
        "degraded_since": F.when(bad, F.when(going, F.col("__since")).otherwise(F.col("checked_at"))),
        "consecutive_degraded_checks": F.when(bad, F.when(going, F.col("__n") + 1).otherwise(1)).otherwise(0),
    }).drop("__since", "__n")


def streaks(history: DataFrame, key: str, at: str, degraded: Column) -> DataFrame:
    """history with since and n of the streak each check is in; null and 0 for healthy checks. One sort per key."""
    order = Window.partitionBy(key).orderBy(at)
    island = history.withColumn("__bad", F.coalesce(degraded, F.lit(False))).withColumn("__run", F.sum((~F.col("__bad")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(key, "__run", "__bad").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumns({"since": F.when(F.col("__bad"), F.min(at).over(run)), "n": F.when(F.col("__bad"), F.count("*").over(run)).otherwise(0).cast("long")}).drop("__bad", "__run")


def persistent(rows: DataFrame, now: Column, hours: int = PERSISTENT_HOURS) -> DataFrame:
    """Rows whose streak is `hours` old or older."""
    return rows.where(F.col("since").isNotNull() & (F.timestamp_diff("HOUR", F.col("since"), now) >= hours))


def regressions(old: DataFrame, new: DataFrame, key: str, floor: float = FLOOR) -> DataFrame:
    """Keys of which new has fewer than floor of old's rows: (key, before, after)."""
    a, b = old.groupBy(key).agg(F.count("*").alias("before")), new.groupBy(key).agg(F.count("*").alias("after"))
    return a.join(b, key, "left").withColumn("after", F.coalesce("after", F.lit(0).cast("long"))).where(F.col("after") < floor * F.col("before"))


def lineage(window: DataFrame, history: DataFrame) -> DataFrame:
    """Faults of a newest-first window (pos, id, at) against its history (pos, id, at): one row per fault.

    The rows of the window that history knows must be the window's tail and history's head, in the same order and with the same times.
    """
    seen = window.join(history.select("id", F.col("pos").alias("h"), F.col("at").alias("h_at")), "id", "left")
    first = seen.agg(F.min(F.when(F.col("h").isNotNull(), F.col("pos"))).alias("first"), F.count("h").alias("known"))
    at = seen.join(F.broadcast(first), F.lit(True))
    fault = F.when(F.col("first").isNull(), "no overlap").when((F.col("pos") >= F.col("first")) & F.col("h").isNull(), "gap").when(F.col("h") != F.col("pos") - F.col("first"), "order").when(F.col("at") != F.col("h_at"), "time")
    return at.select("pos", "id", fault.alias("fault")).where("fault is not null")


def merge_window(window: DataFrame, history: DataFrame) -> DataFrame:
    """The window's rows and the history it doesn't cover."""
    return window.unionByName(history.join(window.select("id"), "id", "left_anti"))


def window_rules(windows: DataFrame, size: int = 10) -> DataFrame:
    """(feed, fault, key) of feed windows (feed, pos, id, url, at): repeats, wrong order, wrong size."""
    rows = windows.withColumn("__before", F.lag("at").over(Window.partitionBy("feed").orderBy("pos")))
    wrong = rows.where(F.col("__before") < F.col("at")).select("feed", F.lit("order").alias("fault"), F.col("id").cast("string").alias("key"))
    again = lambda c: windows.groupBy("feed", c).agg(F.count("*").alias("n")).where("n > 1").select("feed", F.lit(f"repeated {c}").alias("fault"), F.col(c).cast("string").alias("key"))
    count = windows.groupBy("feed").agg(F.count("*").alias("n")).where(F.col("n") != size).select("feed", F.lit("size").alias("fault"), F.col("n").cast("string").alias("key"))
    return wrong.unionByName(again("id")).unionByName(again("url")).unionByName(count)


def body_status(current_words: Column, captured_words: Column, same_revision: Column, cached: Column) -> Column:
    """Where a body comes from: complete in the list, cached and valid, excerpt, or metadata only."""
    whole = captured_words >= F.ceil(COVERAGE * current_words)
    return F.when(whole & (captured_words > 0), "list").when(cached & same_revision, "cache").when(captured_words > 0, "excerpt").when(cached, "prior").otherwise("metadata")


def cache_fits(listing: Column, cached: Column) -> Column:
    """Whether a cached row may stand for a listed one: complete by its declared words, of the same revision, and with titles that don't conflict."""
    complete = F.regexp_count(F.coalesce(cached.body_text, F.lit("")), F.lit("\\S+")) >= F.ceil(COVERAGE * F.coalesce(listing.wordcount, F.lit(0)))
    return F.coalesce(complete & (F.coalesce(cached.body_text, F.lit("")) != "") & (listing.updated_at == cached.updated_at) & compatible_surface(listing.title, cached.title), F.lit(False))


def resolved(current: DataFrame, previous: DataFrame) -> DataFrame:
    """current (slug, title, updated_at, wordcount, body_text) with the body that a refresh keeps, where it comes from, and the status of its revision.

    The listing's own body if complete, else the cached one if it fits, else what the listing shows, else the cached one of an older revision, else nothing.
    """
    both = current.alias("c").join(previous.select("slug", F.struct("title", "updated_at", "body_text").alias("__old")), "slug", "left")
    listed = F.coalesce("body_text", F.lit(""))
    kept = F.coalesce(F.col("__old.body_text"), F.lit(""))
    here = F.struct("title", "updated_at", "wordcount")
    words = F.regexp_count(listed, F.lit("\\S+"))
    origin = body_status(F.coalesce("wordcount", F.lit(0)), words, cache_fits(here, F.col("__old")), kept != "")
    revision = F.when(origin.isin("list", "cache", "excerpt"), "current").when((origin == "prior") & F.col("__old.updated_at").isNotNull(), "prior").otherwise("unverified")
    body = F.when(origin.isin("cache", "prior"), kept).otherwise(listed)
    return both.withColumns({"body_origin": origin, "body_revision_status": revision, "content_status": F.when(origin.isin("list", "cache"), "full").otherwise("excerpt"), "__body": body}).drop("body_text", "__old").withColumnRenamed("__body", "body_text")


def degrades(current: DataFrame, previous: DataFrame, stable: list[str]) -> DataFrame:
    """(slug, degrades): whether a gap in a body is a live failure. It isn't for members' posts, nor where an excerpt was disclosed before and neither revision nor metadata has changed."""
    old = previous.select("slug", F.struct("content_status", "updated_at", *stable).alias("__old"))
    both = current.join(old, "slug", "left")
    o = F.col("__old")
    same = reduce(lambda a, f: a & F.col(f).eqNullSafe(o[f]), stable, F.col("updated_at").eqNullSafe(o.updated_at) & (F.coalesce("updated_at", F.lit("")) != ""))
    known = o.isNotNull() & (o.content_status == "excerpt") & same
    return both.select("slug", ((F.col("audience") == "everyone") & ~F.coalesce(known, F.lit(False))).alias("degrades"))


def edge(window: DataFrame, archive: DataFrame, size: int = 10) -> DataFrame:
    """Faults between a feed window (pos, id, at) and the newest rows of an archive (id, at): places where id or time differ, and a window of the wrong size."""
    newest = archive.orderBy(F.desc("at"), "id").limit(size)
    ranked = newest.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("at"), "id")) - 1).select("pos", F.col("id").alias("a_id"), F.col("at").alias("a_at"))
    both = window.join(ranked, "pos", "full_outer")
    fault = F.when(F.col("id").isNull() | F.col("a_id").isNull(), "size").when(F.col("id") != F.col("a_id"), "id").when(F.col("at") != F.col("a_at"), "time")
    return both.select("pos", fault.alias("fault")).where("fault is not null")


def bridged(rows: DataFrame, reviewed: DataFrame, now: Column, days: int = 3) -> DataFrame:
    """Faults of rows (pos, id) against a reviewed sequence (pos, id, reviewed_at): the same ids in the same order, reviewed at most `days` ago and not in the future."""
    both = rows.select("pos", F.col("id").alias("__id")).join(reviewed, "pos", "full_outer")
    age = F.timestamp_diff("SECOND", F.col("reviewed_at"), now)
    fault = F.when(F.col("id").isNull() | F.col("__id").isNull(), "length").when(F.col("id") != F.col("__id"), "order").when((age < 0) | (age > days * 86400), "expired")
    return both.select("pos", fault.alias("fault")).where("fault is not null")


def bridge_provenance(reviewed: DataFrame) -> DataFrame:
    """What a status tells of a reviewed bridge: one row of its source, rows, ends, time and reviewer."""
    first, last = F.min_by("id", "pos"), F.max_by("id", "pos")
    return reviewed.groupBy("source", "reviewer").agg(F.count("*").alias("rows"), first.alias("first_id"), last.alias("last_id"), F.max("reviewed_at").alias("reviewed_at"))


def trusted_order(history: DataFrame) -> DataFrame:
    """History (id, date) by instant, the newest first; ids break ties."""
    return history.withColumn("instant", sortable(F.col("date"))).orderBy(F.desc("instant"), "id")


def retry_order(rows: DataFrame) -> DataFrame:
    """rows (is_new, attempted_at, idx) with turn: new ones, those never tried, then the longest untried."""
    kind = F.when(F.col("is_new"), 0).when(F.col("attempted_at").isNull() | (F.col("attempted_at") == ""), 1).otherwise(2)
    keyed = rows.withColumns({"__k": kind, "__a": F.coalesce("attempted_at", F.lit(""))})
    return numbered(keyed, ["__k", "__a", "idx"], "turn").withColumn("turn", F.col("turn") + 1).drop("__k", "__a")
