"""What a release publishes and what must hold of it: catalogue of all sources, endpoints, wire rows, and comparisons with what they came from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from .contracts import repeats, together, violations
from .rows import digest

# Bounds of published data (fixed values).
SEARCH_BYTES, PREVIEW_CHARS, TIDY_LISTS = 500_000, 1200, ("directions", "instruments", "managers")
REVISIONS = ("current", "prior", "unverified")


# The catalogue


def concatenated(first: DataFrame, *others: tuple[DataFrame, DataFrame | None]) -> DataFrame:
    """All of the first source, and of each other (rows, matched ids) the rows that no earlier source has. Columns that a source lacks are null."""
    kept = [rows if matched is None else rows.join(matched.select("source_id").distinct(), "source_id", "left_anti") for rows, matched in others]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept, first)


def with_alternates(posts: DataFrame, links: DataFrame) -> DataFrame:
    """posts (source, slug) with the URLs of their twins merged into alternate_urls; links is (target "source:slug", source, url). A new URL replaces an old one of its source."""
    new = links.groupBy(F.col("target").alias("__t")).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("source", "url")))).alias("__new"))
    both = posts.join(new, F.concat_ws(":", "source", "slug") == F.col("__t"), "left")
    none = F.create_map().cast("map<string,string>")
    old = F.map_filter(F.coalesce("alternate_urls", none), lambda k, v: ~F.coalesce(F.map_contains_key(F.coalesce(F.col("__new"), none), k), F.lit(False)))
    return both.withColumn("alternate_urls", F.map_concat(old, F.coalesce("__new", none))).drop("__t", "__new")


# Comparisons


def agreement(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(rule, key) for keys that only one side has, and for fields in which the two sides differ; null equals null."""
    a = left.select(F.col(key), F.struct(*fields).alias("__a"))
    b = right.select(F.col(key), F.struct(*fields).alias("__b"))
    both = a.join(b, key, "full_outer")
    alone = F.when(F.col("__a").isNull(), F.array(F.lit("only right"))).when(F.col("__b").isNull(), F.array(F.lit("only left")))
    differ = F.filter(F.array(*(F.when(~F.col("__a")[f].eqNullSafe(F.col("__b")[f]), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    return both.select(F.explode(F.coalesce(alone, differ)).alias("rule"), F.col(key).cast("string").alias("key"))


def exact(published: DataFrame, rebuilt: DataFrame, key: str, name: str) -> DataFrame:
    """(rule, key) of rows by which a published table and its rebuilding differ, as bags; arrays and structs are compared too."""
    columns = sorted(rebuilt.columns)
    rows = lambda df: df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"))
    a, b = rows(published), rows(rebuilt)
    return a.exceptAll(b).select(F.lit(f"{name}: not rebuilt").alias("rule"), "key").unionByName(b.exceptAll(a).select(F.lit(f"{name}: not published").alias("rule"), "key"))


def bundle(tables: Mapping[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """(rule, key) of tables whose count or digest, taken again from what was read back, isn't the manifest's (name, n, digest)."""
    again = reduce(DataFrame.unionByName, [digest(df, sorted(df.columns)).select(F.lit(name).alias("name"), "n", "digest") for name, df in tables.items()])
    return agreement(again, manifest, "name", ["n", "digest"])


def endpoints(articles: DataFrame, search_index: DataFrame, related: DataFrame, families: DataFrame, latest: DataFrame) -> dict[str, DataFrame]:
    """The six published tables; the manifest holds count and digest of the five others."""
    out = {"articles_index": articles, "latest": latest, "search_index": search_index, "related": related, "families": families}
    rows = [digest(df, sorted(df.columns)).select(F.lit(name).alias("name"), "n", "digest") for name, df in out.items()]
    return out | {"manifest": reduce(DataFrame.unionByName, rows)}


def bundle_checksum(files: DataFrame) -> DataFrame:
    """One digest over files (path, content), independent of their order: of sorted "path digest" lines, so no task holds two files."""
    line = F.concat_ws("\0", "path", F.sha2("content", 256))
    return files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("checksum"), F.count("*").alias("files"))


def oversized(df: DataFrame, key: str, most: int = SEARCH_BYTES) -> DataFrame:
    """One row (bytes, fits): the size of a table as JSON lines against its cap."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 1), F.lit(0)).alias("bytes")).withColumn("fits", F.col("bytes") <= most)


def strings_in(schema: T.DataType, c: Column, skip: Sequence[str] = ("url", "sha256", "body_sha256")) -> Column:
    """All strings in a value of any shape, fields by the names in skip aside: an expression that follows the schema."""
    none = F.array().cast("array<string>")
    if isinstance(schema, T.StringType):
        return F.when(c.isNotNull(), F.array(c)).otherwise(none)
    if isinstance(schema, T.StructType):
        parts = [strings_in(f.dataType, c[f.name], skip) for f in schema.fields if f.name not in skip]
        return F.flatten(F.array(*parts)) if parts else none
    if isinstance(schema, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(c, lambda x: strings_in(schema.elementType, x, skip))), none)
    if isinstance(schema, T.MapType):
        return F.coalesce(F.flatten(F.transform(F.map_values(c), lambda x: strings_in(schema.valueType, x, skip))), none)
    return none


# Contracts


def provenance(articles: DataFrame) -> DataFrame:
    """Which revision of the source a body comes from, and whether status and times say the same."""
    c = F.col
    at, seen, state, full = c("source_updated_at"), c("observed_source_updated_at"), c("body_revision_status"), c("content_status") == "full"
    excerpt = c("content_status") == "excerpt"
    timed = lambda t: (t == "") | (D.precision(t) == "instant")
    return violations(articles.where("content_status <> 'registry'"), c("slug"), {
        "revision status": state.isin(*REVISIONS), "source time": timed(at), "observed time": timed(seen),
        "current times match": (state != "current") | (at == seen), "prior times differ": (state != "prior") | (excerpt & (at != "") & (seen != "") & (at != seen)),
        "unverified is an excerpt": (state != "unverified") | excerpt, "full is current": ~full | ((state == "current") & (at != "")),
    })


def wire(rows: DataFrame) -> DataFrame:
    """Rows as readers get them: identities, trimmed texts, allowed values, lists without repeats, masks in range."""
    c = F.col
    trimmed = lambda n: c(n) == F.trim(n)
    member = c("publication_access") == "member"
    tidy = {f"{n} without repeats": F.size(F.array_distinct(n)) == F.size(n) for n in TIDY_LISTS}
    return together(
        violations(rows, c("id"), {
            "id": c("id").rlike("^a_[0-9a-f]{14}$"), "title": trimmed("title") & (c("title") != ""), "subtitle": trimmed("subtitle"), "url": c("url").startswith("https://"),
            "source": c("source").isin("substack", "medium"), "access": c("publication_access").isin("public", "member", "unknown"), "status": c("content_status").isin("full", "excerpt"),
            "preview length": c("member_preview_chars").between(0, PREVIEW_CHARS), "preview of members only": member | (c("member_preview_chars") == 0), "member is an excerpt": ~member | (c("content_status") == "excerpt"),
            "mask": c("mask").between(0, 63), **tidy,
        }),
        repeats(rows, c("id"), "unique id"), repeats(rows, c("url"), "unique url"),
    )


def sorted_unique(c: Column, pattern: str | None = None) -> Column:
    """Whether a list is in order and has no repeats, and its terms match a pattern."""
    ok = c == F.array_sort(F.array_distinct(c))
    return ok & F.forall(c, lambda x: x.rlike(f"^(?:{pattern})$")) if pattern else ok


# Small outputs


def client_span(span: Column) -> Column:
    """A span as readers get it; null where it has no text."""
    text = F.coalesce(span.text, F.lit(""))
    return F.when(text != "", F.struct(span.text.alias("text"), F.coalesce(span.truncated, F.lit(False)).alias("truncated"), F.coalesce(span.start, F.lit(0)).alias("start"), F.coalesce(span.end, F.lit(0)).alias("end"), F.coalesce(span.sha256, F.lit("")).alias("sha256")))


def client_brief(brief: Column) -> Column:
    """A brief as readers get it: spans without text are left out."""
    with_text = lambda xs: F.coalesce(F.filter(xs, lambda x: F.coalesce(x.text, F.lit("")) != ""), F.array())
    sections = F.transform(with_text(brief.sections), lambda s: F.struct(s.kind.alias("kind"), s.heading.alias("heading"), s.text.alias("text"), s.truncated.alias("truncated"), s.source_order.alias("source_order"), s.start.alias("start"), s.end.alias("end"), s.sha256.alias("sha256")))
    points = F.transform(with_text(brief.checkpoints), lambda p: F.struct(p.date.alias("date"), p.date_label.alias("date_label"), p.text.alias("text"), p.context_kind.alias("context_kind"), p.truncated.alias("truncated"), p.start.alias("start"), p.end.alias("end"), p.sha256.alias("sha256")))
    return F.struct(client_span(brief.lead).alias("lead"), sections.alias("sections"), client_span(brief.fallback_evidence).alias("fallback_evidence"), points.alias("checkpoints"))


def escaped(c: Column) -> Column:
    """Text inside HTML."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def stubs(articles: DataFrame, site: str) -> DataFrame:
    """(path, html): a page per article that names it and sends readers on."""
    title, url = escaped(F.col("title")), escaped(F.col("url"))
    head = F.concat(F.lit("<!doctype html><html lang=\"en\"><head><meta charset=\"utf-8\"><title>"), title, F.lit('</title><meta property="og:title" content="'), title, F.lit('"><link rel="canonical" href="'), url, F.lit('"></head>'))
    body = F.concat(F.lit('<body><p><a href="'), url, F.lit('">'), title, F.lit("</a></p></body></html>"))
    return articles.select(F.concat(F.lit(f"{site}/s/"), "slug", F.lit(".html")).alias("path"), F.concat(head, body).alias("html"))


def sitemap(articles: DataFrame, site: str) -> DataFrame:
    """(loc, lastmod, entry): a sitemap entry per article page."""
    loc = F.concat(F.lit(f"{site}/s/"), "slug", F.lit(".html"))
    day = F.substring("post_date", 1, 10)
    return articles.select(loc.alias("loc"), day.alias("lastmod"), F.concat(F.lit("<url><loc>"), escaped(loc), F.lit("</loc><lastmod>"), day, F.lit("</lastmod></url>")).alias("entry"))


def fetch_status(posts: DataFrame, source: str, checked_at: str, published: int, error: str = "") -> DataFrame:
    """One row: what a fetch of a source brought."""
    n = posts.agg(F.count("*").alias("fetched_count"), F.max_by("post_date", D.instant(F.col("post_date"))).alias("newest"))
    state = F.lit("degraded") if error else F.when(F.col("fetched_count") < published, "degraded").otherwise("ok")
    return n.select(F.lit(1).alias("schema_version"), F.lit(source).alias("source"), F.lit(checked_at).alias("checked_at"), state.alias("status"), F.when(state == "ok", "live").otherwise("cache").alias("mode"), "fetched_count", F.lit(published).alias("published_count"), "newest", F.lit(error).alias("error"))
