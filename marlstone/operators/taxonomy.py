"""Topic families by a ladder of phrase rules; the first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions.text import has_any
from .rows import listed

# Families, the abstention last (fixed values).
FAMILIES = ("firm-mechanics", "career-structure", "model-critique", "scandal-enforcement", "event-reaction", "market-structure", "other")


def family(title: Column, context: Column) -> Column:
    """Family of normalised texts; context is title, subtitle and brief."""
    some = lambda where, phrases: has_any(where, phrases)
    rules = (
        (some(title, L.MISCONDUCT) | (some(title, L.ENFORCEMENT) & some(context, L.MISCONDUCT)), "scandal-enforcement"),
        (some(title, L.CAREER), "career-structure"),
        (some(title, L.MODEL) & some(title, L.CRITIQUE), "model-critique"),
        (some(title, L.MARKET_STRUCTURE), "market-structure"),
        (some(title, L.EVENT), "event-reaction"),
        (some(context, L.NAMED_FIRMS) & some(title, L.MECHANICS), "firm-mechanics"),
        (some(context, L.CAREER), "career-structure"),
        (some(context, L.MODEL) & some(context, L.CRITIQUE), "model-critique"),
        (some(context, L.MARKET_STRUCTURE), "market-structure"),
    )
    return F.coalesce(*(F.when(c, f) for c, f in rules), F.lit("other"))


def by_family(articles: DataFrame, order: str = "pos") -> DataFrame:
    """Slugs of each family in catalogue order; every family has a row."""
    domain = articles.sparkSession.createDataFrame([(f, i) for i, f in enumerate(FAMILIES)], "family string, place int")
    slugs = articles.groupBy("family").agg(listed("slug", order).alias("slugs"))
    return domain.join(slugs, "family", "left").select("family", "place", F.coalesce("slugs", F.array().cast("array<string>")).alias("slugs"))
