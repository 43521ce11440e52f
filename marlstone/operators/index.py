"""Inverted entity index over a catalogue: entities by word sequences, postings by catalogue position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicon
from ..functions.text_udf import capitalised_names, normalized_words, search_words
from .rows import Down, numbered

# Spellings of labels that title case gets wrong (fixed values).
LABELS = {"aqr": "AQR", "cfm": "CFM", "hrt": "HRT", "qrt": "QRT", "ltcm": "LTCM", "vix": "VIX", "cds": "CDS", "etf": "ETF", "fomc": "FOMC", "sebi": "SEBI", "sec": "SEC", "cftc": "CFTC", "mifid": "MiFID", "var": "VaR", "pca": "PCA", "ols": "OLS", "sabr": "SABR", "d-e-shaw": "D. E. Shaw"}


def catalogue(articles: DataFrame, priority: Mapping[str, int]) -> DataFrame:
    """articles with pos, their place in catalogue order: date descending, source priority, slug descending.

    Only keys are sorted, by range; the rest of the rows is joined back.
    """
    rank = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in priority.items() for x in p)), F.col("source")), F.lit(99))
    keys = articles.select("source", "slug", F.coalesce("post_date", F.lit("")).alias("d"), rank.alias("p"))
    placed = numbered(keys, [Down("d"), "p", Down("slug")], "pos")
    return articles.join(placed.select("source", "slug", "pos"), ["source", "slug"])


def search_text(title: Column, subtitle: Column, lead: Column, sections: Column) -> Column:
    """The text that entities are searched in: title, subtitle, lead, and headings and texts of sections."""
    parts = F.flatten(F.transform(F.coalesce(sections, F.array()), lambda s: F.array(s.heading, s.text)))
    return F.concat_ws(" ", title, subtitle, lead, F.array_join(parts, " "))


def aliases(entities: Mapping[str, Sequence[str]] = lexicon.ENTITIES) -> list[tuple[str, str]]:
    """(entity, alias as normalised words) pairs."""
    return [(name, " ".join(w)) for name, own in entities.items() for a in own if (w := search_words(a))]


def entities(articles: DataFrame, text: str, names: list[tuple[str, str]] | None = None, key: str = "pos") -> DataFrame:
    """(key, entity) for every entity with an alias among a text's words.

    The lexicon is small and fixed, so it becomes one expression; no join.
    """
    found = aliases() if names is None else names
    padded = F.concat(F.lit(" "), F.array_join(normalized_words(text), " "), F.lit(" "))
    words = articles.select(key, padded.alias("words"))
    hits = F.array_distinct(F.filter(F.array(*(F.when(F.col("words").contains(f" {a} "), F.lit(n)) for n, a in found)), lambda x: x.isNotNull()))
    return words.select(key, F.explode(hits).alias("entity"))


def discovered(articles: DataFrame, text: str, key: str = "pos") -> DataFrame:
    """(key, entity) for organisations that are named by capitals somewhere in the catalogue, wherever their words occur."""
    names = articles.select(F.explode(capitalised_names(text)).alias("entity")).distinct()
    words = articles.select(key, normalized_words(text).alias("w"))
    grams = lambda n: F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.array_join(F.slice(F.col("w"), i + 1, F.lit(n)), "-"))
    every = F.concat(*(F.when(F.size("w") >= n, grams(n)).otherwise(F.array()) for n in (2, 3)))
    return words.select(key, F.explode(F.array_distinct(every)).alias("entity")).join(names, "entity").select(key, "entity")


def postings(found: DataFrame, key: str = "pos", span: int = 100_000) -> DataFrame:
    """(entity, df, chunk, postings): positions of each entity in order, in chunks of `span` places of the catalogue, so that no entity is one row of any length."""
    df = found.groupBy("entity").agg(F.count("*").alias("df"))
    chunks = found.groupBy("entity", F.floor(F.col(key) / span).alias("chunk")).agg(F.sort_array(F.collect_list(key)).alias("postings"))
    return chunks.join(df, "entity").select("entity", "df", "chunk", "postings")


def lookup(found: DataFrame, articles: DataFrame, entity: str, key: str = "pos") -> DataFrame:
    """Articles of an entity, in catalogue order."""
    return articles.join(found.where(F.col("entity") == entity).select(key), key).orderBy(key)


# Entities that are markets or instruments, and models or mechanisms; words that stay small in labels (fixed values).
MARKETS = (
    "bitcoin", "bonds", "copper", "dxy", "ethereum", "euro", "futures", "gold", "natural-gas", "non-deliverable-forwards", "oil", "options",
    "precious-metals", "silver", "spx", "swaps", "treasuries", "vix", "vvix", "yen",
)
MODELS = (
    "avellaneda-stoikov", "basis-trade", "black-litterman", "black-scholes", "carry-trade", "delta-hedging", "dispersion-trading", "expected-shortfall", "factor-model", "gamma", "gamma-scalping", "heston",
    "hull-white", "kelly-criterion", "market-making", "market-microstructure", "market-structure", "mean-reversion", "monte-carlo", "risk-parity", "rough-volatility", "sabr", "sharpe-ratio",
    "sortino-ratio", "statistical-arbitrage", "stochastic-volatility", "value-at-risk", "variance-swaps", "volatility-arbitrage", "volatility-risk-premium",
)
SMALL = ("and", "for", "of", "the")


def label(entity: Column) -> Column:
    """A fixed label, or the entity's first alias (its name, if it has none) in title case; small words stay small but at the start."""
    fixed = F.create_map(*(F.lit(x) for p in LABELS.items() for x in p))
    said = F.create_map(*(F.lit(x) for name, own in lexicon.ENTITIES.items() for x in (name, own[0])))
    words = F.filter(F.split(F.lower(F.replace(F.coalesce(F.try_element_at(said, entity), entity), F.lit("-"), F.lit(" "))), " +"), lambda w: w != "")
    titled = F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*SMALL), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000))))
    return F.coalesce(F.try_element_at(fixed, entity), F.array_join(titled, " "))


def kind(entity: Column) -> Column:
    """The broad kind that an entity is shown under."""
    return F.when(entity.isin(*MARKETS), "market / instrument").when(entity.isin(*MODELS), "model / mechanism").otherwise("organization / institution")
