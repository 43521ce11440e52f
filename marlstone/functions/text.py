"""Native text expressions. Lengths and offsets are code points; patterns are Unicode-aware."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that str.strip() would take off (fixed values).
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"


def by_script(c: Column, found: Callable[[str], Column], fold: bool = True) -> Column:
    """What found gives under the flags that a text needs: without Unicode's classes and cases for texts of ASCII, where they say the same and are slow."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, found("(?i)" if fold else "")).otherwise(found("(?iU)" if fold else "(?U)"))


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is computed once, however often it is named: in a list of one."""
    return F.element_at(F.transform(F.array(c), use), 1)


def matches(c: Column, pattern: str) -> Column:
    """Whether a pattern occurs, case and script aside."""
    return by_script(c, lambda flags: c.rlike(flags + pattern))


def strip(c: Column) -> Column:
    """Trimmed by a character list: linear, unlike a pattern anchored at the end."""
    return F.btrim(c, F.lit(BLANKS))


def squash(c: Column) -> Column:
    """Runs of white space as one space, trimmed."""
    return strip(F.regexp_replace(c, "(?U)\\s+", " "))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit("(?U)\\b[\\w’'-]+\\b"))


def bounded_excerpt(c: Column, limit: int = 1200) -> Column:
    """At most limit characters: cut at the last space before and closed by an ellipsis, which counts; empty where there is no such space."""
    t = strip(c)
    cut = F.regexp_extract(F.substring(t, 1, limit), "(?s)^(.*) ", 1)
    return F.when(F.length(t) <= limit, t).when(cut == "", "").otherwise(F.concat(strip(cut), F.lit("…")))


def excerpt(c: Column, limit: int = 800) -> Column:
    """At most limit characters without a partial last word and without ellipsis."""
    t = strip(c)
    head = F.substring(t, 1, limit)
    whole = F.substring(t, limit + 1, 1).rlike("(?U)^\\s") | F.substring(t, limit, 1).rlike("(?U)^\\s")
    cut = F.regexp_extract(head, "(?s)^(.+)[ \\n\\t]", 1)
    return F.when(F.length(t) <= limit, t).otherwise(strip(F.when(whole | (cut == ""), head).otherwise(cut)))


def sentences(c: Column) -> Column:
    """Split after . ! ? where white space and a capital ASCII letter follow."""
    return F.split(c, "(?U)(?<=[.!?])\\s+(?=[A-Z])")


def paragraphs(c: Column, separator: str = "\n\n", least: int = 50) -> Column:
    """Trimmed paragraphs of more than `least` characters."""
    return F.filter(F.transform(F.split(c, separator), strip), lambda p: F.length(p) > least)


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; 0 where either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) < 1) | (F.size(b) < 1), 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def has_phrase(c: Column, phrase: str) -> Column:
    """Whether a phrase occurs in a normalised text as whole words."""
    return F.concat(F.lit(" "), c, F.lit(" ")).contains(f" {phrase.strip()} ")


def has_any(c: Column, phrases: Iterable[str]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | has_phrase(c, p)
    return found


def first_match(c: Column, patterns: Iterable[tuple[str, int]], least: int, most: int) -> Column:
    """The first pattern's match that is longer than least, cut to most; null without one."""
    found = [strip(by_script(c, lambda flags, p=p, g=g: F.regexp_extract(c, flags + p, g))) for p, g in patterns]
    return F.coalesce(*(once(x, lambda x: F.when(F.length(x) > least, F.substring(x, 1, most))) for x in found))


def matches_of(c: Column, pattern: str, most: int, group: int = 0, fold: bool = True) -> Column:
    """The first `most` matches."""
    return F.slice(by_script(c, lambda flags: F.regexp_extract_all(c, F.lit(flags + pattern), F.lit(group)), fold), 1, most)


def joined(arrays: Iterable[Column], most: int, separator: str) -> Column:
    """Matches of several patterns without repeats, in order of first sight; null without any."""
    every = F.slice(F.array_distinct(F.flatten(F.array(*arrays))), 1, most)
    return once(every, lambda every: F.when(F.size(every) > 0, F.array_join(every, separator)))


def features(words: Column, stopwords: Iterable[str], least: int = 3) -> Column:
    """Words of weight, and pairs of neighbours among them, joined by a hyphen."""
    kept = F.filter(words, lambda w: (F.length(w) >= least) & ~w.rlike("^[0-9]+$") & ~w.isin(*stopwords))

    def with_pairs(kept: Column) -> Column:
        pairs = F.zip_with(kept, F.slice(kept, F.lit(2), F.greatest(F.size(kept), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.concat_ws("-", a, b)))
        return F.concat(kept, F.filter(pairs, lambda p: p.isNotNull()))

    return F.flatten(F.transform(F.array(kept), with_pairs))  # in a list of one, so that words are looked at once


def truncated_title(c: Column) -> Column:
    return c.rlike("(?:…|\\.{2,3})\\s*$")


def slugify(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(c), "(?U)[^\\w\\s-]", ""), "(?U)[\\s_-]+", "-"), F.lit("-"))


def table_cell(c: Column) -> Column:
    """A value inside a markdown table."""
    return F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), "[\\r\\n]+", " ")


def guarded_cell(c: Column) -> Column:
    """A CSV value that no spreadsheet takes for a formula."""
    return F.when(c.rlike("^[=+\\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def compatible_surface(a: Column, b: Column) -> Column:
    """Two listings of one title: one holds the other once trailing ellipses are off."""
    bare = lambda c: strip(F.regexp_replace(strip(c), "(?:…|\\.{3})$", ""))
    return F.contains(bare(a), bare(b)) | F.contains(bare(b), bare(a))


def canonical_surface(surfaces: Column) -> Column:
    """Of the texts under which a listing shows one body (an array) the longest, the last in order of equal ones, and whether every two of them are compatible; empty and compatible without any."""
    own = F.array_distinct(F.filter(surfaces, lambda s: s.isNotNull() & (strip(s) != "")))
    longest = F.array_max(F.transform(own, lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))
    empty = lambda s: strip(F.regexp_replace(strip(s), "(?:…|\\.{3})$", "")) == ""
    fits = F.forall(own, lambda a: F.forall(own, lambda b: F.when(empty(a) | empty(b), empty(a) & empty(b)).otherwise(compatible_surface(a, b))))
    return F.struct(F.coalesce(longest.s, F.lit("")).alias("text"), fits.alias("compatible"))
