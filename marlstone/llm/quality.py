"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per row. The ledger keeps the measurements and one failure bit for each rule;
policies are versioned masks over those bits, so a new policy or an ablation reads the ledger and never the texts.
No step shuffles but the ablation, which sums a few counters.

Defined results: null text counts as empty; an empty text fails the word-count rule; repeated rows and ids are judged row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, col, free_name, let

#: Bit of each rule in the ledger. Bits are never reused; new rules get new bits.
RULES = {"few_words": 0, "repeated_words": 1, "symbols": 2, "repeated_lines": 3, "word_length": 4, "shouting": 5}


@dataclass(frozen=True)
class Policy:
    """A named set of rules whose failure rejects a row."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES[r] for r in self.rules)


POLICIES = {
    1: Policy(1, ("few_words", "repeated_words")),
    2: Policy(2, ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting")),
}
CURRENT = 2
WINDOW = 5


def _repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of width words found twice or more, from 64-bit hashes of the windows.

    Only rows with a repeated window pay for the sort; the covered words are the union of the windows from their sorted starts.
    """
    grams = lambda ws: F.transform(F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)]))
    pairs = lambda g: F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    twice = lambda s: F.transform(s, lambda x, j: F.when((x.g == F.get(s, j - 1).g) | (x.g == F.get(s, j + 1).g), x.i))
    starts = lambda s: F.sort_array(F.filter(twice(s), lambda i: i.isNotNull()))
    steps = lambda at: F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    covered = lambda g: F.aggregate(let(let(pairs(g), starts), steps), F.lit(0), lambda acc, x: acc + x)
    whole = lambda ws: let(grams(ws), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))
    return let(words, lambda ws: F.when(F.size(ws) < width + 1, F.lit(0)).otherwise(whole(ws)))


def ledger(df: DataFrame, text_col: str = "text", out: str = "ledger") -> DataFrame:
    """df with a struct column: the measurements and fail_bits. The struct's name is lengthened if df has it already."""
    out = free_name(df, out)
    tmp = free_name(df, "__words")
    text = F.coalesce(col(text_col), F.lit(""))
    cut = df.withColumn(tmp, F.filter(F.split(text, SPACE + "+"), lambda w: w != ""))
    words = F.col(tmp)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    measured = cut.withColumn(
        out,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
            F.regexp_count(text, F.lit("!!")).cast("long").alias("n_shouts"),
        ),
    ).drop(tmp)
    m = F.col(out)
    failed = {
        "few_words": m.n_words < 10,
        "repeated_words": 100 * m.n_repeat_words > 20 * m.n_words,
        "symbols": 10 * m.n_symbols > 3 * m.n_words,
        "repeated_lines": 10 * m.n_dup_lines > 6 * m.n_lines,
        "word_length": (m.word_chars < 2 * m.n_words) | (m.word_chars > 15 * m.n_words),
        "shouting": 2 * m.n_shouts > m.n_words,
    }
    bits = sum((F.when(c, F.lit(1 << RULES[r])).otherwise(F.lit(0)) for r, c in failed.items()), F.lit(0))
    return measured.withColumn(out, m.withField("fail_bits", bits.cast("long")))


def passes(bits: Column, version: int = CURRENT) -> Column:
    """Whether a row with these failure bits passes a policy."""
    return bits.bitwiseAND(F.lit(POLICIES[version].mask)) == 0


def ablations(bits: DataFrame, bits_col: str = "fail_bits", version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that only it rejects (they pass if the rule is taken out).

    One pass of bitwise sums with map-side combination; an empty ledger gives zeros.
    """
    mask = POLICIES[version].mask
    fails = F.col(bits_col).bitwiseAND(F.lit(mask))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    sums = bits.agg(*[f(r) for r in POLICIES[version].rules for f in (lambda r: count(fails.bitwiseAND(F.lit(1 << RULES[r])) != 0).alias(f"f_{r}"), lambda r: count(fails == (1 << RULES[r])).alias(f"o_{r}"))])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"), F.col(f"o_{r}").alias("n_only")) for r in POLICIES[version].rules])
    return sums.select(F.inline(rows))
