"""Building blocks of several operators: first rows, gates, upserts, checks. All are one shuffle on their key at most."""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", rank).where(F.col("__n") <= n).drop("__n")


@dataclass(frozen=True)
class Down:
    """A sort key in descending order, nulls last; other keys ascend, nulls first."""

    key: Column | str


#: Rows sampled for each range when cut points are chosen.
SAMPLED = 20


def _keys(order: Sequence[Column | str | Down]) -> list[tuple[Column, bool]]:
    out = []
    for o in order:
        k, down = (o.key, True) if isinstance(o, Down) else (o, False)
        out.append((F.col(k) if isinstance(k, str) else k, down))
    return out


def _sorted(keys: list[tuple[Column, bool]]) -> list[Column]:
    return [k.desc_nulls_last() if down else k.asc_nulls_first() for k, down in keys]


def _bucket(keys: list[tuple[Column, bool]], kinds: Sequence[T.DataType], cuts: Sequence[Row]) -> Column:
    """How many cut points a row doesn't come before: a search tree of comparisons, so that equal rows share a bucket, always the same one."""

    def before(cut: Row) -> Column:
        less = F.lit(False)
        for (k, down), kind, v in reversed(list(zip(keys, kinds, cut))):
            lit = F.lit(v).cast(kind)
            sooner = (k > lit) | (lit.isNull() & k.isNotNull()) if down else (k < lit) | (k.isNull() & lit.isNotNull())
            less = F.coalesce(sooner, F.lit(False)) | (k.eqNullSafe(lit) & less)
        return less

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(before(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def ranges(df: DataFrame, order: Sequence[Column | str | Down], out: str) -> tuple[DataFrame, int]:
    """df with the number of the range, of about equal size, that each row falls in, and how many there are.

    The cut points come to the driver once, from SAMPLED rows a range, and are constants from then on: the number is a plain
    function of the row, whatever reads or recomputes it.
    """
    keys = _keys(order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = df.select(*(k.alias(f"k{i}") for i, (k, _) in enumerate(keys)))
    drawn = named.orderBy(F.rand(11)).limit(SAMPLED * n)
    sample = drawn.orderBy(*_sorted([(F.col(f"k{i}"), down) for i, (_, down) in enumerate(keys)])).collect()
    cuts = list(dict.fromkeys(sample[len(sample) * i // n] for i in range(1, n))) if sample else []
    return df.withColumn(out, _bucket(keys, [f.dataType for f in named.schema], cuts)), len(cuts) + 1


def numbered(df: DataFrame, order: Sequence[Column | str | Down], out: str) -> DataFrame:
    """df with its rows numbered from 0 in a total order: each range by itself, from the sizes of the ranges before it. Rows that tie are numbered in any order, but never twice."""
    dealt, n = ranges(df, order, "__range")
    sizes = dict(dealt.groupBy("__range").count().collect())
    starts = F.array(*(F.lit(x).cast("long") for x in accumulate((sizes.get(i, 0) for i in range(n - 1)), initial=0)))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*_sorted(_keys(order))))
    return dealt.withColumn(out, F.get(starts, F.col("__range")) + place - 1).drop("__range")


def ranked(df: DataFrame, values: Sequence[str], places: Callable[[int], Sequence[int]]) -> dict[str, list]:
    """For each numeric column the values at some places of its sorted order (nulls left out); places is told how many there are.

    Three passes for all columns together: cut points, sizes of ranges, and counts by value in the ranges that are asked for, so that values in very many rows cost no more than others.
    """
    long = df.select(F.explode(F.array(*(F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("v")) for v in values))).alias("x")).select("x.*").where("v is not null")
    dealt, _ = ranges(long, ["name", "v"], "r")
    sizes = {(r.name, r.r): r.n for r in dealt.groupBy("name", "r").agg(F.count("*").alias("n")).collect()}
    wanted = []
    for name in values:
        own = sorted((r, n) for (m, r), n in sizes.items() if m == name)
        starts = [0, *accumulate(n for _, n in own)]
        for k, place in enumerate(places(starts[-1]) if own else ()):
            i = bisect.bisect_right(starts, place) - 1
            wanted.append((name, own[i][0], k, place - starts[i]))
    found: dict[str, list] = {name: [] for name in values}
    if wanted:
        asked = df.sparkSession.createDataFrame(wanted, "name string, r int, k int, at long")
        some = dealt.join(F.broadcast(asked.select("name", "r").distinct()), ["name", "r"]).groupBy("name", "r", "v").agg(F.count("*").alias("n"))
        end = F.sum("n").over(Window.partitionBy("name", "r").orderBy("v"))
        at = some.withColumn("end", end).join(F.broadcast(asked), ["name", "r"]).where((F.col("at") < F.col("end")) & (F.col("at") >= F.col("end") - F.col("n")))
        for r in at.orderBy("name", "k").collect():
            found[r.name].append(r.v)
    return found


def dedup_by_prefix(df: DataFrame, key: str, text: str, length: int, order: str) -> DataFrame:
    """The first row for each key and first characters of a text; a null key or text counts as empty."""
    return first_per(df, [F.coalesce(F.col(key), F.lit("")), F.substring(F.coalesce(F.col(text), F.lit("")), 1, length)], [order])


def unique_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no other row."""
    return df.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where("__n = 1").drop("__n")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """new where it has the key, old otherwise; columns are those of old."""
    rest = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return rest.unionByName(new.select(*old.columns))


def disappeared(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.select(*keys).distinct().join(new.select(*keys), list(keys), "left_anti")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side; empty if both are equal as bags."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def counts_over(df: DataFrame, domain: DataFrame, key: str) -> DataFrame:
    """Counts for every value of a fixed domain, zero included."""
    found = df.groupBy(key).agg(F.count("*").alias("n"))
    return domain.join(found, key, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def mode_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """The commonest spelling of a key: by count, then not all in lower case, then case-folded, then raw."""
    n = df.groupBy(key, label).agg(F.count("*").alias("n"))
    return first_per(n, [key], [F.desc("n"), (F.col(label) == F.lower(label)).cast("int"), F.lower(label), F.col(label)])


def listed(value: Column | str, order: Column | str) -> Column:
    """An aggregate: values in an order, as an array."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o") if isinstance(order, str) else order.alias("o"), F.col(value).alias("v") if isinstance(value, str) else value.alias("v"))))
    return F.transform(pairs, lambda p: p.v)


def digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a digest of all rows that doesn't depend on their order. Row digests are summed in four 32-bit lanes, so no task sees all rows."""
    h = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    lanes = [F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i in range(4)]
    sums = df.select(*columns).agg(F.count("*").alias("n"), *lanes)
    return sums.select("n", F.sha2(F.concat_ws(":", "n", *(F.coalesce(F.col(f"s{i}").cast("string"), F.lit("0")) for i in range(4))), 256).alias("digest"))


def leaf(key: str, leaves: int) -> Column:
    """The range, of `leaves`, that the hash of a key falls in."""
    return F.floor(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40)) * leaves / (1 << 40)).cast("int")


def tree(df: DataFrame, columns: Sequence[str], key: str, leaves: int = 4096) -> DataFrame:
    """(leaf, n, digest): a table's digests by ranges of its keys' hashes, whatever the order and partitioning of its rows. Rows are summed up in their tasks, and no leaf holds them."""
    h = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    lanes = [F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i in range(4)]
    sums = df.groupBy(leaf(key, leaves).alias("leaf")).agg(F.count("*").alias("n"), *lanes)
    return sums.select("leaf", "n", F.sha2(F.concat_ws(":", "n", *(F.col(f"s{i}").cast("string") for i in range(4))), 256).alias("digest"))


def root(tree_: DataFrame) -> DataFrame:
    """One row (n, digest) over the leaves of a tree, of which there is a fixed number at most."""
    line = F.concat_ws(":", "leaf", "digest")
    return tree_.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sha2(F.array_join(listed(line, "leaf"), "\n"), 256).alias("digest"))


def changed(a: DataFrame, b: DataFrame) -> DataFrame:
    """(leaf) of the ranges in which two trees differ."""
    old = b.select("leaf", F.col("n").alias("__n"), F.col("digest").alias("__d"))
    return a.join(old, "leaf", "full_outer").where(~F.col("digest").eqNullSafe(F.col("__d"))).select("leaf")


#: Ids of a side in a cell of pairs, at most; about as many cells share a task.
CELL = 1024


def pairs_of_classes(members: DataFrame, links: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(src, dst, and the other columns of links): pairs of members (id, class) of linked classes (a, b), without a record and itself.

    Ids travel in lists of up to CELL of one class. A link becomes cells, a list of one side with a list of the other, dealt evenly
    whatever the sizes of classes; pairs are made where the result is read, and never shuffled.
    """
    some = members if asked is None else members.join(asked.select("id").distinct(), "id", "left_semi")
    left, right = _lists(some).withColumnsRenamed({"class": "a", "ids": "__a"}), _lists(members).withColumnsRenamed({"class": "b", "ids": "__b"})
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # links meet counts of lists, not lists: each side's lists are fetched by number once cells are dealt
    counts = lambda df, k, out: df.groupBy(k).agg(F.max("list").alias(out))
    cells = links.join(counts(left, "a", "__na"), "a").join(counts(right, "b", "__nb"), "b")
    cells = cells.withColumn("__la", F.explode(F.sequence(F.lit(0), F.col("__na")))).withColumn("__lb", F.explode(F.sequence(F.lit(0), F.col("__nb")))).drop("__na", "__nb")
    met = cells.join(left.withColumnRenamed("list", "__la"), ["a", "__la"]).join(right.withColumnRenamed("list", "__lb"), ["b", "__lb"]).repartition(4 * n)
    kept = [c for c in links.columns if c not in ("a", "b")]
    return met.select(F.explode("__a").alias("src"), "__b", *kept).select("src", F.explode("__b").alias("dst"), *kept).where("src <> dst")


def _lists(members: DataFrame) -> DataFrame:
    """(class, list, ids): members in numbered lists of about CELL, no group larger: a class is dealt by hash over as many lists as its size asks for."""
    sized = members.join(members.groupBy("class").agg(F.count("*").alias("__n")), "class")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("__n") / CELL)).cast("int")
    return sized.select("class", part.alias("list"), "id").groupBy("class", "list").agg(F.sort_array(F.collect_list("id")).alias("ids"))
