"""Personal data: patterns, and information-theoretic sanitisation around them.

Patterns find e-mail addresses, IP addresses, card and phone numbers; each distinct value is a protected entity. The corpus
then tells which terms give an entity away. Of N documents c(t) hold the term, c(e) the entity and c(t,e) both, wherever they
stand in the text; all four count documents, copies included. The chance of the entity beside the term is estimated as
c(t,e) / (c(t) + SMOOTHING), as if SMOOTHING more documents had the term alone: one meeting is weak evidence, and the more documents
a corpus has, the more a rare term tells. The term discloses PMI / IC(e) = 1 + log(that chance) / log(N / c(e)) of what there is
to know of the entity. A term whose share reaches GENERALISE is cut to its first letters in the documents of that entity; one
that reaches REMOVE is taken out.

The pass over the texts keeps those of documents with an entity (others can't change); counts of terms are summed in each task
before they are shuffled; entities, terms and texts travel as 64-bit hashes. Terms and entities of one text are paired only where
both stand in several texts, and entities that always stand together once; what is joined is written first, so that Spark splits
hot keys. No group is collected but the terms of one text.

Defined results: null text counts as empty and stays null; documents without entity stay as they are; repeated rows count as
documents each; an entity or term in very many documents is summed in parts like any other.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, col, free_name, sliced, with_struct

KINDS = ("email", "ip", "card", "phone")
SMOOTHING, GENERALISE, REMOVE = 1.0, 0.85, 0.95
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DIGIT_OR_AT = re.compile(r"[0-9@]")
#: Words whose terms a worker remembers before it starts anew.
CACHE_WORDS = 100_000
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs without @ cost nothing."""
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            pos = m.end()
        at = text.find("@", max(at + 1, pos))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed and then by start; matches that fail their test are dropped, not retried."""
    if not text or not _DIGIT_OR_AT.search(text):
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return found


def hashed(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def entity(text: str, span: tuple[str, int, int]) -> int:
    """The protected value behind a span, whatever its spelling."""
    kind, a, b = span
    value = text[a:b]
    return hashed(f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else re.sub('[^0-9]', '', value)}")


_HASHES: dict[str, int] = {}


def _terms(words) -> set[int]:
    """Hashes of the terms in words (runs of three letters or more, in lower case), remembered by word."""
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    out = set()
    for w in words:
        if (h := _HASHES.get(w)) is None:
            h = _HASHES[w] = tuple(hashed(t) for t in _TERM.findall(w.lower()))
        out.update(h)
    return out


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by term, summed in the task; tables of bounded size are passed on as they fill."""
    def table():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], names=["t", "n"])

    counts: Counter = Counter()
    for batch in sliced(batches):
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(_terms(set(text.split())))
        if len(counts) > 500_000:
            yield table()
            counts = Counter()
    if counts:
        yield table()


def _protected_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, m, es, terms) of texts with their spans: hash and copies of the text, hashes of its entities and of its terms outside the spans."""
    for batch in sliced(batches):
        es, terms = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("base").to_pylist()):
            rest, pos = [], 0
            for x, y in sorted((s["start"], s["end"]) for s in spans):
                rest.append(text[pos:x])
                pos = max(pos, y)
            rest.append(text[pos:])
            es.append(sorted({entity(text, (s["kind"], s["start"], s["end"])) for s in spans}))
            terms.append(list(_terms(set(" ".join(rest).split()))))
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("m"), *(pa.array(x, pa.list_(pa.int64())) for x in (es, terms))], names=["h", "m", "es", "terms"])


def term_spans(text: str, base: list[tuple[str, int, int]], terms: dict[int, float]) -> list[tuple[int, int, float]]:
    """Where flagged terms stand outside the base spans: (start, end, disclosure)."""
    taken = sorted((a, b) for _, a, b in base)
    out, k = [], 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        if (share := terms.get(hashed(m[0].lower()))) is None:
            continue
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if not any(x < b and a < y for x, y in taken[k : k + len(KINDS) + 1]):
            out.append((a, b, share))
    return out


def sanitised(text: str, base: list[tuple[str, int, int]], terms: list[tuple[int, int, float]], remove: float = REMOVE) -> str:
    """The text with base spans as marks, terms above `remove` taken out and other flagged terms cut to two letters."""
    cuts: list[tuple[int, int, str]] = []
    for kind, a, b in sorted(base, key=lambda s: (s[1], -s[2])):
        if not cuts or a >= cuts[-1][1]:
            cuts.append((a, b, MARKS[kind]))
        elif b > cuts[-1][1]:
            cuts[-1] = (cuts[-1][0], b, cuts[-1][2])
    cuts = sorted(cuts + [(a, b, "[…]" if share >= remove else text[a : a + 2] + "…") for a, b, share in terms])
    out, pos = [], 0
    for a, b, mark in cuts:
        out += [text[pos:a], mark]
        pos = b
    return "".join([*out, text[pos:]])


def _spelled(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def disclosures(seen: DataFrame, words: DataFrame, n: int, scratch: Scratch, least: float = GENERALISE, smoothing: float = SMOOTHING, meetings: int = 1) -> DataFrame:
    """(h, t, share) of terms of texts that disclose one of their entities by `least` or more, after `meetings` documents with both at least. seen has the distinct texts with entities (h, m copies, es, terms), words the documents by term (t, n).

    As c(t,e) is c(e) at most, only terms of c(t) + smoothing <= c(e) ** least * N ** (1 - least) for some entity can reach `least`;
    the others, most of what is said, are left out before anything is paired.

    What a text says of itself needs no pairs: there c(t,e) is m at least, and with that count the entity of the least c(e) has the
    highest share. More than m have only terms and entities that both stand in several texts; only those are paired, and of entities
    that stand in the very same texts one. So a list of any number of addresses costs its words, as long as its addresses keep together.
    """
    n = max(n, 2)
    says = seen.select("h", "m", F.explode("es").alias("e"))
    ce = scratch.write(says.groupBy("e").agg(F.sum("m").alias("ce"), F.count("*").alias("texts"), F.sum(F.xxhash64("h", F.lit(1)).cast("decimal(38,0)")).alias("where1"), F.bit_xor(F.xxhash64("h", F.lit(2))).alias("where2")), "entities")
    most = (ce.agg(F.max("ce").alias("most")).first().most or 0) ** least * n ** (1 - least) * (1 + 1e-9)
    ct = words.groupBy("t").agg(F.sum("n").alias("ct")).where(F.col("ct") + smoothing <= most)
    rare = scratch.write(seen.select("h", "m", F.explode("terms").alias("t")).join(ct.hint("merge"), "t"), "rare")
    low = says.join(ce.select("e", "ce"), "e").groupBy("h").agg(F.min("ce").alias("ce"))
    share = lambda cet: 1 + F.log(cet / (F.col("ct") + smoothing)) / F.greatest(F.log(F.lit(float(n)) / F.col("ce")), F.lit(1e-9))
    alone = rare.where(F.col("m") >= meetings).join(low, "h").select("h", "t", share(F.col("m")).alias("share")).where(F.col("share") >= least)

    several = rare.groupBy("t").agg(F.count("*").alias("k")).where("k > 1").select("t")
    first = ce.where("texts > 1").groupBy("texts", "where1", "where2").agg(F.min("e").alias("e"), F.first("ce").alias("ce"))
    held = says.join(first.select("e", "ce"), "e").select("h", "e", "ce")
    pairs = scratch.write(rare.join(several, "t", "left_semi").join(held, "h").select("h", "m", "t", "ct", "e", "ce"), "pairs")
    told = pairs.groupBy("e", "t").agg(F.sum("m").alias("cet"), F.first("ct").alias("ct"), F.first("ce").alias("ce")).where(F.col("cet") >= meetings)
    told = scratch.write(told.withColumn("share", share(F.col("cet"))).where(F.col("share") >= least).select("e", "t", "share"), "telling")
    together = pairs.select("h", "e", "t").join(told, ["e", "t"]).select("h", "t", "share")
    found = scratch.write(alone.unionByName(together).groupBy("h", "t").agg(F.max("share").alias("share")), "found")
    scratch.drop(ce, rare, pairs, told)
    return found


def sanitise(docs: DataFrame, text_col: str = "text", out: str = "pii", generalise: float = GENERALISE, remove: float = REMOVE, smoothing: float = SMOOTHING, meetings: int = 1) -> DataFrame:
    """docs with a struct column: base (spans), terms (spans of flagged terms), text (sanitised; null stays null) and changed."""
    out = free_name(docs, out)
    keep, key, own_terms = [col(c) for c in docs.columns], free_name(docs, "__h"), free_name(docs, "__terms")
    spans_of = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("h", T.LongType())])

    def patterns(texts):
        spans = [base_spans(t) for t in texts]
        return [[[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], [hashed(t) if s else None for t, s in zip(texts, spans)]]

    scratch = Scratch(docs.sparkSession)
    marked = with_struct(docs, out, [col(text_col)], patterns, spans_of)
    has = F.size(F.col(out).base) > 0
    hit = scratch.write(marked.where(has), "pii")
    n = docs.select(F.lit(1)).count()

    # equal texts are read once and count as often as they stand there
    once = hit.select(F.col(out).h.alias("h"), col(text_col).alias("text"), F.col(out).base.alias("base")).groupBy("h").agg(F.first(F.struct("text", "base")).alias("x"), F.count("*").alias("m"))
    seen = scratch.write(once.select("h", "m", "x.*").mapInArrow(_protected_texts, "h long, m long, es array<long>, terms array<long>"), "texts")
    words = docs.select(col(text_col).alias("text")).mapInArrow(_term_counts, "t long, n long")
    found = disclosures(seen, words, n, scratch, generalise, smoothing, meetings)
    flags = scratch.write(found.groupBy("h").agg(F.collect_list(F.struct("t", "share")).alias(own_terms)), "flags")
    scratch.drop(seen, found)

    result = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("terms", T.ArrayType(SPAN)), T.StructField("text", T.StringType()), T.StructField("changed", T.BooleanType())])

    def finish(texts, bases, flagged):
        made = [[], [], [], []]
        for text, base, terms in zip(texts, bases, flagged):
            own = [(s["kind"], s["start"], s["end"]) for s in base]
            more = term_spans(text, own, {x["t"]: x["share"] for x in terms}) if terms else []
            made[0].append(base)
            made[1].append([{"kind": "term", "start": a, "end": b} for a, b, _ in more])
            made[2].append(sanitised(text, own, more, remove))
            made[3].append(True)
        return made

    tmp = free_name(hit, "__done")
    flagged = hit.withColumn(key, F.col(out).h).join(flags.withColumnRenamed("h", key), key, "left")
    done = with_struct(flagged, tmp, [col(text_col), F.col(out).base, F.col(own_terms)], finish, result).select(*keep, F.col(tmp).alias(out))
    none = F.array().cast(T.ArrayType(SPAN))
    rest = marked.where(~has).select(*keep, F.struct(none.alias("base"), none.alias("terms"), col(text_col).alias("text"), F.lit(False).alias("changed")).alias(out))
    return done.unionByName(rest)


def spelled(spans) -> F.Column:
    """kind:start:end of spans, comma-joined as they stand."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
