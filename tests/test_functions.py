import random
import re
import time

import pandas as pd
import pytest
from pyspark.util import PythonEvalType
from pyspark.sql import functions as F

from marlstone import lexicon as L
from marlstone.functions import briefs as B
from marlstone.functions import dates as D
from marlstone.functions import numbers as N
from marlstone.functions import observe as O
from marlstone.functions import text as X
from marlstone.functions import text_udf as U
from marlstone.functions import urls
from marlstone.plans import passages


def one(spark, c, **values):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(c.alias("x")).first().x


@pytest.mark.parametrize("text, want", [
    ("The desk never went long oil during the shock.", "unspecified"),
    ("The mandate does not hold a long position in equities.", "unspecified"),
    ("Traditional arbitrage-based pricing breaks down in an incomplete market.", "unspecified"),
    ("The fund was not only long oil but also short airline stocks.", "long/short"),
    ("The fund was not long oil but went short airline stocks.", "short"),
    ("This was not speculation—it was a long oil position.", "long"),
    ("The manager bought puts on the index.", "short"),
    ("A long/short equity fund with a long-term view.", "unspecified"),
    ("They ran a merger arb book and bought shares.", "arbitrage/relative value"),
    ("They bought 100 NO contracts and went long oil.", "long"),
    ("", "unspecified"),
])
def test_direction(text, want):
    assert O.direction_of(text) == want


def test_direction_on_long_input_is_quick():
    begun = time.time()
    O.direction_of("The manager built a " + "00" * 50_000 + "%x")
    O.direction_of("no " * 3000 + "long oil")
    O.references_only("1. " * 20_000)
    assert time.time() - begun < 20


def test_reference_lines():
    assert O.references_only("References:\n[1] Smith, J. (2019) Journal of Things\nhttps://x.org/a")
    assert not O.references_only("The fund bought oil at $40 per barrel, see https://x.org for more on this trade.")
    assert O.reference_line("12. Available at https://x.org") and not O.reference_line("A normal sentence about bonds.")


def test_native_fields(spark):
    t = "Because the spread was mispriced by many dealers. The fund bought $2.5 billion of Acme Holdings bonds at 92.5 and profited $40 million on it. Yield of 5%."
    got = spark.createDataFrame([(t,)], "t string").select(O.instruments(F.col("t")).alias("i"), O.quantities(F.col("t")).alias("q"), O.underlying(F.col("t")).alias("u"), O.outcome(F.col("t")).alias("o"), O.thesis(F.col("t")).alias("h"), O.fund(F.lit("said Bill Ackman today")).alias("f")).first()
    assert got.i == ["bond"] and "$2.5 billion" in got.q and got.u == "Acme Holdings" and got.o.startswith("profited $40 million") and got.h == "the spread was mispriced by many dealers." and got.f == "Ackman"
    assert one(spark, O.instruments(F.col("a")), a="nothing here") == ["unspecified"]
    assert one(spark, O.clean_underlying(F.col("a")), a="US hedge fund exposure; Gold") == "Gold"
    assert one(spark, O.clean_underlying(F.col("a")), a="hedge fund") is None


def test_false_positive(spark):
    rows = [("Subscribe to continue reading about the fund that bought oil at $40 in the spring of that long year.", "long", ["commodity"], True), ("The fund bought oil at $40 per barrel in the spring of that year and sold it a month later for more.", "long", ["commodity"], False), ("The fund bought oil.", "long", ["commodity"], True)]
    df = spark.createDataFrame(rows, "t string, d string, i array<string>, want boolean")
    assert all(r.got == r.want for r in df.select("want", O.false_positive(F.col("t"), F.col("d"), F.col("i")).alias("got")).collect())


def test_excerpts(spark):
    long = "word " * 400
    e = one(spark, X.bounded_excerpt(F.col("a")), a=long)
    assert e.endswith("…") and len(e) <= 1201 and not e[:-1].endswith(" ")
    assert one(spark, X.bounded_excerpt(F.col("a")), a="  short ") == "short" and one(spark, X.bounded_excerpt(F.col("a")), a=" ") == ""
    e = one(spark, X.excerpt(F.col("a")), a="abcdefg " * 200)
    assert len(e) <= 800 and e.endswith("abcdefg")
    assert len(one(spark, X.excerpt(F.col("a")), a="x" * 2000)) == 800


def test_sentences(spark):
    assert len(one(spark, X.sentences(F.col("a")), a="First sentence.  Second one! Third?")) == 3
    assert len(one(spark, X.sentences(F.col("a")), a="First." + " " * 100_000 + "lowercase")) == 1


def test_word_count_is_unicode(spark):
    import re

    t = "naïve café’s 3rd—try d'été über_x"
    assert one(spark, X.word_count(F.col("a")), a=t) == len(re.findall(r"\b[\w’'-]+\b", t))


def test_normalisation():
    assert ["-".join(U.search_words(x)) for x in ("Hull-White’s", "D.E. Shaw", "Γ Scalping", "S&P 500", "Société Générale")] == ["hull-white", "d-e-shaw", "gamma-scalping", "s-and-p-500", "societe-generale"]
    assert U.title_key("Two &amp; Three\xa0Ways — Straße") == "2 and 3 ways strasse" and U.title_key(None) == ""
    assert U.visible_text("<p>a<b>b</b></p><script>x</script><p>c &amp; d</p>") == "ab\n\nc & d" and U.visible_text("<p>a</p><br><br><br><p>b</p>") == "a\n\nb"
    assert U.organisations("Foo Capital, and the Bar Baz Partners; Securities and Exchange Commission") == ["bar-baz-partners", "foo-capital"]
    assert U.organisations("Foo Capital and the Bar Partners") == [] and U.organisations("foo Capital") == [] and U.organisations("Inside Foo Capital") == ["foo-capital"]
    assert U.organisations("Market Management") == [] and U.organisations(None) == [] and U.organisations("Foo (Capital) of Foo of") == []


def test_dates(spark):
    for s, want in (("2024-02-30", None), ("2024-02-29", "day"), ("2024-01-01T00:00:00", None), ("2024-01-01T00:00:00+02:00", "instant"), ("2024-01-01T00:00:00.123Z", "instant"), ("x", None)):
        assert one(spark, D.precision(F.col("a")), a=s) == want
    assert one(spark, D.distance(F.col("a"), F.lit("2024-01-09T00:00:00Z")), a="2024-01-01") == 8
    assert one(spark, D.distance(F.col("a"), F.lit("never")), a="2024-01-01") == D.FAR
    assert [str(x) for x in one(spark, D.in_prose(F.col("a")), a="On March 4th, 2027 and February 30, 2027 and may 1 2026.")] == ["2027-03-04", "2026-05-01"]
    assert str(one(spark, D.from_rfc2822(F.col("a")), a="Sat, 22 Aug 2026 10:00:00 GMT")) == "2026-08-22 10:00:00"
    assert one(spark, D.from_epoch_millis(F.col("a")), a=1735689600123) == "2025-01-01T00:00:00.123Z" and one(spark, D.from_epoch_millis(F.col("a")), a=5) is None
    assert one(spark, D.displayed(F.col("a")), a="2024-03-05") == "05 MAR 2024"


def test_urls(spark):
    assert one(spark, urls.canonical(F.col("a")), a="HTTPS://Foo.COM:443/p/x/#top") == "https://foo.com/p/x"
    assert one(spark, urls.canonical(F.col("a")), a="http://foo.com:8080/?q=1") == "http://foo.com:8080?q=1"
    assert one(spark, urls.publication(F.col("a")), a="https://x.substack.com/p/y") == "substack" and one(spark, urls.publication(F.col("a")), a="https://evil-substack.com.org/p/y") is None
    assert one(spark, urls.native_id(F.col("a")), a="https://medium.com/@u/title-0123456789ab") == "0123456789ab"
    assert len(one(spark, urls.stable_id("a", F.col("a")), a="x")) == 16


@pytest.mark.parametrize("words", [0, 1, 109, 110, 111, 220, 330, 331, 550, 770])
def test_read_minutes_rounds_half_to_even(spark, words):
    assert one(spark, N.read_minutes(F.col("a")), a=words) == max(1, round(words / 220))


def test_rounding_is_pythons(spark):
    import random

    r = random.Random(1)
    values = [0.5, 1.5, 2.5, 0.125, 0.375, 2.675, 1.005, 0.0000005, 0.0000015, 1e-9, 0.0] + [r.random() * 10 ** r.randint(-6, 3) for _ in range(3000)] + [k / 64 for k in range(300)] + [-k / 16 for k in range(60)]
    for digits in (2, 4, 6):
        got = spark.createDataFrame([(v,) for v in values], "v double").select("v", N.rounded(F.col("v"), digits).alias("r")).collect()
        assert [x.r for x in got] == [round(x.v, digits) for x in got], digits


def test_masks(spark):
    mask = one(spark, N.pack([F.col("a") > 1, F.col("a") > 100, F.lit(None).cast("boolean"), F.lit(True)]), a=5)
    assert mask == 9 and [one(spark, b, m=9) for b in N.unpack(F.col("m"), 4)] == [True, False, False, True]


PROSE = "This is a long enough sentence about returns of 12% and a spread of 40 bps that a reader would take for prose in every way. "


def test_brief_spans_are_exact(spark):
    body = "\n".join(["The Title", PROSE * 9, "Evidence", PROSE * 2, "Evidence", PROSE, "What to watch", "The committee has its decision meeting on March 4, 2027, and that matters for the whole of the market a lot. More follows here then.", "References", PROSE])
    b = B.brief_of(body, "The title", "2026-01-01")
    spans = [b["lead"], *b["sections"], *b["checkpoints"]]
    assert all(body[s["start"] : s["end"]] == s["text"] and B.sha(s["text"]) == s["sha256"] for s in spans)
    assert b["lead"]["truncated"] and len(b["lead"]["text"]) <= B.LEAD and b["lead"]["text"].endswith(".")
    assert [s["kind"] for s in b["sections"]] == ["evidence", "implementation"] and b["fallback_evidence"] is None
    assert b["checkpoints"][0]["date"] == "2027-03-04" and b["checkpoints"][0]["text"].endswith("a lot.")
    row = spark.createDataFrame([(body, "The title", "2026-01-01"), (None, None, None)], "b string, t string, d string").select(B.brief("b", "t", "d").alias("x")).collect()
    assert row[0].x.lead.text == b["lead"]["text"] and row[1].x.lead is None and row[1].x.sections == []


def test_brief_abstains():
    assert B.heading_kind("Results show that it works. It does.") is None and B.heading_kind("Subscribe for evidence") is None and B.heading_kind("The mechanism") == "mechanism"
    assert not B.prose("Short.") and not B.prose("subscribe " * 30) and B.prose(PROSE)
    assert B.brief_of("")["lead"] is None
    assert B.boilerplate("By Jane Roe", "Jane Roe") and not B.boilerplate("By Jane Roe")


def test_open_references_stay():
    page = "<title>war &amp; p&amp</title><p>a &lt;b&gt; &amp;lt; &am &copy</p>"
    assert U.visible_text(page, closed=True) == "war & p&amp\na <b> &lt; &am &copy"
    assert U.visible_text(page) == "war & p&\na <b> < &am ©"


def test_whole_texts_reach_python_by_few_rows():
    arrow = [f for f in (U.normalize_title, U.normalize_taxonomy, U.normalize_identity, U.normalized_words, U.strip_html) if f.evalType != PythonEvalType.SQL_BATCHED_UDF]
    assert not arrow


def _made(parsed, rng) -> str:
    """Some text that a parsed pattern matches, bounds and looks ahead aside."""
    out = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "IN":
            kind, x = rng.choice(arg)
            out.append({"LITERAL": lambda: chr(x), "RANGE": lambda: chr(rng.randint(*x)), "NEGATE": lambda: "q"}.get(str(kind), lambda: {"CATEGORY_DIGIT": "7", "CATEGORY_SPACE": " "}.get(str(x), "w"))())
        elif name == "BRANCH":
            out.append(_made(rng.choice(arg[1]), rng))
        elif name == "SUBPATTERN":
            out.append(_made(arg[3], rng))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out.append("".join(_made(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2)))))
        elif name in ("ANY", "NOT_LITERAL"):
            out.append("q")
    return "".join(out)


def _misses(patterns, stems) -> list[str]:
    rng, missed, seen = random.Random(5), [], 0
    for p in patterns:
        parsed = re._parser.parse(p, re.I)
        for _ in range(3000):
            if m := re.search(p, _made(parsed, rng), re.I):
                seen += 1
                missed += [] if U.holds(m[0], stems) else [m[0]]
    assert seen > 1000 * len(patterns)
    return missed


def test_stems_are_in_all_that_their_patterns_match():
    assert not _misses([L.PROMOTIONAL, L.UPDATE_NOTICE, L.URL_OR_CITATION], L.NOTICE_STEMS)
    assert not _misses([L.LONG, L.SHORT, L.ARBITRAGE, L.OWNS_PUTS, *L.TRIGGERS], L.SIGNAL_STEMS)
    assert not _misses([L.URL], L.URL_STEMS)
    for text in ("SUBſCRIBE", "ſıgn up", "lİnkedin", "youtube", "LinKedin"):
        assert U.holds(text, L.NOTICE_STEMS) and re.search(L.PROMOTIONAL, text, re.I)


class _Unwanted:
    def __getattr__(self, name):
        raise AssertionError("a slow pattern is tried on a plain text")


def test_plain_lines_need_no_patterns_of_notices(monkeypatch):
    monkeypatch.setattr(B, "_NOT_RESEARCH", [_Unwanted()])
    assert not B.boilerplate("Nothing of the kind was said by anyone on that day, nor later.")
    assert B.brief.evalType == PythonEvalType.SQL_BATCHED_UDF


def test_quiet_passages_need_no_patterns_of_trades(monkeypatch):
    monkeypatch.setattr(O, "_SIGNALS", {"long": _Unwanted()})
    quiet = "Nothing of note was said on that day by anyone there."
    r = O.Reading(quiet)
    assert (r.direction, r.denied, r.trade(), O.windows([quiet] * 3)) == ("unspecified", [], False, [])


def test_no_passage_is_no_reading(monkeypatch):
    monkeypatch.setattr(O, "Reading", _Unwanted())
    assert O.reading.func(pd.Series([None])).values.tolist() == [["unspecified", False, False, False]]


def test_heavy_rows_of_one_file_are_dealt(spark):
    assert passages.q_passage_fields(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4
    assert one(spark, O.quantities(F.col("a")), a="£５ million, ٣% and 7% at £3 million") == "£５ million, £3 million, ٣%, 7%"
