import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions.text_udf import normalized_words
from marlstone.operators import asof, contracts, health, index, link, observations, publish, release, rows, search, similarity, taxonomy, threads
from marlstone.plans import archive
from marlstone.schemas import POST

TRADE = "The fund bought $2 billion of corporate bonds at 92 because dealers had to sell them before the end of the quarter. It was long credit for a year."


def posts_of(spark, values):
    names = POST.fieldNames()
    return spark.createDataFrame([tuple(v.get(n) for n in names) for v in values], POST)


def post(i, body, **more):
    return {"source": "substack", "source_id": str(i), "slug": f"s{i}", "title": f"Post {i}", "subtitle": "", "post_date": f"2026-01-{i + 1:02d}", "url": f"https://x.substack.com/p/s{i}", "audience": "everyone", "wordcount": len(body.split()), "body_text": body, "content_status": "current", "is_published": True} | more


def test_observations_from_paragraphs_and_windows(spark):
    filler = "Nothing of note is said here at all, only words that fill the space until there are enough of them to count. " * 3
    sentences = filler.strip() + " It was late. The desk shorted oil futures then. More followed."
    got = observations.extract(posts_of(spark, [post(0, filler + "\n\n" + TRADE + "\n\n" + TRADE), post(1, sentences), post(2, "too short"), post(3, filler), post(4, None or "")])).collect()
    by = {r.article_url[-2:]: r for r in got}
    assert set(by) == {"s0", "s1"} and len(got) == 2
    assert by["s0"].direction == "long" and by["s0"].instruments == ["bond"] and not by["s0"].description_truncated
    assert by["s1"].direction == "short" and "shorted oil futures" in by["s1"].trade_description
    kept = observations.published(observations.extract(posts_of(spark, [post(0, filler + "\n\n" + TRADE)])))
    assert kept.count() == 1 and observations.documentation(kept).first().documentation_score >= 2


def test_directions_from_cache(spark):
    df = observations.extract(posts_of(spark, [post(0, "x" * 150 + "\n\n" + "The manager traded crude oil with some leverage in the spring and the position was sized with care by the desk.")]))
    cache = df.select(F.sha2("trade_description", 256).alias("digest"), F.lit("long").alias("label"))
    assert df.first().direction == "unspecified" and observations.resolve_directions(df, cache).first().direction == "long"


def test_taxonomy_ladder(spark):
    cases = [("citadel fraud", "", "scandal-enforcement"), ("career path at a fund", "", "career-structure"), ("black scholes is wrong", "", "model-critique"), ("market structure notes", "", "market-structure"), ("the oil war", "", "event-reaction"), ("how it made money", "jane street", "firm-mechanics"), ("quiet day", "nothing", "other")]
    df = spark.createDataFrame(cases, "t string, c string, want string").withColumn("c", F.concat_ws(" ", "t", "c"))
    assert all(r.got == r.want for r in df.select("want", taxonomy.family(F.col("t"), F.col("c")).alias("got")).collect())
    by = taxonomy.by_family(spark.createDataFrame([("other", 1, "b"), ("other", 0, "a")], "family string, pos int, slug string")).collect()
    assert len(by) == 7 and next(r.slugs for r in by if r.family == "other") == ["a", "b"]


def test_match_ladder(spark):
    sub = posts_of(spark, [
        post(0, "", slug="linked", title="Whatever"), post(1, "", slug="same", title="The Same Title"), post(2, "", slug="twin-a", title="Twins"), post(3, "", slug="twin-b", title="Twins"),
        post(4, "", slug="long", title="A rather long title about the way in which things were done then"), post(5, "", slug="rev", title="Reviewed thing"),
        post(6, "", slug="subt", title="Unlike", subtitle="A subtitle that is more than sixty characters long, as it has to be here"), post(7, "", slug="fuzzy", title="How the big fund lost five billion dollars in a day"),
    ])
    med = posts_of(spark, [
        {"medium_id": "m0", "title": "x", "post_date": "2026-01-01", "mirror_substack_slug": "linked"}, {"medium_id": "m1", "title": "the same TITLE!", "post_date": "2026-01-05"}, {"medium_id": "m2", "title": "Twins", "post_date": "2026-01-03"},
        {"medium_id": "m3", "title": "A rather long title about the way in which th…", "display_title": "A rather long title about the way in which th…", "post_date": "2026-01-05"}, {"medium_id": "m4", "title": "Other name", "post_date": "2026-01-06"},
        {"medium_id": "m5", "title": "Differs", "subtitle": "A subtitle that is more than sixty characters long, as it has to be here", "post_date": "2026-01-07"}, {"medium_id": "m6", "title": "How the big fund lost 5 billion dollars in one day", "post_date": "2026-01-08"},
        {"medium_id": "m7", "title": "The same title", "post_date": "2026-03-05"},
    ])
    over = spark.createDataFrame([("m4", "rev", "", "")], "medium_id string, substack_slug string, medium_title_key string, substack_title string")
    got = {r.l_id: (r.r_id, r.reason) for r in link.match_posts(med, sub, over).collect()}
    assert got == {"m0": ("linked", "explicit-link"), "m1": ("same", "normalized-title-and-date"), "m3": ("long", "ellipsized-title-prefix-and-date"), "m4": ("rev", "reviewed-override"), "m5": ("subt", "subtitle-and-date"), "m6": ("fuzzy", "title-similarity-and-date")}


def test_registry_crosslink_against_a_loop(spark):
    posts = posts_of(spark, [post(0, "", slug="a", title="Alpha story"), post(1, "", slug="b", title="Beta story")])
    records = spark.createDataFrame([("1", "Alpha story", "u1", "2026-01-02", "paid"), ("2", "Alpha story", "u2", "2026-01-01", "public"), ("3", "Gamma", "u3", "2026-01-01", "public"), ("4", "Beta story", "u4", "2026-02-01", "public"), ("5", "Alpha story", "u5", "2026-01-03", "paid")], "source_id string, title string, url string, post_date string, access string")
    none = spark.createDataFrame([], "source string, source_id string, target_source string, target_slug string, decision string, reason string")
    links, own = link.crosslink(posts, records, "patreon", none)
    assert {r.source_id: r.alternate for r in links.collect()} == {"1": False, "2": True, "5": False}
    assert {r.source_id: r.target for r in own.collect()} == {"1": "substack:a", "5": "substack:a", "3": None, "4": None}


PAIRS = ["Optiver pays market makers well", "What Optiver hides about pods", "Gamma scalping on a quiet Tuesday", "A gamma scalping diary begins", "Precious metals roared again", "Precious metals hedges fail quietly", "Hull-White in practice today", "Calibrating Hull-White badly", "D.E. Shaw hires physicists", "Notes on D.E. Shaw and pods"]


def graph_by_hand(titles, entities):
    import math
    from collections import Counter

    from marlstone import lexicon
    from marlstone.functions.text_udf import search_words

    feats = []
    for t in titles:
        w = [x for x in search_words(t) if len(x) >= 3 and not x.isdigit() and x not in lexicon.STOPWORDS]
        feats.append(Counter(w + [f"{a}-{b}" for a, b in zip(w, w[1:])]))
    n = len(titles)
    df = Counter(f for c in feats for f in c)
    idf = {f: math.log((n + 1) / (k + 1)) + 1 for f, k in df.items() if 2 <= k <= max(2, int(0.45 * n))}
    vec = []
    for c in feats:
        v = {f: (1 + math.log(k)) * idf[f] for f, k in c.items() if f in idf}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        vec.append({f: x / size for f, x in v.items()})
    edf = Counter(e for s in entities for e in s)
    sq = {e: (math.log((n + 1) / (k + 1)) + 1) ** 2 for e, k in edf.items()}
    out = {}
    for i in range(n):
        ranked = []
        for j in range(n):
            if i != j:
                shared = entities[i] & entities[j]
                cos = sum(sq[e] for e in shared) / math.sqrt(sum(sq[e] for e in entities[i]) * sum(sq[e] for e in entities[j])) if shared else 0
                lex = 0.45 * sum(x * vec[j].get(f, 0) for f, x in vec[i].items())
                common = feats[i].keys() & feats[j].keys()
                same = vec[i].keys() & vec[j].keys()
                low = 0 if shared or same else min(0.01, sum(sorted(1 / df[f] for f in sorted(common, key=lambda f: (df[f], "-" not in f, f))[:3])) / 100)
                score = round(min(1, lex + 0.15 * cos + low), 6)
                if score > 0:
                    ranked.append((-score, f"substack:s{j}"))
        out[f"substack:s{i}"] = [(d, -s) for s, d in sorted(ranked)[:5]]
    return out


def test_read_models(spark):
    posts = posts_of(spark, [post(i, "", title=t) for i, t in enumerate(PAIRS)])
    m = archive.build(posts)
    found = {}
    for r in m.entities.join(m.articles.select("pos", "id"), "pos").collect():
        found.setdefault(r.id, set()).add(r.entity)
    entities = [found.get(f"substack:s{i}", set()) for i in range(10)]
    assert all("d-e-shaw" in entities[i] for i in (8, 9)) and all("hull-white" in entities[i] for i in (6, 7)) and "gamma-scalping" in entities[2]
    got = {}
    for r in m.related.orderBy("src", "rnk").collect():
        got.setdefault(r.src, []).append((r.dst, r.score))
    want = graph_by_hand(PAIRS, entities)
    assert {k: [d for d, _ in v] for k, v in got.items()} == {k: [d for d, _ in v] for k, v in want.items() if v}
    assert all(abs(a[1] - b[1]) < 2e-6 for k in got for a, b in zip(got[k], want[k]))
    assert all(got[f"substack:s{i}"][0][0] == f"substack:s{i ^ 1}" for i in range(10))
    why = {(r.src, r.dst): r.why for r in m.related.collect()}
    assert why["substack:s8", "substack:s9"] == ["d-e-shaw"]
    assert [r.pos for r in m.articles.orderBy(F.desc("post_date")).collect()] == list(range(10))
    topics = {r.entity: list(r.ids) for r in m.topics.collect()}
    assert topics["hull-white"] == ["substack:s6", "substack:s7"] and dict(map(tuple, m.defaults.collect()))["substack:s6"] == "hull-white"
    assert m.families.count() == 7


def test_names_found_by_capitals(spark):
    df = spark.createDataFrame([(0, "Inside Foo Capital today"), (1, "why foo capital matters"), (2, "bar")], "pos int, text string")
    assert sorted((r.pos, r.entity) for r in index.discovered(df, "text").collect()) == [(0, "foo-capital"), (1, "foo-capital")]


def test_asof_and_terciles(spark):
    curve = spark.createDataFrame([("2026-01-02", 4.0, 4.3, 4.8), ("2026-01-05", 4.1, 4.5, 4.8), ("2026-01-06", 4.2, 4.8, 4.8)], "day string, y2 double, y10 double, y30 double")
    days = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("2026-01-04",), ("2026-01-05",), ("2026-01-09",)], "day string")
    got = {r.day: (r.as_of, r.slope_band, r.level_band) for r in asof.rate_context(days, curve).collect()}
    assert got == {"2026-01-02": ("2026-01-02", "low", "low"), "2026-01-04": ("2026-01-02", "low", "low"), "2026-01-05": ("2026-01-05", "mid", "mid"), "2026-01-09": ("2026-01-06", "high", "high")}
    r = random.Random(3)
    for n in (1, 2, 3, 7, 20):
        v = [r.randrange(6) for _ in range(n)]
        lower, upper = asof.tercile_cuts(spark.createDataFrame([(float(x), None) for x in v], "v double, w double"), "v", "w")["v"]
        s = sorted(v)
        assert (lower, upper) == (s[(n - 1) // 3], s[2 * (n - 1) // 3])
    assert asof.tercile_cuts(spark.createDataFrame([], "v double"), "v") == {"v": (None, None)}


def test_asof_without_keys_matches_brute_force(spark):
    r = random.Random(4)
    right = [(x, i) for i, x in enumerate(r.sample(range(5000), 300))] + [(None, -1)]
    left = [(r.randrange(-50, 5100), i) for i in range(2000)] + [(None, 2000)]
    got = asof.asof_backward(spark.createDataFrame(left, "t long, l long").repartition(7), spark.createDataFrame(right, "t long, v long").repartition(5), "t").collect()
    known = sorted(x for x in right if x[0] is not None)
    want = {i: max((x for x in known if t is not None and x[0] <= t), default=(None, None)) for t, i in left}
    assert len(got) == len(left) and all((x.as_of, x.v) == want[x.l] for x in got)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_rows_are_numbered_without_gaps(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions * 2))
    try:
        df = spark.range(100_000, numPartitions=partitions).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("a"), F.md5(F.col("id").cast("string")).alias("s"))
        got = rows.numbered(df, [rows.Down("a"), "s"], "n").select("n", "a", "s").toPandas()
        assert sorted(got.n) == list(range(100_000))
        key = lambda x: (x[1] != x[1] or x[1] is None, -(x[1] if x[1] == x[1] and x[1] is not None else 0), x[2])
        in_order = list(got.sort_values("n").itertuples(index=False, name=None))
        assert in_order == sorted(in_order, key=key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_health(spark):
    previous = spark.createDataFrame([("a", "t0", 2), ("b", None, 0)], "source string, degraded_since string, consecutive_degraded_checks int")
    current = spark.createDataFrame([("a", "t1", "degraded"), ("b", "t1", "degraded"), ("c", "t1", "ok")], "source string, checked_at string, status string")
    got = {r.source: (r.degraded_since, r.consecutive_degraded_checks) for r in health.advance(current, previous).collect()}
    assert got == {"a": ("t0", 3), "b": ("t1", 1), "c": (None, 0)}
    t = dt.datetime(2026, 1, 1)
    now = spark.createDataFrame([("x", t, t + dt.timedelta(hours=48)), ("y", t, t + dt.timedelta(hours=47, minutes=59))], "source string, since timestamp, now timestamp")
    assert [r.source for r in health.persistent(now, F.col("now")).collect()] == ["x"]
    history = spark.createDataFrame([(0, "c", 3), (1, "b", 2), (2, "a", 1)], "pos int, id string, at int")
    ok = spark.createDataFrame([(0, "e", 5), (1, "d", 4), (2, "c", 3), (3, "b", 2)], "pos int, id string, at int")
    assert health.lineage(ok, history).count() == 0
    bad = spark.createDataFrame([(0, "d", 4), (1, "b", 2), (2, "c", 9)], "pos int, id string, at int")
    assert {r.fault for r in health.lineage(bad, history).collect()} == {"order"} and health.merge_window(ok, history).count() == 5
    assert health.retry_order(spark.createDataFrame([(False, "2026", 0), (False, "", 1), (True, "", 2), (False, "2025", 3)], "is_new boolean, attempted_at string, idx int")).orderBy("turn").first().idx == 2


def test_search(spark):
    rows_ = spark.createDataFrame([(1, "VIX", "x", "y", "z"), (2, "", "on VIX", "", ""), (3, "", "", "vix thesis", ""), (4, "", "", "", "the VIX rose"), (5, "", "", "", "nothing")], "id int, u string, h string, s string, p string")
    f = {"exact": ["u"], "subject": ["h"], "related": ["s"], "mention": ["p"]}
    got = {r.id: (r.tier, r.part) for r in search.tiered(rows_, "VIX", f).collect()}
    assert got == {1: ("exact", "primary"), 2: ("subject", "related"), 3: ("related", "related"), 4: ("mention", "related")}
    assert {r.part for r in search.tiered(rows_.where("id >= 4"), "vix", f).collect()} == {"related"} and search.tiered(rows_, "", f).count() == 0
    tags = spark.createDataFrame([(["a"], "2026-01-01", "long"), (["b"], "2026-02-01", "long")], "i array<string>, date string, stance string")
    assert search.refined(tags, {"i": ["a", "c"]}, {"stance": "long"}).first().reasons == ["i: a, c", "stance: long"] and search.refined(tags, {}, {}).count() == 0


def test_contracts_catch_each_fault(spark):
    good = post(1, "x", title="T", url="https://x.substack.com/p/s1")
    assert contracts.articles(posts_of(spark, [good])).count() == 0
    for change, rule in (({"source": "web"}, "source"), ({"title": " T"}, "title"), ({"url": "http://x.substack.com/p/s1"}, "url"), ({"url": "https://medium.com/p/s1"}, "url source"), ({"post_date": "2026-13-01"}, "date"), ({"wordcount": -1}, "wordcount"), ({"content_status": "registry"}, "registry without words"), ({"alternate_urls": {"substack": "u"}}, "no link to itself"), ({"audience": None}, "audience")):
        assert rule in {r.rule for r in contracts.articles(posts_of(spark, [good | change])).collect()}, rule
    assert {r.rule for r in contracts.articles(posts_of(spark, [good, good])).collect()} == {"unique slug", "unique url", "unique id"}
    obs = observations.extract(posts_of(spark, [post(0, "x" * 60 + "\n\n" + TRADE)]))
    assert contracts.evidence(obs).count() == 0 and contracts.evidence(obs.withColumn("direction", F.lit("short"))).first().rule == "direction"
    assert contracts.private_names(["E-Mail", "title", "ip"]) == ["E-Mail", "ip"]
    assert contracts.private_keys(spark.createDataFrame([('{"Pass_word": 1, "a": 2}',)], "j string"), ["j"]).first().key == "Pass_word"


def test_publish(spark, tmp_path):
    posts = posts_of(spark, [post(0, "word " * 500, audience="only_paid"), post(1, "open text")])
    cut = publish.redacted(posts.withColumn("public_preview_text", F.lit("what all can see")))
    shown = cut.where("slug = 's0'").first()
    assert contracts.preview_proof(cut).count() == 0 and shown.body_text == shown.member_preview.text == "what all can see" and shown.wordcount == 0
    p = F.col("member_preview")
    for field, value, rule in (("body_sha256", F.lit("0" * 64), "preview digest"), ("text", F.lit("else"), "preview length"), ("surface", F.lit("metadata-only"), "preview surface")):
        assert rule in {r.rule for r in contracts.preview_proof(cut.withColumn("member_preview", p.withField(field, value))).collect()}, rule
    assert publish.redacted(posts).where("slug = 's0'").first().member_preview.surface == "metadata-only"
    root = f"file://{tmp_path}/out"
    v1 = publish.publish(spark, {"articles": publish.metadata(posts)}, root)
    assert publish.current(spark, root, "articles").count() == 2
    with pytest.raises(ValueError):
        publish.publish(spark, {"articles": publish.metadata(posts)}, root, contracts.articles(posts_of(spark, [post(0, "", source="x")])))
    assert spark.read.text(f"{root}/CURRENT").first().value == v1
    articles = publish.metadata(posts)
    tables = release.endpoints(articles, articles.select("slug", "title"), articles.select("slug"), articles.groupBy("content_status").count(), publish.latest(articles))
    publish.publish(spark, tables, root)
    back = {n: publish.current(spark, root, n) for n in tables}
    manifest = back.pop("manifest")
    assert len(back) == 5 and release.bundle(back, manifest).count() == 0
    assert {r.rule for r in release.bundle(back | {"latest": back["latest"].limit(1)}, manifest).collect()} == {"n", "digest"}
    v2 = publish.publish(spark, {"articles": publish.metadata(posts).limit(1)}, root)
    assert v2 != v1 and publish.current(spark, root, "articles").count() == 1
    obs = observations.extract(posts_of(spark, [post(0, "x" * 60 + "\n\n" + TRADE.replace("bonds", "bonds | notes"))]))
    assert "bonds \\| notes" in publish.markdown(obs).first().section
    m = publish.manifest(publish.metadata(posts), obs).first()
    assert (m.articles, m.observations) == (2, 1) and m.data_checksum == publish.manifest(publish.metadata(posts.repartition(3)), obs).first().data_checksum
    wire = publish.compact(spark.createDataFrame([(1, "x", "d"), (2, "y", "e")], "id int, a string, b string"), {"b": "d"}, {"_m": [F.col("id") > 1, F.col("id") > 0]})
    assert [r.row for r in wire.collect()] == ['{"id":1,"a":"x","_m":2}', '{"id":2,"a":"y","b":"e","_m":3}']
    back = publish.hydrate(wire, "id int, a string, b string, _m int", {"b": "d"}, {"_m": 2}).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "x", "d", False, True), (2, "y", "e", True, True)]


def test_rows(spark):
    df = spark.createDataFrame([(1, "A"), (1, "a"), (1, "A"), (2, "b"), (2, "B")], "k int, l string")
    assert {r.k: r.l for r in rows.mode_label(df, "k", "l").collect()} == {1: "A", 2: "B"}
    assert rows.same_rows(df, df).count() == 0 and rows.same_rows(df, df.limit(4)).count() == 1
    words = spark.createDataFrame([("D.E. Shaw",)], "t string").select(normalized_words("t").alias("w")).first().w
    assert words == ["d", "e", "shaw"]


def test_follow_ups_are_later_and_narrow(spark):
    m = spark.createDataFrame([("wide", i, i) for i in range(40)] + [("thin", 3, 3), ("thin", 30, 30)], "entity string, id int, at int")
    assert [(r.src, r.dst) for r in threads.follow_ups(m, 40).collect()] == [(3, 30)]


def test_similarity_bounds(spark):
    f = spark.createDataFrame([(i, "t", "all") for i in range(30)] + [(0, "t", "x"), (1, "t", "x")], "id int, field string, feature string")
    kept = similarity.idf(similarity.document_frequency(f), 30)
    assert [r.feature for r in kept.collect()] == ["x"]


def test_frequencies_shuffle_counts_only(spark):
    lists = spark.createDataFrame([(i, ["all", "all", f"own{i}", "x" if i < 2 else "all"]) for i in range(30)], "id int, features array<string>")
    df = similarity.frequency_of(lists)
    assert {r.feature: r.df for r in df.where("df > 1").collect()} == {"all": 30, "x": 2}
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
