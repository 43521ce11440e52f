"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html_main, language, near_dedup, packing, periods, pii, quality, ranked, repeats, toxicity, warc
from .common import SPACE, let, table


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("ledger")
    failed = ~quality.passes(m.fail_bits, 1)
    return quality.ledger(docs).select(
        "doc_id", m.n_words.alias("n_words"), m.word_chars.alias("word_chars"), m.n_symbols.alias("n_symbols"), m.n_dup_lines.alias("n_dup_lines"),
        m.n_repeat_words.alias("n_repeat_words"), failed.alias("base_failed"), (~failed & quality.passes(m.fail_bits)).alias("kept"), m.fail_bits.alias("fail_bits"),
    )


OP8_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT r, i, ws[i:i+4] AS gram FROM w, unnest(range(1, len(ws) - 3)) AS u(i)),
d AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g),
c AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM d, unnest(range(0, 5)) AS u(k) WHERE n > 1 GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '!!'))::BIGINT AS n_shouts
  FROM w LEFT JOIN c USING (r)),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END + CASE WHEN 2 * n_shouts > n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    log = chat.events_of(turns.unionByName(more))
    return chat.read_back(chat.render(chat.fold(log)))


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
x AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\')) + 2 * len(regexp_extract_all(text, '<</?SYS>>|\[/?INST\]|</?s>|\[[/:]?ROLE\]'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 20 + length(role) END AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM x GROUP BY conv_id
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.col("hits")
    return decontaminate.find(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", h.n_words.alias("n_words"), decontaminate.hit_words(h.spans).alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"), decontaminate.contaminated(h).alias("contaminated"),
    )


OP10_SQL = r"""
WITH norm AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
item AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT item, least(len(ws), 13) AS n, array_to_string(ws[i:i+least(len(ws), 13)-1], ' ') AS g FROM item, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, i, array_to_string(ws[i:i+n-1], ' ') AS g FROM norm, sizes, unnest(range(1, len(ws) - n + 2)) AS u(i)),
hit AS (SELECT r, i, dw.n, item FROM dw JOIN win USING (n, g)),
cov AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, n FROM hit), unnest(range(0, n)) AS u(k) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM norm LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""

def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc.responses(table(spark, sf_dir, "pages"), "page_id", "html", "url")
    records = warc.derive(responses, "key", "payload", "target_uri", "record_id", "warc_date", "headers")
    chars = F.when(F.col("warc_type") == "conversion", F.length(F.decode("block", "UTF-8"))).cast("long")
    return records.select(F.col("key").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length", "block_digest", "source_digest", chars.alias("text_chars"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", F.round("toxicity.severity", 6).alias("severity"), "toxicity.grade", "toxicity.toxic")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("pii")
    count = lambda kind: F.size(F.filter(p.base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.spelled(p.base), 256).alias("base_sha256"), pii.spelled(F.concat(p.base, p.terms)).alias("spans"), F.size(p.terms).cast("long").alias("n_term"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_main.main_text(pages).select("page_id", "url", F.col("main.text").alias("text"), F.length("main.text").cast("long").alias("n_chars"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.classes(docs).select("doc_id", "near.class_id", "near.class_size", "near.n_verified")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("repeats")
    removed = F.aggregate(r.spans, F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", r.n_words.alias("n_words"), removed.alias("n_removed"), F.sha2(r.kept, 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, i, md5(array_to_string(ws[i:i+34], ' ')) AS g FROM d, unnest(range(1, len(ws) - 33)) AS u(i)),
again AS (SELECT g FROM w GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS i FROM w JOIN again USING (g), unnest(range(0, 35)) AS u(k)),
x AS (SELECT d.r, t.i, ws[t.i] AS word FROM d, unnest(range(1, len(ws) + 1)) AS t(i)),
k AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.i) AS kept, count(*) AS n FROM x ANTI JOIN gone ON x.r = gone.r AND x.i = gone.i GROUP BY x.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language.remainder() == 2, F.lit(False))
    models = language.train(language.sample(docs.where(~held_out).select("text", "lang")))
    return language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), models).select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.round("language.score", 6).alias("score"))


def planted(docs: DataFrame) -> DataFrame:
    """Documents in which one in ten, by the checksum of its id, goes over into a period of its own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(words):
        n = F.size(words).cast("long")
        return let(F.struct(n.alias("n"), (g % n).alias("a")), lambda x: let(1 + F.floor((x.n - x.a) / (3 + g % 8)), lambda p: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), x.n - 1), lambda i: F.get(words, F.when(i < x.a, i).otherwise(x.a + (i - x.a) % p).cast("int"))), " ")))

    words = F.filter(F.split("text", SPACE + "+"), lambda w: w != "")
    has = F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return docs.select("doc_id", F.when((h % 10 == 0) & has, let(words, tail)).otherwise(F.col("text")).alias("text"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS b, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
q AS (SELECT b, term, count(*) AS times FROM (SELECT b, unnest(ws) AS term FROM b) GROUP BY b, term),
al AS (SELECT count(*) AS n, sum(len(ws))::BIGINT AS l FROM d WHERE len(ws) > 0),
m AS (SELECT r, 25 + (75 * len(ws) * n) // l AS m FROM d, al WHERE len(ws) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), al),
s AS (SELECT b, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM p JOIN q USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY b, r),
k AS (SELECT b, doc_id, score, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id) AS rank FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k JOIN b USING (b) WHERE rank <= 10
"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.col("periods").runs
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), F.concat(r.period.cast("string"), F.lit("\n")))), "")
    found = periods.runs(planted(table(spark, sf_dir, "documents").select("doc_id", "text"))).withColumn("x", longest)
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-F.col("x").start).alias("start"), F.col("x").length.alias("length"), (-F.col("x").period).alias("period"),
        F.floor(1000 * F.col("x").length / -F.col("x").period).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("periods").collapsed, 256).alias("collapsed_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
           lambda c, x: list_reduce([xor(c, x)] || range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) AS h FROM documents),
a AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a, (h // 10) % 8 + 3 AS parts FROM d),
t AS (
  SELECT r, doc_id, n, CASE WHEN coalesce(h % 10 = 0 AND n > 0, false) THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1]) ELSE ws END AS ws FROM a),
w AS (SELECT r, n, i, ws[i + 1] AS word FROM t, unnest(range(n)) AS u(i)),
e AS (SELECT x.r, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
isl AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e),
st AS (SELECT r, q, min(i) AS s, count(*) + q AS len FROM isl GROUP BY r, q, k HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (SELECT r, s, len, min(q) AS q FROM st GROUP BY r, s, len),
top AS (SELECT r, count(*) AS n_runs, first(s ORDER BY len DESC, s, q) AS s, first(len ORDER BY len DESC, s, q) AS len, first(q ORDER BY len DESC, s, q) AS q,
               string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, i FROM runs, unnest(range(s + q, s + len)) AS u(i)),
kept AS (SELECT w.r, string_agg(word, ' ' ORDER BY w.i) AS words FROM w ANTI JOIN gone ON w.r = gone.r AND w.i = gone.i GROUP BY w.r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period, (1000 * len // q)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM t LEFT JOIN top USING (r) LEFT JOIN kept USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc_derivatives, op2_packing, op3_pii, op4_html_extraction, op5_toxicity, op6_substring_dedup, op7_chat_formatting, op8_quality_rules, op9_minhash_near_dedup, op10_decontamination, op11_ranked_search, op12_language_id, op13_periodic_runs)}
SQL: dict[str, str] = {"op6_substring_dedup": OP6_SQL, "op7_chat_formatting": OP7_SQL, "op8_quality_rules": OP8_SQL, "op10_decontamination": OP10_SQL, "op11_ranked_search": OP11_SQL, "op13_periodic_runs": OP13_SQL}
