"""The queries opN_<name> on the driver's tables, and the SQL that must agree."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm import decontaminate as decon
from gaugework.llm import html, language, mixture, neardup, pii, quality, shard, tokens, warc
from gaugework.llm.common import importable, materialize, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def put(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return put


def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


LEDGER_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r CROSS JOIN range(5) AS q(k) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM
  (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, (SELECT count(*) FROM range(1, len(w)) AS q(k) WHERE w[k] = w[k + 1])::BIGINT AS n_stutter, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
  coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
  + CASE WHEN 100 * n_stutter > 20 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits FROM m)
"""


def ledger_of(spark, sf_dir):
    """The ledger of all documents, evaluated and stored once; policies and ablations read it."""
    return materialize(quality.ledger(docs(spark, sf_dir).select("doc_id", "text")).drop("text"), "ledger")


@query(
    LEDGER_SQL
    + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
  fail_bits & 119 = 0 AS kept, fail_bits FROM f"""
)
def op3_quality_ledger(spark, sf_dir):
    """3: measurements, failure bits and the current policy's verdict of every document."""
    entries = quality.apply_policy(quality.apply_policy(ledger_of(spark, sf_dir), "base", "base_kept"), quality.CURRENT)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits",
    )


@query(
    LEDGER_SQL
    + """, masks AS (SELECT * FROM (VALUES ('too_few_words', 1), ('repeated_windows', 2), ('symbol_heavy', 4), ('short_words', 16), ('long_words', 32), ('stutter', 64)) v(rule, bit))
SELECT 'v2' AS policy, rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits & 119 = bit) AS n_sole, count(*) FILTER (fail_bits & 119 = 0) AS n_kept,
  count(*) AS n_documents FROM f CROSS JOIN masks GROUP BY rule"""
)
def quality_ablations(spark, sf_dir):
    """Beside 3: for each rule of the current policy, what it rejects, and alone, from the stored bits."""
    return quality.ablations(ledger_of(spark, sf_dir))


@query(r"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d CROSS JOIN s WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, p.n, k, item_id FROM p JOIN win ON p.g = win.g AND p.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT word_at) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS word_at FROM h) GROUP BY doc_id),
ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN ids USING (doc_id)
""")
def op5_decontaminate(spark, sf_dir):
    """5: words of every document inside an occurrence of a benchmark window."""
    out = decon.decontaminate(docs(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def learnable(doc_id: str = "doc_id"):
    """Documents that a model may learn from; those without an id are."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1, F.lit(True))


@query()
def op2_language_id(spark, sf_dir):
    """2: language of every document, learned on those that are not held out."""
    rows = docs(spark, sf_dir)
    model = language.train(rows.where(learnable()), tokenizer_path("piece_bpe_32k.model"))
    out = language.predict(rows.select("doc_id", "text"), model)
    return out.select("doc_id", (~learnable()).alias("held_out"), "lang_pred", "score")


@query()
def op6_token_store(spark, sf_dir):
    """6: token ids of every document, written to the store and read back."""
    folder = work_dir(spark, "tokens")
    tokens.write_store(docs(spark, sf_dir).select("doc_id", "text"), folder, tokenizer_path("byte_bpe_50k.json"))
    return tokens.read_store(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op10_html_text(spark, sf_dir):
    """10: main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = html.extract(pages)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op4_histogram_shards(spark, sf_dir):
    """4: eight shards of nearly equal bytes."""
    out = shard.shard(docs(spark, sf_dir).select("doc_id", "text"), 8)
    return out.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query(r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p),
b AS (SELECT *, lpad(array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || h[i])::INT), 4, '0')), ''), 160, '0') AS bits FROM f)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32),
  lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(1, 6), lambda j: (bits[5 * k + j])::INT * (1 << (5 - j))))::INT]), '') AS payload_digest,
  CASE WHEN page_id = first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id OR first_id IS NULL THEN NULL ELSE first_id END AS refers_to FROM b
""")
def op8_warc_archive(spark, sf_dir):
    """8: every page as a WARC record, written and read back."""
    folder = work_dir(spark, "warc")
    warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: A key for shows and tests; a corpus to be published needs one that is kept secret.
DEMONSTRATION_KEY = "gaugework-demonstration-key"


@query()
def op7_pii_pseudonyms(spark, sf_dir):
    """7: every document with its personal data replaced, and counts by kind."""
    out = pii.pseudonymize(docs(spark, sf_dir).select("doc_id", "text"), DEMONSTRATION_KEY)
    return out.select("doc_id", "text", *[f"n_{k.name}" for k in pii.KINDS], "n_pii")


def _level_sql(name: str, source: str, parent: str, node: str) -> str:
    """CTEs that share budget b among nodes with weight w and capacity c, as mixture.share does."""
    by = f"PARTITION BY {parent} ORDER BY c::DOUBLE / w::DOUBLE, {node}"
    return f"""
{name}_1 AS (SELECT *, b - coalesce(sum(c) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
  sum(w) OVER ({by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ww FROM {source}),
{name}_2 AS (SELECT *, min(CASE WHEN c * ww <= l * w THEN 1 ELSE 0 END) OVER ({by} ROWS UNBOUNDED PRECEDING) AS f FROM {name}_1),
{name}_3 AS (SELECT *, b - coalesce(sum(c) FILTER (f = 1) OVER (PARTITION BY {parent}), 0) AS r, sum(w) FILTER (f = 0) OVER (PARTITION BY {parent}) AS ow,
  sum(w) FILTER (f = 0) OVER ({by} ROWS UNBOUNDED PRECEDING) AS cw FROM {name}_2),
{name} AS (SELECT * EXCLUDE (b), CASE WHEN f = 1 THEN c ELSE (r * cw) // ow - (r * (cw - w)) // ow END::HUGEINT AS b FROM {name}_3)"""


def mixture_sql(documents: str = "documents", result: str = "SELECT doc_id, domain, lang, source, n_tokens, unnest(range(n))::INTEGER AS epoch FROM picked WHERE n > 0") -> str:
    return (
        r"""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS th, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  ['web', 'books', 'code', 'talk'][1 + coalesce(try_cast(regexp_extract(source, '(\d+)$', 1) AS BIGINT), 0) % 4] AS domain,
  (coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) + 1)::BIGINT AS n_tokens FROM """
        + documents
        + r"""),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS t, 2 * sum(n_tokens)::HUGEINT AS cap,
  CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END::HUGEINT AS wd,
  CASE lang WHEN 'en' THEN 5 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 ELSE 1 END::HUGEINT AS wl,
  CASE source WHEN 'src0' THEN 3 ELSE 1 END::HUGEINT AS ws FROM d GROUP BY domain, lang, source),
n1 AS (SELECT domain, max(wd) AS w, sum(cap)::HUGEINT AS c, (SELECT sum(t) * 9 // 10 FROM leaf)::HUGEINT AS b FROM leaf GROUP BY domain),"""
        + _level_sql("p1", "n1", "1", "domain")
        + """,
n2 AS (SELECT domain, lang, max(wl) AS w, sum(cap)::HUGEINT AS c, any_value(p1.b) AS b FROM leaf JOIN p1 USING (domain) GROUP BY domain, lang),"""
        + _level_sql("p2", "n2", "domain", "lang")
        + """,
n3 AS (SELECT domain, lang, source, max(ws) AS w, sum(cap)::HUGEINT AS c, any_value(p2.b) AS b FROM leaf JOIN p2 USING (domain, lang) GROUP BY domain, lang, source),"""
        + _level_sql("p3", "n3", "domain, lang", "source")
        + """,
plan AS (SELECT domain, lang, source, (p3.b // t)::BIGINT AS whole, (p3.b % t)::BIGINT AS rest FROM p3 JOIN leaf USING (domain, lang, source)),
keyed AS (SELECT d.*, whole, rest, md5(concat_ws(':', 'epoch', whole::VARCHAR, coalesce(doc_id::VARCHAR, ''), th)) AS k FROM d JOIN plan USING (domain, lang, source)),
picked AS (SELECT *, whole + CASE WHEN rest > 0 AND sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) <= rest
  THEN 1 ELSE 0 END AS n FROM keyed)
"""
        + result
    )


@query(mixture_sql())
def op9_mixture(spark, sf_dir):
    """9: every document that the mixture takes, once for each epoch."""
    rows = docs(spark, sf_dir).select("doc_id", "text", "lang", "source")
    out = mixture.mix(rows, mixture.corpus_path(), mixture.corpus_weights(), mixture.corpus_budget(), keep=["doc_id", "lang", "source"])
    return out.select("doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "n_tokens", "epoch")


@query(r"""
WITH RECURSIVE w AS (SELECT doc_id, md5(text) AS node, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
nodes AS (SELECT node, any_value(w) AS w FROM w WHERE len(w) > 0 GROUP BY node),
s AS (SELECT node, g, count(*) AS c FROM (SELECT node, array_to_string(w[i:i + 4], ' ') AS g FROM
  (SELECT node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM nodes)) GROUP BY node, g),
n AS (SELECT node, sum(c) AS n FROM s GROUP BY node),
e AS (SELECT a.node AS a, b.node AS b, sum(least(a.c, b.c)) AS c FROM s AS a JOIN s AS b USING (g) WHERE a.node < b.node GROUP BY a.node, b.node),
l AS (SELECT a, b FROM e JOIN n AS x ON a = x.node JOIN n AS y ON b = y.node WHERE 1000 * c >= 800 * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT node, node AS other FROM nodes UNION SELECT reach.node, u.b FROM reach JOIN u ON reach.other = u.a),
label AS (SELECT node, min(other) AS label FROM reach GROUP BY node),
class AS (SELECT label, min(doc_id) AS class_id, count(*) AS class_size FROM w JOIN label USING (node) GROUP BY label)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(class_size, 1)::BIGINT AS class_size
FROM w LEFT JOIN label USING (node) LEFT JOIN class USING (label)
""")
def op1_near_duplicates(spark, sf_dir):
    """1: class of every document, by exact and near copies."""
    return neardup.near_duplicates(docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", "class_id", "class_size")
