"""The operators as named queries over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeline.llm import (
    bm25,
    embedding_links,
    mixing,
    packing,
    pattern_packing,
    periodic_runs,
    quality,
    simhash,
    source_divergence,
    token_counts,
    token_records,
    toxicity,
    warc_zip,
)
from gaugeline.llm.common import WORD, load
from gaugeline.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


WORDS_SQL = r"coalesce(len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+')), 0)"

MIX_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {WORDS_SQL.format("text")} AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0'), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
-- Cut off and share again, round after round, until no target is above its cap.
fill(round, source, source_size, weight, capped) AS (
  SELECT 0, source, source_size, weight, source_size = 0 FROM w
  UNION ALL
  SELECT round + 1, source, source_size, weight,
         capped OR weight * (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())
                   >= 3 * source_size * sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ()
  FROM fill WHERE round < (SELECT count(*) FROM w)),
final AS (SELECT * FROM fill WHERE round = (SELECT count(*) FROM w)),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE
    CAST((sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ()) * weight AS DOUBLE)
    / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
  FROM final),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole + CASE WHEN budget > 0 AND (upto <= budget OR
         (upto - own < budget AND upto - budget < budget - (upto - own))) THEN 1 ELSE 0 END AS BIGINT) AS copies,
       copies * size AS taken
FROM r"""


@query("op1_mixing", MIX_SQL)
def _(spark, sf_dir):
    return mixing.mix(load(spark, sf_dir, "documents"))


@query("op2_token_records")
def _(spark, sf_dir):
    folder = work_folder(spark, "token-records")
    manifest = token_records.write_records(
        load(spark, sf_dir, "documents"), folder, tokenizer("byte_bpe_50k.json"), end_id=0)
    return token_records.read_records(manifest, folder).select(
        "doc_id", F.col("before").alias("start"), "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_simhash")
def _(spark, sf_dir):
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_packing")
def _(spark, sf_dir):
    pieces = packing.pack_documents(load(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op5_toxicity")
def _(spark, sf_dir):
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


LINKS_SQL = """
WITH RECURSIVE u AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON e.vec_id = c.x LEFT JOIN n ON e.vec_id = n.x"""


@query("op6_embedding_links", LINKS_SQL)
def _(spark, sf_dir):
    return embedding_links.linked_vectors(load(spark, sf_dir, "embeddings"))


@query("op7_quality")
def _(spark, sf_dir):
    return quality.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
w AS (SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((('0x' || substr(hex || '0', 5 * i // 4 + 1, 2))::INTEGER >> (3 - 5 * i % 4)) & 31) + 1 AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM w"""


@query("op8_warc_zip", WARC_SQL)
def _(spark, sf_dir):
    folder = work_folder(spark, "warc-zip")
    packages = warc_zip.write_packages(load(spark, sf_dir, "pages"), folder)
    return warc_zip.read_packages(packages, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_token_counts")
def _(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, tokenizer("piece_bpe_32k.model"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


BM25_SQL = """
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x20\\x09-\\x0D]+')) AS t FROM documents),
p AS (SELECT doc_id, t, count(*) AS tf FROM w GROUP BY ALL),
l AS (SELECT doc_id, sum(tf) AS dl FROM p GROUP BY doc_id),
g AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM l) / (SELECT count(*) FROM documents) AS mean),
d AS (SELECT t, count(*) AS df FROM p GROUP BY t),
i AS (SELECT p.*, l.dl, ln(1 + (g.n - df + 0.5) / (df + 0.5)) AS idf, g.mean FROM p JOIN l USING (doc_id) JOIN d USING (t), g),
s AS (SELECT q.doc_id AS query_id, i.doc_id, sum(q.tf * i.idf * i.tf * 2.2 / (i.tf + 1.2 * (0.25 + 0.75 * i.dl / i.mean))) AS score
      FROM p q JOIN i USING (t) WHERE q.doc_id % 20 = 0 GROUP BY ALL),
-- Scores that are equal but for rounding are ties.
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 4) AS score FROM r WHERE rank <= 10"""


@query("op10_bm25", BM25_SQL)
def _(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    found = bm25.search(docs, docs.where("doc_id % 20 = 0"))
    return found.select("query_id", "rank", "doc_id", F.round("score", 4).alias("score"))


@query("op11_pattern_packing")
def _(spark, sf_dir):
    pieces = pattern_packing.pack_documents(load(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text: one document in ten goes on periodically from some word on, as the contract of op12 says."""
    words = (
        docs.select("doc_id", "text", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"))
        .withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
        .withColumn("a", F.expr("cast(h div 10 % nullif(size(w), 0) as int)"))
        .withColumn("p", F.expr("cast(1 + (size(w) - a) div (3 + h div 10 % 8) as int)"))
    )
    periodic = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p])), ' ')")
    return words.select("doc_id", F.when(F.size("w") > 0, periodic).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def _(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_planted_periods(load(spark, sf_dir, "documents")))
    best = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) -> case
        when b is null or r.length * b.period > b.length * r.period then r
        when r.length * b.period = b.length * r.period and struct(r.start, r.period) < struct(b.start, b.period) then r
        else b end)""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        F.col("key").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
a AS (SELECT lang, source, term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
      FROM a JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 5) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q
      FROM a JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y USING (lang, term) GROUP BY ALL),
s AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(f, 0) AS f FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
      LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = o.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
n AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item COLLATE "C") AS rank FROM s)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM n WHERE part = 'pair' OR rank <= 50"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def _(spark, sf_dir):
    return source_divergence.source_divergence(load(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def _(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
