"""The registered queries of this subpackage. Each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoarfrost.llm.aliases import UrlRule, judge_urls
from hoarfrost.llm.common import read
from hoarfrost.llm.dom import extract
from hoarfrost.llm.dom import learn as learn_pages
from hoarfrost.llm.leaks import find_leaks
from hoarfrost.llm.maxscore import top_k, whole_terms
from hoarfrost.llm.negatives import hard_negatives, labelled_terms
from hoarfrost.llm.packing import pack_documents
from hoarfrost.llm.quality import score_documents
from hoarfrost.llm.runs import collapse_runs
from hoarfrost.llm.separators import count_tokens
from hoarfrost.llm.sharding import shard_records
from hoarfrost.llm.simhash import near_duplicates
from hoarfrost.llm.suffixes import remove_repeats
from hoarfrost.llm.wavelet import index_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, with the items."""
    found = find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "shared", "answered", "first_word", "words")


@query
def op2_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document over 40 shards of equal weight."""
    return shard_records(read(spark, sf_dir, "documents"), [1.0] * 40)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that start more than once."""
    found = remove_repeats(read(spark, sf_dir, "documents"), 400, as_text=True)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.col("kept_text").alias("text"),
    )


@query
def op4_separator_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, from flat files of two-byte ids with 50256 after each."""
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 50256)


@query
def op5_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through wavelet shards: written, read back, decoded."""
    return index_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


@query
def op6_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labelled ones that are not held out."""
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_trie_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents: three-word shingles, two bits."""
    found = near_duplicates(read(spark, sf_dir, "documents"), 3, 2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for each vector whose id is divisible by 50, among all others."""
    rows = whole_terms(read(spark, sf_dir, "embeddings"), "embedding", "vec_id", 256)
    return top_k(rows, rows.where("vec_id % 50 = 0"), 5)


ORACLES["op8_maxscore_search"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS t FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.t, c.t)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
) WHERE rank <= 5
"""


@query
def op9_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, 4096)


@query
def op10_dom_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = read(spark, sf_dir, "pages")
    return extract(pages, learn_pages(pages))


@query
def op11_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100, among all rows."""
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = labelled_terms(vectors.withColumn("label", moved), "embedding", "vec_id", "label", 256)
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))


ORACLES["op11_tree_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS t
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id AS vec_id, a.label = c.label AS alike, list_inner_product(a.t, c.t)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS n FROM s WHERE alike) WHERE n <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM p JOIN s n ON n.ar = p.ar AND NOT n.alike AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
) WHERE rank <= 5
"""

URL_RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


@query
def op12_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision on the address of every page."""
    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


#: Of the links, those that are absolute addresses in double quotes; pages here declare no other kind.
ORACLES["op12_redirect_filter"] = """
WITH RECURSIVE p AS (
  SELECT page_id, url, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), rules(verdict, h, q) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), links AS (
  SELECT url AS a, unnest(regexp_extract_all(html, '(?i)<link rel="canonical" href="([^"]+://[^"]*)"', 1)) AS b FROM p
  UNION SELECT url, unnest(regexp_extract_all(html, '(?i)<meta http-equiv="refresh" content="[0-9.]+; *url=([^"]+://[^"]*)"', 1)) FROM p
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
ends AS (
  SELECT b, translate(regexp_extract(b, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(b, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM (SELECT DISTINCT b FROM edges)
), judged AS (
  SELECT b, arg_max(verdict, length(h || q)) AS verdict
  FROM ends JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY b
), bad AS (
  SELECT r.a FROM reach r JOIN judged j ON r.b = j.b GROUP BY r.a HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow')
), fit AS (
  SELECT p.rowid AS id, arg_max(h || q, length(h || q)) AS rule, arg_max(verdict, length(h || q)) AS verdict
  FROM (SELECT row_number() OVER () AS rowid, * FROM p) p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY p.rowid
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN url IN (SELECT a FROM bad) THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' WHEN url IN (SELECT a FROM bad) THEN 'alias' ELSE 'default' END AS how
FROM (SELECT row_number() OVER () AS rowid, * FROM p) p LEFT JOIN fit ON fit.id = p.rowid
"""


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents; in those whose h ends in 0, words from a on repeat with period p."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    docs = docs.withColumn("g", F.when(h % 10 == 0, F.floor(h / 10))).withColumn("w", F.when(F.col("g").isNotNull(), words))
    docs = docs.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int")))
    docs = docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
    found = collapse_runs(docs, 24, 3)
    more = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = found.select("*", more.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
