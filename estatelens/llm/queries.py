"""The registered queries over the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, boilerplate, lm, mixing, packing, pii, quality, repair, secrets, sharding, simhash, substrings, trie


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, by sampled splitters."""
    out = sharding.sharded(_documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of each row whose id is divisible by 20, by robust-pruned graphs."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base formats and spans that boosted trees add."""
    return pii.digest(pii.detected(_documents(spark, sf_dir)))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base formats and random-looking tokens by Markov log-likelihood ratio."""
    return secrets.digest(secrets.detected(_documents(spark, sf_dir)))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust multivariate outliers per language and source."""
    return quality.verdicts(_documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that are boilerplate of its source, dropped."""
    out = boilerplate.cleaned(_documents(spark, sf_dir))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.md5(F.coalesce(F.col("clean"), F.lit("")).cast("binary")).alias("clean_md5"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2048 tokens, by column generation."""
    return packing.packed(_documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and causal self-attention score of every document."""
    return lm.scored(_documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mixing.taken(_documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, by minimal-perfect-hash node tables."""
    return trie.nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that windows of earlier documents cover, by super-k-mers."""
    out = substrings.cleaned(_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation with its faults and cheapest repair, by Hirschberg's recursion."""
    return repair.repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("repaired")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_nearest_neighbours, op3_pii, op4_secrets, op5_quality_rules, op6_line_dedup, op7_simhash, op8_packing, op9_lm_scoring, op10_mixing, op11_prefix_trie, op12_substring_dedup, op13_conversation_repair, pipeline)
}

OP2 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

OP6 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '-') AS host, text, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT DISTINCT host, coalesce(text, '') AS page FROM d),
t AS (SELECT host, count(*) AS pages FROM u GROUP BY host),
l AS (SELECT DISTINCT host, page, trim(x) AS line FROM (SELECT host, page, unnest(string_split(page, chr(10))) AS x FROM u) WHERE trim(x) <> ''),
b AS (SELECT host, list(line) AS bad FROM (SELECT l.host, line FROM l JOIN t ON l.host = t.host GROUP BY l.host, line, pages HAVING count(*) >= 5 AND count(*) > 0.02 * pages) GROUP BY host),
j AS (SELECT d.*, list_filter(ls, lambda x: trim(x) = '' OR NOT coalesce(list_contains(bad, trim(x)), false)) AS rest FROM d LEFT JOIN b ON d.host = b.host)
SELECT doc_id, coalesce(len(list_filter(ls, lambda x: trim(x) <> '')), 0)::BIGINT AS n_lines,
       CASE WHEN text IS NULL THEN 0 ELSE len(ls) - len(rest) END::BIGINT AS n_dropped,
       md5(CASE WHEN text IS NULL THEN '' ELSE array_to_string(rest, chr(10)) END) AS clean_md5 FROM j
"""

OP11 = """
WITH t AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bits AS (SELECT conv_id, ts, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1))) AS b FROM t),
h AS (SELECT conv_id, ts, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda x, y: xor(x >> 1, CASE WHEN xor(x, y) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295) % 6 AS h FROM bits),
r AS (SELECT h.conv_id, list_concat(coalesce(f.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN t f ON f.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS depth FROM r),
n AS (SELECT ts[1:depth] AS px, depth, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (WHERE len(ts) = depth) AS n_ends,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(ts) = depth), '')) AS ends_sha256 FROM p GROUP BY ALL),
k AS (SELECT px[1:depth - 1] AS px, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
a AS (SELECT px, depth, unnest(range(0, depth + 1)) AS up, CASE WHEN depth > 0 THEN (n_convs - 1) * length(px[depth].t) ELSE 0 END AS saved, CASE WHEN n_convs = n_ends THEN 1 ELSE 0 END AS leaf FROM n),
s AS (SELECT px[1:up] AS px, up AS depth, sum(saved) AS saved, sum(leaf) AS leaves FROM a GROUP BY ALL)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.depth = n.depth AND s.px = n.px LEFT JOIN k ON k.depth = n.depth AND k.px = n.px LEFT JOIN n o ON o.depth = n.depth - 1 AND o.px = n.px[1:n.depth - 1]
"""

OP12 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13),
m AS (SELECT r, k, doc_id, min(doc_id) OVER (PARTITION BY array_to_string(w[k:k + 12], ' ')) AS m FROM s),
g AS (SELECT r, list(p) AS gone FROM (SELECT DISTINCT r, unnest(range(k, k + 13)) AS p FROM m WHERE m < doc_id) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(gone, i), false)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN g ON d.r = g.r
"""

ORACLES: dict[str, str] = {"op6_line_dedup": OP6, "op11_prefix_trie": OP11, "op12_substring_dedup": OP12}
