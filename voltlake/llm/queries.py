"""Queries of the operators of this package over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from voltlake.llm import bpe, conversations, embedding, langid, packing, pii, quality, runs, secrets, simhash, spotsigs, substring, toxicity
from voltlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of those that SQL can express.
ORACLE: dict[str, str] = {}


def register(name: str):
    def keep(fn):
        QUERIES[name] = fn
        return fn
    return keep


@register("op1_byte_bpe")
def op1_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@register("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.learn(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@register("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark, sf_dir):
    out = simhash.near_copies(table(spark, sf_dir, "documents"), words=3, bits=2)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op8_substring_dedup")
def op8_substring_dedup(spark, sf_dir):
    return substring.digests(table(spark, sf_dir, "documents"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", langid.held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "evidence")


@register("op3_personal_data")
def op3_personal_data(spark, sf_dir):
    return pii.detect(table(spark, sf_dir, "documents"), pii.train())


@register("op6_secret_scan")
def op6_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.train(spark))


@register("op4_spot_signatures")
def op4_spot_signatures(spark, sf_dir):
    return spotsigs.report(table(spark, sf_dir, "documents"))


@register("op10_embedding_near_dedup")
def op10_embedding_near_dedup(spark, sf_dir):
    return embedding.near_copies(table(spark, sf_dir, "embeddings"))


@register("op11_conversation_repair")
def op11_conversation_repair(spark, sf_dir):
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


@register("op12_quality_classifier")
def op12_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@register("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    return runs.report(runs.detect(table(spark, sf_dir, "documents"), planted=True))


@register("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


# --- DuckDB SQL ----------------------------------------------------------------------

ORACLE["op8_substring_dedup"] = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM w)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, s + k AS i
  FROM (SELECT doc_id, s, unnest(range(0, 35)) AS k FROM win WHERE h IN (SELECT h FROM again))),
each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

ORACLE["op10_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
tops AS (SELECT x, min(y) AS m FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       least(vec_id, coalesce(m, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN tops ON tops.x = vec_id"""
