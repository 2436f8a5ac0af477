"""Registered queries of the subpackage: ``QUERIES[name] = (function, SQL)``.

Each function takes (spark, sf_dir), applies one operator with production
parameters to its whole table and returns the contract's columns.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.llm import (collocations, context_mixing, filter_audit, imatch, jaccard_join, mixing, packing, quality_fm, quality_rules,
                           sanitise, secret_scan, substring_dedup, toxicity)
from basinflow.llm.exchange import NO_ID
from basinflow.llm.store import read_table


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = quality_rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    v = quality_rules.judge(docs.select("doc_id", "text"), rules)
    return v.select("doc_id", *[F.col(f"verdict.{c}") for c in quality_rules.COUNTS],
                    F.col("verdict.base_failed"), F.col("verdict.kept"), F.col("verdict.rule"))


def byte_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# Residual tokens decide; residual documents and attention cost break ties.
PACK_WEIGHTS = (1.0, 0.1, 0.1)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"), byte_bpe_path())
    return packing.pack(pieces, weights=PACK_WEIGHTS).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# Production mixture: shares of tokens by source, language and topic group.
MIX_TOPICS = 8
MIX_TARGETS = {
    "source": {f"src{k}": 0.05 for k in range(20)},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "topic": {str(k): 1 / MIX_TOPICS for k in range(MIX_TOPICS)},
}
MIX_FRACTION = 0.5


def op2_mix_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = mixing.mix(docs, MIX_TARGETS, MIX_FRACTION, topics=MIX_TOPICS)
    return out.select("doc_id", "mix.*")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read_table(spark, sf_dir, "documents"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_neighbours(read_table(spark, sf_dir, "documents"))


def _is_training(ids: np.ndarray) -> np.ndarray:
    return np.array([i == NO_ID or zlib.crc32(str(i).encode()) % 7 != 2 for i in ids.tolist()], bool)


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    out = context_mixing.score(docs, ~held_out, _is_training)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                      "bits_per_byte")


def _scored(docs: DataFrame, model, threshold: float) -> DataFrame:
    scored = toxicity.with_score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _scored(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")), 0.5)


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _scored(docs, quality_fm.fit(docs, read_table(spark, sf_dir, "labels")), 0.3)


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.judged(secret_scan.candidates(read_table(spark, sf_dir, "documents")))
    base = F.filter("spans", lambda s: s["kind"] != "reuse")

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind):
        return count(lambda s: s["kind"] == kind)

    return found.select(
        F.col("id").alias("doc_id"),
        *[of_kind(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_copied"),
        of_kind("reuse").alias("n_reuse"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(filter_audit.masks(docs, read_table(spark, sf_dir, "labels")))


def op12_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(sanitise.PATTERNS))

    def of_kind(*kinds):
        return F.size(F.filter("spans", lambda s: s["kind"].isin(*kinds))).cast("long")

    return found.select(
        "doc_id", *[of_kind(k).alias(f"n_{k}") for k in sanitise.PATTERNS],
        F.sha2(sanitise.span_text(base).cast("binary"), 256).alias("base_sha256"),
        sanitise.span_text(F.col("spans")).alias("spans"),
        of_kind("remove").alias("n_remove"), of_kind("general").alias("n_general"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents").select("text", "lang"))


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
), first AS (SELECT g, min(doc_id) AS owner FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM win JOIN first USING (g) WHERE owner < doc_id
), word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS txt, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [1]
                                       ELSE range(1, len(ws) - 3) END) AS i FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM both_have JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), reach(node, label) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT link.y, reach.label FROM reach JOIN link ON link.x = reach.node WHERE reach.label < link.y
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
JOIN (SELECT node, min(label) AS component_id FROM reach GROUP BY node) r ON r.node = w.doc_id
"""

OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
    len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id
), cell AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic, len(list_filter(fails, lambda x: x)) AS many
  FROM m GROUP BY part, fails
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), turn AS (
  SELECT filter_order, step, list_transform(range(1, 6), lambda k: ascii(filter_order[k]) - 64) AS f
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), each AS (
  SELECT part, filter_order, step, n, good, toxic, many, fails[f[step]] AS failed,
         len(list_filter(f[1:step - 1], lambda k: fails[k])) > 0 AS gone_before
  FROM cell, turn
)
SELECT part, filter_order, step::INT AS step,
  coalesce(sum(n) FILTER (NOT gone_before AND NOT failed), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (NOT gone_before AND failed), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (gone_before AND failed), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (failed AND many = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (NOT gone_before AND failed), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (NOT gone_before AND failed), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // greatest(many, 1)) FILTER (failed), 0)::BIGINT AS shapley
FROM each GROUP BY part, filter_order, step
"""

OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
start AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
gram AS (
  SELECT lang, unnest([ws[i:i], CASE WHEN i + 1 <= len(ws) THEN ws[i:i + 1] END, CASE WHEN i + 2 <= len(ws) THEN ws[i:i + 2] END]) AS g
  FROM start
), f AS (SELECT lang, g, count(*) AS f FROM gram WHERE g IS NOT NULL GROUP BY lang, g),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cand AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f)) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.g = c.g[:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]
), scored AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, part AS g, max(a) AS a
  FROM (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS part FROM cand WHERE len(g) = 3) GROUP BY lang, part
), kept AS (
  SELECT s.lang, array_to_string(s.g, ' ') AS phrase, s.a, l, r, score
  FROM scored s LEFT JOIN inside b ON b.lang = s.lang AND b.g = s.g
  WHERE b.a IS NULL OR 100 * b.a < 50 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""

QUERIES = {
    "op11_filter_audit": (op11_filter_audit, OP11_SQL),
    "op12_sanitise": (op12_sanitise, None),
    "op13_collocations": (op13_collocations, OP13_SQL),
    "op5_context_mixing": (op5_context_mixing, None),
    "op8_imatch": (op8_imatch, None),
    "op10_jaccard_join": (op10_jaccard_join, OP10_SQL),
    "op3_substring_dedup": (op3_substring_dedup, OP3_SQL),
    "op2_mix_raking": (op2_mix_raking, None),
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op4_toxicity": (op4_toxicity, None),
    "op9_quality_fm": (op9_quality_fm, None),
    "op6_secret_ownership": (op6_secret_ownership, None),
    "op7_quality_rules": (op7_quality_rules, None),
}
