"""The operators of this package over the test tables, as registered queries."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.llm import (
    best_fit,
    hard_negatives,
    language_model,
    line_windows,
    merkle,
    mixing,
    near_duplicates,
    packing,
    quality,
    repeats,
    token_counts,
    training_order,
    vector_graph,
)
from lakeproof.llm.frames import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# How the mixture is weighed in op10 and in the pipeline.
WEIGHTS = {
    "domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0},
    "language": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0},
}
MIX_FRACTION = 0.5


def importable(spark: SparkSession) -> None:
    """Let workers on this machine import the package from where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def tree():
    """Domain, language and source of a document. Sources are spread over four domains by their name."""
    return {
        "domain": F.concat(F.lit("d"), F.pmod(F.xxhash64("source"), F.lit(4)).cast("string")),
        "language": F.col("lang"),
        "origin": F.col("source"),
    }


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.lm_scores(read(spark, sf_dir, "documents"))


ORACLES["op2_lm_scores"] = r"""
WITH listed AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM listed),
place AS (
  SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS p, lag(w, 2) OVER (PARTITION BY r ORDER BY i) AS q FROM word),
one AS (SELECT w, count(*) AS c FROM word GROUP BY w),
two AS (SELECT p, w, count(*) AS c FROM place WHERE i > 1 GROUP BY p, w),
three AS (SELECT q, p, w, count(*) AS c FROM place WHERE i > 2 GROUP BY q, p, w),
total AS (SELECT count(*) AS n FROM word),
scored AS (
  SELECT place.r, i > 1 AND CASE WHEN i = 2 THEN two.c < 2 ELSE three.c < 2 END AS backed,
         CASE WHEN three.c >= 2 THEN ln(three.c::DOUBLE / before_two.c)
              WHEN two.c >= 2 THEN ln(two.c::DOUBLE / before_one.c) + CASE WHEN i > 2 THEN ln(0.4::DOUBLE) ELSE 0 END
              ELSE ln(one.c::DOUBLE / total.n) + (least(i, 3) - 1) * ln(0.4::DOUBLE) END AS s
  FROM place JOIN one ON one.w = place.w CROSS JOIN total
  LEFT JOIN two ON two.p = place.p AND two.w = place.w LEFT JOIN one AS before_one ON before_one.w = place.p
  LEFT JOIN three ON three.q = place.q AND three.p = place.p AND three.w = place.w
  LEFT JOIN two AS before_two ON before_two.p = place.q AND before_two.w = place.p)
SELECT listed.doc_id, count(scored.s) AS n_words, count(*) FILTER (backed) AS n_backed_off, round(avg(s), 6) AS mean_log_score
FROM listed LEFT JOIN scored USING (r) GROUP BY listed.r, listed.doc_id
"""


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), packing.default_path())


@query
def op4_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_vectors(read(spark, sf_dir, "embeddings"))


ORACLES["op4_vector_graph"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.a = e.vec_id) AS n_links,
       min(reach.b) AS component_id, e.vec_id = min(reach.b) AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), token_counts.default_path())


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_shards(read(spark, sf_dir, "documents"), training_order.default_path())


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.line_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


ORACLES["op8_line_dedup"] = r"""
WITH line AS (
  SELECT doc_id, hash(doc_id, text) AS k, i, l, trim(l, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) <> '' AS full_line
  FROM (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
numbered AS (
  SELECT doc_id, k, i, l, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS pos FROM line WHERE full_line),
windows AS (
  SELECT a.doc_id, a.k, a.pos, a.l AS l1, b.l AS l2, c.l AS l3
  FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND a.k = b.k AND b.pos = a.pos + 1
  JOIN numbered c ON a.doc_id = c.doc_id AND a.k = c.k AND c.pos = a.pos + 2),
later AS (
  SELECT doc_id, k, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, k, pos) > 1),
gone AS (SELECT DISTINCT doc_id, k, pos + d AS pos FROM later, (VALUES (0), (1), (2)) AS v(d))
SELECT line.doc_id, count(*) FILTER (full_line) AS n_lines, count(gone.pos) AS n_removed,
       coalesce(string_agg(line.l, chr(10) ORDER BY line.i) FILTER (gone.pos IS NULL), '') AS text
FROM line LEFT JOIN numbered USING (doc_id, k, i) LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.k = line.k AND gone.pos = numbered.pos
GROUP BY line.doc_id, line.k
"""


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(read(spark, sf_dir, "documents"), near_duplicates.Join(words=4))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(read(spark, sf_dir, "documents"), tree(), WEIGHTS, MIX_FRACTION)
    return mixed.select("doc_id", "domain", "language", "origin", "n_tokens", "quota", "n_copies")


@query
def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(read(spark, sf_dir, "documents"), best_fit.default_path())


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampers = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = {"n_chars": F.try_add("n_chars", F.lit(1))}
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered, tampers)


def _spelled(*values: str) -> str:
    return " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values)


ORACLES["op12_merkle"] = f"""
WITH RECURSIVE leaf AS (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({_spelled("doc_id", "source", "lang", "n_chars", "text")}) AS h,
         sha256({_spelled("doc_id", "source", "lang", "n_chars + 1", "text")}) AS changed,
         list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT) AS digits
  FROM documents),
sum AS (
  SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT, digits), lambda crc, d:
    list_reduce(list_prepend(xor(crc, d), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295) AS crc FROM leaf),
placed AS (
  SELECT leaf.*, CASE WHEN crc % 7 = 0 THEN changed ELSE h END AS other, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaf JOIN sum USING (r)),
node AS (
  SELECT lang, 0 AS level, pos, n, h FROM placed UNION ALL
  SELECT lang, level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY lang, level, pos // 2),
sub AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
crown AS (
  SELECT 0 AS level, pos, n, h FROM sub UNION ALL
  SELECT level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM crown WHERE n > 1 GROUP BY level, pos // 2),
climb AS (
  SELECT r, lang, 0 AS level, pos, n, other AS v, '' AS proof FROM placed UNION ALL
  SELECT c.r, c.lang, c.level + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN c.pos % 2 = 0 THEN c.v || coalesce(s.h, '') ELSE s.h || c.v END), c.proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN node s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1),
rise AS (
  SELECT c.r, 0 AS level, sub.pos, sub.n, c.v, c.proof FROM climb c JOIN sub ON sub.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1 UNION ALL
  SELECT c.r, c.level + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN c.pos % 2 = 0 THEN c.v || coalesce(s.h, '') ELSE s.h || c.v END), c.proof || coalesce(s.h, '')
  FROM rise c LEFT JOIN crown s ON s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1)
SELECT placed.doc_id, placed.h AS leaf, sub.h AS subroot, crown.h AS root, sha256(rise.proof) AS proof_sha256,
       rise.v AS folded_root, rise.v = crown.h AS verified
FROM placed JOIN sub ON sub.lang IS NOT DISTINCT FROM placed.lang JOIN rise ON rise.r = placed.r AND rise.n = 1 JOIN crown ON crown.n = 1
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id AND len(a.e) = len(v.e) WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negative AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""
