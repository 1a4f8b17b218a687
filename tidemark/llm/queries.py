"""The queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_fit_packing, chat_repair, dart_dedup, image_copies, pivot_dedup, quality_classifier, secret_scans, source_mixing, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary of that name is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = chat_repair.repair(_table(spark, sf_dir, "conversations"))
    return repaired.select("conv_id", "turn", "place", "role", "new_role", "action", "inserted", "cost", "rendered")


def op2_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_copies.find_copies(image_copies.render_pages(_table(spark, sf_dir, "pages"))).withColumnRenamed("id", "page_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = quality_classifier.quality_scores(docs, labels)
    return scored.select("doc_id", (quality_classifier.remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.digest(secret_scans.scan_secrets(_table(spark, sf_dir, "documents")))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mixed(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.toxicity_scores(docs, labels)
    return scored.select("doc_id", (quality_classifier.remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_chat_repair, op2_image_copies, op3_quality_classifier, op4_secret_scans, op5_source_mixing, op6_toxicity, op7_minhash_dedup, op8_best_fit_packing, op9_token_counts, op10_embedding_dedup, pipeline)}


def _sql_spans(rule: secret_scans.Rule, number: int) -> str:
    """A list of the rule's spans as structs, by lengths of matches and of the text between them."""
    pattern = rule.pattern.replace("'", "''")
    hits, gaps, values = f"regexp_extract_all(t, '{pattern}', 0)", f"string_split_regex(t, '{pattern}')", f"regexp_extract_all(t, '{pattern}', {rule.group})"
    gap, hit = f"[length(x) FOR x IN {gaps}]", f"[length(x) FOR x IN {hits}]"
    return f"""[{{'s': (list_sum({gap}[1:i]) + coalesce(list_sum({hit}[1:i - 1]), 0))::BIGINT, 'k': {number}, 'e': (list_sum({gap}[1:i]) + list_sum({hit}[1:i]))::BIGINT, 'n': '{rule.kind}'}}
        FOR i IN range(1, len({hits}) + 1) IF length({values}[i]) >= {rule.least}]"""


def _secret_sql() -> str:
    rules = secret_scans.BASE_RULES + secret_scans.MORE_RULES
    base = len(secret_scans.BASE_RULES)
    listed = "array_to_string([x.n || ':' || x.s || ':' || x.e FOR x IN {}], ',')"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS (SELECT doc_id, list_sort({" || ".join(_sql_spans(r, i) for i, r in enumerate(rules))}) AS a FROM d),
    based AS (SELECT doc_id, a, [x FOR x IN a IF x.k < {base}] AS b FROM found)
    SELECT doc_id, {", ".join(f"len([x FOR x IN a IF x.k = {i}]) AS n_{r.kind}" for i, r in enumerate(secret_scans.BASE_RULES))},
           sha256({listed.format("b")}) AS base_sha256, {listed.format("a")} AS spans
    FROM based"""


_MIXING_SQL = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS most FROM totals),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(most, (SELECT max(level) FROM levels) * weight) AS target FROM levels),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM rated
"""

ORACLE_SQL = {"op4_secret_scans": _secret_sql(), "op5_source_mixing": _MIXING_SQL}
