"""Registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontamination, exact_dedup, hard_negatives, langid, mixing, ngram_join, packing, pii, spelling, suffix_dedup, toxicity
from .common import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.fit_on(docs, ~held_out)
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir):
    return mixing.mix_sizes(_table(spark, sf_dir, "documents")).drop("copies")


def op4_nearest_neighbours(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_chat_format(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat.conversation_digests(chat.format_conversations(rows.unionByName(extra)))


def op6_pii(spark, sf_dir):
    return pii.digests(pii.find_private(_table(spark, sf_dir, "documents")))


def op7_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels, ~held_out)
    return toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("evidence")


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op9_packing(spark, sf_dir):
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op10_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.link_components(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), modulus=199)


def op13_decontamination(spark, sf_dir):
    return decontamination.leak_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_chat_format": op5_chat_format,
    "op6_pii": op6_pii,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_packing": op9_packing,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op3_mixing": mixing.MIX_SQL,
    "op11_hard_negatives": hard_negatives.NEGATIVES_SQL,
    "op13_decontamination": decontamination.LEAK_SQL,
    "op4_nearest_neighbours": """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND list_count(embedding) = len(embedding) AND isfinite(list_min(embedding)) AND isfinite(list_max(embedding))
    AND (list_min(embedding) <> 0 OR list_max(embedding) <> 0)),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, min(sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY row_number() OVER w <= 10
""",
    "op5_chat_format": r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) t(i)),
e AS (SELECT *, length(regexp_replace(role, '([\\<"])', 'xx', 'g')) + length(regexp_replace(text, '([\\<"])', 'xx', 'g')) AS escaped FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(escaped + length('<turn role=""></turn>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
}
