"""The queries of this package, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mairie.llm import chat, extraction, language, lines, manifest, minhash, mixing, negatives, packing, pii, secrets, spans, sql, vectors
from mairie.llm.common import store, table


# Conversation -7: texts that look like the template's own control strings.
LOOKALIKE = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(LOOKALIKE).alias("text"),
    )
    return chat.conversation_digests(chat.format_turns(rows.union(added))).drop("n_tokens", "n_loss_tokens")


OP1_SQL = r"""
with rows as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), shown as (
  select *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') as escaped,
    case role when 'user' then '### User: ' when 'assistant' then '### Assistant: ' else '### System: ' end as header
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(header) + length(escaped) + 8) as bigint) as formatted_chars
from shown group by conv_id
"""


def op2_multi_index_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = spans.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op4_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"))
    # The digest is taken where the ids are, so the ids need not travel with the ranks.
    return packing.pack(store(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"))


def _count(kind: str):
    return F.size(F.filter(F.split("base", ","), lambda x: x.startswith(kind + ":"))).cast("bigint").alias("n_" + kind)


def op5_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_private(docs, pii.fit(docs))
    return found.select("doc_id", *map(_count, pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(3))
    model = language.fit(docs.select("doc_id", "text", "lang"), F.coalesce(rest("doc_id") != 1, F.lit(False)))
    found = language.predict(docs, model)
    return found.select("doc_id", F.coalesce(rest("doc_id") == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    # Copies of one document lie in several shards; rows of a document share all but copy, shard and position.
    return mixed.groupBy("doc_id", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("size"))), F.lit(0)).alias("taken"),
    )


def op8_char_cnn_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.fit(docs))
    return found.select("doc_id", *map(_count, secrets.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = lines.judge_documents(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words",
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = manifest.build(table(spark, sf_dir, "documents"), changed=manifest.lowered_leaf(tampered))
    checked = manifest.verify(tree, F.coalesce("changed", "leaf"))
    return checked.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "lang", "place")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_multi_index_near_dedup": op2_multi_index_near_dedup,
    "op3_repeated_spans": op3_repeated_spans,
    "op4_nnls_packing": op4_nnls_packing,
    "op5_semi_markov_pii": op5_semi_markov_pii,
    "op6_language_id": op6_language_id,
    "op7_source_mixing": op7_source_mixing,
    "op8_char_cnn_secrets": op8_char_cnn_secrets,
    "op9_line_quality": op9_line_quality,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op1_chat_formatting": OP1_SQL,
    "op2_multi_index_near_dedup": sql.NEAR_VECTORS,
    "op3_repeated_spans": sql.REPEATED_SPANS,
    "op9_line_quality": sql.LINE_QUALITY,
    "op10_minhash_near_dedup": sql.NEAR_DOCUMENTS,
    "op12_merkle_manifest": sql.MERKLE,
    "op13_hard_negatives": sql.NEGATIVES,
}
