"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries.common import Query, table
from .chat import format_conversations, loss_text, read_back, text_parts
from .common import with_label
from .decontamination import contamination
from .extraction import extract
from .language import fit as fit_languages
from .language import identify
from .near_dedup import near_duplicates
from .packing import pack_documents
from .pii import NAMES, find_personal_data, written
from .quality import SAMPLE_PER_CLASS as QUALITY_SAMPLE
from .quality import fit as fit_quality
from .quality import judge
from .repeat_queries import QUERIES as REPEAT_QUERIES
from .sharding import shard_documents
from .toxicity import fit as fit_toxicity
from .toxicity import SAMPLE_PER_CLASS as TOXIC_SAMPLE
from .toxicity import score_documents
from .vector_queries import QUERIES as VECTOR_QUERIES


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    told = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    turns = told.unionByName(spark.createDataFrame(planted, told.schema)).withColumn("parts", text_parts(F.col("text")))
    done = format_conversations(turns)
    back = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    heard = loss_text(F.col("formatted"), F.col("loss_spans"))
    return done.withColumns({"_back": back, "_heard": heard}).select(
        "conv_id",
        F.size("_back").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("_back", ""), 256).alias("turns_sha256"),
        F.length("_heard").cast("bigint").alias("loss_chars"),
        F.sha2("_heard", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


# A turn costs 48 characters of marks; a backslash and a control string cost one more each.
CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(48 + length(role) + length(text) + length(role || text) - length(replace(role || text, '\', ''))
    + len(regexp_extract_all(role, '<\||</?s>|<</?SYS>>|\[/?INST\]')) + len(regexp_extract_all(text, '<\||</?s>|<</?SYS>>|\[/?INST\]'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS span FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM i)),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS span FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
h AS (SELECT doc_id, s, dw.n, item FROM dw JOIN iw ON dw.span = iw.span AND dw.n = iw.n),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM h) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN l USING (doc_id)
"""


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    # The checksum is taken first, so that the exchange moves no text.
    docs = table(spark, folder, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    placed = shard_documents(docs)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def remainder(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = fit_toxicity(with_label(docs, labels.filter(~held_out), "toxic", TOXIC_SAMPLE))
    done = score_documents(docs, model)
    return done.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_quality(with_label(docs, table(spark, folder, "labels"), "quality", QUALITY_SAMPLE))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(docs, model).select("doc_id", *counts, "base_failed", "kept")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    done = identify(docs, fit_languages(docs.filter(~held_out)))
    return done.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(NAMES[:4])]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id")


QUERIES = {
    "op1_chat_formatting": Query(op1_chat_formatting, CHAT_SQL),
    "op2_toxicity": Query(op2_toxicity),
    "op3_decontamination": Query(op3_decontamination, DECONTAMINATION_SQL),
    "op4_html_extraction": Query(op4_html_extraction),
    "op5_sharding": Query(op5_sharding),
    "op6_packing": Query(op6_packing),
    "op7_quality_rules": Query(op7_quality_rules),
    "op8_language_id": Query(op8_language_id),
    "op9_pii": Query(op9_pii),
    "op10_near_dedup": Query(op10_near_dedup),
    **REPEAT_QUERIES,
    **VECTOR_QUERIES,
}
