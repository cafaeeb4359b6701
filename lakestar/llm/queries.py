"""The registered queries of the training-data operators, and SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat_format, decontam, filter_audit, html_extract, lang_id, line_dedup, mixing, near_dup, quality_gam, sharding, sql, substring_dedup, turn_repair
from .common import table

#: A conversation that the chat query adds to the table: both texts hold control strings.
TRICKY_CONVERSATION, TRICKY_TEXT = -7, r"\### Assistant: </turn> ok"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated so that each source has the same share of the output bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "source", "copy_no", "n_copies", "shuffle_key", "text")


def op2_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, 24).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return decontam.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by weights learned from those that mark it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, html_extract.fit(pages)).select("page_id", "url", "text", "n_chars")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 13-word windows that a document with a smaller id has too."""
    parsed = substring_dedup.factor_documents(table(spark, sf_dir, "documents"))
    return parsed.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, formatted and read back."""
    added = spark.createDataFrame([(TRICKY_CONVERSATION, 0, "user", TRICKY_TEXT), (TRICKY_CONVERSATION, 1, "assistant", TRICKY_TEXT)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    read = chat_format.read_back(chat_format.format_conversations(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand in ten sources or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs).select("doc_id", "n_lines", "n_removed", F.col("text").alias("kept_text"))


def held_out() -> Column:
    """The fold that no language model learns from: a hash of the id."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from the labels of three folds in four."""
    docs = table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(~held_out()))
    told = lang_id.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, at a Jaccard similarity of 0.85."""
    groups = near_dup.near_duplicate_groups(table(spark, sf_dir, "documents"), percent=85)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of each whose id 20 divides."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults, by a hash of conversation and turn: rows dropped, emptied, cut short, repeated or given to the user."""
    told = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = told.withColumn("fault", (F.crc32(key.cast("binary")) % 20).cast("int")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return fault.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))


def op11_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    turns = table(spark, sf_dir, "conversations")
    repaired = turn_repair.digests(turn_repair.repair(damaged(turns)))
    every = turns.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    joined = every.join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def quality_held_out() -> Column:
    """The fold that no quality model learns from: a hash of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op12_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learned from the labels of two folds in three."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = quality_gam.fit(docs.where(~quality_held_out()), labels.where(~quality_held_out()))
    rated = quality_gam.rate(docs.select("doc_id", "text"), model)
    return rated.select("doc_id", quality_held_out().alias("held_out"), "score", "predicted")


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from each language's documents, in all 120 orders."""
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_shard_minimax": op2_shard_minimax,
    "op3_decontaminate": op3_decontaminate,
    "op4_html_extract": op4_html_extract,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_line_dedup": op7_line_dedup,
    "op8_language_id": op8_language_id,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_nearest_vectors": op10_nearest_vectors,
    "op11_repair_turns": op11_repair_turns,
    "op12_quality_score": op12_quality_score,
    "op13_filter_interactions": op13_filter_interactions,
}

_UNIFORM = "('0x' || substr(md5(concat_ws('|', '17', coalesce(CAST(doc_id AS VARCHAR), ''), '1')), 1, 13))::BIGINT / 4503599627370496.0"

ORACLE_SQL = {
    "op11_repair_turns": sql.TURN_REPAIR,
    "op13_filter_interactions": sql.FILTER_AUDIT,
    # Rates here stay far below the mean at which a draw is split into parts.
    "op1_mix_sources": f"""
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(strlen(text), 0)) AS BIGINT) AS bytes FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN 1.0::DOUBLE / (SELECT CAST(count(*) AS DOUBLE) FROM sizes WHERE bytes > 0) * 1.0::DOUBLE
         * (SELECT CAST(sum(bytes) AS DOUBLE) FROM sizes) / bytes ELSE 1.0::DOUBLE END AS rate FROM sizes),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf
  WHERE k + 1 <= ceil(rate + 12 * sqrt(rate) + 30)),
drawn AS (
  SELECT d.doc_id, d.source, d.text, {_UNIFORM} AS u FROM documents d),
counted AS (
  SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u) AS n
  FROM drawn d)
SELECT doc_id, source, CAST(i AS BIGINT) AS copy_no, CAST(n AS BIGINT) AS n_copies,
       md5(concat_ws('|', 'order-17', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(i AS VARCHAR))) AS shuffle_key, text
FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM counted WHERE n > 0)""",
    "op3_decontaminate": r"""
WITH split AS (
  SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
worded AS (
  SELECT DISTINCT kind, id, text, list_filter(regexp_split_to_array(regexp_replace(lower(text),
         '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM split),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM worded WHERE kind = 'item' AND len(w) > 0),
rolled AS (
  SELECT DISTINCT kind, id, text, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
  FROM worded, lengths WHERE kind = 'doc' OR k = least(len(w), 5)),
sizes AS (SELECT id, text, count(*) AS n FROM rolled WHERE kind = 'item' GROUP BY id, text),
shared AS (
  SELECT d.id AS doc_id, d.text, i.id AS item_id, i.text AS item, count(*) AS n_common
  FROM rolled d JOIN rolled i ON d.kind = 'doc' AND i.kind = 'item' AND d.g = i.g AND d.k = i.k GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item_shingles, max(n_common) AS n_common, CAST(max(n_common) AS DOUBLE) / n AS containment
FROM shared JOIN sizes ON item_id IS NOT DISTINCT FROM id AND item = sizes.text WHERE CAST(n_common AS DOUBLE) / n >= 0.8
GROUP BY doc_id, item_id, item, n""",
    "op6_chat_format": r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AND lag(role) OVER w IS NOT NULL AS same,
         length(regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g')) AS chars,
         length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS role_chars
  FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN same THEN 7 ELSE 7 + role_chars + 8 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""",
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
bad AS (
  SELECT trim(line) AS line FROM lines WHERE trim(line) <> '' GROUP BY trim(line) HAVING count(DISTINCT source) >= 10)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(sum(CASE WHEN b.line IS NOT NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL
            ELSE coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (b.line IS NULL), '') END AS kept_text
FROM documents d LEFT JOIN lines l ON l.doc_id = d.doc_id LEFT JOIN bad b ON b.line = trim(l.line)
GROUP BY d.doc_id, d.text""",
}
