"""One query per corpus operator, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_count, chat, collocations, decontaminate, embed_dedup, language, line_dedup, merkle, merkle_sql, mixing, near_dup, suffix_dedup, token_files, warc
from .common import read_table, scratch

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLE_SQL: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        LLM_QUERIES[name] = fn
        return fn

    return register


@query("op1_warc")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = warc.mark_revisits(read_table(spark, sf_dir, "pages"), min_bytes=0)
    files = warc.write_archives(marked, scratch(spark, "warc"))
    records = warc.read_archives(spark, files, payloads=False)
    return records.select(warc.page_key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          warc.page_key("refers_to_id").alias("refers_to"))


@query("op2_near_dup")
def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_units(read_table(spark, sf_dir, "documents"), kind="sentence", min_words=1, run_words=40)


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold(F.col("doc_id")) == 1, F.lit(False))
    model = spark.sparkContext.broadcast(language.train(documents.where(~held_out)))
    return language.predict(documents.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


@query("op7_embedding_dedup")
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_chat")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    parts = turns.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    return chat.digests(chat.format_conversations(parts))


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(documents, scratch(spark, "tokens"), public_tokenizers.path(BYTE_BPE))
    return token_files.read_token_files(spark, manifest)


@query("op11_collocations")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"), min_count=100, longest=5, top=2000)


@query("op12_merkle")
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower).otherwise(F.col("text"))
    rows = merkle.manifest(documents, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"text": changed})
    return merkle.verified(rows, "doc_id")


@query("op13_suffix_dedup")
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=100)
    kept = F.octet_length("kept").cast("long")
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - kept).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


LLM_ORACLE_SQL["op3_line_dedup"] = r"""
WITH parts AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS p FROM documents),
line AS (
  SELECT doc_id, unnest(p) AS l, generate_subscripts(p, 1) - 1 AS unit FROM parts),
placed AS (
  SELECT *, CAST(coalesce(sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s,
         trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS plain
  FROM line),
counted AS (
  SELECT *, length(plain) - length(replace(plain, ' ', '')) + 1 AS n, row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS place FROM placed WHERE plain <> ''),
ranked AS (
  SELECT *, first_value(doc_id) OVER w AS fd, first_value(s) OVER w AS fs, row_number() OVER w AS r
  FROM counted WINDOW w AS (PARTITION BY plain ORDER BY doc_id, s)),
runs AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM ranked WHERE r > 1),
held AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, run) AS words FROM runs)
SELECT doc_id, unit, s AS start, s + length(l) AS "end", n AS n_words, fd AS first_doc, fs AS first_start FROM held WHERE words >= 40
"""

LLM_ORACLE_SQL["op7_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND vec_id IS NOT NULL AND list_sum(list_transform(e, lambda x: abs(x))) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, v.vec_id) AS component_id, v.vec_id = coalesce(c.c, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON n.a = v.vec_id LEFT JOIN comp c ON c.a = v.vec_id
"""

LLM_ORACLE_SQL["op9_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn>') + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), chr(10), '\n')) + 1
                + length(replace(replace(text, '\', '\\'), '<', '\l')) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

LLM_ORACLE_SQL["op11_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM piece),
gram AS (
  SELECT lang, k.k AS k, unnest(list_transform(range(1, len(ws) - k.k + 2), lambda i: ws[i:i + k.k - 1])) AS ph
  FROM w, (SELECT unnest(range(1, 6)) AS k) k WHERE len(ws) >= k.k),
freq AS (SELECT lang, k, ph, count(*) AS f FROM gram GROUP BY lang, k, ph),
total AS (SELECT lang, sum(f) AS n FROM freq WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM freq WHERE k > 1 AND f >= 100),
inside AS (
  SELECT lang, f, unnest(list_transform(range(1, k - s.s + 2), lambda i: ph[i:i + s.s - 1])) AS ph
  FROM cand, (SELECT unnest(range(2, 5)) AS s) s WHERE s.s < k),
held AS (SELECT lang, ph, max(f) AS f FROM inside GROUP BY lang, ph),
kept AS (SELECT c.* FROM cand c LEFT JOIN held h ON h.lang = c.lang AND h.ph = c.ph WHERE h.f IS NULL OR 100 * h.f < 100 * c.f),
cut AS (
  SELECT c.lang, c.ph, c.f AS a, j.j, l.f AS l, r.f AS r, t.n,
         (1000 * CAST(c.f AS HUGEINT) * CAST(t.n AS HUGEINT)) // (CAST(l.f AS HUGEINT) * CAST(r.f AS HUGEINT)) AS score
  FROM kept c, (SELECT unnest(range(1, 5)) AS j) j, freq l, freq r, total t
  WHERE j.j < c.k AND l.lang = c.lang AND l.ph = c.ph[1:j.j] AND r.lang = c.lang AND r.ph = c.ph[j.j + 1:] AND t.lang = c.lang),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) AS o FROM cut),
ranked AS (
  SELECT *, array_to_string(ph, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank
  FROM low WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

LLM_ORACLE_SQL["op12_merkle"] = merkle_sql.sql()
