"""The registered queries of this subpackage, and SQL for those that DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_format, decontaminate, language_id, quality, recurrent_lm, resampling, sharding, simhash_dedup, token_counts, topk_search, toxicity, turn_repair, word_bpe
from tidemark.llm.common import tuned

#: A public vocabulary file; workers find it by its name.
WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = recurrent_lm.score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Conversation -7: texts that hold what templates use as marks.
HOSTILE = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE).alias("text")
    )
    back = chat_format.read_back(chat_format.format_conversations(turns.union(hostile)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), WORD_BPE)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def encoded_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to."""
    made = word_bpe.encode(docs, WORD_BPE, decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_recurrent_lm": op1_recurrent_lm,
    "op2_decontaminate": op2_decontaminate,
    "op3_chat_format": op3_chat_format,
    "op4_sharding": op4_sharding,
    "op5_topk_search": op5_topk_search,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_word_bpe": op9_word_bpe,
    "op10_quality": op10_quality,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_turn_repair": op13_turn_repair,
}

#: op2 for DuckDB: windows of items against windows of documents, word by word.
DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bs AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p : p + m - 1], ' ') AS g FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM bs)
), dw AS (
  SELECT r, p, m, array_to_string(w[p : p + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT m FROM bs) WHERE len(w) >= m)
), hits AS (SELECT dw.r, dw.p, dw.m, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g
), words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + m)) AS q FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

#: op3 from its turns: the digests don't depend on the template; the formatted length follows it.
CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS text_e, replace(replace(role, '\', '\\'), '<|', '<\|') AS role_e,
         coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) = role, FALSE) AS goes_on
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(CASE WHEN goes_on THEN 7 ELSE 23 + length(role_e) END + length(text_e)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0
), r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

#: crc32 in DuckDB: a table of 256 steps, then a fold over the bytes of each distinct text.
CRC_SQL = """
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
), crcs AS (
  SELECT w, xor(list_reduce(list_transform(range(CAST(length(h) / 2 AS BIGINT)), lambda i: CAST(('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT)), lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) + 1 AS BIGINT)]), 4294967295), 4294967295) AS crc
  FROM (SELECT w, hex(encode(w)) AS h FROM texts), steps
)
"""

RESAMPLING_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), dw AS (SELECT r, unnest(w) AS w FROM d
), bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), texts AS (SELECT w FROM dw UNION SELECT w FROM bw), {CRC_SQL},
s AS (SELECT crc % 10000 AS b, count(*) AS n FROM dw JOIN crcs USING (w) GROUP BY 1
), t AS (SELECT crc % 10000 AS b, count(*) AS n FROM bw JOIN crcs USING (w) GROUP BY 1
), g AS (
  SELECT s.b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((s.n + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON t.b = s.b
), x AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN crcs USING (w) JOIN g ON g.b = crc % 10000 GROUP BY r
), o AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN x USING (r)
), e AS (
  SELECT *, n_features >= 20 AS takes, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS k, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM o
)
SELECT doc_id, n_features, weight, score, CASE WHEN takes AND k <= 10 * n // 100 THEN k END AS rank FROM e
"""

#: op13 by an automaton of four states that reads the turns one by one and keeps each state's cheapest audit.
REPAIR_SQL = rf"""
WITH RECURSIVE texts AS (SELECT DISTINCT coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS w FROM conversations), {CRC_SQL},
hurt AS (
  SELECT conv_id AS c, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text, unnest(range(CASE crc % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
  FROM conversations JOIN crcs ON w = coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')
), placed AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM hurt
), marked AS (SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again FROM placed
), f AS (
  SELECT c, turn, role, text, i, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, left(role, 1) AS initial,
         coalesce(lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), FALSE) AS wrong
  FROM marked
), ins(s, z, l, k) AS (VALUES (0, 0, '', 0), (0, 2, 'I', 2), (0, 3, 'II', 4), (1, 1, '', 0), (1, 2, 'I', 2), (1, 3, 'II', 4), (2, 2, '', 0), (2, 3, 'I', 2), (2, 2, 'II', 4), (3, 3, '', 0), (3, 2, 'I', 2), (3, 3, 'II', 4)
), step(s, symbol, z) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2), (0, 'D', 0), (1, 'D', 1), (2, 'D', 2), (3, 'D', 3)
), ways AS (
  SELECT c, 0::BIGINT AS i, 0 AS s, struct_pack(cost := 0, audit := '') AS best FROM f GROUP BY c
  UNION ALL
  SELECT ways.c, f.i, step.z, min(struct_pack(
           cost := ways.best.cost + ins.k + CASE WHEN symbol = 'D' THEN 3 WHEN symbol = initial THEN 0 ELSE 2 END + CASE WHEN symbol <> 'D' AND truncated THEN 1 ELSE 0 END,
           audit := ways.best.audit || ins.l || CASE WHEN symbol = 'D' THEN 'D' WHEN symbol = initial THEN 'K' ELSE 'R' END))
  FROM ways JOIN f ON f.c IS NOT DISTINCT FROM ways.c AND f.i = ways.i + 1 JOIN ins ON ins.s = ways.s JOIN step ON step.s = ins.z
  WHERE symbol = 'D' OR (NOT blank AND NOT duplicate AND (symbol <> 's' OR initial = 's'))
  GROUP BY ways.c, f.i, step.z
), sums AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE wrong) AS illegal, max(i) AS n
  FROM f GROUP BY c
), ended AS (
  SELECT ways.c, min(struct_pack(cost := best.cost + ins.k, audit := best.audit || ins.l)) AS best
  FROM ways JOIN sums ON sums.c IS NOT DISTINCT FROM ways.c AND sums.n = ways.i JOIN ins ON ins.s = ways.s WHERE ins.z IN (0, 3) GROUP BY ways.c
), letters AS (SELECT c, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM ended
), edits AS (
  SELECT c, p, audit[p] AS l, length(replace(audit[1:p], 'I', '')) AS i, length(replace(audit[1:p], 'D', '')) - 1 AS k, length(replace(audit, 'D', '')) % 2 AS odd FROM letters
), built AS (
  SELECT edits.c, p, CASE WHEN l = 'K' THEN role WHEN (k + odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE text END AS line
  FROM edits LEFT JOIN f ON f.c IS NOT DISTINCT FROM edits.c AND f.i = edits.i AND l <> 'I' WHERE l <> 'D'
), hashed AS (SELECT c, sha256(string_agg(line, chr(10) ORDER BY p)) AS h FROM built GROUP BY c
), every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM every LEFT JOIN sums ON sums.c IS NOT DISTINCT FROM conv_id LEFT JOIN ended ON ended.c IS NOT DISTINCT FROM conv_id LEFT JOIN hashed ON hashed.c IS NOT DISTINCT FROM conv_id
"""

ORACLES: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE_SQL,
    "op3_chat_format": CHAT_SQL,
    "op5_topk_search": TOPK_SQL,
    "op12_importance_resampling": RESAMPLING_SQL,
    "op13_turn_repair": REPAIR_SQL,
}
