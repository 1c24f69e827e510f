"""The registered queries of this package and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import alignment, ann, decontaminate, digest_index, lines, lm_scoring, mixing, prefix_trie, quality, repeats, simhash, token_files, toxicity
from tallyloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::DOUBLE AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS position
  FROM sized GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][position % 3 + 1]::DOUBLE AS weight, 2 * source_size AS most FROM per
), ordered AS (
  SELECT *, 1.5 * sum(source_size) OVER () AS budget,
    coalesce(sum(most) OVER (ORDER BY most / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY most / weight, position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM w
), level AS (
  SELECT arg_min((budget - used) / free, most / weight) FILTER (WHERE (budget - used) / free * weight < most) AS level FROM ordered
), targets AS (
  SELECT source, source_size, least(most, weight * coalesce(level, 1e300)) AS target FROM ordered, level
), plan AS (
  SELECT s.doc_id, s.text, s.size, t.source_size::BIGINT AS source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5(concat('42:', coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))), 1, 12))::BIGINT / 281474976710656.0
    < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM plan
"""


@_query("op2_mix_sources", MIX_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mixing_plan(table(spark, folder, "documents"))
    return plan.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# Id that ends a document in the token files.
END_ID = 2


def token_file_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query("op3_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    manifest = token_files.write_token_files(table(spark, folder, "documents"), target, token_file_path(), END_ID)
    token_files.save_manifest(manifest, target)
    rows = token_files.read_token_files(token_files.load_manifest(spark, target), target)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query("op8_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.simhash_classes(table(spark, folder, "documents"))
    # The fingerprint is stored little-endian; as a number its hexadecimal digits run the other way round.
    digits = F.lower(F.array_join(F.reverse(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.hex(F.substring("fingerprint", i, F.lit(1))))), ""))
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


@_query("op4_decontaminate")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_words")


@_query("op10_repeated_lines")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.repeated_lines(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


@_query("op5_nearest")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.search(ann.build_index(vectors, 5), vectors.where(F.col("vec_id") % 50 == 0), 5)


def _judged(rows: DataFrame, threshold: float) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return rows.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


@_query("op6_quality")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels")), 0.3)


@_query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return _judged(toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")), ["doc_id"]), 0.5)


@_query("op9_repeats")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    rows = repeats.remove_repeats(table(spark, folder, "documents"), ["doc_id"])
    # The remaining bytes as text; a character that a removal cut through is replaced.
    left = F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text")
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), left)


@_query("op1_lm_score")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, folder, "documents"))


DEDUP_SQL = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM normal
"""


@_query("op13_exact_dedup", DEDUP_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    rows = digest_index.dedup_newest_first(table(spark, folder, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@_query("op12_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as known

    rows, _ = alignment.align(table(spark, folder, "documents"), known.path("byte_bpe_50k.json"), known.path("piece_bpe_32k.model"))
    return rows


TRIE_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
    sha256(concat(len(coalesce(role, '')), ':', role, text)) AS id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id
), crc AS (
  -- crc32, bit by bit
  SELECT conv_id, 0 AS i, 4294967295::BIGINT AS v FROM ids
  UNION ALL
  SELECT conv_id, i + 1, xor(w >> 1, (w & 1) * 3988292384) FROM (
    SELECT conv_id, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(conv_id::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE v END AS w
    FROM crc WHERE i < 8 * len(conv_id::VARCHAR)
  )
), plan AS (
  SELECT c.conv_id, c.h, c.lead, least(c.h, coalesce(l.n, 0)) AS taken
  FROM (SELECT conv_id, conv_id - conv_id % 20 AS lead, xor(arg_max(v, i), 4294967295::BIGINT) % 4 AS h FROM crc GROUP BY conv_id) c
  LEFT JOIN ids l ON l.conv_id = c.lead
), rebuilt AS (
  SELECT p.conv_id, t.place, t.id, t.words FROM plan p JOIN turns t ON t.conv_id = p.lead AND t.place < p.taken
  UNION ALL
  SELECT p.conv_id, t.place - p.h + p.taken, t.id, t.words FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.place >= p.h
), members AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS words FROM ids
  UNION ALL
  SELECT conv_id, place + 1, sha256(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY place)), words FROM rebuilt
), last AS (
  SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id
), ended AS (
  SELECT m.depth, m.node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM members m JOIN last USING (conv_id, depth) GROUP BY ALL
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM members GROUP BY depth, node
), placed AS (
  SELECT n.*, u.node AS parent FROM nodes n LEFT JOIN members u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1
), kids AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM placed WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT m.depth, m.node, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN kids k USING (depth, node) JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth
  GROUP BY m.depth, m.node
)
SELECT p.conv_id, p.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, p.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM placed p LEFT JOIN nodes u ON u.depth = p.depth - 1 AND u.node = p.parent LEFT JOIN kids k ON k.depth = p.depth AND k.node = p.node
JOIN below b ON b.depth = p.depth AND b.node = p.node LEFT JOIN ended e ON e.depth = p.depth AND e.node = p.node
"""


@_query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))
