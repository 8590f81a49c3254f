"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from logweave.llm import byte_bpe
from logweave.llm.common import read_table, stored, text_of
from logweave.llm.convo_repair import conversation_hashes, damage, find_repairs, repaired_rows
from logweave.llm.cube_mix import mix_sources
from logweave.llm.decontam import find_items
from logweave.llm.exact_index import exact_dedup
from logweave.llm.hmm_score import score_texts
from logweave.llm.passages import repeated_passages
from logweave.llm.quality_rules import score_ids
from logweave.llm.shards import shard_rows
from logweave.llm.simhash_cover import fingerprints
from logweave.llm.token_align import alignment_counts
from logweave.llm.url_rules import judge_urls
from logweave.llm.warc import deduplicate_archives, resolved, write_archives

SHARDS = 40
MIX_SEED = 7
#: fixed values: the URL rules as (host, path, verdict)
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_rows(read_table(spark, sf_dir, "documents"), SHARDS)
    text = text_of(sharded)
    return sharded.select(
        "doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_ids(docs, read_table(spark, sf_dir, "labels")).select(
        F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def op3_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = deduplicate_archives(spark, write_archives(pages))
    return resolved(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                                    "base_score", "score")


def op7_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"), seed=MIX_SEED)
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def op8_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints(docs).select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op9_url_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_items(docs, read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damage(said)
    repairs = stored(find_repairs(rows), "repairs")
    hashes = conversation_hashes(repaired_rows(rows, repairs)).withColumnRenamed("conv", "hashed")
    known = said.select("conv_id").distinct()
    zero = {n: F.coalesce(F.col(n), F.lit(0)).alias(n)
            for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return (known.join(repairs, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
            .select("conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")))


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment_counts(docs, public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))


def op13_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hypergeometric_shards": op1_hypergeometric_shards,
        "op2_rule_quality": op2_rule_quality,
        "op3_paragraph_minhash": op3_paragraph_minhash,
        "op4_extendible_hash_dedup": op4_extendible_hash_dedup,
        "op5_warc_revisits": op5_warc_revisits,
        "op6_hmm_scores": op6_hmm_scores,
        "op7_cube_mix": op7_cube_mix,
        "op8_simhash_anchors": op8_simhash_anchors,
        "op9_url_wildcards": op9_url_wildcards,
        "op10_wu_manber_decontamination": op10_wu_manber_decontamination,
        "op11_repair_conversations": op11_repair_conversations,
        "op12_lockstep_alignment": op12_lockstep_alignment,
        "op13_backtracking_bpe": op13_backtracking_bpe,
    }


_OP4 = """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

_OP5 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
), f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f"""

_OP9 = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (page_id)"""

_OP10 = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, list_slice(w, k, k + n - 1) AS ws
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM (SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0) a) b
), spots AS (
  SELECT doc_id, n, k, list_slice(w, k, k + n - 1) AS ws
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM words, (SELECT DISTINCT n FROM windows) l WHERE len(w) >= n) c
), hits AS (
  SELECT s.doc_id, s.k, s.n, item_id FROM spots s JOIN windows v ON s.ws = v.ws
), hit_words AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM (SELECT DISTINCT doc_id, k, n FROM hits) d) e
  GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) f GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def llm_oracles() -> dict[str, str]:
    return {"op4_extendible_hash_dedup": _OP4, "op5_warc_revisits": _OP5, "op9_url_wildcards": _OP9,
            "op10_wu_manber_decontamination": _OP10}
