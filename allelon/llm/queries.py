"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelon.llm import langid, lexicon, linededup, packing, quality, rules, sharding, simhash, tokens, topk, trie, warc, whitening
from allelon.llm.common import crc_fold, read_table
from allelon.storage import store

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharding.shard_shuffle(docs, 8).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexicon.encode_documents(read_table(spark, sf_dir, "documents"), WORD_BPE)
    return found.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, PIECES), keep=("doc_id",))
    return found.select("doc_id", F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = store(quality.feature_rows(docs), "quality-features")  # texts are read once
    found = quality.predict_rows(rows, quality.fit_rows(rows, read_table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.token_counts(read_table(spark, sf_dir, "documents"), WORD_BPE)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = topk.sign_codes(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(codes, codes.where(F.col("id") % 50 == 0), 10).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack_documents(read_table(spark, sf_dir, "documents"), BYTE_BPE)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality_rules(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_warc, op2_sharding, op3_bpe_codec, op4_language_id, op5_quality_classifier, op6_token_counts, op7_topk_search, op8_packing, op9_quality_rules, op10_simhash, op11_line_dedup, op12_prefix_trie, op13_whitening)
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, strlen(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM h)
SELECT page_id, cast(n AS bigint) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
""",
    "op7_topk_search": """
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
bits AS (SELECT vec_id, array_to_string(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 AND NOT isnan(embedding[i]) THEN '1' ELSE '0' END), '') AS b FROM v),
codes AS (SELECT vec_id, b::BIT AS code FROM bits),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, cast(bit_count(xor(q.code, c.code)) AS int) AS distance,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY bit_count(xor(q.code, c.code)), c.vec_id) AS rank
  FROM codes q JOIN codes c ON q.vec_id % 50 = 0)
SELECT query_id, cast(rank AS int) AS rank, vec_id, distance FROM near WHERE rank <= 10
""",
    "op11_line_dedup": """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, c.owner IS NOT NULL AND c.owner <> k.doc_id AS lost FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    # DuckDB has no crc32, so its table is built here; a path is the digests of its turns one after the other.
    "op12_prefix_trie": r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS table8),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id AS varchar), ''), lambda s: cast(ascii(s) AS bigint))),
    lambda c, x: xor(table8[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 4 AS h FROM ids, crc),
own AS (SELECT conv_id, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL),
built AS (SELECT h.conv_id, digest, words, k FROM h JOIN own ON own.conv_id = h.conv_id - h.conv_id % 20 AND k <= h
    UNION ALL SELECT h.conv_id, digest, words, k FROM h JOIN own ON own.conv_id = h.conv_id AND k > h),
prefixes AS (SELECT conv_id, words, string_agg(digest, '') OVER w AS path, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS turns FROM built
    WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT conv_id, 0, '', 0, (SELECT count(*) FROM built b WHERE b.conv_id = ids.conv_id) FROM ids),
node AS (SELECT path, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
    sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = turns), '')) AS ends_sha256 FROM prefixes GROUP BY path),
kids AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (path)),
below AS (SELECT left(path, 64 * up) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM full_node) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, cast(saved_tokens AS bigint) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN below USING (path) LEFT JOIN node p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
""",
}
