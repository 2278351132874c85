"""The queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, UPPER
from quarry.llm.clustering import cluster_vectors
from quarry.llm.decontamination import decontaminate
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.line_dedup import line_dedup
from quarry.llm.mixing import schedule
from quarry.llm.near_dedup import near_dedup
from quarry.llm.packing import pack_documents
from quarry.llm.passages import repeated_passages
from quarry.llm.quality import score_documents
from quarry.llm.records import read_records, write_records
from quarry.llm.resampling import importance_resample
from quarry.llm.topk import top_inner_products
from quarry.llm.warc import locate, read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(_table(spark, sf_dir, "pages"), min_bytes=0)
    return read_archives(locate(archives)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_passages(_table(spark, sf_dir, "documents"), min_words=50)
    return out.select(F.col("id").alias("doc_id"), "start_word", "n_words", F.col("other_id").alias("other_doc_id"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schedule(_table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", "source", "block", "release", "deadline", "slot")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup(_table(spark, sf_dir, "documents"), words=4, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_records(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_records(spark, index).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=10, min_words=20, seed=2024)
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64, scale=1024, seed=3)


QUERIES = {f.__name__: f for f in (op1_packing, op2_top_k, op3_warc, op4_repeated_passages, op5_mixing, op6_quality, op7_exact_dedup, op8_near_dedup, op9_line_dedup, op10_token_records,
                                  op11_importance_resampling, op12_decontamination, op13_clustering)}

#: Words of letters, digits and characters outside ASCII, A-Z lowered.
_LETTER_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


def _clustering_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Lloyd's rounds as one chain of tables: (c, d, m) centroids, (vec_id, c, distance) assignments."""
    assign = """a{0} AS MATERIALIZED (SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance
                    FROM (SELECT vec_id, c, sum((x - m) * (x - m)) AS distance FROM v JOIN c{0} USING (d) GROUP BY vec_id, c) GROUP BY vec_id)"""
    move = """c{1} AS MATERIALIZED (SELECT o.c, o.d, coalesce(n.m, o.m) AS m FROM c{0} o LEFT JOIN (
                    SELECT c, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
                    FROM v JOIN a{0} USING (vec_id) GROUP BY c, d) n USING (c, d))"""
    chain = ",\n             ".join(assign.format(r) + ",\n             " + move.format(r, r + 1) for r in range(rounds))
    return f"""
        WITH e AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dim}
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             v AS MATERIALIZED (SELECT vec_id, generate_subscripts(embedding, 1) AS d, floor({scale} * unnest(embedding)::DOUBLE)::HUGEINT AS x FROM e),
             s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM e QUALIFY c < {k}),
             c0 AS MATERIALIZED (SELECT c, d, x AS m FROM s JOIN v USING (vec_id)),
             {chain},
             {assign.format(rounds)},
             h AS (SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
        SELECT vec_id, c::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{rounds} JOIN h USING (c)"""


ORACLE_SQL = {
    "op2_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS query_id, b.vec_id,
                          list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
                   FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest FROM pages),
             h AS (SELECT page_id, newest, strlen(payload) AS payload_bytes, sha1(payload) AS hx FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(hx, 5 * (i // 4)::INTEGER + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> newest THEN newest END AS refers_to
        FROM h""",
    "op7_exact_dedup": r"""
        WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
                   FROM documents),
             g AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                          first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id
                   FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op8_near_dedup": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'),
                                       lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct([array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)])
                                  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
        e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS v FROM s),
        p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.v = b.v GROUP BY a.doc_id, b.doc_id, a.n, b.n
                           HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        r AS (SELECT x, y FROM p UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
        c AS (SELECT x, min(y) AS low FROM r GROUP BY x)
        SELECT doc_id, len(sh) AS n_shingles, coalesce(low, doc_id) AS component_id, coalesce(low, doc_id) = doc_id AS kept
        FROM s LEFT JOIN c ON s.doc_id = c.x""",
    "op9_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
             l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
             k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                                       '{UPPER}', '{LOWER}') AS key FROM l),
             f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
             m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op11_importance_resampling": rf"""
        WITH nib AS (SELECT list_transform(range(16), lambda i: list_reduce(range(4), lambda x, j: xor(x >> 1, (x & 1) * 3988292384), i)) AS tab),
             w AS (SELECT doc_id, {_LETTER_WORDS} AS ws FROM documents),
             d AS MATERIALIZED (SELECT doc_id, unnest(ws) AS f FROM w),
             b AS MATERIALIZED (SELECT unnest({_LETTER_WORDS}) AS f FROM benchmark),
             names AS MATERIALIZED (SELECT DISTINCT f FROM (SELECT f FROM d UNION ALL SELECT f FROM b)),
             bytes AS (SELECT f, hex(encode(f)) AS hx FROM names),
             bucket AS MATERIALIZED (
                 SELECT f, xor(list_reduce(list_transform(range(len(hx)), lambda i: instr('0123456789ABCDEF', hx[i + 2 - 2 * (i % 2)]) - 1),
                                           lambda c, n: xor(c >> 4, tab[xor(c & 15, n) + 1]), 4294967295), 4294967295) % 10000 AS k
                 FROM bytes, nib),
             s AS (SELECT k, count(*) AS n FROM d JOIN bucket USING (f) GROUP BY k),
             t AS (SELECT k, count(*) AS n FROM b JOIN bucket USING (f) GROUP BY k),
             total AS (SELECT (SELECT count(*) FROM d) AS s, (SELECT count(*) FROM b) AS t),
             gain AS (SELECT k, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (total.s + 10000)::DOUBLE
                                                / ((coalesce(s.n, 0) + 1)::DOUBLE * (total.t + 10000)::DOUBLE)))::BIGINT AS g
                      FROM s FULL JOIN t USING (k), total),
             mean AS (SELECT doc_id, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM d JOIN bucket USING (f) JOIN gain USING (k) GROUP BY doc_id),
             h AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                          ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::UBIGINT::DOUBLE AS h
                   FROM w LEFT JOIN mean USING (doc_id)),
             score AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
             r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM score WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
        FROM score LEFT JOIN r USING (doc_id)""",
    "op12_decontamination": rf"""
        WITH w AS MATERIALIZED (SELECT doc_id, {_LETTER_WORDS} AS ws FROM documents),
             i AS (SELECT item_id::VARCHAR AS item, {_LETTER_WORDS} AS ws FROM benchmark),
             win AS MATERIALIZED (SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[p:p + 9], ' ') AS words
                                  FROM i, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS u(p) WHERE len(ws) > 0),
             place AS (SELECT doc_id, p, n, array_to_string(ws[p:p + n - 1], ' ') AS words
                       FROM w, (SELECT DISTINCT n FROM win) AS l, unnest(range(1, len(ws) - n + 2)) AS u(p)),
             hit AS MATERIALIZED (SELECT doc_id, p, n, item FROM place JOIN win USING (n, words)),
             c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + n)) AS v(q) GROUP BY doc_id),
             o AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN c USING (doc_id) LEFT JOIN o USING (doc_id)""",
    "op13_clustering": _clustering_sql(),
}
