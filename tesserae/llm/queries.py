"""The registered corpus queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import align, bpe_codec, divergence, exact_dedup, mixing, near_dedup, packing, sharding, sstable, suffix_dedup, token_counts, topk, toxicity
from tesserae.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dedup.components(spark, table(spark, sf_dir, "documents"), k=3, percent=85)
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.lengths(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return token_counts.suffix_sums(token_counts.histogram(lengths))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.coded(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), ("n_tokens", "ids_sha256", "decoded_sha256")).withColumnRenamed("id", "doc_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), with_ids=False).withColumnRenamed("id", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.classes(spark, table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("at") == F.col("keep_at")).alias("kept"), F.col("digest").alias("text_sha256"))


def op7_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sstable.written(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shards(spark, table(spark, sf_dir, "documents"))
    return rows.withColumnRenamed("id", "doc_id").withColumn("grown_shard", F.lit(None).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.scored(docs, toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.cleaned(spark, table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = align.aligned(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return rows.withColumnRenamed("id", "doc_id")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mixed(spark, table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_token_counts, op3_bpe, op4_topk, op5_packing, op6_exact_dedup, op7_token_tables, op8_hilbert_shards, op9_toxicity, op10_suffix_dedup,
    op11_alignment, op12_divergence, op13_mixing)}

ORACLE_SQL = {
    "op1_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
             n AS (SELECT doc_id, len(sh) AS n FROM s), e AS (SELECT doc_id, unnest(sh) AS g FROM s),
             c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
             l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
             sym AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
             r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, sym.y FROM r JOIN sym ON r.b = sym.x)
        SELECT a AS doc_id, any_value(n.n)::BIGINT AS n_shingles, min(b) AS component_id, a = min(b) AS kept FROM r JOIN n ON n.doc_id = r.a GROUP BY a""",
    "op4_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op6_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)""",
    "op10_suffix_dedup": """
        WITH z AS (SELECT doc_id, encode(coalesce(text, '')) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
             w AS (SELECT doc_id, i, md5(h[i + 1 : i + 400]) AS m FROM z, unnest(range(0, n - 399)) AS t(i)),
             g AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1), p AS (SELECT doc_id, i FROM w WHERE m IN (SELECT m FROM g)),
             q AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER o + 400 OR lag(i) OVER o IS NULL THEN 1 ELSE 0 END AS fresh FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
             r AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM q) GROUP BY ALL),
             k AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM r UNION ALL SELECT doc_id, max(b), max(n) FROM r JOIN z USING (doc_id) GROUP BY doc_id),
             t AS (SELECT doc_id, string_agg(hex(h[x + 1 : y]), '' ORDER BY x) AS kept FROM k JOIN z USING (doc_id) GROUP BY doc_id),
             u AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS gone, count(*) AS spans FROM r GROUP BY doc_id)
        SELECT z.doc_id, z.n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(coalesce(unhex(kept), h)) AS kept_sha256
        FROM z LEFT JOIN u USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op12_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
             g AS (SELECT DISTINCT lang, source FROM d), w AS (SELECT n, lang, source, unnest(ws) AS term FROM d),
             k AS (SELECT lang, term, count(*) AS q FROM w GROUP BY ALL HAVING count(DISTINCT n) >= 10),
             c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
             v AS (SELECT lang, count(*) AS v, sum(q) AS nl FROM k GROUP BY lang),
             t AS (SELECT lang, source, sum(n) AS nt FROM c GROUP BY ALL),
             x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.nt, 0) + 2 * v.v) AS p,
                          1 + 1000000000::HUGEINT * (k.q + 2) // (v.nl + 2 * v.v) AS q
                   FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
             m AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0)::BIGINT AS value
                   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
                   UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM x WHERE n > 0 AND p > q),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM u)
        SELECT * FROM r WHERE part = 'pair' OR rank <= 10""",
    "op13_mixing": r"""
        WITH z AS (SELECT doc_id AS id, source, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS key,
                          CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(concat_ws('/', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS tick FROM documents),
             s AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY key),
             r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY key) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
             l AS (SELECT *, cap / weight AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights FROM r),
             o AS (SELECT *, (budget - coalesce(sum(cap) OVER w, 0)) / (weights - coalesce(sum(weight) OVER w, 0)) <= ratio AS open
                   FROM l WINDOW w AS (ORDER BY ratio, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
             a AS (SELECT key, source_size, CASE WHEN NOT open THEN cap ELSE weight * (budget - coalesce(sum(cap) FILTER (NOT open) OVER (), 0)) / (sum(weight) FILTER (open) OVER ()) END AS target FROM o),
             p AS (SELECT id, source, key, size, CAST(coalesce(sum(size) OVER (PARTITION BY key ORDER BY tick, id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM z WHERE size > 0
                   UNION ALL SELECT id, source, key, size, 0 FROM z WHERE size = 0),
             t AS (SELECT key, target, size, turn * source_size + start AS first FROM p JOIN a USING (key), unnest([0, 1]) AS u(turn) WHERE size > 0 AND target > 0),
             e AS (SELECT *, CASE WHEN CAST(first + size AS DOUBLE) / target <= 1 THEN size ELSE 32 END AS step FROM t),
             c AS (SELECT key, target, least(step, size - k * step) AS words, first + k * step + least(step, size - k * step) AS ends FROM (SELECT *, unnest(range((size - 1) // step + 1)) AS k FROM e)),
             q AS (SELECT key, words, coalesce(sum(words) OVER (ORDER BY CAST(ends AS DOUBLE) / target, key, ends ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position FROM c),
             g AS (SELECT key, sum(least(words, (SELECT 3 * sum(size) // 2 FROM z) - position)) AS got FROM q WHERE position < (SELECT 3 * sum(size) // 2 FROM z) GROUP BY key)
        SELECT id AS doc_id, size, source_size, coalesce(target, 0) AS target,
               CAST(greatest(0, least(size, coalesce(got, 0) - start)) + greatest(0, least(size, coalesce(got, 0) - source_size - start)) AS BIGINT) AS taken
        FROM p JOIN a USING (key) LEFT JOIN g USING (key)""",
}
