"""The operators applied to the driver's tables, with production parameters.

``QUERIES`` maps a query name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL``
has the DuckDB SQL of those that SQL expresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (blockjoin, lines, mixing, packing, quality, resampling, sharding, simhash, substring, suffixes,
                          topk, urls, whitening)
from tidemark.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE = 2048
END_ID = 1
NEAREST = 20
TOP = 5
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]
SUBSTRING_WORDS = 13
SUFFIX_BYTES = 200
SHARDS = 24
SIMHASH_SHINGLE = 4
SIMHASH_DISTANCE = 4
MIX_WEIGHTS = {"src0": 6.0}     # every other source: 1.0
MIX_SEED = 17
WHITEN_SCALE, WHITEN_SHIFT = 64, 1_000_000
WHITEN_COMPONENTS = 32
RESAMPLE = {"grams": 1, "buckets": 10_000, "percent": 10, "least_words": 20, "seed": 2024}


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, quality.train_fold(table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return (quality.scored(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path(), SEQUENCE, END_ID).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockjoin.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, NEAREST)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup_substrings(docs, SUBSTRING_WORDS).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, MIX_WEIGHTS, MIX_SEED)


def op7_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op8_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.balanced_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, SIMHASH_SHINGLE, SIMHASH_DISTANCE).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, TOP)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, fits = whitening.quantized("embedding", WHITEN_SCALE, WHITEN_SHIFT)
    rows = table(spark, sf_dir, "embeddings").filter(fits).select("vec_id", x.alias("x"))
    return whitening.whiten(rows, WHITEN_COMPONENTS, "vec_id", "x")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"), **RESAMPLE).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.dedup_suffixes(docs, SUFFIX_BYTES).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality,
    op2_line_dedup,
    op3_pack,
    op4_block_nearest,
    op5_substrings,
    op6_poisson_mix,
    op7_url_trees,
    op8_best_fit_shards,
    op9_simhash,
    op10_uniform_threshold,
    op11_whitening,
    op12_resample,
    op13_suffixes,
    pipeline,
)}

LINE_DEDUP_SQL = """
WITH line AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents),
w AS (
    SELECT doc_id, pos, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c,
           count(*) OVER (PARTITION BY doc_id) - pos AS after
    FROM line WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
    SELECT doc_id, pos FROM w WHERE after >= 2
    QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1),
covered AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range(3) t(k)),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(covered.pos) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY line.pos) FILTER (covered.pos IS NULL), '') AS text
    FROM line LEFT JOIN covered USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text AS text
FROM documents d LEFT JOIN kept USING (doc_id)
"""

MIX_SQL = """
WITH RECURSIVE s AS (
    SELECT coalesce(source, '') AS src, sum(strlen(coalesce(text, '')))::DOUBLE AS bytes,
           CASE WHEN coalesce(source, '') = 'src0' THEN 6.0::DOUBLE ELSE 1.0::DOUBLE END AS w
    FROM documents GROUP BY ALL),
r AS (
    SELECT src, CASE WHEN bytes = 0 THEN 1.0::DOUBLE
                     ELSE w / (SELECT sum(w) FROM s) * (SELECT sum(bytes) FROM s) / bytes END AS rate FROM s),
m AS (SELECT src, greatest(1, ceil(rate / 8))::BIGINT AS draws, rate / greatest(1, ceil(rate / 8)) AS mean FROM r),
cdf AS (
    SELECT src, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM m
    UNION ALL
    SELECT src, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < 64),
drawn AS (
    SELECT d.doc_id, d.source, d.text, coalesce(d.source, '') AS src, unnest(generate_series(0, m.draws - 1)) AS draw
    FROM documents d JOIN m ON coalesce(d.source, '') = m.src),
u AS (
    SELECT *, (('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || draw), 1, 13))::BIGINT + 0.5::DOUBLE)
              / 4503599627370496::DOUBLE AS u FROM drawn),
n AS (
    SELECT u.doc_id, u.source, u.text, u.draw, count(*) AS n
    FROM u JOIN cdf ON u.src = cdf.src AND cdf.c < u.u GROUP BY ALL),
copies AS (SELECT doc_id, source, text, draw, unnest(generate_series(1, n)) AS copy FROM n)
SELECT doc_id, source, text, draw, copy,
       md5('order 17|' || coalesce(doc_id::VARCHAR, '') || '|' || draw || '|' || copy) AS shuffle_key
FROM copies
"""

_GOOD_VECTORS = """
WITH v AS (
    SELECT vec_id, min(embedding) AS embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    GROUP BY vec_id)"""

NEAREST_SQL = _GOOD_VECTORS + """,
d AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM v WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT q.vec_id AS query_id, row_number() OVER w AS rank, r.vec_id AS vec_id, list_dot_product(q.e, r.e) AS score
FROM d q JOIN d r ON q.vec_id <> r.vec_id AND len(q.e) = len(r.e) WHERE q.vec_id % 20 = 0
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, r.e) DESC, r.vec_id)
QUALIFY row_number() OVER w <= 20
"""

TOP_SQL = _GOOD_VECTORS + """,
d AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM v)
SELECT q.vec_id AS query_id, row_number() OVER w AS rank, r.vec_id AS vec_id,
       list_dot_product(q.e, r.e)::BIGINT AS score
FROM d q JOIN d r ON q.vec_id <> r.vec_id AND len(q.e) = len(r.e) WHERE q.vec_id % 50 = 0
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, r.e) DESC, r.vec_id)
QUALIFY row_number() OVER w <= 5
"""

RESAMPLE_SQL = """
WITH RECURSIVE step AS (  -- the CRC-32 of every byte
    SELECT i::BIGINT AS byte, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
    UNION ALL
    SELECT byte, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
of_byte AS (SELECT list(c ORDER BY byte) AS crcs FROM step WHERE k = 8),
text AS (
    SELECT 's' AS side, doc_id, row_number() OVER () AS place, text FROM documents
    UNION ALL SELECT 't', NULL, NULL, text FROM benchmark),
said AS (
    SELECT side, doc_id, place, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM text),
word AS (SELECT side, place, unnest(words) AS word FROM said),
crc AS (
    SELECT word, hex(word) AS digits, 0 AS pos, 4294967295::BIGINT AS c FROM (SELECT DISTINCT word FROM word)
    UNION ALL
    SELECT word, digits, pos + 2,
           xor(c >> 8, crcs[(xor(c, ('0x' || substr(digits, pos + 1, 2))::BIGINT) & 255) + 1])
    FROM crc, of_byte WHERE pos < length(digits)),
bucket AS (SELECT word, xor(c, 4294967295) % 10000 AS bucket FROM crc WHERE pos = length(digits)),
n AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
      FROM word JOIN bucket USING (word) GROUP BY bucket),
gain AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE
                                   / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
weight AS (
    SELECT place, sum(gain)::BIGINT AS weight FROM word JOIN bucket USING (word) JOIN gain USING (bucket)
    WHERE side = 's' GROUP BY place),
scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT
                                                       + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM said LEFT JOIN weight USING (place) WHERE side = 's'),
placed AS (
    SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS LAST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM placed
"""

ORACLE_SQL = {
    "op12_resample": RESAMPLE_SQL,
    "op4_block_nearest": NEAREST_SQL,
    "op10_uniform_threshold": TOP_SQL,
    "op2_line_dedup": LINE_DEDUP_SQL,
    "op6_poisson_mix": MIX_SQL,
}
