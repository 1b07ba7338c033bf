"""Registered queries of the pipeline operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontam,
    fingerprints,
    hard_negatives,
    packing,
    quality,
    sharding,
    simhash_dedup,
    substring_dedup,
    surrogates,
    token_counts,
    toxicity,
    warc,
    whitening,
)

TOKENIZER = "byte_bpe_50k.json"


def vocabulary(name: str = TOKENIZER) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.surrogate_report(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component AS component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    rows = rows.select("*", F.posexplode("whitened").alias("k", "value"))
    return rows.select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", F.col("deviation").cast("long"), F.col("value").alias("whitened"),
        F.col("explained")[F.col("k")].alias("explained"), "identity_error",
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), "embedding")
    found = hard_negatives.mine_negatives(rows, anchors=F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_removed"),
        F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_decontamination, op3_sharding, op4_token_counts, op5_toxicity,
        op6_fingerprints, op7_surrogates, op8_quality, op9_simhash_dedup, op10_packing,
        op11_whitening, op12_hard_negatives, op13_substring_dedup,
    )
}

_WORDS = r"""regexp_extract_all(regexp_replace(lower(coalesce(text, '')),
 '[\x{80}-\x{A9}\x{AB}-\x{B4}\x{B6}-\x{B9}\x{BB}-\x{BF}\x{2000}-\x{206F}\x{3000}-\x{303F}]', ' ', 'g'),
 '[0-9a-z\x{80}-\x{10FFFF}]+')"""


#: Words of items and documents, and how many words a shingle of an item has.
_ITEM_WORDS = f"""SELECT item_id, w, least(len(w), 5)::BIGINT AS k
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0"""


def _shingles(key: str, rows: str) -> str:
    return f"""SELECT DISTINCT {key}, k, unnest([array_to_string(w[i:i + k - 1], ' ')
      FOR i IN range(1, greatest(len(w) - k + 1, 0) + 1)]) AS s FROM {rows}"""


ORACLES = {
    "op1_warc": """
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), g AS (SELECT d, max(page_id) AS kept FROM p WHERE n >= 1000 AND page_id IS NOT NULL GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN n >= 1000 AND kept > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND kept > page_id THEN kept END AS refers_to, url
FROM p LEFT JOIN g ON p.d = g.d AND p.n >= 1000
""",
    "op2_decontamination": f"""
WITH i AS ({_ITEM_WORDS}),
b AS ({_shingles("item_id", "i")}),
t AS (SELECT doc_id, w, k FROM (SELECT doc_id, {_WORDS} AS w FROM documents), (SELECT DISTINCT k FROM i)),
d AS ({_shingles("doc_id", "t")}),
n AS (SELECT item_id, count(*) AS size FROM b GROUP BY item_id),
h AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, size, shared / size AS containment
FROM h JOIN n USING (item_id) WHERE shared >= ceil(0.8 * size - 1e-9)
""",
    "op12_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * c::DOUBLE) FOR c IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)])::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
""",
    "op13_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM g) WHERE r > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, i + unnest(range(0, 20)) AS p FROM later)
  GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
    CASE WHEN ps IS NULL THEN ws
      ELSE [ws[p] FOR p IN range(1, len(ws) + 1) IF NOT list_contains(ps, p)] END AS ks
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(ks, ' ')) AS kept_sha256 FROM kept
""",
}
