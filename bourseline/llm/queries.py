"""The registered queries of the dealt operators and the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseline.llm import ann, byte_bpe, fixity, language, licences, minhash, packing, pseudonyms, quality_cnn, quality_rules, resampling, toxicity, whitening


PSEUDONYM_KEY = "a key of the test tables"  # a real corpus takes its own from where secrets are kept


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.tokenize(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), numbered=True)
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", *packing.NUMBERED)
    return packing.assign(pieces)


def op2_quality_cnn(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    network = quality_cnn.train(docs, labels.where(~held_out))
    scored = quality_cnn.score(docs, network)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY).select("doc_id", "text", F.size("pii").alias("n_replaced"), F.transform("pii", lambda x: x["kind"]).alias("kinds"))


def op4_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(ann.usable(_table(spark, sf, "embeddings"), "vec_id", "embedding"), F.col("id") % 20 == 0, k=20)


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    """Every document and every page: a document has its text and, as its host, its source; a page has all evidence."""
    docs = _table(spark, sf, "documents")
    pages = language.page_evidence(_table(spark, sf, "pages"))
    rows = docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("source").alias("host")).unionByName(
        pages.select("page_id", "text", "host", "domain", "suffix", "declared"), allowMissingColumns=True
    )
    return language.identify(rows, language.train(docs), ["doc_id", "page_id"])


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode(byte_bpe.encode(_table(spark, sf, "documents"), path), path)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op8_licences(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = licences.scan(docs, licences.train(docs))
    families = F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"])))
    return found.select("doc_id", "n_paragraphs", "licences", families.alias("families"))


def op9_fixity(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of a replica of all pages in which some records are damaged, shortened, lost or written twice."""
    pages = _table(spark, sf, "pages")
    n = F.col("page_id")
    html = F.when(n % 97 == 1, F.concat(F.lit("?"), F.substring("html", 2, 2**31 - 1))).when(n % 2500 == 60, F.substring("html", 1, 100)).otherwise(F.col("html"))
    replica = pages.where(n % 2500 != 125).withColumn("html", html)
    replica = replica.unionByName(pages.where(n % 2500 == 30))
    return fixity.audit(fixity.records(pages), fixity.records(replica))


def op10_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), words=4)


def op11_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    scored = toxicity.score(docs, toxicity.train(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    rows = whitening.on_grid(_table(spark, sf, "embeddings"), "vec_id", "embedding")
    return whitening.whiten(rows, whitening.train(rows, components=16), "vec_id")


def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    found = resampling.resample(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), percent=10, seed=2024, least_words=20)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


_ALL = (
    op1_packing, op2_quality_cnn, op3_pseudonyms, op4_ann, op5_language, op6_quality_rules, op7_byte_bpe, op8_licences, op9_fixity, op10_minhash,
    op11_toxicity, op12_whitening, op13_resampling,
)
QUERIES = {f.__name__: f for f in _ALL}

_RECORDS = """SELECT page_id // 1000 AS file, page_id AS key, strlen(record) AS length, sha256(record) AS hash
  FROM (SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:sha256:'
    || sha256(page_id::VARCHAR || chr(10) || url) || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
    || html || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM {source})"""
_PLACED = """SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY key, hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  row_number() OVER (PARTITION BY file, key ORDER BY hash) AS copy FROM ({records})"""
_REPLICA = """(SELECT page_id, url, CASE WHEN page_id % 97 = 1 THEN '?' || substr(html, 2) WHEN page_id % 2500 = 60 THEN substr(html, 1, 100) ELSE html END AS html
  FROM pages WHERE page_id % 2500 <> 125 UNION ALL SELECT page_id, url, html FROM pages WHERE page_id % 2500 = 30)"""

SQL: dict[str, str] = {
    "op9_fixity": f"""WITH a AS ({_PLACED.format(records=_RECORDS.format(source="pages"))}), b AS ({_PLACED.format(records=_RECORDS.format(source=_REPLICA))})
SELECT coalesce(a.file, b.file) AS file, coalesce(a.key, b.key) AS key, CAST(coalesce(a.copy, b.copy) AS INTEGER) AS copy,
  CASE WHEN b.hash IS NULL THEN 'missing' WHEN a.hash IS NULL THEN 'extra' WHEN a.hash = b.hash THEN 'moved' ELSE 'changed' END AS state,
  a."offset" AS "offset", a.length AS length, a.hash AS hash, b."offset" AS other_offset, b.length AS other_length, b.hash AS other_hash
FROM a FULL JOIN b ON a.file = b.file AND a.key = b.key AND a.copy = b.copy
WHERE a.hash IS NULL OR b.hash IS NULL OR a.hash <> b.hash OR a."offset" <> b."offset" """,
    "op13_resampling": r"""WITH RECURSIVE bits AS (
  SELECT i, i::UBIGINT AS v, 0 AS round FROM range(256) AS t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, round + 1 FROM bits WHERE round < 8
), crc AS (SELECT list(v ORDER BY i) AS step FROM bits WHERE round = 8),
split AS (
  SELECT doc_id, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT doc_id, text, row_number() OVER () AS id FROM documents UNION ALL SELECT NULL, text, NULL FROM benchmark)
), met AS (SELECT doc_id, id, unnest(words) AS word FROM split),
buckets AS (
  SELECT word, xor(list_reduce(list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::UBIGINT),
    lambda c, b: xor(c >> 8, step[(xor(c & 255, b) + 1)::BIGINT]), 4294967295::UBIGINT), 4294967295::UBIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM met) CROSS JOIN crc
), counted AS (
  SELECT bucket, count(id)::DOUBLE AS s, (count(*) - count(id))::DOUBLE AS t FROM met JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counted
), weighed AS (
  SELECT d.doc_id, d.id, count(g.gain) AS n_features, CASE WHEN count(g.gain) = 0 THEN 0 ELSE floor(sum(g.gain) / count(g.gain)) END::BIGINT AS weight
  FROM (SELECT doc_id, id FROM split WHERE id IS NOT NULL) d LEFT JOIN met m ON m.id = d.id LEFT JOIN buckets b ON b.word = m.word LEFT JOIN gains g ON g.bucket = b.bucket
  GROUP BY d.doc_id, d.id
), scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= floor(10 * n / 100) THEN place END AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)""",
}
