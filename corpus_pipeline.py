"""From raw documents to packed training sequences, in five stages.

1. language: documents whose language is not recognised go.
2. quality: documents that fail the quality rules go.
3. near-duplicates: of each group (five-word shingles, similarity 0.8) the smallest id stays.
4. personal data: validated values become format-preserving pseudonyms.
5. packing: the texts become token ids in sequences of 2048.

Each stage is written as Parquet below the shared folder and read again, so that a lost
executor never costs more than the stage at hand. Extra columns of the documents pass
through the first four stages. A row without an id passes as a document of its own. Rows
that share an id are one document for stage 3: one of them stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourseline.llm import language, minhash, packing, pseudonyms, quality_rules
from bourseline.sources.storage import stage

PSEUDONYM_KEY = "a key of the test tables"  # a real corpus takes its own from where secrets are kept


def _rows(docs: DataFrame) -> DataFrame:
    """`id`, `text`, `hash` (of the text) and `row`: all columns as one structure, so that none meets another name."""
    return docs.select(
        F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("hash"), F.col("source").alias("host"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the source counts as the host."""
    model = language.train(docs)
    if model is None:
        return docs
    rows = _rows(docs)
    # The text's hash tells rows apart that share an id.
    found = language.identify(rows.select("id", "hash", "text", "host"), model, ["id", "hash"])
    rejected = found.where(~F.col("kept")).select(F.col("id").alias("other"), F.col("hash").alias("its")).distinct()
    same = F.col("id").eqNullSafe(F.col("other")) & (F.col("hash") == F.col("its"))
    return rows.join(rejected, same, "left_anti").select("row.*")


def worthwhile(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    rows = _rows(docs)
    named = rows.where("id IS NOT NULL")
    found = minhash.near_duplicates(named.select("id", "text"), words=5, key="id")
    copies = found.where(~F.col("kept")).select("id").distinct()
    # Of the rows that share an id one stays; the limit by rank comes before the exchange, which the join uses again.
    content = F.to_json("row") if "map<" in docs.schema.simpleString() else F.col("row")
    place = F.row_number().over(Window.partitionBy("id").orderBy("hash", F.xxhash64(content)))
    single = named.select("id", "hash", "row").withColumn("place", place).where("place = 1").join(copies, "id", "left_anti")
    return single.select("row.*").unionByName(rows.where("id IS NULL").select("row.*"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data."""
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, pii=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences: `doc_id`, `start`, `length`, `ids`, `doc_tokens`, `sequence_id`, `offset`."""
    return packing.assign(packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), numbered=True))


STAGES = [
    ("language", recognised),
    ("quality", worthwhile),
    ("near-duplicates", distinct),
    ("personal data", private),
    ("packing", packed),
]

# Learned models, hashes and tokens are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
