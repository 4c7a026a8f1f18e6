"""A ledger of the sources that have been taken in, kept beside the data they went to.

An entry is (name, size, checksum, run). A run writes its data and its entries below its own number, and counts once
its commit is there. A run that dies before that is repeated under the same number: its folders are written over, so
nothing counts twice. A source whose size or checksum has changed is new again, and the entry of the
latest run tells which of its rows are in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseline.sources.storage import names_in, put_if_absent

ENTRY = T.StructType([T.StructField("name", T.StringType()), T.StructField("size", T.LongType()), T.StructField("checksum", T.StringType()), T.StructField("run", T.LongType())])
KEY = ["name", "size", "checksum"]


def committed(spark: SparkSession, store: str) -> int:
    """The last run that counts; 0 if there is none."""
    return max([int(n) for n in names_in(spark, f"{store}/runs") if n.isdigit()], default=0)


def commit(spark: SparkSession, store: str, run: int) -> None:
    put_if_absent(spark, f"{store}/runs/{run}", "")


def entries(spark: SparkSession, store: str) -> DataFrame:
    """The entry in force of every source, from committed runs."""
    run = committed(spark, store)
    if not run:
        return spark.createDataFrame([], ENTRY)
    known = spark.read.schema(ENTRY).parquet(f"{store}/sources").filter(F.col("run") <= run)
    latest = known.groupBy("name").agg(F.max(F.struct("run", "size", "checksum")).alias("e"))
    return latest.select("name", "e.size", "e.checksum", "e.run")


def write(found: DataFrame, store: str, run: int) -> None:
    """The entries of a run; they count when it is committed."""
    found.select(*KEY).write.mode("overwrite").parquet(f"{store}/sources/run={run}")


def of_rows(rows: DataFrame, source: str) -> DataFrame:
    """Entries of sources that come as rows: how many, and a sum of row hashes, which no order of rows changes."""
    hashed = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)"))
    return rows.groupBy(F.col(source).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("size"), hashed.cast("string").alias("checksum"))


def of_files(listing: DataFrame) -> DataFrame:
    """Entries of listed files; the time of the last change stands in for a checksum, so that no file is opened."""
    return listing.select("name", "size", F.date_format("modified", "yyyy-MM-dd HH:mm:ss.SSS").alias("checksum"))


def unseen(found: DataFrame, known: DataFrame) -> DataFrame:
    """Entries that are new or have changed, with `before`: the run that took their last state, if any."""
    last = known.select(F.col("name").alias("_n"), F.col("size").alias("_size"), F.col("checksum").alias("_sum"), F.col("run").alias("before"))
    both = found.join(last, F.col("name").eqNullSafe(F.col("_n")), "left")
    return both.filter(F.col("before").isNull() | (F.col("size") != F.col("_size")) | (F.col("checksum") != F.col("_sum"))).select(*KEY, "before")
