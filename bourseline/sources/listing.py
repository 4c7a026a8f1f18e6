"""Files of a folder without opening them: names, sizes and times, rules on names, and what a run has to read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseline.sources import ledger
from bourseline.sources.readers import file_named
from bourseline.sources.storage import qualified


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """`path`, `name`, `size` and `modified` of every file in a folder, or also in those below it. The content is not asked
    for, so nothing is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    if not recursive:
        files = files.filter(~F.substring("path", len(qualified(spark, folder)) + 2, 2**31 - 1).contains("/"))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def select_files(listing: DataFrame, contains: str | None = None, extension: str | None = None, dated: bool = False) -> DataFrame:
    """The files whose names keep the rules (see `file_named`)."""
    return listing.filter(file_named(F.col("name"), contains, extension, dated))


def unprocessed_files(listing: DataFrame, store: str) -> DataFrame:
    """The files that the ledger of a store does not know, or knows with another size or time."""
    found = ledger.unseen(ledger.of_files(listing), ledger.entries(listing.sparkSession, store))
    return listing.join(found.select("name"), "name", "left_semi").select(*listing.columns)


def read_files(files: DataFrame, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """The rows of the selected files, with `file_name`; no other file is opened. The paths go through the
    driver, which lists what Spark reads in any case."""
    paths = [r["path"] for r in files.select("path").collect()]
    spark = files.sparkSession
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file_name", T.StringType())]))
    rows = spark.read.schema(schema).format(fmt).load(paths)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"))
