"""Presence, columns and sizes of a wanted list of datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseline.operators.frames import named_counts

WANTED = "schema_name string, name string"


def wanted_list(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(pairs, WANTED)


def presence(wanted: DataFrame, views: DataFrame, tables: DataFrame) -> DataFrame:
    """VIEW, TABLE or MISSING for every wanted name."""
    keys = ["schema_name", "name"]
    is_view = views.select(*keys, F.lit(True).alias("_v")).distinct()
    is_table = tables.select(*keys, F.lit(True).alias("_t")).distinct()
    kind = F.when(F.col("_v"), "VIEW").when(F.col("_t"), "TABLE").otherwise("MISSING")
    return wanted.join(is_view, keys, "left").join(is_table, keys, "left").select(*keys, kind.alias("object_type"))


def columns(spark: SparkSession, datasets: dict[str, DataFrame]) -> DataFrame:
    """Name, type and position of every column, from the schemas alone."""
    lines = [
        (name, f.name, f.dataType.simpleString(), i + 1)
        for name, df in datasets.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(lines, "dataset string, column_name string, data_type string, ordinal_position int")


def audit(spark: SparkSession, wanted: list[str], datasets: dict[str, DataFrame], counts: DataFrame | None = None) -> DataFrame:
    """One line per wanted dataset: present or missing, columns, rows. `counts` (dataset, n) may come from the files'
    footers (see `sources.footers`); without it the rows are counted."""
    names = spark.createDataFrame([(w,) for w in wanted], "dataset string")
    widths = columns(spark, datasets).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_columns"))
    counts = (named_counts(datasets) if counts is None else counts).withColumnRenamed("n", "n_rows")
    return names.join(widths, "dataset", "left").join(counts, "dataset", "left").select(
        "dataset",
        F.when(F.col("n_rows").isNull(), "MISSING").otherwise("TABLE").alias("object_type"),
        "n_columns", "n_rows",
    )
