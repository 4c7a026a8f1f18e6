"""Readers. Schemas are always given, text is cast later, nothing is inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseline import schemas
from bourseline.operators.frames import require_columns


def history_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The accumulated history: columns by the names in its header, in any order, cast to the schema's
    types (bad text is null); a missing column is an error. A path that does not exist yet is an empty history."""
    try:
        text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
        require_columns(text, schema.fieldNames())
        return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def processed_sources(history: DataFrame, source: str) -> DataFrame:
    """Distinct source names already in the history."""
    return history.select(F.col(source).cast("string").alias(source)).na.drop().distinct()


def sheet_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed rows of sheets, workbooks and document tables, one row of cells each."""
    return spark.read.schema(schemas.SHEET_ROWS).format(fmt).load(path)


def json_pages(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed JSON documents, one per line, in plain or packed files."""
    return spark.read.schema(schema).json(path)


def file_named(
    name: Column, contains: str | None = None, extension: str | None = None, dated: bool = False
) -> Column:
    """Condition on file names: part of the name (any case), extension, 8-digit prefix."""
    keep = F.lit(True)
    if contains:
        keep = keep & F.lower(name).contains(contains.lower())
    if extension:
        keep = keep & name.contains(extension)
    if dated:
        keep = keep & name.rlike(r"^\d{8}")
    return keep


def pipe_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain `|` separated files in Latin-1, all columns as text."""
    return (
        spark.read.option("header", True).option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    )
