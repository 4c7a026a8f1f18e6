"""Writers: replace, upsert by date, exports.

A table that is being read is never overwritten in place: `replace_table` adds a version and
moves the catalog's name over to it once the version is committed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseline.sources import versions
from bourseline.sources.storage import get_text, names_in, put_if_absent


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite one CSV dataset; as many part files as the data needs."""
    df.write.mode("overwrite").option("header", True).csv(path)


JSON_ROWS = 500_000  # rows of a file: packed files are not split by readers


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document per row, packed (names are repeated in each), in files of a bounded number of rows."""
    df.write.option("compression", "gzip").option("maxRecordsPerFile", JSON_ROWS).json(path)


def sorted_export(df: DataFrame, path: str, keys: list[str]) -> None:
    """Export in key order across part files (range partitioned, sorted inside)."""
    df.orderBy(*keys).write.mode("overwrite").option("header", True).csv(path)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Let `df` be the next version of the table `name`, and the catalog's name show it. Replacing the name's definition is
    one step in the catalog, so there is always a table; readers of the version before keep theirs until it expires.
    The rows of the new version come back."""
    spark = df.sparkSession
    made = versions.replace(df, versions.folder_of(spark, name))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{made.path}`")
    return spark.read.schema(made.schema).parquet(made.path)


def define_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A view of the catalog over its tables, new or in place of the one before."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def snapshot_view(spark: SparkSession, view: str, name: str) -> DataFrame:
    """Store the present contents of a view under another name."""
    return replace_table(spark.table(view), name)


class SchemaMismatch(ValueError):
    """Rows do not have the columns that a table was declared with."""


SCHEMA_FILE = "_schema.json"  # Spark's readers pass over names that begin so
# What a column may hold besides its own type: narrower numbers, which are cast.
WIDENS = {
    "smallint": {"tinyint"}, "int": {"tinyint", "smallint"}, "bigint": {"tinyint", "smallint", "int"},
    "float": {"tinyint", "smallint"}, "double": {"tinyint", "smallint", "int", "float"}, "timestamp": {"date"},
}


def declared(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema a table was declared with."""
    return T.StructType.fromJson(json.loads(get_text(spark, f"{path}/{SCHEMA_FILE}"))) if SCHEMA_FILE in names_in(spark, path) else None


def declare_table(spark: SparkSession, path: str, schema: T.StructType, date: str) -> None:
    """Create an empty dataset partitioned by date, with its schema beside it, unless it is already there; then
    its schema must be the same."""
    if date not in schema.fieldNames():
        raise SchemaMismatch(f"{path}: no column {date}")
    known = declared(spark, path)
    if known is None:
        put_if_absent(spark, f"{path}/{SCHEMA_FILE}", json.dumps(schema.jsonValue()))
    elif _types(known) != _types(schema):
        raise SchemaMismatch(f"{path}: declared as {known.simpleString()}, not as {schema.simpleString()}")


def _types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def as_declared(df: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    """The columns of the schema, in its order and types. Narrower numbers are widened; a missing or unknown column or any
    other type is refused, before a row is looked at."""
    have = dict(_types(df.schema))
    wrong = [f"{n} is missing" for n, _ in _types(schema) if n not in have]
    wrong += [f"{n} is not a column of the table" for n in have if n not in schema.fieldNames()]
    wrong += [f"{n} is {have[n]}, not {t}" for n, t in _types(schema) if n in have and have[n] != t and have[n] not in WIDENS.get(t, ())]
    if wrong:
        raise SchemaMismatch(f"{path}: {'; '.join(wrong)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if have[f.name] != f.dataType.simpleString() else F.col(f"`{f.name}`") for f in schema.fields])


def upsert_by_date(df: DataFrame, path: str, date: str) -> None:
    """Replace exactly the dates present in `df`; other dates stay as they are. Rows for a declared table must
    have its columns.

    The rebalance hint lets AQE merge small dates into one file and split a date
    that holds most of the rows over several tasks.
    """
    schema = declared(df.sparkSession, path)
    if schema is not None:
        df = as_declared(df, schema, path)
    (
        df.hint("rebalance", date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
