"""What the footers of Parquet files tell: rows, and for each column its bounds and nulls, without a page of data.

Footers are read in tasks, one file after another. A bound is null if any row group lacks it, as
for columns that hold nested values.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseline.sources.archives import file_system
from bourseline.sources.listing import list_files

SCHEMA = "path string, row_group int, n_rows long, column string, low string, high string, n_nulls long"


def footers(files: DataFrame) -> DataFrame:
    """One row for each row group and column of the files (`path`); of a file without row groups one row without a column."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        names = ["path", "row_group", "n_rows", "column", "low", "high", "n_nulls"]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = file_system(path)
                with system.open_input_file(place) as raw:
                    found = pq.read_metadata(raw)
                rows = [] if found.num_row_groups else [(path, None, 0, None, None, None, None)]
                for g in range(found.num_row_groups):
                    group = found.row_group(g)
                    for k in range(group.num_columns):
                        column = group.column(k)
                        s = column.statistics
                        whole = s is not None and s.has_min_max
                        rows.append((
                            path, g, group.num_rows, column.path_in_schema, str(s.min) if whole else None, str(s.max) if whole else None,
                            s.null_count if s is not None and s.has_null_count else None,
                        ))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    return files.select("path").mapInArrow(read, SCHEMA)


def parquet_files(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """`dataset` and `path` of the Parquet files of each dataset (name -> file or folder)."""
    out = None
    for name, folder in folders.items():
        files = list_files(spark, folder, recursive=True).filter(F.col("name").endswith(".parquet") & ~F.col("name").rlike("^[_.]")).select(F.lit(name).alias("dataset"), "path")
        out = files if out is None else out.unionByName(files)
    return out


def row_counts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """`dataset` and `n`, from the footers alone."""
    files = parquet_files(spark, folders)
    groups = footers(files).select("path", "row_group", "n_rows").distinct()  # a row group has a row for each column
    per_file = groups.groupBy("path").agg(F.sum("n_rows").alias("n"))
    return files.join(per_file, "path").groupBy("dataset").agg(F.sum("n").alias("n"))


def column_bounds(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """`dataset`, `column`, `n_values` (rows that are not null) and whether bounds are known, of columns that are not nested."""
    files = parquet_files(spark, folders)
    found = footers(files).filter(F.col("column").isNotNull() & ~F.col("column").contains("."))
    return files.join(found, "path").groupBy("dataset", "column").agg(
        F.sum(F.col("n_rows") - F.col("n_nulls")).alias("n_values"), F.bool_and(F.col("low").isNotNull() | (F.col("n_rows") == F.col("n_nulls"))).alias("bounded")
    )
