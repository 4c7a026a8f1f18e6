"""Zip archives of `|` separated text, as a data source of Spark.

`spark.read.format("zip_pipe").load(folder)` lists the archives of a folder by name and size alone; each archive is a
partition of its own, whose task reads the archive's directory from its end and then streams the first text
member, some megabytes at a time. Neither an archive nor a member is ever held as a whole, so their size does not matter.

Besides its rows every archive gives one line of report: `status` is "rows", "no member" (nothing that ends in .txt)
or "bad" (no zip, or one that breaks off; rows read before the break stay), and `row_idx` the number of
its rows. `rows_of` and `report_of` tell both apart. A member without the expected columns stops the job.

Options: `extension` (.zip), the end of the names to take; `expected`, the columns a member must have, separated by |.
Files are read through pyarrow, which knows local paths, HDFS, S3 and others by their URI.
"""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from bourseline import schemas

ROWS = 20_000  # rows of a batch
STATUS = "status"
FIRST = ["file_name", "row_idx"]
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, csv.Error, RuntimeError)  # the last: encrypted, or packed in an unknown way


def file_system(path: str):
    """pyarrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


class Archive(InputPartition):
    def __init__(self, name: str, path: str) -> None:
        super().__init__(name)
        self.name, self.path = name, path


class ZipPipe(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_pipe"

    def schema(self) -> T.StructType:
        return T.StructType([*schemas.MONTHLY_TEXT.fields, T.StructField(STATUS, T.StringType())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipPipeReader(schema, dict(self.options))


class ZipPipeReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.columns = [f.name for f in schema.fields if f.name not in (*FIRST, STATUS)]
        self.folder, self.extension = options["path"], options.get("extension", ".zip").lower()

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, folder = file_system(self.folder)
        listed = files.get_file_info(fs.FileSelector(folder))
        return [Archive(x.base_name, x.path) for x in sorted(listed, key=lambda x: x.path) if x.is_file and x.base_name.lower().endswith(self.extension)]

    def read(self, partition: InputPartition | None) -> Iterator:
        import pyarrow as pa

        if partition is None:  # a folder without archives
            return
        names = [*FIRST, *self.columns, STATUS]

        def batch(columns: list[list], start: int) -> pa.RecordBatch:
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [pa.array([partition.name] * n, pa.string()), pa.array(range(start, start + n), pa.int64()), *[pa.array(c, pa.string()) for c in columns], pa.nulls(n, pa.string())],
                names=names,
            )

        done, status = 0, "rows"
        files, _ = file_system(self.folder)
        try:
            with files.open_input_file(partition.path) as raw, zipfile.ZipFile(raw) as archive:
                member = next((n for n in archive.namelist() if n.lower().endswith(".txt")), None)
                if member is None:
                    status = "no member"
                else:
                    with archive.open(member) as stream:
                        for columns in self._batches(io.TextIOWrapper(stream, encoding="latin-1", newline=""), partition.name):
                            yield batch(columns, done)
                            done += len(columns[0])
        except (*BROKEN, pa.ArrowInvalid):
            status = "bad"
        line = [partition.name, done, *[None] * len(self.columns), status]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * (len(self.columns) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(line, kinds)], names=names)

    def _batches(self, lines: io.TextIOBase, name: str) -> Iterator[list[list]]:
        """Columns of text, empty cells as nulls, some rows at a time. The second of two equal headings is told by its place."""
        rows = csv.reader(lines, delimiter="|")
        seen: dict[str, int] = {}
        heading = []
        for h in next(rows, []):
            seen[h] = seen.get(h, -1) + 1
            heading.append(schemas.MONTHLY_HEADERS.get(f"{h}.{seen[h]}" if seen[h] else h, h))
        missing = [c for c in self.columns if c not in heading]
        if missing:
            raise ValueError(f"{name}: missing required columns {missing}")
        places = [heading.index(c) for c in self.columns]
        columns: list[list] = [[] for _ in places]
        for row in rows:
            if not row:
                continue
            for own, at in zip(columns, places):
                own.append((row[at] or None) if at < len(row) else None)
            if len(columns[0]) == ROWS:
                yield columns
                columns = [[] for _ in places]
        if columns[0]:
            yield columns


def zip_pipe(spark: SparkSession, folder: str, extension: str = ".zip") -> DataFrame:
    """Rows and report lines of a folder's archives."""
    spark.dataSource.register(ZipPipe)
    return spark.read.format("zip_pipe").option("extension", extension).load(folder)


def rows_of(read: DataFrame) -> DataFrame:
    return read.filter(F.col(STATUS).isNull()).drop(STATUS)


def report_of(read: DataFrame) -> DataFrame:
    """`file_name`, `status` and `n_rows`, one line for each archive."""
    return read.filter(F.col(STATUS).isNotNull()).select("file_name", STATUS, F.col("row_idx").alias("n_rows"))


def write_files(files: DataFrame, folder: str) -> int:
    """Write each row (name, content) as a file of that name below the folder; how many were written. A file that a
    repeated task writes again is the same."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        system, place = file_system(folder)
        system.create_dir(place, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_output_stream(f"{place}/{name}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.select("name", "content").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_lines(lines: DataFrame, folder: str, order: Sequence[str] = ()) -> int:
    """Write each row (name, line) as a line of the text file of that name below the folder, in the given order; how many were
    written. The lines of a file meet in one task, which writes them as they come, some thousands at a time: no file is ever
    held as a whole, so its size does not matter. Rows without a line are passed over."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        system, place = file_system(folder)
        system.create_dir(place, recursive=True)
        out, last = None, None
        try:
            for batch in batches:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for name, group in groupby(pairs, itemgetter(0)):
                    body = "\n".join(line for _, line in group).encode()
                    if out is None or name != last:
                        if out is not None:
                            out.close()
                        out, last = system.open_output_stream(f"{place}/{name}"), name
                    else:
                        body = b"\n" + body
                    out.write(body)
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
        finally:
            if out is not None:
                out.close()

    met = lines.filter(F.col("line").isNotNull()).repartition("name").sortWithinPartitions("name", *order)
    return met.select("name", "line").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
