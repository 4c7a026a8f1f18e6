"""Where intermediate and published data goes.

Everything is written below the shared folder the cluster names in
``spark.checkpoint.dir`` or, if that is not set, below the warehouse, which all
executors share as well. No machine's own temporary folder is used.

Stages live in a folder of the application, which is deleted when the application
ends. Published data stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_marked: set[str] = set()
_landed: list[str] = []


def shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def stage_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's own folder, which goes when the application ends."""
    context = spark.sparkContext
    folder = f"{shared_base(spark)}/bourseline/stages-{context.applicationId}"
    if folder not in _marked:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _marked.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_base(spark)}/bourseline/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str) -> str:
    """Write `df` as a new Parquet dataset of this application and return its path."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    _landed.append(path)
    return path


def landed() -> int:
    """A mark: how many datasets `land` has written so far."""
    return len(_landed)


def drop_landed(spark: SparkSession, mark: int) -> None:
    """Remove the datasets landed since a mark, once nothing reads them any more: a job in steps keeps only its own."""
    for path in _landed[mark:]:
        remove(spark, path)
    del _landed[mark:]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and go on from the written table: later steps read only the
    columns they need, and a lost executor costs no recomputation of the steps before.
    """
    return df.sparkSession.read.schema(df.schema).parquet(land(df, label))


def stage_buckets(df: DataFrame, label: str, column: str) -> DataFrame:
    """As `stage`, in as many buckets by `column` as shuffles have partitions: a join on the column reads
    its rows where they lie."""
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = stage_path(spark, label)
    df.write.bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(name)
    _landed.append(path)
    return spark.table(name)


# ---- small files of the driver ------------------------------------------------


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet. It appears whole or not at all: it is written under
    another name and renamed, which the shared stores do in one step."""
    files, place = _files(spark, path)
    _, draft = _files(spark, f"{path}.draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    files, place = _files(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    files, place = _files(spark, folder)
    return sorted(x.getPath().getName() for x in files.listStatus(place)) if files.exists(place) else []


def qualified(spark: SparkSession, path: str) -> str:
    """The whole URI of a path, as Spark names the files below it."""
    files, place = _files(spark, path)
    return files.makeQualified(place).toString()


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)
