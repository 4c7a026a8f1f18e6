"""Tables replaced as a whole, by versions.

A table is a folder with one data folder for each version and one small file for each commit. A version
is written first; the commit, one rename, makes it the current one. A writer that dies in between leaves
the version before; of two writers that began from the same version the second fails. Readers take a commit and stay
with its version, until it expires: `keep` versions before the current one are left.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bourseline.sources.storage import get_text, names_in, put_if_absent, remove, shared_base

KEPT = 2


class Conflict(RuntimeError):
    """Another writer has committed a version since this one began."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    schema: T.StructType


def folder_of(spark: SparkSession, name: str) -> str:
    return f"{shared_base(spark)}/bourseline/tables/{name}"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Committed versions, rising."""
    return [int(n) for n in names_in(spark, f"{folder}/commits") if n.isdigit()]


def version(spark: SparkSession, folder: str, number: int | None = None) -> Version | None:
    """A committed version, the current one by default; null if there is none."""
    known = numbers(spark, folder)
    number = (known[-1] if known else None) if number is None else number
    if number not in known:
        return None
    found = json.loads(get_text(spark, f"{folder}/commits/{number:010d}"))
    return Version(number, f"{folder}/{found['data']}", T.StructType.fromJson(found["schema"]))


def read(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """The rows of a version, whatever is committed later on."""
    found = version(spark, folder, number)
    if found is None:
        raise LookupError(f"{folder}: no version {'' if number is None else number}")
    return spark.read.schema(found.schema).parquet(found.path)


def write(df: DataFrame, folder: str) -> str:
    """The data folder of a version to be committed."""
    data = f"data-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{folder}/{data}")
    return data


def commit(spark: SparkSession, folder: str, data: str, schema: T.StructType, after: int) -> Version:
    """Make the data folder the version after `after` (0: the first)."""
    try:
        put_if_absent(spark, f"{folder}/commits/{after + 1:010d}", json.dumps({"data": data, "schema": schema.jsonValue()}))
    except FileExistsError as e:
        remove(spark, f"{folder}/{data}")
        raise Conflict(f"{folder}: version {after + 1} is there already") from e
    return Version(after + 1, f"{folder}/{data}", schema)


def expire(spark: SparkSession, folder: str, keep: int = KEPT) -> list[int]:
    """Remove versions older than `keep` before the current one, the commit first. Data that no commit names
    stays: a writer may be about to commit it."""
    gone = numbers(spark, folder)[: -1 - keep]
    for number in gone:
        old = version(spark, folder, number)
        remove(spark, f"{folder}/commits/{number:010d}")
        remove(spark, old.path)
    return gone


def replace(df: DataFrame, folder: str, keep: int = KEPT) -> Version:
    """Write, commit, expire."""
    spark = df.sparkSession
    known = numbers(spark, folder)
    after = known[-1] if known else 0
    made = commit(spark, folder, write(df, folder), df.schema, after)
    expire(spark, folder, keep)
    return made
