"""Incremental intake with Structured Streaming.

A file source remembers which landed files it has read, so each run takes only the
new ones, keeps its rows, and makes the dates it touches anew from all rows kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import broadcast

from bourseline.sources.writers import upsert_by_date


def landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def upsert_new_files(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    finish: Callable[[DataFrame], DataFrame],
    intake: str,
    path: str,
    date: str,
    checkpoint: str,
) -> None:
    """Process everything that has landed since the last run, then stop.

    `prepare` turns landed rows into dated ones, which are added to the intake, one folder for each
    batch and date. Then every date that the batch holds is read back whole, from all batches, and
    `finish` makes its table rows: a date may arrive in any number of pieces. A batch replayed
    after a failure writes its own folder again, so nothing counts twice. The intake and the checkpoint belong together.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = prepare(batch)
        if rows.isEmpty():
            return
        own = f"{intake}/batch={number}"
        rows.write.mode("overwrite").partitionBy(date).parquet(own)
        spark = rows.sparkSession
        schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])
        touched = spark.read.schema(rows.schema).parquet(own).select(date).distinct()
        # The dates of a batch are bounded by the calendar; the join prunes the intake's folders by them.
        whole = spark.read.schema(schema).parquet(intake).join(broadcast(touched), date, "left_semi").select(*rows.columns)
        upsert_by_date(finish(whole), path, date)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
