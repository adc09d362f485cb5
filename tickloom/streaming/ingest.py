"""The ingest job over landing files that arrive one by one."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.plans.ingest import Store, ingest
from tickloom.sources import tables as t

PART = "landed_by"


def land_stream(
    store: Store, landing_path: str, landing_schema: StructType, checkpoint: str, files_per_batch: int | None = None
) -> DataFrame:
    """Take in all landing files not seen before; returns all rows landed so far.

    Rows are kept whether or not their symbol is requested now. Each micro-batch
    is one partition of the landed table, so a repeated one replaces itself.
    """
    spark = store.spark
    schema = StructType([*landing_schema.fields, StructField(PART, StringType())])
    t.create_table(spark, store.landed, schema, partitioned_by=[PART], comment="Landed rows")
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def take(rows: DataFrame, batch_id: int) -> None:
        # A stream runs in a session of its own: only there are its writes seen at once.
        t.overwrite_partitions(rows.withColumn(PART, F.lit(f"{stream_id}-{batch_id}")), store.landed)

    reader = spark.readStream.schema(landing_schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(landing_path)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark.catalog.refreshTable(store.landed)
    return spark.table(store.landed).drop(PART)


def ingest_stream(
    store: Store,
    directory: DataFrame,
    landing_path: str,
    landing_schema: StructType,
    checkpoint: str,
    run_date: date,
    committed_at: datetime,
    files_per_batch: int | None = None,
    day: str = "dt",
) -> int:
    """Land all new files, then run the batch job over everything landed. Returns the bars added.

    The stream only lands; what is requested is decided on the landed table. So
    a symbol listed after its files were consumed still gets its history, and of
    copies in different files the batch job's choice is made. A run that changes
    nothing notes nothing.
    """
    landed = land_stream(store, landing_path, landing_schema, checkpoint, files_per_batch)
    return ingest(store, directory, landed, run_date, committed_at, day)
