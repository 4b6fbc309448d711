"""Landed files as a resumable stream into the same tables."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.validate import validate
from tidemark.plans.layers import build_curated, build_staging
from tidemark.sources.landing import landed_options, landed_schema, with_origin
from tidemark.sources.tables import Tables


def incremental_stream(
    landing_dir: str,
    tables: Tables,
    checkpoint: str,
    as_of: date | None = None,
    lookback_days: int | None = None,
    max_files_per_trigger: int | None = None,
    stream_name: str | None = None,
    bad_lines: str = "raise",
    bad_points: str = "raise",
    pack_every: int | None = None,
) -> StreamingQuery:
    """Process the files that arrived since the last run, then stop.

    The checkpoint is the resume state. Each micro-batch goes through the same steps as the batch
    pipelines. A batch that is repeated after a crash overwrites its own raw partitions and upserts
    the same rows. Files reach batches in any order, so staging keeps the newer ingestion; late
    data needs no watermark.

    ``lookback_days`` without ``as_of`` counts from the UTC day on which a batch runs. Loads are named
    by ``stream_name`` and the batch number; without a name the checkpoint's path gives one.
    ``bad_lines`` and ``bad_points`` are those of ``load_landed`` and ``build_staging``; every
    ``pack_every`` batches the loads before the current one are packed.
    """
    spark = tables.create().spark
    name = stream_name or uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex
    reader = spark.readStream.schema(landed_schema(bad_lines)).options(**landed_options(bad_lines))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arrivals = with_origin(reader.json(landing_dir))

    def process(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{name}-{batch_id}"
        if pack_every and batch_id % pack_every == pack_every - 1:
            # Only this batch can still be repeated: the checkpoint has all earlier ones.
            tables.pack(keep=[load_id])
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            tables.load(batch, load_id, replace=True)
            # The batch at hand, not the table it went to: nothing of the intake is listed or read.
            arrived, _ = validate(batch.filter("corrupt IS NULL"))
            day = as_of or datetime.now(timezone.utc).date()
            build = build_staging(tables, arrived, day, lookback_days, only_if_newer=True, bad_points=bad_points)
            build_curated(tables, build.touched)
        finally:
            batch.unpersist()

    return (
        arrivals.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
