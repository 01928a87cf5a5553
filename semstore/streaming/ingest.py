"""Storing texts as they arrive: a stream of documents, enriched, embedded and upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from semstore.operators.embed import Provider
from semstore.sources.collection import Collection


def text_stream(spark: SparkSession, path: str, schema, *, files_per_batch: int = 1_000, **options) -> DataFrame:
    """Parquet files as they appear in a folder: that of a table, or one of many tables. A single file is a table too."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    # a pattern that only the path itself matches lets a single file be read as well
    head, _, name = path.rstrip("/").rpartition("/")
    return reader.options(**options).parquet(f"{head}/{name[:-1]}[{name[-1]}]")


def store_stream(
    docs: DataFrame,
    collection: Collection,
    provider: Provider,
    *,
    checkpoint: str,
    stream: str = "texts",
    available_now: bool = True,
    every: str | None = None,
    rejects: str | None = None,
    **columns,
) -> StreamingQuery:
    """Start storing a stream of texts; bad texts are left out, and written with the reason below ``rejects``.

    The number of the batch is committed together with its records, so a batch that Spark replays after a failure
    is stored once. Give ``every`` (a processing interval) for a stream that goes on. Where versions of a record may
    arrive in any order, make the collection with ``version``: it then ends up as if they had come in order.
    """
    done = f"stream_{stream}"

    def store(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= int(collection.done(done) or -1) or batch.isEmpty():
            return
        folder = f"{rejects.rstrip('/')}/batch={batch_id}" if rejects else None
        collection.store_memories(batch, provider, strict=False, properties={done: batch_id}, rejects_to=folder, **columns)

    writer = docs.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": available_now}
    return writer.trigger(**trigger).start()
