"""Incremental price alignment with Structured Streaming.

The reference's inputs are bounded files; price observations, however,
arrive continuously.  This module runs the same J2 operator
(:func:`larder.operators.align.align_prices`) over a file stream: each
micro-batch of new price files is joined with the static product table
(stream-static inner join, no state kept) and appended to a Parquet sink.

The J3 summary follows without reading old prices again.  What it needs of the
rows is a frequency table per (keys, price), and those add up: each micro-batch
writes the table of its own rows, every ``compact_every`` batches the tables so
far become one, and a summary is cut from the last such table and the few
written since.  All of it is written under the batch's number, so a batch that
runs again after a failure replaces what it wrote before.

Progress is tracked in a checkpoint location under the session's
``spark.checkpoint.dir`` (shared storage on a cluster), so a restarted or
failed query resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from larder.operators.align import (SUMMARY_KEYS, align_prices, price_carried, price_counts, summarise_prices,
                                    summary_of_counts)
from larder.operators.ranks import add_counts
from larder.session import ensure_checkpoint_dir

# Batches after which the frequency tables so far become one.
COMPACT_EVERY = 16


def price_stream(spark: SparkSession, path: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the Parquet files that land in ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"


def start_alignment(prices: DataFrame, products: DataFrame, sink_path: str,
                    name: str = "prices-aligned", checkpoint: str | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Append the aligned rows of every new micro-batch to ``sink_path``.

    ``available_now`` processes what is there and stops (batch-like
    scheduling); otherwise the query keeps running on a processing-time
    trigger."""
    writer = (align_prices(prices, products).writeStream
              .format("parquet").outputMode("append")
              .option("path", sink_path)
              .option("checkpointLocation", _checkpoint(prices.sparkSession, name, checkpoint)))
    return _triggered(writer, available_now).start()


def summary_of_sink(spark: SparkSession, sink_path: str) -> DataFrame:
    """J3 over everything aligned so far, from the rows themselves."""
    return summarise_prices(spark.read.parquet(sink_path))


def _tables_up_to(batch: int, compact_every: int) -> list[str]:
    """The frequency tables that together hold the batches 0 to ``batch``."""
    compacted = (batch + 1) // compact_every * compact_every
    base = [f"upto={compacted - 1}"] if compacted else []
    return base + [f"batch={b}" for b in range(compacted, batch + 1)]


def _read(spark: SparkSession, state_path: str, names: Sequence[str]) -> list[DataFrame]:
    return [spark.read.parquet(f"{state_path.rstrip('/')}/{n}") for n in names]


def add_batch(aligned: DataFrame, batch: int, state_path: str, keys: Sequence[str] = SUMMARY_KEYS,
              compact_every: int = COMPACT_EVERY) -> None:
    """Write the frequency table of one batch of aligned rows, and every
    ``compact_every`` batches that of all batches so far."""
    spark, base = aligned.sparkSession, state_path.rstrip("/")
    price_counts(aligned, keys).write.mode("overwrite").parquet(f"{base}/batch={batch}")
    if (batch + 1) % compact_every == 0:
        last = batch - compact_every
        parts = ([f"upto={last}"] if last >= 0 else []) + [f"batch={b}" for b in range(last + 1, batch + 1)]
        (add_counts(_read(spark, base, parts), "price_value", carry=price_carried())
         .write.mode("overwrite").parquet(f"{base}/upto={batch}"))


def start_summary(prices: DataFrame, products: DataFrame, sink_path: str, state_path: str,
                  name: str = "price-summary", checkpoint: str | None = None, available_now: bool = True,
                  compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """J2 and J3 over a stream: every micro-batch's aligned rows are written
    to ``sink_path``, under its number, and counted into ``state_path``."""

    def one(batch: DataFrame, number: int) -> None:
        path = f"{sink_path.rstrip('/')}/batch={number}"
        align_prices(batch, products).write.mode("overwrite").parquet(path)
        add_batch(batch.sparkSession.read.parquet(path), number, state_path, compact_every=compact_every)

    writer = prices.writeStream.foreachBatch(one).option(
        "checkpointLocation", _checkpoint(prices.sparkSession, name, checkpoint))
    return _triggered(writer, available_now).start()


def summary_of_state(spark: SparkSession, state_path: str, batch: int, compact_every: int = COMPACT_EVERY,
                     range_rows: int | None = None) -> DataFrame:
    """J3 over the batches 0 to ``batch`` (a finished one, e.g. the query's
    ``lastProgress["batchId"]``), from their frequency tables only."""
    tables = _read(spark, state_path, _tables_up_to(batch, compact_every))
    return summary_of_counts(add_counts(tables, "price_value", carry=price_carried()), range_rows=range_rows)
