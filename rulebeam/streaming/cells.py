"""Incremental cell table over a growing event folder.

The cell table is a plain streaming aggregation: new files update the
per-cell counts held in the state store (one row per cell, bounded by the
feature cardinalities), and each micro-batch writes the whole table to a folder of its
own under the shared checkpoint folder. Readers take the newest complete
folder (``read_cells``), so a running or failed write never shows; the folder
before it stays for readers that still use it. Mining then reads the table like the batch
cells. The state and progress live under the checkpoint folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.features import add_features
from ..operators.cells import build_cells
from ..session import delete_path, list_paths, scratch_path
from ..sources.transactions import events_as_transactions, read_table
from ..spec import PatternSpec


def stream_cells(spark: SparkSession, events_dir: str, spec: PatternSpec, out_path: str,
                 checkpoint_location: str, path_glob: str = "events*.parquet", available_now: bool = True,
                 schema=None, max_files_per_trigger: int | None = None):
    """Start the streaming cell build over the files and folders of ``events_dir`` that match
    ``path_glob``; returns the StreamingQuery. ``schema`` defaults to that of ``events.parquet``
    in ``events_dir``. ``max_files_per_trigger`` splits a large backlog into several batches."""
    schema = schema if schema is not None else read_table(spark, events_dir, "events").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(f"{events_dir.rstrip('/')}/{path_glob}")
    cells = build_cells(add_features(events_as_transactions(events)), spec, by=["split"])

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        for old in _complete(spark, out_path)[:-2]:
            delete_path(spark, f"{out_path}/batch_id={old}")

    writer = (cells.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _complete(spark: SparkSession, out_path: str) -> list[int]:
    """Numbers of the batches that are written completely, in order."""
    done = list_paths(spark, f"{out_path}/batch_id=*/_SUCCESS")
    return sorted(int(p.rsplit("/", 2)[1].split("=")[1]) for p in done)


def read_cells(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest complete cell table of a stream."""
    done = _complete(spark, out_path)
    if not done:
        raise FileNotFoundError(f"no complete cell table under {out_path}")
    return spark.read.parquet(f"{out_path}/batch_id={done[-1]}")


def stream_cells_once(spark: SparkSession, events_dir: str, spec: PatternSpec) -> DataFrame:
    """Run the stream over the files present now and return the cells."""
    out = scratch_path(spark, "stream-cells")
    q = stream_cells(spark, events_dir, spec, out, scratch_path(spark, "stream-state"),
                     path_glob="events.parque[t]")
    q.awaitTermination()
    return read_cells(spark, out)
