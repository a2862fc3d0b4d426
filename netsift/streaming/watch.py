"""Live input: files landing in a folder go through the same parse, shape and write as a batch.

Each micro-batch is a batch of the query's own in the table (see ``batches``), so one that
is run again after a failure replaces itself, and neither another query nor a batch
ingestion nor a compaction is touched. A file is never split over two micro-batches,
hence grouping per file or per run gives the same documents as a batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from netsift.ingest import write_parsed
from netsift.sources.base import Source, get_source
from netsift.sources.lines import number_rows, watch_lines
from netsift.streaming.carry import Carry


def watch(
    spark: SparkSession, source: Source | str, directory: str, path: str, checkpoint: str, *,
    finite: bool = False, interval: str = "10 seconds", pattern: str | None = None,
    files_per_trigger: int | None = None, bytes_per_trigger: int | None = None, **options,
) -> StreamingQuery:
    """Start feeding ``directory`` into the table at ``path``.

    ``finite`` takes what is there and ends; else the query runs until stopped. A micro-batch
    takes at most ``files_per_trigger`` files, or files up to ``bytes_per_trigger`` bytes and one at least.
    """
    source = get_source(source)
    if not source.streaming:
        raise ValueError(f"source {source.name!r} is read in batches only")
    lines = watch_lines(spark, directory, pattern, files_per_trigger, bytes_per_trigger)
    return watch_frame(source, lines, path, checkpoint, finite=finite, interval=interval, **options)


def watch_frame(
    source: Source | str, lines: DataFrame, path: str, checkpoint: str, *,
    finite: bool = False, interval: str = "10 seconds", carry: bool = False, open_for: int | None = None, **options,
) -> StreamingQuery:
    """The same for any streaming frame with ``value``, ``_file`` and ``_block`` columns (a Kafka topic, say).

    Lines are in the order of ``_row`` if there is such a column (a Kafka offset, say), else as they
    come. With ``carry`` documents and marks go on over micro-batches (see ``carry``).
    """
    source = get_source(source)
    state = None
    if carry:
        kept = {k: options[k] for k in ("group", "sentinel") if k in options}
        state = Carry(source, f"{checkpoint.rstrip('/')}/carried", open_for=open_for, **kept)

    def write(batch: DataFrame, batch_id: int) -> None:
        # the query's id lives in its checkpoint: the same after a restart, another for a new checkpoint
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        lines = batch if "_row" in batch.columns else number_rows(batch)
        if state is None:
            write_parsed(source, source.parse(lines, **options), path, batch_id, writer=f"stream-{query}", **options)
            return
        parsed, carried = state.parsed(lines, batch_id, **options)
        write_parsed(source, parsed, path, batch_id, writer=f"stream-{query}", carried=carried, **options)
        state.done(batch.sparkSession, batch_id)

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if finite else writer.trigger(processingTime=interval)
    return writer.start()
