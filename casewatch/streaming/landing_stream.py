"""Continuous ingest: a file stream over the landing folder.

The stream follows the names of landed files; each micro-batch reads its files with the same code as
the batch load, whatever their layout: records that cannot be parsed or compared are stored as
rejects, the rest is deduplicated on the natural key, anti-joined against the raw table and appended.
foreachBatch runs a batch at least once; `casewatch.sources.loads` logs each batch before and after its
append, so a batch that finished is not loaded again, one that died adds only what is missing, and the
weekly job builds the years of every logged batch. `trigger(availableNow=True)` processes what has
landed and stops, which is how a scheduled run uses it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from casewatch.operators import advance_watermark
from casewatch.plans.ingest import append_loadable, current_watermark, ensure_watermark, tagged_rows, write_watermark
from casewatch.session import drop_scratch, scratch_path
from casewatch.sources import loads
from casewatch.sources.landing import CORRUPT_COLUMN, POSITION_COLUMNS, read_landed
from casewatch.sources.tables import write_table

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Files of one micro-batch; their names reach the driver.
FILES_PER_BATCH = 64


def load_files(spark: SparkSession, paths: Sequence[str], raw_path: str, name: str, rejects_path: str | None = None,
               wm_path: str | None = None, multi_line: bool | None = None) -> bool:
    """Load landed files as the micro-batch `name`; False if it was loaded before."""
    if loads.finished(spark, raw_path, name):
        return False
    landed = read_landed(spark, list(paths), multi_line=multi_line, with_position=True, malformed="column")
    parsed = write_table(tagged_rows(landed), scratch_path(spark, "stream-parsed"))
    rows, rejects, years = append_loadable(parsed, raw_path, rejects_path, on_years=lambda y: loads.intend(spark, raw_path, name, y))
    if wm_path:
        before = current_watermark(ensure_watermark(spark, wm_path), None)
        newest = advance_watermark(parsed.where("load_reason IS NULL").drop("load_reason", CORRUPT_COLUMN, *POSITION_COLUMNS)).first()
        if newest is not None and (newest["year"], newest["week"]) > before:
            write_watermark(spark, newest, wm_path)
    loads.finish(spark, raw_path, name, rows, rejects, years, paths)
    drop_scratch(spark, "stream-parsed", "ingest-new", "ingest-rejects")
    return True


def start_landing_stream(spark: SparkSession, landing_dir: str, raw_path: str, checkpoint: str | None = None,
                         multi_line: bool | None = None, available_now: bool = True, processing_time: str | None = None,
                         rejects_path: str | None = None, wm_path: str | None = None) -> StreamingQuery:
    """Start the stream; the caller waits with `awaitTermination()` or `processAllAvailable()`.

    A stream started with another checkpoint reads all files again and adds nothing. `wm_path` names a
    watermark table that the stream moves forward.
    """
    checkpoint = checkpoint or scratch_path(spark, "landing-stream")
    source = (spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("maxFilesPerTrigger", FILES_PER_BATCH).load(landing_dir)
              .select("path"))  # the files' contents are not read here
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:16]  # the checkpoint numbers the batches

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = sorted({r["path"] for r in batch.collect()})  # at most FILES_PER_BATCH; the source may name a file twice
        if paths:
            load_files(spark, [_literal(p) for p in paths], raw_path, loads.name_of(stream, batch_id), rejects_path, wm_path, multi_line)

    writer = source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _literal(path: str) -> str:
    """A path without patterns in it."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)
