"""Incremental landing: a file that has been landed is never landed again.

A Structured Streaming ``binaryFile`` source over a register's folders yields
the paths of files not seen before (``content`` is not selected, so the stream
reads no bytes); the source's file log in the checkpoint is the "already landed"
list, and files are taken whatever their modification time. With
``trigger(availableNow=True)`` every run lands exactly the files that arrived
since the last run and stops. Each micro-batch is read by the layout-aware batch
reader and written by the batch sink, which replaces whole extract files: a batch
that is run again leaves no duplicate rows, and incremental and batch landing
share one table.

The checkpoint must be on shared storage, so that a restarted driver or lost
executors resume from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import dataset_from_file_name
from ..operators.landing import land_register
from ..sinks.writers import write_landed
from ..sources.files import read_files
from ..specs.registers import RegisterSpec

_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Spark forgets files older than this against the newest one; archive years
#: copied with their times kept are the normal case, so nothing is too old.
_ANY_AGE = "36500d"


def stream_files(spark: SparkSession, folder: str, spec: RegisterSpec, fmt: str,
                 dated: bool) -> DataFrame:
    """Streaming ``path, _dated`` of one register's files in a folder."""
    glob = f"{spec.name}*.{fmt}" if dated else f"{spec.name}.{fmt}"
    paths = (spark.readStream.format("binaryFile").schema(_BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", glob).option("maxFileAge", _ANY_AGE)
             .load(folder).select("path"))
    name = F.element_at(F.split("path", "/"), -1)
    return (paths.where(dataset_from_file_name(name, dated) == F.lit(spec.name))
            .withColumn("_dated", F.lit(dated)))


def land_available_now(spark: SparkSession, dated_dir: str | None, undated_dir: str | None,
                       spec: RegisterSpec, out_path: str, checkpoint: str, fmt: str = "parquet",
                       null_value: str = "NA") -> int:
    """Land the files of both folders not landed before into ``out_path``.
    Returns the number of rows landed."""
    streams = [stream_files(spark, folder, spec, fmt, dated)
               for folder, dated in ((dated_dir, True), (undated_dir, False))
               if folder and (spec.dated or not dated)]
    if not streams:
        return 0
    files = streams[0]
    for s in streams[1:]:
        files = files.unionByName(s)
    landed_rows = []

    def land_batch(batch: DataFrame, _epoch: int) -> None:
        if batch.isEmpty():
            return
        rows = land_register(read_files(batch.sparkSession, batch, spec, fmt, null_value), spec)
        seen = Observation()
        write_landed(rows.observe(seen, F.count(F.lit(1)).alias("rows")), out_path)
        landed_rows.append(int(seen.get["rows"]))

    query = (files.writeStream.foreachBatch(land_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return sum(landed_rows)
