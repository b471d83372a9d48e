"""Incremental intake: consolidate only files that arrived since the last run.

A Structured Streaming file source remembers, in its checkpoint, which files it has consumed; with
``trigger(availableNow=True)`` each run processes everything new and stops. A re-run with no new files
adds nothing, and a run interrupted by a lost executor resumes from the checkpoint (the file sink
commits each micro-batch atomically, so output holds every input row exactly once).

Consolidation specs are stateless (projections plus stream-static broadcast lookups), so the same
``transform`` used in batch runs unchanged here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lookups import lookup
from ..session import path_exists
from ..sources.delimited import POSITIONAL_OPTIONS

NO_FILE_IS_TOO_OLD = "36500d"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "csv",
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
    sink_format: str = "parquet",
) -> None:
    """Run one availableNow pass from ``source`` into ``target``.

    ``options`` default to the positional registry reader options for CSV. Which files are new is decided
    by the checkpoint alone: no file is too old to be read (dumps are often copied with their old
    modification times, and the file source would by default drop those a week older than its newest).
    """
    stream = _stream(spark, source, schema, fmt, options, max_files_per_trigger)
    if transform is not None:
        stream = transform(stream)
    query = (
        stream.writeStream.format(sink_format)
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _stream(spark: SparkSession, source: str, schema, fmt: str, options: dict | None, max_files: int | None) -> DataFrame:
    opts = dict(POSITIONAL_OPTIONS if fmt == "csv" else {})
    opts["maxFileAge"] = NO_FILE_IS_TOO_OLD
    opts.update(options or {})
    if max_files:
        opts["maxFilesPerTrigger"] = str(max_files)
    return spark.readStream.format(fmt).schema(schema).options(**opts).load(source)


DIGEST = ("n_rows", "xor_hash", "sum_hash")


def content_digest(columns: list[str]) -> list[Column]:
    """Aggregates that are equal for equal sets of rows, in any order: their number, and the xor and the sum of
    two unlike 64-bit hashes of each. All are partial aggregates, whatever the size of a file."""
    values = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    # Nulls do not enter a hash, so where they stand does, in a place of its own.
    nulls = F.concat(*[F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in values])
    return [F.count(F.lit(1)).alias(DIGEST[0]), F.bit_xor(F.xxhash64(nulls, *values)).alias(DIGEST[1]),
            F.sum(F.xxhash64(*values, nulls, F.lit(1)).cast("decimal(20,0)")).cast("decimal(38,0)").alias(DIGEST[2])]


def ingest_new_content(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "csv",
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """:func:`ingest_new_files` that also knows content: a file whose rows came before under another name, in
    whatever order, adds nothing.

    The state is a table keyed by content digest, ``<checkpoint>/digests``, with one folder per micro-batch. A
    batch works out its files' digests (one aggregate), leaves out those that an earlier batch has, and of
    files alike in the batch takes the first by name. Digests and rows are written to folders named by the
    batch (``<target>/batch=<id>``), which a batch that runs again after a failure overwrites, so every row is
    there once. Read ``target`` as one table; its column ``batch`` tells the intake.
    """
    stream = _stream(spark, source, schema, fmt, options, max_files_per_trigger)
    names = stream.columns
    file = "_cadastro_file"
    known = f"{checkpoint.rstrip('/')}/digests"

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = batch.groupBy(file).agg(*content_digest(names))
        first = files.groupBy(*DIGEST).agg(F.min(file).alias(file))
        if path_exists(session, known):
            seen = session.read.schema(f"{DIGEST[0]} long, {DIGEST[1]} long, {DIGEST[2]} decimal(38,0), {file} string, batch long").parquet(known)
            first = first.join(seen.where(F.col("batch") != batch_id), list(DIGEST), "left_anti")
        first.write.mode("overwrite").parquet(f"{known}/batch={batch_id}")
        fresh = session.read.schema(f"{file} string").parquet(f"{known}/batch={batch_id}")
        rows = lookup(batch, fresh, file, "inner", name="new files").select(names)
        (transform(rows) if transform else rows).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")

    query = (
        stream.withColumn(file, F.col("_metadata.file_path")).writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/files").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
