"""Readers for raw delimited registry files. Every raw column is read as STRING; typing happens later.

Files are read line by line (``multiLine`` off), so an uncompressed dump is split across many tasks.
"""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterable, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.rename import missing_columns
from ..session import scratch_path

log = logging.getLogger(__name__)

# Reader options of the company-register dumps (headerless, ';', Latin-1, '"' escapes).
POSITIONAL_OPTIONS = {"sep": ";", "encoding": "ISO-8859-1", "escape": '"', "header": "false"}
# Reader options of the labour-flow dumps (headered, ';', UTF-8).
HEADERED_OPTIONS = {"sep": ";", "header": "true"}
# Codebook CSVs (comma separated, header 'cod_<name>,<name>').
CODEBOOK_OPTIONS = {"header": "true"}


def string_schema(columns: Iterable[str]) -> StructType:
    """``StructType`` of nullable strings, one per name, in order."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def ddl_schema(columns: Iterable[str]) -> str:
    """The same schema as DDL text: ``'a STRING, b STRING'``."""
    return ", ".join(f"`{c}` STRING" for c in columns)


def read_data(spark: SparkSession, path, fmt: str, schema=None, **options) -> DataFrame:
    """Generic reader: ``spark.read.format(fmt).options(**options).load(path, schema=schema)``."""
    reader = spark.read.format(fmt).options(**{k: str(v) if isinstance(v, bool) else v for k, v in options.items()})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_positional(spark: SparkSession, path, columns: Iterable[str], **options) -> DataFrame:
    """Headerless delimited text, columns by position. Short rows pad with null, extra fields drop."""
    opts = {**POSITIONAL_OPTIONS, **options}
    return read_data(spark, path, "csv", string_schema(columns), **opts)


# A file up to this size costs no more to read through than to open (Spark's own estimate of an opening).
OPEN_COST = "spark.sql.files.openCostInBytes"
PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"


# Outcome of a raw row, and the column that keeps its line.
ROW_STATUS, RAW_LINE = "_row_status", "_raw_line"


def read_checked(spark: SparkSession, path, columns: Iterable[str], **options) -> DataFrame:
    """:func:`read_positional` that hides nothing: every row with its ``_row_status`` and its ``_raw_line``.

    ``ok``: as many fields as columns. ``short``, ``long``: fewer or more (``read_positional`` pads and drops).
    ``broken``: a quoted field that is not closed on its line, or a row that the CSV parser
    rejects. Rows that are not ok have null columns. Blank lines are skipped, as by the CSV reader.
    """
    names = list(columns)
    opts = {**POSITIONAL_OPTIONS, **options}
    sep, encoding = opts["sep"], opts.pop("encoding", "UTF-8")
    for name in ("header", "multiLine"):
        if str(opts.pop(name, "false")).lower() != "false":
            raise ValueError(f"rows are checked line by line; {name} is not supported")
    raw = F.decode(F.col("value").cast("binary"), encoding)
    lines = spark.read.format("text").load(path).select(F.regexp_replace(raw, "\r$", "").alias(RAW_LINE)).where(F.trim(RAW_LINE) != "")
    cut = re.escape(sep)
    # What is left once every closed quoted field (quotes inside are doubled) is taken out.
    bare = F.regexp_replace(RAW_LINE, f'(^|{cut})"(?:[^"]|"")*"(?={cut}|$)', "$1")
    fields = F.size(F.split(bare, cut, -1))
    corrupt = "_cadastro_corrupt"
    parsed = F.from_csv(F.col(RAW_LINE), ddl_schema([*names, corrupt]), {**{k: str(v) for k, v in opts.items()}, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    status = (F.when(bare.rlike(f'(^|{cut})"'), "broken").when(fields < len(names), "short").when(fields > len(names), "long")
              .when(F.col(f"_row.{corrupt}").isNotNull(), "broken").otherwise("ok"))
    checked = lines.withColumn("_row", parsed).withColumn(ROW_STATUS, status)
    good = F.col(ROW_STATUS) == "ok"
    return checked.select(*[F.when(good, F.col("_row").getField(c)).alias(c) for c in names], ROW_STATUS, RAW_LINE)


def first_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line): the first line of every file below ``path`` that has one, as raw bytes, by Spark tasks.

    Files go through Spark's text reader, so any storage and codec it knows will do. Small ones share
    tasks and are read through; a file above Spark's cost of an opening is a task of its own, which stops
    after the first lines. The result is a table in the scratch folder.
    """
    limit = int(_bytes(spark.conf.get(OPEN_COST)))
    lines = spark.read.format("text").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    out = scratch_path(spark, "first_lines")
    schema = "file string, line binary"
    small = lines.where(F.col("size") <= limit).mapInArrow(_heads(stop=False), schema)
    small.write.parquet(out)
    before = {key: spark.conf.get(key) for key in (OPEN_COST, PARTITION_BYTES)}
    try:
        for key in before:  # one split a file, one file a task
            spark.conf.set(key, str(_WHOLE_FILE))
        alone = all(spark.conf.get(key) == str(_WHOLE_FILE) for key in before)
        lines.where(F.col("size") > limit).mapInArrow(_heads(stop=alone), schema).write.mode("append").parquet(out)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(schema).parquet(out)


_WHOLE_FILE = 1 << 50


def _bytes(text: str) -> int:
    """A size as Spark's settings spell it: ``4194304``, ``4194304b``, ``4m``, ``4MB``."""
    number, unit = re.fullmatch(r"([0-9]+)\s*([a-z]*)", text.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit.removesuffix("b").removesuffix("i") or "b"]


def _heads(stop: bool):
    """mapInArrow function: lines in file order -> the first line of each file whose start the task reads."""

    def run(batches):
        seen = None
        for batch in batches:
            files, starts = batch.column(0), batch.column(2)
            at = [i for i in range(batch.num_rows) if i == 0 or files[i] != files[i - 1]] if batch.num_rows else []
            at = [i for i in at if files[i].as_py() != seen and starts[i].as_py() == 0]
            yield pa.RecordBatch.from_arrays([files.take(pa.array(at, pa.int64())), batch.column(3).take(pa.array(at, pa.int64()))],
                                             names=["file", "line"])
            if batch.num_rows:
                seen = files[batch.num_rows - 1].as_py()
                if stop:
                    return

    return run


def headers_of(spark: SparkSession, path, sep: str, encoding: str) -> dict[tuple[str, ...], list[str] | None]:
    """Header (tuple of names) -> the files that start with it; None for all files, if they share one header.

    Only distinct headers reach the driver, and the files of each header only if there are several
    (a scan needs its list of files there). Files without a line have no header and no rows.
    """
    first = first_lines(spark, path)
    raw = [bytes(r.line) for r in first.select("line").distinct().collect()]
    names = {line: tuple(next(csv.reader([line.decode(encoding).removeprefix("\ufeff").rstrip("\r")], delimiter=sep), [])) for line in raw}
    if len(set(names.values())) == 1:
        return {names[raw[0]]: None}
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        found.setdefault(names[bytes(row.line)], []).extend(row.files)
    return found


def read_headered(spark: SparkSession, path, expected: Iterable[str] | None = None, strict: bool = False,
                  **options) -> DataFrame:
    """Headered delimited text; names come from each file's own header, every column a string.

    Files with the same columns in another order are read by name, one scan per distinct header; a column
    that only some files have is null in the others. ``expected`` lists header names the caller will use;
    a name that a header lacks, or has beyond them, is logged (or raises when strict). Compressed files
    (``.gz`` and what else Spark's text reader opens) are read like plain ones.
    """
    opts = {**HEADERED_OPTIONS, **options}
    groups = headers_of(spark, path, opts["sep"], opts.get("encoding", "UTF-8"))
    if not groups:
        return read_data(spark, path, "csv", string_schema(expected or []), **opts)
    parts = [read_data(spark, files or path, "csv", string_schema(names), **opts) for names, files in sorted(groups.items())]
    if expected is not None:
        for part in parts:
            gone = missing_columns(part, expected)
            more = missing_columns(part.sparkSession.createDataFrame([], string_schema(expected)), part.columns)
            if strict and (gone or more):
                raise ValueError(f"header lacks {gone}, has unknown {more}")
            if gone:
                log.warning("header lacks %s", gone)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_codebook(spark: SparkSession, path, **options) -> DataFrame:
    """A codebook CSV (``cod_<name>,<name>``), all strings."""
    return read_data(spark, path, "csv", None, inferSchema="false", **{**CODEBOOK_OPTIONS, **options})


def read_lookup_set(spark: SparkSession, root: str, names: Mapping[str, str], suffix: str = "CSV",
                    strict: bool = True, **options) -> dict[str, DataFrame]:
    """Read one positional 2-column lookup per id, each matched by its own file-name suffix.

    ``names`` maps a file id to a lookup name (``{'PAIS': 'pais'}``): the files ``<root>/*PAISCSV`` become
    a frame ``(cod_pais, nome_pais)``. Files are matched per id, so a missing or extra file never shifts
    another lookup; a missing one raises when ``strict`` (else it is left out).
    """
    out = {}
    for file_id, name in names.items():
        pattern = f"{root.rstrip('/')}/*{file_id}{suffix}"
        try:
            df = read_positional(spark, pattern, [f"cod_{name}", f"nome_{name}"], **options)
            df.schema  # resolves the glob: raises when nothing matches
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise  # anything but a missing file (access denied, say) is the caller's to see
            if strict:
                raise FileNotFoundError(f"no lookup file for {file_id!r} at {pattern}") from exc
            log.warning("no lookup file for %s at %s", file_id, pattern)
            continue
        out[name] = df
    return out
