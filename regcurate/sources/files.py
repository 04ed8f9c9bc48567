"""File sources: register extracts as many files per register.

* file names carry the register and the period: ``bef198512.parquet`` (dated)
  or ``patient_icd8.parquet`` (undated folder, period ``"0"``);
* the register name of a file is matched against the landing spec
  (whitelist); other files are ignored;
* an extract too large for one writer may be a folder of that name with part
  files in it (``bef198512.parquet/part-*``), as Spark writes it; its name is the
  folder's. The streaming and the ledger landing take plain files only;
* files of one register can differ in columns, column order (CSV, which Spark
  reads by position) and types (Parquet copies of typed extracts). So files are
  grouped by layout -- the header line, or the footer's schema, read on the
  executors -- and each layout is scanned with its own schema, every value made
  a string, and unioned by name. A column a file lacks reads as null.

File listing, file-name parsing and layout peeking are metadata work; rows
never pass through the driver.
"""

from __future__ import annotations

import csv
import io

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import dataset_from_file_name, dated_period, extract_name
from ..operators.landing import PROVENANCE, land_register, project_to_spec, union_all
from ..session import ship_package
from ..specs.registers import REGISTERS, RegisterSpec
from .fs import folders, read_first_line, read_parquet_schema


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Distributed listing: ``path, file_name, length``, a row per file; the parts
    of an extract kept as a folder have its name. The ``binaryFile`` source prunes
    ``content`` when it is not selected, so no bytes are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)
    if parted := _parted(spark, root, glob):
        files = files.unionByName(
            spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(parted))
    return files.select("path", extract_name("path").alias("file_name"), "length")


def _parted(spark: SparkSession, root: str, glob: str) -> list[str]:
    """The extracts of a folder that are folders of part files."""
    return [f for f in folders(spark, root, glob) if f.endswith((".parquet", ".csv"))]


def register_files(spark: SparkSession, root: str, dated: bool = True,
                   registers: dict[str, RegisterSpec] | None = None,
                   glob: str = "*") -> DataFrame:
    """Files of a landing folder with ``dataset`` and ``period`` parsed from
    the name, restricted to registers of the spec (files of other registers,
    and dated names without digits, are skipped -- not an error)."""
    registers = REGISTERS if registers is None else registers
    files = list_files(spark, root, glob)
    files = files.withColumn("dataset", dataset_from_file_name("file_name", dated))
    files = files.withColumn("period", dated_period("file_name") if dated else F.lit("0"))
    return files.where(F.col("dataset").isin(list(registers)))


def folder_files(spark: SparkSession, root: str | None, dated: bool,
                 registers: dict[str, RegisterSpec] | None = None,
                 glob: str = "*") -> DataFrame | None:
    """:func:`register_files`, or None where the folder does not exist. Any other
    listing failure (credentials, an unknown scheme) is raised."""
    if not root:
        return None
    try:
        return register_files(spark, root, dated, registers, glob)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_partitioned_register(spark: SparkSession, root: str, spec: RegisterSpec,
                              dated: bool | None = None) -> DataFrame:
    """A register laid out as ``<root>/source_file=<extract>/part-*``: provenance
    is the partition value, the register filter a partition filter."""
    dated = spec.dated if dated is None else dated
    df = spark.read.schema(spec.schema(with_source_file=True)).parquet(root)
    return (df.where(dataset_from_file_name(F.col(PROVENANCE), dated) == F.lit(spec.name))
            .select(*spec.columns, PROVENANCE))


def _provenance(in_file: Column | None = None) -> Column:
    """``source_file``: the value carried in the file when there is one (a
    landed copy keeps its original extract name), else the file's name."""
    name = extract_name("_metadata.file_path")
    return (name if in_file is None else F.coalesce(in_file, name)).alias(PROVENANCE)


def rows_by_file(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``file_name, rows`` of the Parquet files of a folder that have rows. No
    column is read, only row counts; names are parsed once a file, not once a row."""
    none = T.StructType([T.StructField("_none", T.StringType(), True)])
    parts = (spark.read.schema(none).option("pathGlobFilter", glob)
             .parquet(root, *_parted(spark, root, glob))
             .groupBy(F.col("_metadata.file_path").alias("path"))
             .agg(F.count(F.lit(1)).alias("rows")))
    # never NULL, and said so: a NULL test would be pushed, with the parsing, to the rows
    name = F.coalesce(extract_name("path"), F.lit(""))
    return parts.groupBy(name.alias("file_name")).agg(F.sum("rows").alias("rows"))


# --- layouts ------------------------------------------------------------------

def _csv_header(path: str) -> list[str]:
    """Column names of a CSV file; a byte-order mark is not part of them."""
    line = read_first_line(path).rstrip(b"\r").decode("utf-8-sig", "replace")
    return next(csv.reader(io.StringIO(line)), [])


def _parquet_header(path: str) -> list[str]:
    return [f"{f.name}\t{f.type}" for f in read_parquet_schema(path)]


def layouts(files: DataFrame, fmt: str) -> list[tuple[list[str], list[str]]]:
    """(header, paths) of each layout among ``files`` (a ``path`` column). The
    heads are read on the executors; the driver gets every header once, and the
    paths, as Spark's own file index does."""
    ship_package(files.sparkSession)
    header = _csv_header if fmt == "csv" else _parquet_header

    def heads(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "header": [header(p) for p in pdf["path"]]})

    found = files.select("path").mapInPandas(heads, "path string, header array<string>") \
        .groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return sorted((r["header"], r["paths"]) for r in found)


def as_text(c: Column, kind: T.DataType) -> Column:
    """A typed value as the text an extract would carry: dates as YYYY-MM-DD,
    whole numbers without decimals."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
        return F.when(whole, c.cast("long").cast("string")).otherwise(c.cast("string"))
    if isinstance(kind, T.DecimalType):
        return F.regexp_replace(c.cast("string"), r"\.0+$", "")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        day = F.date_format(c, "yyyy-MM-dd")
        midnight = F.date_format(c, "HH:mm:ss") == "00:00:00"
        return F.when(midnight, day).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return c.cast("string")


def _read_layout(spark: SparkSession, header: list[str], paths: list[str], fmt: str,
                 null_value: str) -> DataFrame:
    if fmt == "csv":
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in header])
        return (spark.read.option("header", "true").option("nullValue", null_value)
                .option("mode", "FAILFAST").schema(schema).csv(paths))
    return spark.read.parquet(*paths)           # one schema: any footer gives it


def read_files(spark: SparkSession, files: DataFrame, spec: RegisterSpec, fmt: str = "parquet",
               null_value: str = "NA", extract: str | None = None) -> DataFrame:
    """Files listed in ``files`` (a ``path`` column), one scan per layout, every
    value a string, unioned by name into the spec's columns + ``source_file``
    (and, if asked for, a column ``extract``: the file's own name)."""
    extra = [extract] if extract else []
    frames = []
    for header, paths in layouts(files, fmt):
        df = _read_layout(spark, header, paths, fmt, null_value)
        kinds = {f.name: f.dataType for f in df.schema}
        carried = F.col(PROVENANCE).cast("string") if PROVENANCE in kinds else None
        frames.append(project_to_spec(
            df.select(*[as_text(F.col(f"`{n}`"), k).alias(n) for n, k in kinds.items()
                        if n in spec.columns], _provenance(carried),
                      *[extract_name("_metadata.file_path").alias(e) for e in extra]),
            spec.columns, (PROVENANCE, *extra)))
    if not frames:
        schema = T.StructType([*spec.schema(with_source_file=True).fields,
                               *[T.StructField(e, T.StringType()) for e in extra]])
        return spark.createDataFrame([], schema)
    return union_all(frames)


def read_register(spark: SparkSession, root: str, spec: RegisterSpec, fmt: str = "parquet",
                  dated: bool | None = None, layout: str = "files",
                  null_value: str = "NA") -> DataFrame:
    """Read one register (raw columns + ``source_file``) from a landing folder."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported format {fmt!r}")
    if layout == "partitioned":
        return read_partitioned_register(spark, root, spec, dated)
    dated = spec.dated if dated is None else dated
    glob = f"{spec.name}*.{fmt}" if dated else f"{spec.name}.{fmt}"
    files = register_files(spark, root, dated, {spec.name: spec}, glob)
    return read_files(spark, files, spec, fmt, null_value)


def land_folder(spark: SparkSession, root: str, spec: RegisterSpec, fmt: str = "parquet",
                dated: bool | None = None, **kw) -> DataFrame:
    """Read and land one register: spec columns, ``source_file``, ``period``."""
    return land_register(read_register(spark, root, spec, fmt, dated, **kw), spec)


def landed_schema(spec: RegisterSpec) -> T.StructType:
    return T.StructType(spec.schema(with_source_file=True).fields
                        + [T.StructField("period", T.StringType(), True)])


def read_landed(spark: SparkSession, path: str, spec: RegisterSpec) -> DataFrame:
    """A landed register table. The schema is given, so the partition columns
    ``period`` and ``source_file`` stay strings (no partition-type inference:
    ``0`` and ``198512`` are names, not numbers) and filters on them prune
    folders."""
    schema = landed_schema(spec)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def files_without_key(landed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``source_file, key``: files that have rows but no value at all in a key
    column -- the column is missing, or spelled differently."""
    wide = landed.groupBy(PROVENANCE).agg(*[F.count(k).alias(k) for k in keys])
    return wide.select(PROVENANCE, F.explode(F.array_compact(F.array(
        *[F.when(F.col(k) == 0, F.lit(k)) for k in keys]))).alias("key"))
