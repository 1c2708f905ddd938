"""Scans: period files, folders, delivery files, reference snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.delivery import DELIVERY_ORDER
from tidewatch.runtime import materialize

# Parts of a stored reference, as the training phase writes them.
REFERENCE_PARTS = ("raw", "pre", "scores", "replica")

PERIOD_IN_NAME = r".*\bp(\d+)_"
MODEL_IN_NAME = r".*\bp\d+_([^_./]+)"
PERIOD_FILE = r"^(.*/p\d+_[^/]*\.csv)"


def strings(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | None,
         drop_bad_rows: bool = False, skip_corrupt_files: bool = False, **options) -> DataFrame:
    """CSV with a header, every column as text; types come after the missing-value texts are gone.
    A header that differs from the schema is an error, never a silent shift of columns."""
    reader = (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("mode", "DROPMALFORMED" if drop_bad_rows else "PERMISSIVE")
        .option("ignoreCorruptFiles", skip_corrupt_files).options(**options)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def period_from_path(path=None):
    """Period number out of a file name such as `p3_extrac.csv`."""
    path = F.col("_metadata.file_name") if path is None else path
    return F.regexp_extract(path, PERIOD_IN_NAME, 1).cast("int")


def model_from_path(path=None):
    """Model name out of a file name such as `p3_extrac.csv`."""
    path = F.col("_metadata.file_name") if path is None else path
    return F.regexp_extract(path, MODEL_IN_NAME, 1)


def read_periods(spark: SparkSession, folder: str, periods: Iterable[int], model: str = "extrac",
                 schema: T.StructType | None = None, **options) -> DataFrame:
    """The named periods' CSV files (or folders of parts) as one table with a `period` column.
    Files are met by column name; a column that one period lacks is NULL there."""
    out = None
    for period in periods:
        path = f"{folder}/p{period}_{model}.csv"
        part = _csv(spark, path, schema, **options).withColumn("period", F.lit(int(period)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no periods given")
    return out


def _units(spark: SparkSession, folder: str) -> list[str]:
    """Files below a folder to be scanned as one: a period file, or a period's folder of parts. Only the
    listing is read, and as many names come back as there are such files."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True).load(folder).select("path"))
    period_file = F.regexp_extract("path", PERIOD_FILE, 1)
    unit = F.when(period_file != "", period_file).otherwise(F.col("path"))
    return sorted(r["unit"] for r in files.select(unit.alias("unit")).distinct().collect())


def read_folder(spark: SparkSession, folder: str, schema: T.StructType | None = None,
                drop_bad_rows: bool = False, skip_corrupt_files: bool = False) -> DataFrame:
    """Every CSV file of a folder, the period taken from the file name. Files are met by column name: those
    of one header are one scan, and a column that some lack is NULL in their rows. With a `schema` its
    columns are returned, in its order and types. Unreadable files and rows stop the job unless the
    caller opts to skip them; a folder without CSV files is an error, files without a header have no rows."""
    options = {"pathGlobFilter": "*.csv", "recursiveFileLookup": True}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for unit in _units(spark, folder):
        header = tuple(_csv(spark, unit, None, drop_bad_rows, skip_corrupt_files, **options).columns)
        if header:
            by_header.setdefault(header, []).append(unit)
    if not by_header:
        raise FileNotFoundError(f"no CSV files in {folder}")
    typed = {field.name: field for field in schema or ()}
    out = None
    for header, units in by_header.items():
        own = T.StructType([typed.get(c, T.StructField(c, T.StringType())) for c in header]) if typed else None
        part = _csv(spark, units, own, drop_bad_rows, skip_corrupt_files, **options)
        wanted = [(F.col(f"`{c}`") if c in header else F.lit(None).cast(f.dataType)).alias(c)
                  for c, f in typed.items()] or ["*"]
        part = part.select(*wanted, period_from_path(F.col("_metadata.file_path")).alias("period"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_folder_checked(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): `read_folder`, with what cannot be read put aside and named.

    rejected is (file, period, record, reason): a row with more or fewer fields than its header, or with a value that is
    none of its type, is there with its text; a file without a readable header has one row without a record; files of no bytes are not listed. Every row of
    every file is in one of the two tables. Both come from one written scan, so they agree whatever columns
    are read later.
    """
    options = {"pathGlobFilter": "*.csv", "recursiveFileLookup": True}
    by_header: dict[tuple[str, ...], list[str]] = {}
    unread = []
    for unit in _units(spark, folder):
        try:
            header = tuple(_csv(spark, unit, None, **options).columns)
        except (CapturedException, Py4JJavaError) as error:
            unread.append((unit, type(error).__name__))
            continue
        if header:
            by_header.setdefault(header, []).append(unit)
        else:
            unread.append((unit, "no header"))
    typed = {field.name: field for field in schema or ()}
    out = None
    for header, units in by_header.items():
        bad = "_record"
        while bad in header:
            bad += "_"
        own = T.StructType([typed.get(c, T.StructField(c, T.StringType())) for c in header] + [T.StructField(bad, T.StringType())])
        part = _csv(spark, units, own, columnNameOfCorruptRecord=bad, **options)
        wanted = [(F.col(f"`{c}`") if c in header else F.lit(None).cast(f.dataType)).alias(c)
                  for c, f in typed.items()] or [F.col(f"`{c}`") for c in header]
        file = F.col("_metadata.file_path")
        part = part.select(F.struct(*wanted).alias("fields"), F.struct(
            file.alias("file"), period_from_path(file).alias("period"), F.col(bad).alias("record")).alias("found"))
        part = part.select("fields.*", "found")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    named = spark.createDataFrame(unread, "file string, reason string").select(
        "file", period_from_path(F.col("file")).alias("period"), F.lit(None).cast("string").alias("record"), "reason")
    if out is None:
        return spark.createDataFrame([], T.StructType([*typed.values(), T.StructField("period", T.IntegerType())])), named
    scan = materialize(out, "checked-scan")
    rows = scan.where("found.record is null").select(*[F.col(f"`{c}`") for c in scan.columns if c != "found"], "found.period")
    rejected = scan.where("found.record is not null").select("found.*", F.lit("fields do not fit the header").alias("reason"))
    return rows, rejected.unionByName(named)


def read_raw(spark: SparkSession, folder: str, periods: Iterable[int], model: str = "extrac",
             fmt: str = "csv") -> DataFrame:
    """Raw rows of the wanted periods from CSV files or from a parquet folder. A parquet table with a
    `period` column is pruned to the periods; one without is read whole."""
    if fmt == "csv":
        return read_periods(spark, folder, periods, model)
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(folder)
        return df.where(F.col("period").isin(*periods)) if "period" in df.columns else df
    raise ValueError(f"unknown format {fmt!r}: csv or parquet")


def delivery_schema(with_period: bool = True) -> T.StructType:
    types = {"puntuacion": T.DoubleType(), "score": T.DoubleType(), "variable2": T.DoubleType(),
             "grupo_ejec": T.IntegerType(), "orden": T.IntegerType()}
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in DELIVERY_ORDER]
    return T.StructType(fields + ([T.StructField("period", T.IntegerType())] if with_period else []))


def read_delivery(spark: SparkSession, path: str) -> DataFrame:
    """A delivery table written by `write_delivery`, all periods."""
    return spark.read.schema(delivery_schema()).option("header", True).option("sep", "|").csv(path)


def load_reference(spark: SparkSession, root: str,
                   parts: Iterable[str] = REFERENCE_PARTS) -> dict[str, DataFrame]:
    """The stored reference tables by part; a missing one is named in the error."""
    found = {}
    for part in parts:
        try:
            found[part] = spark.read.parquet(f"{root}/reference_{part}")
        except AnalysisException as error:
            raise FileNotFoundError(
                f"reference part {part!r} not found in {root}; run the training phase first") from error
    return found
