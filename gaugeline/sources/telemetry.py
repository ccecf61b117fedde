"""Raw telemetry scans and the curated Parquet table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.sources.workspace import stage_table

# Fixed value: file name of the public raw data set.
DEFAULT_GLOB = "*MetroPT3*AirCompressor*.csv"

BAD_LINE, BAD_FILE = "_bad_line", "_bad_file"
# A comma followed by an even number of quotes.
COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'

# Columns of the raw compressor table, in file order.
ANALOG_SENSORS = (
    "tp2", "tp3", "h1", "dv_pressure", "reservoirs", "oil_temperature", "motor_current",
)
DIGITAL_SENSORS = (
    "comp", "dv_eletric", "towers", "mpg", "lps", "pressure_switch", "oil_level", "caudal_impulses",
)

TELEMETRY_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in (*ANALOG_SENSORS, *DIGITAL_SENSORS)]
)


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    fail_on_malformed: bool = False,
) -> DataFrame:
    """CSV with a header line; give a schema to avoid the extra pass that inference takes."""
    reader = spark.read.option("header", True)
    if fail_on_malformed:
        reader = reader.option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything on the file system it names."""
    files, at = _file_system(spark, path)
    matches = files.globStatus(at(path))
    return matches is not None and len(matches) > 0


def resolve_source(
    spark: SparkSession, path: str | None, raw_folder: str, pattern: str = DEFAULT_GLOB
) -> tuple[str, str | None]:
    """The given path if it exists, else the raw folder with a file-name filter, else an error."""
    if path and path_exists(spark, path):
        return path, None
    if path_exists(spark, f"{raw_folder.rstrip('/')}/{pattern}"):
        return raw_folder, pattern
    raise FileNotFoundError(f"no input at {path!r} and no {pattern} under {raw_folder}")


def scan_source(
    spark: SparkSession,
    path: str | None,
    raw_folder: str,
    schema: T.StructType | None = None,
    pattern: str = DEFAULT_GLOB,
) -> DataFrame:
    """All files of the resolved source as one frame."""
    folder, name_filter = resolve_source(spark, path, raw_folder, pattern)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.csv(folder)


@dataclass(frozen=True)
class Quarantined:
    """What a scan read well, and the lines it could not read."""

    rows: DataFrame
    #: (file, line, fields): the text of the line, and how many fields it holds.
    bad_lines: DataFrame

    def report(self) -> DataFrame:
        """Rows of the quality report: how many lines did not fit the schema, and of these the short or long ones."""
        counted = self.bad_lines.agg(
            F.count(F.lit(1)).alias("malformed_rows"),
            F.count_if(F.col("fields") != len(self.rows.columns)).alias("malformed_field_count"),
        )
        return counted.unpivot([], counted.columns, "metric", "value")


def scan_quarantined(
    spark: SparkSession,
    path: str | None,
    raw_folder: str,
    schema: T.StructType | None = None,
    pattern: str = DEFAULT_GLOB,
    staged: list[str] | None = None,
) -> Quarantined:
    """``scan_source`` that keeps apart what does not fit the schema instead of half of it as nulls.

    The files are parsed once, with all columns, into a staged table (its path is added to ``staged``);
    both results read that.  A line with a value of another type, or with too few or too many
    fields, is bad as a whole; an empty field is a null and fits.  Without a schema one is inferred first.
    """
    folder, name_filter = resolve_source(spark, path, raw_folder, pattern)
    reader = spark.read.option("header", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if schema is None:
        schema = reader.option("inferSchema", True).csv(folder).schema
    marked = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    parsed = (
        reader.schema(marked)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(folder)
        .withColumn(BAD_FILE, F.col("_metadata.file_path"))
    )
    held = stage_table(parsed, "parsed", staged)
    bad = held.filter(F.col(BAD_LINE).isNotNull())
    fields = F.size(F.split(BAD_LINE, COMMA_OUTSIDE_QUOTES))
    return Quarantined(
        held.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE, BAD_FILE),
        bad.select(F.col(BAD_FILE).alias("file"), F.col(BAD_LINE).alias("line"), fields.alias("fields")),
    )


# -- the curated table --------------------------------------------------------------------------


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def write_curated(df: DataFrame, path: str, partition_by: str = "class") -> None:
    """Replace the curated table; until the new one is complete the old one stays.

    The new table is written beside the old one and then takes its place by two renames, so a run
    that fails while writing changes nothing.  If it fails between the renames, the old table lies
    at ``<path>.old``, from where ``recover_curated`` (called first here) brings it back.  On stores
    that copy to rename, the swap takes as long as the copy.

    No repartition by the partition column first: one dominant class would then be
    written by a single task.  Every task writes its own file per class instead.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover_curated(spark, path)
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old"
    df.write.partitionBy(partition_by).parquet(new)
    files, at = _file_system(spark, path)
    if files.exists(at(path)) and not files.rename(at(path), at(old)):
        raise OSError(f"could not move {path} away")
    if not files.rename(at(new), at(path)):
        raise OSError(f"could not move {new} to {path}")
    if files.exists(at(old)):
        files.delete(at(old), True)


def recover_curated(spark: SparkSession, path: str) -> bool:
    """Brings back the table that an interrupted ``write_curated`` had moved away; whether there was one."""
    path = path.rstrip("/")
    files, at = _file_system(spark, path)
    old = at(f"{path}.old")
    if not files.exists(old):
        return False
    if files.exists(at(path)):
        files.delete(old, True)  # the swap was complete, only the cleaning was not
        return False
    return bool(files.rename(old, at(path)))


def update_curated(df: DataFrame, path: str, partition_by: str = "class") -> None:
    """Replace the classes that ``df`` holds and leave all others as they are.

    Spark's dynamic partition overwrite: the files of the new partitions are staged, and the old
    partitions go only when the job commits.  ``df`` must not read the table it replaces.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )
