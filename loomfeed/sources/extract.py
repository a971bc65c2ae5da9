"""Extract files: pipe-delimited text with one upper-case header per part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import FILE, clean_strings
from .tables import read_delimited

# Field separator and file extension.
SEPARATOR = "|"
EXTENSION = "txt"
HEADER = "0-header.txt"
_FORM = {
    "sep": SEPARATOR,
    "compression": "none",
    "quote": '"',
    "escape": "\\",
    "charToEscapeQuoteEscaping": "\u0000",
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def extract_rows(df: DataFrame) -> DataFrame:
    """Rows as they go into the file: cleaned strings under upper-case names."""
    cleaned = clean_strings(df, FILE)
    return cleaned.select(*[F.col(c).alias(c.upper()) for c in cleaned.columns])


def write_extract(
    df: DataFrame,
    path: str,
    max_records_per_file: int = 0,
) -> None:
    """Write ``df`` under ``path``; an empty frame gives one file that holds the header.

    Values with ``"`` are wrapped in quotes with ``\\"`` inside. Values that hold the separator
    or a line break are wrapped too, so that the file can be read back. Every part carries the
    header; ``max_records_per_file`` bounds the parts.
    """
    rows = extract_rows(df)
    writer = rows.write.mode("overwrite").options(
        extension=EXTENSION, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSS"
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path, header=True, **_FORM)


def write_extract_parts(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Write ``df`` under ``path`` as parts without a header, after one small file that holds it.

    The header file sorts first, so all files in order of name are one extract with one header. The
    parts are written by all tasks. A manifest in ``_manifest`` lists every part with its number of
    rows; it is written last and tells that the extract is whole.
    """
    spark, rows = df.sparkSession, extract_rows(df)
    writer = rows.write.mode("overwrite").options(
        extension=EXTENSION, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSS"
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path, header=False, **_FORM)
    _write_header(spark, SEPARATOR.join(rows.columns), path)
    parts = _part_rows(spark, path, rows.columns)
    counts = parts.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    counts.write.mode("overwrite").parquet(f"{path}/_manifest")


def _write_header(spark: SparkSession, line: str, path: str) -> None:
    """The header as a file of its own, moved into place under a name before all parts."""
    aside = f"{path}/_header"
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(aside)
    place = spark._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for file in system.globStatus(place(f"{aside}/part-*")):
        system.rename(file.getPath(), place(f"{path}/{HEADER}"))
    system.delete(place(aside), True)


def _part_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in columns])
    reader = spark.read.schema(schema).option("pathGlobFilter", f"part-*.{EXTENSION}")
    return reader.csv(path, header=False, sep=SEPARATOR, quote='"', escape="\\", multiLine=True)


def read_extract_parts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read such an extract back, all text; an extract without manifest is not whole."""
    read_manifest(spark, path)
    return _part_rows(spark, path, columns)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and number of rows ``n`` of every part that has rows."""
    return spark.read.schema("file string, n long").parquet(f"{path}/_manifest")


def read_extract(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read an extract back, all text; blank and NULL are both NULL."""
    return read_delimited(spark, path, columns, SEPARATOR)
