"""Landed JSON documents: one object per file or an array of them, facts also in the folder names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a character JSON cannot hold unescaped; read up to it, a file is one text of several lines.
NEVER = "\x1e"
# Fixed value: layout of the company list folders.
ROLE_AND_DATES = {
    "company_role": r"buyer-supplier-list/([^/]+)/",
    "from_date": r"(\d{4}-\d{2}-\d{2})_to_\d{4}-\d{2}-\d{2}",
    "to_date": r"\d{4}-\d{2}-\d{2}_to_(\d{4}-\d{2}-\d{2})",
}


def read_landed_json(spark: SparkSession, folder: str, schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """All JSON files below a folder with a given schema (no inference pass), plus ``source_file``.

    Files of several lines (UTF-8) are parsed from memory: Spark's ``multiLine`` reads the exact text of every number, truth
    value and nested object from the file again, which costs most of the time and many times the input. Fields that do not
    parse are null and the text of a broken document is kept in ``_corrupt_record`` when the schema names that column.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    if multi_line:
        reader = reader.option("lineSep", NEVER)
    rows = reader.option("mode", "PERMISSIVE").json(folder)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def path_fields(rows: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """Adds role and date range read from ``source_file``; dates as dates, absent parts null."""
    found = {name: F.nullif(F.regexp_extract("source_file", pattern, 1), F.lit(""))
             for name, pattern in (patterns or ROLE_AND_DATES).items()}
    return rows.withColumns({
        name: value.try_cast("date") if name.endswith("_date") else value for name, value in found.items()})
