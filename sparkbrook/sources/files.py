"""File sources. Paths with a scheme are left alone; plain local ones become absolute."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _resolved(path: str) -> str:
    return os.path.abspath(path) if "://" not in path and os.path.exists(path) else path


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """All columns are strings unless a schema is given; no inference pass over the data."""
    reader = spark.read.option("header", str(header).lower())
    return (reader.schema(schema) if schema else reader).csv(_resolved(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """JSON files below ``path`` at any depth; the schema is inferred unless given."""
    reader = spark.read.option("recursiveFileLookup", "true").option("multiLine", str(multi_line).lower())
    return (reader.schema(schema) if schema else reader).json(_resolved(path))


def stream_json(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None, multi_line: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """A stream of JSON files. The schema is mandatory; the rate limit is a source option.

    corrupt_column: adds a string column with the text of lines that cannot be parsed.
    """
    if corrupt_column and corrupt_column not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("multiLine", str(multi_line).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(_resolved(path))
