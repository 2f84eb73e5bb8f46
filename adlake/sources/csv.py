"""Strict CSV sources (S1 Bronze strings, S2 typed impressions), read by description.

A :class:`CsvSource` says what a file must look like; one reader and one writer serve all.
The header is read through Spark, so any file system and a directory of part files work;
``enforceSchema=False`` has every file's header checked again during the scan.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adlake.model import SOURCES, TYPED_IMPRESSIONS, bronze_schema


class HeaderMismatch(ValueError):
    """A CSV file's header isn't the one its description asks for."""


@dataclass(frozen=True)
class CsvSource:
    """Expected columns and types; whether names in the header may carry blanks; the file name
    recorded with each row, if any; and the format's options."""

    schema: T.StructType
    padded_header: bool = False
    provenance: bool = False
    options: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        found = spark.read.options(header=True, inferSchema=False).csv(path).columns
        wanted = self.schema.fieldNames()
        if [c.strip() if self.padded_header else c for c in found] != wanted:
            raise HeaderMismatch(f"{path}: columns {found}, wanted {wanted}")
        as_found = T.StructType([T.StructField(c, f.dataType) for c, f in zip(found, self.schema)])
        strict = {"header": True, "enforceSchema": False, "mode": "FAILFAST", **self.options}
        rows = spark.read.schema(as_found).options(**strict).csv(path)
        origin = [_origin().alias("source_file")] if self.provenance else []
        return rows.select(*[F.col(f"`{c}`").alias(w) for c, w in zip(found, wanted)], *origin)

    def write(self, df: DataFrame, path: str) -> str:
        (df.select(*self.schema.fieldNames()).write.mode("errorifexists")
         .options(header=True, **self.options).csv(path))
        return path


def _origin() -> Column:
    """The name of the file that a row was read from, by Spark's file metadata; a folder of part files
    that Spark wrote stands for one file."""
    path = F.col("_metadata.file_path")
    own, folder = F.regexp_extract(path, "[^/]+$", 0), F.regexp_extract(path, "([^/]+)/[^/]+$", 1)
    encoded = F.when(own.startswith("part-"), folder).otherwise(own)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))  # paths are percent-encoded, plus signs aren't


def raw_source(name: str) -> CsvSource:
    """Raw strings with each row's file; the published headers have trailing blanks."""
    return CsvSource(bronze_schema(name), padded_header=True, provenance=True)


#: Impressions with types, the NULL token and doubled quotes.
TYPED_SOURCE = CsvSource(TYPED_IMPRESSIONS, options={"nullValue": "NULL", "escape": '"'})


def _raw_path(source_dir: str, name: str) -> str:
    return f"{source_dir.rstrip('/')}/{SOURCES[name][0]}"


def read_source_csv(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    return raw_source(name).read(spark, _raw_path(source_dir, name))


def write_source_csv(df: DataFrame, source_dir: str, name: str) -> str:
    """Write a Bronze frame as the raw CSV source ``name`` (a directory of part files)."""
    return raw_source(name).write(df, _raw_path(source_dir, name))


def read_impressions_csv(spark: SparkSession, path: str) -> DataFrame:
    return TYPED_SOURCE.read(spark, path)


def write_typed_csv(df: DataFrame, path: str) -> str:
    return TYPED_SOURCE.write(df, path)
