"""Reading tables from CSV with a declared schema."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegralType,
    StringType,
    StructField,
    StructType,
)

from ..operators.quality import require_rows

# The columns of the track file, in file order. The first one is
# the row number written by the tool that made the file.
INDEX_COLUMN = "_empty"
TRACK_SCHEMA = """
    _empty INT,
    track_id STRING,
    artists STRING,
    album_name STRING,
    track_name STRING,
    popularity INT,
    duration_ms INT,
    explicit BOOLEAN,
    danceability FLOAT,
    energy FLOAT,
    key INT,
    loudness FLOAT,
    mode INT,
    speechiness FLOAT,
    acousticness FLOAT,
    instrumentalness FLOAT,
    liveness FLOAT,
    valence FLOAT,
    tempo FLOAT,
    time_signature INT,
    track_genre STRING
"""

# Columns that must be filled, and columns that must lie in 0..1.
TRACK_REQUIRED = (
    "track_id",
    "artists",
    "track_name",
    "track_genre",
    "popularity",
    "duration_ms",
    "danceability",
    "energy",
    "valence",
    "acousticness",
    "instrumentalness",
)
TRACK_UNIT_FEATURES = ("danceability", "energy", "acousticness", "instrumentalness", "valence")
TRACK_PROBE_KEYS = ("track_id", "artists", "track_genre")


CORRUPT = "_corrupt_record"


class ParsedCsv(NamedTuple):
    """A CSV table as declared, and what does not fit."""

    rows: DataFrame
    rejected: DataFrame  # record, reason


def _typed(name: str, kind: DataType) -> Column:
    """The text of a column as its type; null where it does not fit."""
    text = _named(name)
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, BooleanType):
        truth = F.lower(text)
        return F.when(truth == "true", True).when(truth == "false", False)
    if isinstance(kind, IntegralType):
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast(kind))
    return text.try_cast(kind)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def parse_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    rfc4180: bool = True,
    multi_line: bool = False,
    header: bool = True,
) -> ParsedCsv:
    """CSV with a declared schema (or its DDL), split into rows that fit it and the others.

    A row is rejected as a whole when it has too few or too many fields, or when a
    field is not a value of its column's type: whole numbers are digits with a
    sign at most, booleans ``true`` or ``false`` in any case, other types what
    ``try_cast`` takes. All fields are read as text and judged, so which rows
    there are does not depend on the columns a query reads. Empty fields are
    null and fit every type; an empty file has neither rows nor rejected ones.

    ``rejected`` has the text of the record and, as reason, ``fields`` for their
    number or the names of the columns that do not fit, joined by commas. A record
    with the right number of fields is written out again for that, so its quotes
    may differ. With ``rfc4180`` a doubled quote inside a quoted field is one
    quote; otherwise the escape is a backslash, as in Spark's default.
    ``multi_line`` allows line breaks inside quotes, at the price of reading each
    file in one task.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if CORRUPT in schema.names:
        raise ValueError(f"a column must not be called {CORRUPT}")
    texts = StructType([StructField(n, StringType()) for n in [*schema.names, CORRUPT]])
    raw = (
        spark.read.schema(texts)
        .option("header", header)
        .option("sep", ",")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"' if rfc4180 else "\\")
        .option("multiLine", multi_line)
        .option("columnPruning", False)
        .csv(path)
    )
    typed = {f.name: _typed(f.name, f.dataType) for f in schema}
    wrong = F.array_compact(
        F.array(
            *[
                F.when(_named(f.name).isNotNull() & typed[f.name].isNull(), F.lit(f.name))
                for f in schema
            ]
        )
    )
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("fields")).when(
        F.size(wrong) > 0, F.array_join(wrong, ",")
    )
    judged = raw.withColumn("_reason", reason)
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    again = F.to_csv(F.struct(*[_named(n) for n in schema.names]), {"escape": '"', **blanks})
    rows = judged.where("_reason IS NULL").select(*[typed[n].alias(n) for n in schema.names])
    rejected = judged.where("_reason IS NOT NULL").select(
        F.coalesce(F.col(CORRUPT), again).alias("record"), F.col("_reason").alias("reason")
    )
    return ParsedCsv(rows, rejected)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    rfc4180: bool = True,
    multi_line: bool = False,
    header: bool = True,
) -> DataFrame:
    """The rows of :func:`parse_csv`; malformed ones are dropped, whatever is read of them."""
    options = dict(rfc4180=rfc4180, multi_line=multi_line, header=header)
    return parse_csv(spark, path, schema, **options).rows


def read_tracks(spark: SparkSession, path: str, *, rfc4180: bool = True) -> DataFrame:
    """The track table without its row-number column; raises when it is empty."""
    tracks = read_csv(spark, path, TRACK_SCHEMA, rfc4180=rfc4180).drop(INDEX_COLUMN)
    return require_rows(tracks, f"no tracks in {path}")
