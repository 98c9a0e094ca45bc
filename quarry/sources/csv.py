"""CSV-family scans.

* ``read_csv_inferred``  -- headered CSV, types inferred (one extra pass).
* ``read_csv_strict``    -- fixed schema, malformed lines dropped. Built on
  ``read.text`` + ``from_csv`` + a corrupt-record filter so the kept rows do
  not depend on which columns a query reads (``DROPMALFORMED`` on the CSV
  reader only validates the projected columns).
* ``read_csv_by_header`` -- pick columns by their header name, drop rows
  whose required field is empty, cast to the wanted types.
* ``read_points_csv``    -- headerless ``id,x,y`` files by glob.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COL = "_corrupt_record"

POINT_SCHEMA = "id string, x double, y double"


def read_csv_inferred(
    spark: SparkSession, path: str, header: bool = True
) -> DataFrame:
    """Headered CSV with inferred column types (samples the data once)."""
    return spark.read.csv(path, header=header, inferSchema=True)


def _as_struct(schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema)


def strict_csv_lines(
    lines: DataFrame,
    schema: StructType | str,
    value_col: str = "value",
    header_line: str | Column | None = None,
) -> DataFrame:
    """Parse text lines against ``schema`` keeping only well-formed records.

    A line is kept when every field parses to its type and the field count
    equals the schema width; blank lines are no records and are skipped, as
    the CSV reader does. Works on batch and streaming DataFrames alike.
    ``header_line`` (literal or Column) removes every line equal to it.
    """
    struct = _as_struct(schema)
    with_corrupt = StructType(
        list(struct.fields) + [StructField(CORRUPT_COL, StringType(), True)]
    )
    if header_line is not None:
        hdr = header_line if isinstance(header_line, Column) else F.lit(header_line)
        lines = lines.filter(F.col(value_col) != hdr)
    parsed = lines.filter(F.trim(value_col) != "").select(
        F.from_csv(
            F.col(value_col),
            with_corrupt.simpleString(),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL},
        ).alias("r")
    )
    return parsed.filter(F.col(f"r.{CORRUPT_COL}").isNull()).select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in struct.fields]
    )


def read_csv_strict(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    header: bool | str = True,
) -> DataFrame:
    """Fixed-schema CSV scan with malformed lines dropped, stable under any
    projection and under ``count()``. One record per line.

    ``header=True`` removes every line equal to the schema's field names
    joined by commas (what a writer of these columns puts first); a string
    gives the exact header text instead; ``False`` keeps all lines.
    """
    struct = _as_struct(schema)
    lines = spark.read.text(path)
    if header is True:
        header_line = ",".join(f.name for f in struct.fields)
    elif isinstance(header, str):
        header_line = header
    else:
        header_line = None
    return strict_csv_lines(lines, struct, header_line=header_line)


def read_csv_by_header(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    required: Sequence[str] = (),
    empty_as_blank: bool = True,
) -> DataFrame:
    """Typed, cleaned ingest of a headered CSV by column *name*.

    ``columns`` maps header names to Spark SQL types, in output order. Rows
    whose ``required`` fields are empty are dropped; the rest are cast (a
    value that does not parse raises under ANSI mode, as a strict ``int()``
    would). With ``empty_as_blank`` other empty string fields read as ``''``
    rather than null.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    for name in required:
        c = F.col(f"`{name}`")
        raw = raw.filter(c.isNotNull() & (c != ""))
    out = []
    for name, dtype in columns.items():
        c = F.col(f"`{name}`")
        if dtype.lower() in ("string", "varchar"):
            c = F.coalesce(c, F.lit("")) if empty_as_blank else c
        else:
            c = c.cast(dtype)
        out.append(c.alias(name))
    return raw.select(*out)


def read_points_csv(
    spark: SparkSession, path_glob: str, schema: str = POINT_SCHEMA
) -> DataFrame:
    """Headerless ``id,x,y`` files (any number, by glob) as ``id, x, y``."""
    return spark.read.csv(path_glob, schema=schema, header=False)
