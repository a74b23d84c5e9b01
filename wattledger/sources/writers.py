"""Result sinks. Both overwrite the target directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cell(field: T.StructField) -> Column:
    """What CSV can hold without loss: timestamps with the fractions they have, texts without line breaks."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("string").alias(field.name)
    if isinstance(field.dataType, T.StringType):
        broken = F.raise_error(F.lit(f"line break in CSV column {field.name}")).cast("string")
        return F.when(column.rlike("[\\r\\n]"), broken).otherwise(column).alias(field.name)
    return column


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write CSV with a header, one part per partition; empty texts are quoted, NULL is an empty cell.

    A text with a line break fails the write: files of such texts could not be split, and other readers would see two
    rows. ``single_file`` brings the result into one task: only for small aggregates, never for per-meter results.
    """
    cells = df.select(*[_cell(f) for f in df.schema.fields])
    parts = cells.coalesce(1) if single_file else cells
    parts.write.mode("overwrite").option("header", True).option("escape", '"').options(
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
