"""Input tables with declared schemas; reading never infers, counts or triggers a job."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.schemas import TABLES

CORRUPT = "_corrupt_record"
# stands for NULL in no file: an unquoted empty cell is NULL, a quoted one an empty string
_NEVER = "\u0000"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, on_bad_rows: str = "fail") -> DataFrame:
    """CSV with a header, which has to match the schema.

    on_bad_rows: "fail" ends the query at the first row that does not parse. "keep" reads what does parse of it, NULL
    for the rest, and gives the row's text in an added column ``_corrupt_record``, NULL for whole rows.
    Timestamps may have fractions of seconds. Cells have no line breaks, so that files can be split.
    """
    if on_bad_rows not in ("fail", "keep"):
        raise ValueError(f"unknown treatment of bad rows: {on_bad_rows}")
    reader = spark.read.option("header", True).option("enforceSchema", False).option("nullValue", _NEVER).option("escape", '"')
    if on_bad_rows == "fail":
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_table(spark: SparkSession, table: str, path: str, fmt: str = "csv", on_bad_rows: str = "fail") -> DataFrame:
    """A table of ``wattledger.schemas.TABLES`` from CSV (see ``read_csv``) or from Parquet."""
    if fmt == "parquet":
        return spark.read.schema(TABLES[table]).parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported format: {fmt}")
    return read_csv(spark, path, TABLES[table], on_bad_rows)


def split_rows(spark: SparkSession, table: str, path: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(whole rows, damaged rows) of a CSV table, both written to ``folder`` by one scan of the files.

    Whole rows have the table's columns. Damaged ones are told by file, block, position and text: ``block`` is where the file's
    block that holds the row begins, in bytes, and ``line`` counts the rows of the table from there, header left out. Blocks are
    as a session cuts files, so a place is exact for the session that wrote it; ``row_text`` finds the row in any other.
    """
    read = read_table(spark, table, path, on_bad_rows="keep")
    columns = [c for c in read.columns if c != CORRUPT]
    # an id counts the rows of a task from its number on, in the order of the file
    place = F.struct(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("line")
    )
    marked = read.withColumn("place", place).withColumn("damaged", F.col(CORRUPT).isNotNull())
    marked.write.mode("errorifexists").partitionBy("damaged").parquet(f"{folder}/rows")
    stored = spark.read.schema(marked.schema).parquet(f"{folder}/rows")
    # a task may read several blocks: each counts from its first row; as many rows as there are blocks
    first = F.broadcast(stored.groupBy("place.file", "place.block").agg(F.min("place.line").alias("first")))
    bad = stored.where("damaged").select("place.file", "place.block", "place.line", F.col(CORRUPT).alias("row_text"))
    bad = bad.join(first, ["file", "block"]).select("file", "block", (F.col("line") - F.col("first")).alias("line"), "row_text")
    return stored.where("NOT damaged").select(columns), bad


def read_meter_readings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, "meter_readings", path, fmt)


def read_plant_output(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, "plant_output", path, fmt)


def read_weather(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, "weather", path, fmt)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows, as one distributed count each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def malformed_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table read with ``on_bad_rows="keep"``: its name, number of rows and number of damaged rows.

    Spark parses only the columns that a query uses, so every column takes part in the count: a row counts 1 more than its
    hash modulo 1, which is 0.
    """
    counts = []
    for name, df in tables.items():
        every = F.pmod(F.xxhash64(*[c for c in df.columns if c != CORRUPT]), F.lit(1)) + 1
        found = df.agg(F.coalesce(F.sum(every), F.lit(0)).alias("row_count"), F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed_rows"))
        counts.append(found.select(F.lit(name).alias("table_name"), "row_count", "malformed_rows"))
    return reduce(DataFrame.unionByName, counts)
