"""Typed reads and plain writes of raw files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.records import csv_records

# An unquoted empty field is NULL, a quoted one the empty string; blanks around a
# value belong to it, and a row that does not fit the schema stops the load
# instead of turning into NULLs.
_CSV = {
    "header": "false",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}


def load_raw(
    spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Read headerless CSV files with a fixed column order and fixed types.

    Large files are split between tasks. Texts may hold line breaks only with ``multi_line``; the records are
    then cut by :func:`csv_records`, which reads the files twice and shuffles their lines once.
    """
    # Spark would take a quoted empty field for NULL; a mark that no file can hold, since it is drawn
    # anew for every read, keeps the two apart.
    mark = f"\u0001{uuid.uuid4().hex}"
    options = {**_CSV, "emptyValue": mark, "mode": "FAILFAST"}
    if multi_line:
        row = F.from_csv("record", schema, {**options, "multiLine": "true"})
        df = csv_records(spark, path).select(row.alias("row")).select("row.*")
    else:
        df = spark.read.schema(schema).options(**options).csv(path)
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string" and (not columns or f.name in columns)]
    df = df.withColumns({name: F.when(F.col(name) == mark, "").otherwise(F.col(name)) for name in texts})
    return df.select(*columns) if columns else df


def write_raw(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """Write CSV files that :func:`load_raw` reads back unchanged.

    Texts with line breaks are refused unless ``multi_line`` is set here and when reading.
    """
    if not multi_line:
        refused = F.raise_error(F.lit("a text holds a line break: write and read with multi_line")).cast("string")
        texts = [f.name for f in df.schema if f.dataType.typeName() == "string"]
        df = df.withColumns({n: F.when(F.col(n).rlike("[\r\n]"), refused).otherwise(F.col(n)) for n in texts})
    (
        df.write.options(**_CSV, emptyValue='""')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .mode("errorifexists")
        .csv(path)
    )


def read_table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """One parquet table of a folder of tables; a known schema needs no footer read."""
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parquet")
