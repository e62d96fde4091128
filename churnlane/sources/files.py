"""File sources: CSV as the reference reads it, JSON request bodies (SRC-1, SRC-3, FN-6).

``multiLine`` CSV cannot be split inside a file (a quoted newline may sit
anywhere), so every *file* is one task: keep inputs as many moderately sized
files.  ``inferSchema`` costs a full extra pass; pass ``schema=`` in production.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"'}


def scan_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """Rows of CSV files with a header line, quoted line breaks and doubled quotes; types are inferred unless ``schema`` is given."""
    r = spark.read.options(**CSV_OPTIONS)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write with header and RFC-4180 quoting; whitespace-only text is kept as is."""
    out = df.repartition(files) if files else df
    (out.write.mode("overwrite")
        .option("header", "true").option("escape", '"').option("quoteAll", "false")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(path))


def records_to_rows(df: DataFrame, body_col: str, record_schema: StructType) -> DataFrame:
    """A column of JSON arrays of records -> one row per record (missing field -> NULL)."""
    arr = F.from_json(F.col(body_col), ArrayType(record_schema))
    return df.select(F.explode(arr).alias("_r")).select("_r.*")
