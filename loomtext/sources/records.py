"""Record tables: reading, literals, writing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stands for null in CSV, so that empty texts stay empty. A text that is just this, or this behind
# more backslashes, is written with one more and read with one less.
CSV_NULL = "\\N"
_MARK_LIKE, _ESCAPED_MARK = r"^\\+N\z", r"^\\{2,}N\z"


def _strings(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Changes every column of strings."""
    columns = [(F.col(f"`{f.name.replace('`', '``')}`"), f) for f in df.schema.fields]
    return df.select(*(change(c).alias(f.name) if isinstance(f.dataType, T.StringType) else c for c, f in columns))


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: Sequence[str],
    fmt: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Typed rows of a CSV with header (quoted fields may hold commas), JSON lines,
    ORC or parquet; rows with a null required column are dropped. In CSV an empty field is null and
    a quoted empty one an empty text; ``\\N`` is null and ``\\\\N`` the text ``\\N``. With ``multi_line`` quoted fields may hold line breaks,
    but a CSV file is read by one task; without it, large files are split."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = (
            reader.option("header", True)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .option("nullValue", CSV_NULL)
            .option("emptyValue", "")
        )
    rows = reader.format(fmt).load(path)
    if fmt == "csv":
        rows = _strings(rows, lambda c: F.when(c.rlike(_ESCAPED_MARK), c.substr(F.lit(2), F.length(c))).otherwise(c))
    return rows.na.drop(subset=list(required))


def inline_records(
    spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType
) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def read_or_inline(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: Sequence[str],
    rows: Iterable[Sequence],
    fmt: str = "csv",
) -> DataFrame:
    """Read the file, or fall back to literal rows if it does not exist."""
    try:
        return read_records(spark, path, schema, required, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return inline_records(spark, rows, schema).na.drop(subset=list(required))


def write_records(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "csv", mode: str = "error"
) -> None:
    """Write the columns in this order; CSV gets a header and quotes that read back exactly."""
    rows = df.select(*columns)
    if fmt == "csv":
        rows = _strings(rows, lambda c: F.when(c.rlike(_MARK_LIKE), F.concat(F.lit("\\"), c)).otherwise(c))
    writer = rows.write.mode(mode)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("quoteAll", True)
            .option("nullValue", CSV_NULL)
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(fmt).save(path)
