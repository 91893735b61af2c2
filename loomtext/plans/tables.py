"""Readers of the given tables and the shape of results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", "text")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark texts as queries."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def widened(df: DataFrame) -> DataFrame:
    """Whole numbers as long, fractions as double."""
    wide = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        wide.append(c.alias(f.name))
    return df.select(*wide)


class Registry:
    """Queries of one area with their SQL twins."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[name] = lambda spark, sf_dir: widened(fn(spark, sf_dir))
            if sql:
                self.sql[name] = sql
            return fn

        return register
