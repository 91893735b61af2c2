"""Building blocks that keep the other operators balanced on large and skewed tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# A side is broadcast only if it was counted and measured within both limits.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot if it holds more than 1/HOT_KEYS of all rows, so there are fewer than HOT_KEYS
# hot keys whatever the data, and each hot key is cut into parts of at most 1/HOT_KEYS of the rows.
HOT_KEYS = 10_000

# Hash-ordered numbering cuts rows into 16**RANK_DIGITS even pieces per group at least, and into
# more where those would exceed PIECE_ROWS.
RANK_DIGITS, PIECE_ROWS = 3, 1_000_000

# Rows that one task of a shuffle sorts, where their number is known and Spark's own number of
# partitions would give it more.
TASK_ROWS = 1_000_000
_SHARES = 1 << 30  # places of a hash within a bucket

# Shuffle files of a write are deleted at its end; else they stay until the driver's garbage goes.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A local session without that setting gets a
    new temporary folder; a cluster without it is refused, as executors could not share one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="loomtext-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; inside ``scratch_tables`` it is deleted at the end."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever file system its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``written`` stores inside the block once it ends, failed or not.

    For work whose result is stored before the block ends, such as a batch of a stream: a frame
    that is still lazy then would miss its tables. Blocks may be nested; each owns its own.
    """
    owned: list[str] = []
    token = _owned.set(owned)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in owned:
            remove_path(spark, path)


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives later joins true file sizes and cheap
    counts from the file footers.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every write of this session inside the block once it is done.

    A stored table needs them no more. Without this a query of many steps holds the shuffles of
    all its steps on disk at once, as they go only with the garbage of the driver.
    """
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def written_in_parts(
    parts: Iterable[DataFrame], name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write frames of one schema to one table, one after the other, and read it back.

    A part is made, shuffled and written before the next is asked for, and its shuffle files are
    deleted then, so the disk holds the table and the shuffles of one part. At least one part.
    """
    path = schema = None
    for part in parts:
        spark = part.sparkSession
        path, schema = path or scratch_path(spark, name), part.schema
        with freed_shuffles(spark):
            writer = part.write.mode("append").option("compression", "zstd")
            writer.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table that is read by fewer tasks than there are cores, by its row key.

    Such a table is small: a larger one is cut into more tasks than that by its bytes. For tables
    just read, whose tasks are known without running anything; operators do not call it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if 0 < df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal by key in partitions of about ``TASK_ROWS`` rows, unless Spark's setting gives smaller ones.

    For rows that are sorted or grouped by these keys next, so that a task's memory stays the same
    as the table grows.
    """
    parts = math.ceil(rows / TASK_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > usual else df


def dealt_in_line(df: DataFrame, bucket: str, sizes: list[int], *keys: str) -> DataFrame:
    """Deal by bucket, a number below ``len(sizes)``, in partitions of about ``TASK_ROWS`` rows.

    ``sizes`` are the rows of each bucket. Rows stand in line by bucket and within it by a hash of
    ``keys``, and the line is cut into even parts: small neighbours share a task, a large bucket
    is divided. Few rows are cut finer, up to Spark's number of partitions.
    """
    total = sum(sizes)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = min(TASK_ROWS, max(1, TASK_ROWS // 16, math.ceil(total / usual)))
    first = F.lit(list(accumulate(sizes, initial=0)))[F.col(bucket)]
    share = F.pmod(F.xxhash64(*keys), F.lit(_SHARES)) / _SHARES
    place = first + F.floor(share * F.lit(list(sizes))[F.col(bucket)])
    return df.repartitionById(max(1, math.ceil(total / rows)), F.floor(place / rows).cast("int"))


def _row_bytes(schema: T.StructType) -> Column:
    width = F.lit(8 * len(schema.fields)).cast("long")
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            if isinstance(field.dataType.elementType, T.StringType):
                text = F.array_join(c, "", "")
                width = width + F.coalesce(F.octet_length(text) + 8 * F.size(c), F.lit(0))
            else:
                width = width + 8 * F.greatest(F.size(c), F.lit(0))
    return width


def within_bound(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Count and measure a stored table against both limits (one aggregate, no rows collected)."""
    n, size = table_size(df)
    return n <= max_rows and size <= max_bytes


def table_size(df: DataFrame) -> tuple[int, int]:
    """Rows and about the bytes of a table."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df.schema))).first()
    return n, size or 0


def _hot_keys(weights: DataFrame, key: str, n_rows: str) -> DataFrame:
    total = weights.agg((F.sum(n_rows) / HOT_KEYS).alias("t")).scalar()
    parts = F.ceil(F.col(n_rows) / total).cast("int")
    return weights.filter(F.col(n_rows) > total).select(key, parts.alias("_parts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    row_id: str,
    weights: DataFrame | None = None,
    n_rows: str = "n_rows",
    rows: int = 0,
) -> DataFrame:
    """Inner join for two sides that are both too large to broadcast.

    Rows of ``big`` with a hot key are cut into parts by a hash of ``row_id``; rows of ``small``
    with that key are repeated once per part. ``weights`` gives the rows of ``big`` per key if
    that is already known; else it is counted. ``rows`` of ``big``, if known, bound what a task sorts.
    """
    if weights is None:
        weights = big.groupBy(key).agg(F.count(F.lit(1)).alias(n_rows))
    hot = F.broadcast(_hot_keys(weights.select(key, n_rows), key, n_rows))
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(row_id)), F.col("_parts")).cast("int")
    )
    left = big.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    right = (
        small.join(hot, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
        .drop("_parts")
    )
    left, right = (dealt(side, rows, key, "_part") for side in (left, right))
    return left.join(right, [key, "_part"]).drop("_part")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    row_id: str,
    weights: DataFrame | None = None,
    n_rows: str = "n_rows",
    small_is_bounded: bool | None = None,
    rows: int = 0,
) -> DataFrame:
    """Inner join: broadcast ``small`` if it was measured to be small, else salt hot keys."""
    if small_is_bounded is None:
        small_is_bounded = within_bound(small)
    if small_is_bounded:
        return big.join(F.broadcast(small), key)
    return salted_join(big, small, key, row_id, weights, n_rows, rows)


def hash_key(seed: int | str, c: Column | str) -> Column:
    """Reproducible shuffle key: the md5 of seed and id, the same in any SQL engine."""
    value = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")))


def hash_rank(
    df: DataFrame,
    key: str,
    tie: str,
    rank: str,
    group: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Exact 1-based position by (md5 key, tie), overall or within each group.

    A plain row_number would put a whole table, or a hot group, into one task. Here rows are cut
    into even pieces of bounded size by the leading hex digits of the key; rows are numbered inside
    a piece and shifted by the sizes of the pieces before it. ``total`` adds the size of the group.
    """
    by = [group] if group else []
    digits, rows = RANK_DIGITS, df.count()
    while 16**digits * PIECE_ROWS < rows:
        digits += 1
    pieces = df.withColumn("_piece", F.substring(F.col(key), 1, digits))
    inside = Window.partitionBy(*by, "_piece").orderBy(key, tie)
    numbered = pieces.withColumn("_inside", F.row_number().over(inside))
    sizes = pieces.groupBy(*by, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    # At most 16**digits rows per group here.
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_n").over(Window.partitionBy(*by)).alias(total)] if total else []
    shifts = sizes.select(
        *by, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"), *extra
    )
    joined = numbered.join(shifts, [*by, "_piece"])
    return joined.withColumn(rank, F.col("_shift") + F.col("_inside")).drop(
        "_piece", "_inside", "_shift"
    )


_OFFSET_BITS = 33  # monotonically_increasing_id: task number above, row of the task below


def ordered_number(df: DataFrame, key: str, number: str) -> DataFrame:
    """Exact 1-based position by a unique key, without one task seeing the whole table.

    The table is sorted in ranges and written with each row's task and place in it, which fixes
    the ranges; a row's number is its place plus the rows of the ranges before.
    """
    placed = df.orderBy(key).withColumn("_place", F.monotonically_increasing_id())
    stored = written(placed, "numbered").withColumn(
        "_range", F.shiftright("_place", _OFFSET_BITS)
    )
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per task of the sort from here on.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1))
    return (
        stored.join(F.broadcast(shifts), "_range")
        .withColumn(number, F.col("_shift") + inside + 1)
        .drop("_range", "_place", "_shift")
    )


def top_k(
    df: DataFrame, by: str | list[str], score: str, tie: str, k: int, rank: str = "rank"
) -> DataFrame:
    """The k best rows per group by score, ties by the smaller id.

    Spark cuts each task's rows to k per group before the shuffle, so a hot group stays small.
    Scores are compared after rounding to 9 places, as sums may arrive in any order.
    """
    keys = [by] if isinstance(by, str) else by
    order = Window.partitionBy(*keys).orderBy(F.round(F.col(score), 9).desc(), F.col(tie))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)
