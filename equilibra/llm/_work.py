"""What several operators share: tables of a run, routing, files in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equilibra.session import shared_dir

#: ASCII white space, for both Spark's and Python's patterns (fixed values).
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder of one run, in the folder that all machines share."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of ``df`` has, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, path: str, name: str) -> DataFrame:
    """Write a table whose rows have a dense number ``name`` (long, from 0) in the order of
    its partitions. No row moves: a row's number is its place in its partition plus the rows
    of earlier partitions, of which one count each is summed and broadcast."""
    table = saved(df.withColumn(name, F.monotonically_increasing_id()), path)
    part = F.shiftright(name, 33)
    counts = table.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0).cast("long")).alias("__before"))
    place = F.col(name).bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__before")
    return table.join(F.broadcast(before), part == F.col("__part")).withColumn(name, place).drop("__part", "__before")


def bits_for(members: int, least: int = 22, most: int = 26) -> int:
    """Bits that number the bits of a table of ``members``: about 16 bits a member, at most
    2**26 bits (a million rows, some 40 MB broadcast); with more members more others pass."""
    return max(least, min(most, (16 * members).bit_length()))


def bit_words(hashes: DataFrame, bits: int = 22) -> DataFrame:
    """Set of 64-bit hashes (column ``h``) as at most 2**(bits-6) rows of 64 bits.

    A row of a hash sets the bit that the hash's ``bits`` upper bits number. The
    table has a greatest size whatever the input (22 bits: 65,536 rows, about
    2 MB), so it may be broadcast. It never misses a member; the more
    members, the more others pass, and the exact join behind it does the rest.
    """
    top = F.shiftrightunsigned("h", 64 - bits)
    return (
        hashes.select((top / 64).cast("long").alias("__word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) % 64 as int))").alias("b"))
        .groupBy("__word")
        .agg(F.bit_or("b").alias("__bits"))
    )


def in_words(df: DataFrame, h: Column, words: DataFrame, bits: int = 22) -> DataFrame:
    """Adds ``__hit``: whether the hash may be a member (no shuffle of ``df``)."""
    top = F.shiftrightunsigned(h, 64 - bits)
    return (
        df.withColumn("__top", top)
        .withColumn("__word", (F.col("__top") / 64).cast("long"))
        .join(F.broadcast(words), "__word", "left")
        .withColumn("__hit", F.coalesce(F.expr("getbit(__bits, cast(__top % 64 as int))") == 1, F.lit(False)))
        .drop("__top", "__word", "__bits")
    )


#: Spark's names of stores, and pyarrow's (fixed values).
SCHEMES = {"s3a://": "s3://", "s3n://": "s3://", "dbfs:/": "/dbfs/"}


def files_of(uri: str):
    """(file system, path in it) of a shared folder, for files that aren't tables.

    Folders on each machine (``file:``, a mounted ``dbfs:``), in S3 and in Google's store are reached
    as they are; ``hdfs:`` and ``viewfs:`` need Hadoop's native library on the workers. Others raise.
    """
    import re

    from pyarrow import fs

    for own, other in SCHEMES.items():
        if uri.startswith(own):
            uri = other + uri[len(own) :].lstrip("/")
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def packed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` whole in a struct ``row``: helper columns beside it clash with none of
    its names. ``select("row.*")`` unpacks them."""
    return df.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row"))


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that at its end hands freed memory back to the system: Python
    workers live on from stage to stage, and what one keeps the next must do without."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            import ctypes
            import gc

            import pyarrow

            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return run


def partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def cells(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)
