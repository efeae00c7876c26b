"""Result sink: each product is written as a table under one root folder.

The reference meant to post each result to a dashboard endpoint; here a
result is published by writing it with any Spark writer (Parquet by default)
so a dashboard, a catalog or the next job can read it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from equilibra.session import shared_dir
from equilibra.sources.versions import Store, Write


def _root(spark: SparkSession, root: str | None) -> str:
    return (root or f"{shared_dir(spark)}/published").rstrip("/")


def publish(
    df: DataFrame,
    name: str,
    *,
    root: str | None = None,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> str:
    """Write ``df`` to ``<root>/<name>`` and return that path.

    ``root`` defaults to ``<spark.checkpoint.dir>/published``: shared storage
    on a cluster, never a machine-local folder. The write is a normal Spark
    job: tasks lost with an executor are rerun and the commit protocol keeps
    the folder whole.
    """
    path = f"{_root(df.sparkSession, root)}/{name}"
    writer = df.write.mode(mode).format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def publish_all(
    products: Mapping[str, DataFrame],
    *,
    root: str | None = None,
    format: str = "parquet",
    mode: str = "overwrite",
) -> dict[str, str]:
    """Publish several products; returns name -> path."""
    return {name: publish(df, name, root=root, format=format, mode=mode) for name, df in products.items()}


def read_published(spark: SparkSession, name: str, *, root: str | None = None, format: str = "parquet") -> DataFrame:
    return spark.read.format(format).load(f"{_root(spark, root)}/{name}")


def publish_version(
    df: DataFrame,
    name: str,
    *,
    root: str | None = None,
    by: str | Column | None = None,
    parts: tuple[str, ...] | None = None,
) -> int:
    """Publish a new version of a table and return its number.

    The old version is read until the new one is whole, and stays if the write fails
    (``equilibra.sources.versions``); ``publish`` with ``overwrite`` deletes before it writes.
    With ``by`` (such as ``Date``, or its month) only the parts that ``df`` has rows of, or
    that ``parts`` names, are replaced, once the table exists; without, all of it.
    """
    store = Store(df.sparkSession, _root(df.sparkSession, root))
    new = name not in store.names()
    mode = "all" if by is None or new else "part"
    return store.commit([Write(name, df, mode, by, parts or ())])


def read_version(spark: SparkSession, name: str, *, root: str | None = None, version: int | None = None) -> DataFrame:
    """A table as last published by ``publish_version``, or as of a version."""
    return Store(spark, _root(spark, root)).read(name, version=version)
