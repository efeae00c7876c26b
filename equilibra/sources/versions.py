"""Versioned tables: data is staged in a folder of its own, the manifest is switched last.

A commit writes the data of one or several tables under ``data/<commit>`` and then appends its
entries to the manifest, all in one file, which Spark's commit protocol moves into place
as a whole. Readers ask the manifest only, so until that moment, or
if a write fails, they get the old result, and afterwards the new one of every table.
No file is ever changed or deleted. Older versions stay readable.

Modes of a write: ``all`` replaces the table; ``part`` replaces only the parts (values of one
column, such as a date) that the frame has, or that are named; ``add`` adds rows to them.

The driver holds the manifest: one row per commit, table and part (as many as a
partitioned table has folders), and no data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "version long, commit string, name string, mode string, part string, folder string, rows long, schema string"
MODES = ("all", "part", "add")
PART = "_part"


@dataclass(frozen=True)
class Write:
    """What a commit does to one table. ``by``: the column, or expression, whose values are the
    parts (few: each has a folder). ``parts``: with mode ``part``, values to replace even where
    the frame has no row of them."""

    name: str
    frame: DataFrame
    mode: str = "all"
    by: str | Column | None = None
    parts: tuple[str, ...] = ()


def part_name(value: Column) -> Column:
    """A value as the name of a folder: plain where letters, digits, ``_``, ``.`` and ``-`` will do."""
    text = value.cast("string")
    plain = F.concat(F.lit("v"), text)
    return F.when(text.isNull(), F.lit("n")).when(text.rlike(r"^[A-Za-z0-9_.-]+$"), plain).otherwise(F.concat(F.lit("h"), F.hex(text)))


class Store:
    """Versioned tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self) -> list[Row]:
        """The manifest. Of commits that took the same version, the one of least name counts."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        first: dict[int, str] = {}
        for r in rows:
            first[r["version"]] = min(r["commit"], first.get(r["version"], r["commit"]))
        return [r for r in rows if r["commit"] == first[r["version"]]]

    def version(self) -> int:
        """The latest version; 0 before the first commit."""
        return max((r["version"] for r in self._entries()), default=0)

    def names(self) -> list[str]:
        return sorted({r["name"] for r in self._entries()})

    def current(self, name: str, version: int | None = None) -> list[Row]:
        """The manifest entries that make up a table, now or as of a version."""
        mine = [r for r in self._entries() if r["name"] == name and (version is None or r["version"] <= version)]
        if not mine:
            raise ValueError(f"{name} was never published under {self.root}" + (f" up to version {version}" if version else ""))
        whole = max((r["version"] for r in mine if r["mode"] == "all"), default=0)
        since: dict[str | None, int] = {}
        for r in mine:
            if r["mode"] == "part":
                since[r["part"]] = max(r["version"], since.get(r["part"], 0))
        return [r for r in mine if r["version"] >= max(whole, since.get(r["part"], 0))]

    def commit(self, writes: Iterable[Write]) -> int:
        """Stage the data of all writes, then switch to it; returns the new version.

        Raises if another commit took the version meanwhile: its data counts, this one's doesn't.
        """
        commit, rows = uuid.uuid4().hex, []
        version = self.version() + 1
        for w in writes:
            if w.mode not in MODES or w.mode == "part" and w.by is None:
                raise ValueError(f"{w.name}: mode {w.mode!r} isn't one of {MODES}, or has no column of parts")
            folder, schema = f"data/{commit}/{w.name}", w.frame.schema.json()
            if w.by is not None:
                parted = w.frame.withColumn(PART, part_name(F.col(f"`{w.by}`") if isinstance(w.by, str) else w.by))
                # Few files for a small part, several for a large one: sizes are known at run time.
                parted.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
                held = self.spark.read.schema(T.StructType([*w.frame.schema.fields, T.StructField(PART, T.StringType())])).parquet(f"{self.root}/{folder}")
                counts = {r[PART]: r["count"] for r in held.groupBy(PART).count().collect()}
            else:
                w.frame.write.parquet(f"{self.root}/{folder}")
                counts = {None: self.spark.read.schema(w.frame.schema).parquet(f"{self.root}/{folder}").count()}
            gone = {part_name_of(v) for v in w.parts}.difference(counts)
            rows += [(version, commit, w.name, w.mode, part, folder, n, schema) for part, n in counts.items()]
            rows += [(version, commit, w.name, w.mode, part, folder, 0, schema) for part in gone]
            if not counts and not gone:  # no row: still a table, with this schema
                rows.append((version, commit, w.name, "all" if w.mode == "all" else "add", None, folder, 0, schema))
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")
        if not any(r["commit"] == commit for r in self._entries()):
            raise RuntimeError(f"version {version} of {self.root} was taken by another commit: commit again")
        return version

    def read(self, name: str, parts: Iterable[str | None] | None = None, version: int | None = None) -> DataFrame:
        """A table, or only some parts of it; the other parts' files aren't looked at."""
        return self.read_folders(name, None if parts is None else {part_name_of(v) for v in parts}, version)

    def read_folders(self, name: str, wanted: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The same, with parts named as in the manifest."""
        entries = self.current(name, version)
        schema = T.StructType.fromJson(json.loads(max(entries, key=lambda r: r["version"])["schema"]))
        wanted = None if wanted is None else set(wanted)
        paths = [f"{self.root}/{r['folder']}" + (f"/{PART}={r['part']}" if r["part"] else "") for r in entries if r["rows"] and (wanted is None or r["part"] in wanted)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def part_name_of(value: object) -> str:
    """``part_name`` of one value."""
    if value is None:
        return "n"
    text = str(value)
    plain = text and all(c.isascii() and (c.isalnum() or c in "_.-") for c in text)
    return f"v{text}" if plain else f"h{text.encode().hex().upper()}"
