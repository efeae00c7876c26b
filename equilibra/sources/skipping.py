"""Data skipping: which files of a bundle table can hold what a product reads.

The codes of a bundle lie below three arrays, where file formats keep no statistics that a
filter could use: a scan for one symptom reads every file. The index has a row per file with
its component and session codes and the bounds of its patients and dates, built by
one Spark pass over the codes (no sample text is read). ``matching_files`` asks it, ``load_bundle(...,
index=...)`` reads only those files, with the narrowed schema on top.

Skipping is right only while the index knows every file: before each use its files, their sizes
and their times are compared with what lies under the source (a listing, no data), and any
difference raises ``StaleIndex``. ``refresh_index`` indexes only files that are new or changed.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import patient_id, session_date

#: What the index reads of a bundle (fixed values).
INDEX_FIELDS = (
    "entry.resource.subject.reference",
    "entry.resource.effectiveDateTime",
    "entry.resource.code.coding.code",
    "entry.resource.component.code.coding.code",
)
FILE = ("file", "size", "changed")
#: Files that Spark's readers take for data.
HIDDEN = r"(^|/)[_.][^/]*$"


class StaleIndex(ValueError):
    """The index doesn't describe the files as they are."""


def list_files(spark: SparkSession, source: str) -> DataFrame:
    """(file, size, changed) of the data files under a folder; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    listed = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("changed"))
    return listed.filter(~F.col("file").rlike(HIDDEN) & (F.col("size") > 0))


def index_rows(bundles: DataFrame) -> DataFrame:
    """The index of a frame that was read from files: a row per file.

    Files without an observation have empty code lists and no bounds. Observations without a
    date lie in no range of dates, so they don't count in a file's bounds.
    """
    resource = F.col("entry.resource")
    metadata = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("changed")]
    each = bundles.select(*metadata, F.explode_outer("entry").alias("entry"))
    # Distinct codes per observation first, so that groups meet few short arrays.
    blank = F.array().cast("array<string>")
    held = F.flatten(F.filter(resource["component"]["code"]["coding"], lambda c: c.isNotNull()))["code"]
    seen = each.select(
        *FILE,
        F.coalesce(F.array_distinct(resource["code"]["coding"]["code"]), blank).alias("sessions"),
        F.coalesce(F.array_distinct(held), blank).alias("components"),
        patient_id(resource["subject"]["reference"]).alias("patient"),
        session_date(resource["effectiveDateTime"]).alias("date"),
        F.col("entry").isNotNull().alias("any"),
    )
    # A row per (file, code lists) leaves a task at most; lists of one kind of session are alike.
    some = seen.groupBy(*FILE, "sessions", "components").agg(
        F.count_if("any").alias("observations"),
        F.min("patient").alias("patient_min"),
        F.max("patient").alias("patient_max"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
    )
    codes = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    bounds = [f(c).alias(c) for f, c in ((F.min, "patient_min"), (F.max, "patient_max"), (F.min, "date_min"), (F.max, "date_max"))]
    return some.groupBy(*FILE).agg(F.sum("observations").alias("observations"), codes("sessions"), codes("components"), *bounds)


def _read(spark: SparkSession, source: str | list[str], format: str, base: str) -> DataFrame:
    from equilibra.sources.bundles import BUNDLE_SCHEMA, prune_schema

    paths = [source] if isinstance(source, str) else source
    full = spark.read.format(format).option("basePath", base).load(paths).schema if format != "json" else BUNDLE_SCHEMA
    return spark.read.format(format).schema(prune_schema(full, INDEX_FIELDS)).load(paths)


def _indexed(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Index rows of the listed ``files``; one without a row gives none in a scan, but belongs to the index."""
    blank = F.array().cast("array<string>")
    other = {c: F.lit(None).cast(t) for c, t in rows.dtypes if c not in FILE} | {"sessions": blank, "components": blank, "observations": F.lit(0).cast("long")}
    empty = files.join(rows.select("file"), "file", "left_anti")
    return rows.unionByName(empty.select(*FILE, *[v.alias(c) for c, v in other.items()]))


def build_index(spark: SparkSession, source: str, index: str, *, format: str = "parquet") -> str:
    """Index all files under ``source`` and write the index to the folder ``index``."""
    rows = index_rows(_read(spark, source, format, source))
    _indexed(list_files(spark, source), rows).write.mode("errorifexists").parquet(index)
    return index


def refresh_index(spark: SparkSession, source: str, old: str, index: str, *, format: str = "parquet") -> str:
    """Write a new index to ``index`` from the one at ``old``: only files that are new or changed are read."""
    known, listed = spark.read.parquet(old), list_files(spark, source)
    out, fresh = known.join(listed, list(FILE), "left_semi"), listed.join(known, list(FILE), "left_anti")
    paths = [unquote(r["file"]) for r in fresh.select("file").collect()]
    if paths:
        out = out.unionByName(_indexed(fresh, index_rows(_read(spark, paths, format, source))))
    out.write.mode("errorifexists").parquet(index)
    return index


def matching_files(
    spark: SparkSession,
    source: str,
    index: str,
    *,
    codes: Iterable[str] | None = None,
    session_code: str | None = C.SESSION,
    dates: tuple[str, str] | None = None,
    patients: tuple[str, str] | None = None,
) -> list[str]:
    """Files that may hold an observation of the session with one of the component codes,
    in the closed ranges of dates and patients. One row per file reaches the driver."""
    known = spark.read.parquet(index)
    listed = list_files(spark, source)
    differ = known.select(*FILE).exceptAll(listed).unionAll(listed.exceptAll(known.select(*FILE))).limit(3).collect()
    if differ:
        raise StaleIndex(f"{index} isn't the index of what lies under {source}: {', '.join(sorted({r['file'] for r in differ}))}")
    may = F.lit(True)
    if codes is not None:
        may &= F.arrays_overlap("components", F.lit(sorted(set(codes))).cast("array<string>"))
    if session_code is not None:
        may &= F.array_contains("sessions", session_code)
    if dates is not None:
        low, high = (F.lit(d).cast("date") for d in dates)
        may &= (F.col("date_max") >= low) & (F.col("date_min") <= high)
    if patients is not None:
        may &= (F.col("patient_max") >= F.lit(patients[0])) & (F.col("patient_min") <= F.lit(patients[1]))
    return sorted(unquote(r["file"]) for r in known.filter(may).select("file").collect())


def write_clustered(bundles: DataFrame, path: str, files: int | None = None) -> str:
    """Write bundles so that files hold few different codes and dates: sorted by the codes of
    their components, then by date, in ranges (``files`` of them, if given)."""
    from equilibra.sources.bundles import BUNDLE_SCHEMA

    codes = F.transform(F.coalesce("entry", F.array().cast(BUNDLE_SCHEMA["entry"].dataType)), lambda e: F.flatten(e["resource"]["component"]["code"]["coding"])["code"])
    kind = F.array_join(F.sort_array(F.array_distinct(F.flatten(codes))), ",")
    when = session_date(F.try_element_at("entry", F.lit(1))["resource"]["effectiveDateTime"])
    order = [kind, when, F.xxhash64("entry")]  # the hash lets a range split bundles of one kind and day
    ranged = bundles.repartitionByRange(files, *order) if files else bundles.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order[:2]).write.mode("errorifexists").parquet(path)
    return path
