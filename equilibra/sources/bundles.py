"""Reading the bundle table.

A bundle row holds ``entry``, an array of observations. Only the paths the
products need are listed in ``BUNDLE_SCHEMA``; any other field a real table
carries is allowed and ignored (nested column pruning keeps it out of the scan).
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from equilibra.sources.schemas import merged

_CODING = T.ArrayType(T.StructType([T.StructField("code", T.StringType())]))

COMPONENT_TYPE = T.StructType(
    [
        T.StructField("code", T.StructType([T.StructField("coding", _CODING), T.StructField("text", T.StringType())])),
        T.StructField("valueBoolean", T.BooleanType()),
        T.StructField("valueQuantity", T.StructType([T.StructField("value", T.DoubleType())])),
        T.StructField(
            "valueSampledData",
            T.StructType(
                [
                    T.StructField("data", T.StringType()),
                    T.StructField(
                        "extension",
                        T.ArrayType(T.StructType([T.StructField("valueString", T.StringType())])),
                    ),
                ]
            ),
        ),
    ]
)

RESOURCE_TYPE = T.StructType(
    [
        T.StructField("subject", T.StructType([T.StructField("reference", T.StringType())])),
        T.StructField("effectiveDateTime", T.StringType()),
        T.StructField("category", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
        T.StructField(
            "code",
            T.StructType(
                [
                    T.StructField(
                        "coding",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField("code", T.StringType()), T.StructField("display", T.StringType())]
                            )
                        ),
                    )
                ]
            ),
        ),
        T.StructField("component", T.ArrayType(COMPONENT_TYPE)),
    ]
)

BUNDLE_SCHEMA = T.StructType(
    [T.StructField("entry", T.ArrayType(T.StructType([T.StructField("resource", RESOURCE_TYPE)])))]
)


# --- fixed values: nested leaves each kind of product reads -----------------
SESSION_FIELDS = (
    "entry.resource.subject.reference",
    "entry.resource.effectiveDateTime",
    "entry.resource.code.coding.code",
    "entry.resource.code.coding.display",
    "entry.resource.component.code.coding.code",
    "entry.resource.component.code.text",
)
FLAG_FIELDS = SESSION_FIELDS + ("entry.resource.component.valueBoolean",)
QUANTITY_FIELDS = SESSION_FIELDS + ("entry.resource.component.valueQuantity.value",)
SAMPLE_FIELDS = SESSION_FIELDS + ("entry.resource.component.valueSampledData.data",)
TIMED_FIELDS = SAMPLE_FIELDS + ("entry.resource.component.valueSampledData.extension.valueString",)
FACT_FIELDS = tuple(dict.fromkeys(FLAG_FIELDS + QUANTITY_FIELDS))
REPORT_FIELDS = tuple(dict.fromkeys(FLAG_FIELDS + QUANTITY_FIELDS + SAMPLE_FIELDS))


def prune_schema(schema: T.StructType, fields: tuple[str, ...] | list[str]) -> T.StructType:
    """The part of ``schema`` on the given dotted leaf paths (arrays are
    crossed transparently). Paths the schema lacks are skipped; the result
    keeps the schema's own field order and types."""
    paths = [f.split(".") for f in fields]

    def keep(dtype: T.DataType, tails: list[list[str]]) -> T.DataType | None:
        if isinstance(dtype, T.ArrayType):
            inner = keep(dtype.elementType, tails)
            return None if inner is None else T.ArrayType(inner, dtype.containsNull)
        if isinstance(dtype, T.MapType) or not isinstance(dtype, T.StructType):
            return dtype if any(len(t) == 0 for t in tails) else None
        if any(len(t) == 0 for t in tails):
            return dtype  # the whole struct was asked for
        out = []
        for field in dtype.fields:
            sub = [t[1:] for t in tails if t[0] == field.name]
            if sub:
                kept = keep(field.dataType, sub)
                if kept is not None:
                    out.append(T.StructField(field.name, kept, field.nullable, field.metadata))
        return T.StructType(out) if out else None

    pruned = keep(schema, paths)
    return pruned if pruned is not None else T.StructType([])


def _is_table(spark: SparkSession, name: str) -> bool:
    if "/" in name or ":" in name:
        return False
    try:
        return spark.catalog.tableExists(name)
    except Exception:  # not a valid table identifier
        return False


def load_bundle(
    spark: SparkSession,
    source: str,
    *,
    format: str | None = None,
    options: dict[str, str] | None = None,
    fields: tuple[str, ...] | list[str] | None = None,
    index: str | None = None,
    codes: Iterable[str] | None = None,
    dates: tuple[str, str] | None = None,
    patients: tuple[str, str] | None = None,
) -> DataFrame:
    """A catalog table by name, or files at a path in any Spark format.

    With ``format`` unset, a name known to the catalog is read as a table and
    anything else as Parquet files. Delta needs its package on the session's
    classpath (``format="delta"``, untested here; without ``fields``, as it takes
    no schema from its reader).

    ``fields`` (e.g. ``FLAG_FIELDS``) reads files with the file schema
    narrowed to those nested leaves. Spark prunes nested columns of a scan
    only down to the first array whose elements are read in more than one
    field, so without this every product would read every component's sample
    text; with it a columnar source reads just the listed leaf columns. Paths that the
    files lack, all or some of them, are read as typed nulls (``equilibra.sources.schemas``).
    By catalog name, the table's own files are read in this way, with its
    partition columns and read options. It raises with ``fields`` where the files
    or partitions under the table's location aren't those of the catalog, for a
    view, and for a table of another format than ``FILE_TABLES``.

    ``index`` (of ``equilibra.sources.skipping``, for files at a path): only files that may
    hold a session with one of the component ``codes``, in the closed ranges ``dates``
    and ``patients``, are read. Other rows of those files are still there: products
    filter by code themselves. Raises ``StaleIndex`` if the files have changed.
    """
    if index is not None:
        from equilibra.sources.skipping import matching_files

        files = matching_files(spark, source, index, codes=codes, dates=dates, patients=patients)
        return _indexed_files(spark, source, files, format or "parquet", options or {}, fields)
    if codes is not None or dates is not None or patients is not None:
        raise ValueError("codes, dates and patients need an index")
    if format is None and _is_table(spark, source):
        return spark.table(source) if not fields else _table_files(spark, source, fields)
    if fields and format == "delta":
        raise ValueError("fields can't narrow a Delta read: leave fields unset")
    reader = spark.read.format(format or "parquet")
    if options:
        reader = reader.options(**options)
    if fields:
        full = merged(reader.load(source).schema, BUNDLE_SCHEMA)  # file metadata only
        reader = reader.schema(prune_schema(full, fields))
    return reader.load(source)


def _indexed_files(spark: SparkSession, source: str, files: list[str], format: str, options: dict[str, str], fields: tuple[str, ...] | list[str] | None) -> DataFrame:
    """The files of ``source`` that an index names, with the schema of all of them."""
    reader = spark.read.format(format).options(**options)
    schema = reader.load(source).schema
    schema = prune_schema(merged(schema, BUNDLE_SCHEMA), fields) if fields else schema
    if not files:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", source).schema(schema).load(files)


#: Table formats that are plain files under one location.
FILE_TABLES = ("parquet", "orc", "json")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _table_files(spark: SparkSession, name: str, fields: tuple[str, ...] | list[str]) -> DataFrame:
    """The table's files with its schema narrowed to ``fields`` and its partition columns."""
    said = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    names = [c for c, _ in said]
    details = dict(said[names.index("# Detailed Table Information") + 1 :]) if "# Detailed Table Information" in names else {}
    provider, location = details.get("Provider", "").lower(), details.get("Location")
    if provider not in FILE_TABLES or not location:
        raise ValueError(f"{name} isn't a table of files ({', '.join(FILE_TABLES)}): fields can't narrow it")
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    schema = prune_schema(merged(spark.table(name).schema, BUNDLE_SCHEMA), [*fields, *parts])
    files = spark.read.format(provider).options(**_table_options(name, details)).schema(schema).load(location)
    if set(files.inputFiles()) != set(spark.table(name).inputFiles()):
        raise ValueError(f"{name}: the files under {location} aren't those of the catalog's partitions: fields can't narrow it")
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect() if parts else []:
        held = [(k, unquote(v)) for k, v in (x.split("=", 1) for x in row["partition"].split("/"))]
        quoted = [(k, "null" if v in ("null", NO_VALUE) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'") for k, v in held]
        at = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({', '.join(f'`{k}` = {v}' for k, v in quoted)})").collect()
        own = next(r["data_type"] for r in at if r["col_name"] == "Location")
        folder = "/".join(f"{k}={NO_VALUE if q == 'null' else v}" for (k, v), (_, q) in zip(held, quoted, strict=True))
        if not unquote(unquote(own)).rstrip("/").endswith("/" + unquote(folder)):
            raise ValueError(f"{name}: partition {row['partition']} lies at {own}: fields can't narrow it")
    return files


def _table_options(name: str, details: dict[str, str]) -> dict[str, str]:
    """The read options that the table was made with."""
    said = details.get("Storage Properties", "[]").strip()[1:-1]
    pairs = [x.split("=", 1) for x in said.split(", ")] if said else []
    if any(len(x) < 2 or "(redacted)" in x[1] for x in pairs):
        raise ValueError(f"{name}: its options can't be read from the catalog: fields can't narrow it")
    return {k: v for k, v in pairs if k not in ("path", "serialization.format")}
