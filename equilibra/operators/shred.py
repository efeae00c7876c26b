"""Shredding: one table per array path of a nested frame, with generated parent keys.

``flatten_nested`` unnests sibling arrays side by side, so an observation with 3 codings, 2
categories and 10 components becomes 60 rows. Here each array has a table of its own
with one row per element, keyed by the row's number (``_row``, given once, when the frame is
written) and the element's position in each array around it. Rows are linear in elements,
and the flat form is a join of the tables that are asked for.

``shred`` writes the numbered frame and returns the tables as lazy selections of it;
``write_shredded`` stores each as a table of its own; ``flat`` joins. Joins are left joins on
the parent's key, so a null or empty array gives one row of nulls, as in the flat form; two
bundles never share a key. What lies below an array is joined to it before its siblings multiply
it, so the rows that are shuffled and sorted are those of the tables, or of one array with those
below it; the product of an array's siblings is made in the last joins and goes out as a stream.

Names are those of the flat form (``parent_child``); positions are the array's name and ``_pos``
(numbered, as is the path, where an array's elements are arrays). Maps are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "_row"
ROOT = ""


@dataclass
class Table:
    """One array path: its key columns (parent's key first), its parent's path, its plain columns."""

    path: str
    parent: str | None
    keys: list[str]
    columns: list[str] = field(default_factory=list)
    frame: DataFrame | None = None


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _leaves(name: str, dtype: T.DataType, value: Column, sep: str) -> tuple[list[tuple[str, Column]], list[tuple[str, T.ArrayType, Column]]]:
    """(plain fields, arrays) below a value, through structs."""
    if isinstance(dtype, T.ArrayType):
        return [], [(name, dtype, value)]
    if not isinstance(dtype, T.StructType):
        return [(name, value)], []
    plain, arrays = [], []
    for f in dtype.fields:
        p, a = _leaves(f"{name}{sep}{f.name}" if name else f.name, f.dataType, value.getField(f.name) if name else _quoted(f.name), sep)
        plain, arrays = plain + p, arrays + a
    return plain, arrays


def _tables(path: str, parent: str | None, keys: list[str], name: str, dtype: T.DataType, frame: DataFrame, value: Column | None, sep: str) -> list[Table]:
    """The table of an array path (or the root), and those below it."""
    plain, arrays = _leaves(name, dtype, value, sep)
    names = [n for n, _ in plain]
    if len(set(names)) < len(names) or set(names) & set(keys):
        raise ValueError(f"shredding {path or 'the frame'} gives a name twice: {sorted(names)}")
    out = [Table(path, parent, keys, names, frame.select(*keys, *[v.alias(n) for n, v in plain]))]
    for below, kind, held in arrays:
        place, k = f"{below}_pos", 2
        while place in keys:
            place, k = f"{below}_pos{k}", k + 1
        inner = frame.select(*keys, F.posexplode(held).alias(place, "_e"))
        out += _tables(below if k == 2 else f"{below}~{k - 1}", path, [*keys, place], below, kind.elementType, inner, F.col("_e"), sep)
    return out


def shred(df: DataFrame, folder: str, sep: str = "_") -> dict[str, Table]:
    """Write ``df`` with row numbers under ``folder`` and return its tables by array path
    (the root's is ``""``), parents first. The numbers are kept with the rows, so tables
    made at different times, or made again after a lost executor, still fit together."""
    base = f"{folder.rstrip('/')}/rows"
    df.withColumn(ROW, F.monotonically_increasing_id()).write.mode("errorifexists").parquet(base)
    schema = T.StructType([*df.schema.fields, T.StructField(ROW, T.LongType())])
    frame = df.sparkSession.read.schema(schema).parquet(base)
    return {t.path: t for t in _tables(ROOT, None, [ROW], "", df.schema, frame, None, sep)}


def write_shredded(tables: dict[str, Table], folder: str) -> dict[str, Table]:
    """Store every table under ``folder`` (named by its path) and return the stored ones."""
    out = {}
    for path, t in tables.items():
        at = f"{folder.rstrip('/')}/{path or 'root'}"
        t.frame.write.mode("errorifexists").parquet(at)
        out[path] = Table(path, t.parent, t.keys, t.columns, t.frame.sparkSession.read.schema(t.frame.schema).parquet(at))
    return out


def flat(tables: dict[str, Table], columns: Iterable[str] | None = None) -> DataFrame:
    """The flat form as a join of the tables that hold ``columns`` (all, if not given).

    With all columns the rows are those of ``flatten_nested``. With some, arrays that none
    of them lies in are not joined and multiply nothing.
    """
    asked = [c for t in tables.values() for c in t.columns] if columns is None else list(columns)
    owner = {c: t.path for t in tables.values() for c in t.columns}
    unknown = [c for c in asked if c not in owner]
    if unknown:
        raise ValueError(f"no table has {unknown}")
    needed = {ROOT} | (set(tables) if columns is None else set())
    for c in asked:
        path: str | None = owner[c]
        while path is not None:
            needed.add(path)
            path = tables[path].parent
    below: dict[str, list[str]] = {}
    for path, t in tables.items():
        if path in needed and path != ROOT:
            below.setdefault(t.parent, []).append(path)

    def own(path: str) -> DataFrame:
        t = tables[path]
        return t.frame.select(*[_quoted(c) for c in t.keys], *[_quoted(c) for c in t.columns if c in asked])

    def met(out: DataFrame, under: DataFrame, up: list[str], kept: list[str]) -> DataFrame:
        """Left join on the parent's key ``up``; of the keys below, ``kept`` stay."""
        mine = under.select(*[_quoted(k).alias(f"_of_{k}") for k in up], *[_quoted(c) for c in under.columns if c in asked or c in kept])
        # A parent that isn't there has no position: null equals nothing, and gives no elements.
        # Tables grow with the elements: never a broadcast, whose table the driver would hold.
        return out.join(mine.hint("merge"), [_quoted(k) == _quoted(f"_of_{k}") for k in up], "left").drop(*[f"_of_{k}" for k in up])

    def joined(out: DataFrame, path: str) -> DataFrame:
        """Rows with a table's keys, with all that lies below that table."""
        up, children = tables[path].keys, below.get(path, [])
        if len(children) == 1:  # nothing beside it multiplies the rows: they go down with it
            return joined(met(out, own(children[0]), up, tables[children[0]].keys[-1:]), children[0])
        for child in children:
            out = met(out, joined(own(child), child), up, [])
        return out

    out = joined(own(ROOT), ROOT)
    return out.select(*[_quoted(c) for c in asked])


def sizes(spark: SparkSession, tables: dict[str, Table]) -> DataFrame:
    """(path, rows) of every table."""
    out = None
    for path, t in tables.items():
        one = t.frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(path).alias("path"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
