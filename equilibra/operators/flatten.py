"""Generic flattening of a nested DataFrame.

Semantics: repeat until no column is an array or a struct: take the first
such column; an array is unnested in place with ``explode_outer`` (a null or
empty array gives one row with null); a struct is replaced by its children,
named ``parent_child`` and appended after all other columns. Maps are left as
they are. Sibling arrays therefore multiply rows.

The schema walk runs on the driver over types only. Struct expansions do not
add plan nodes: each flattened column is tracked as a nested field expression
of the last generator's output, so the plan is one projection plus one
``Generate`` per array level and Catalyst prunes every field nobody reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_complex(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.StructType))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def flatten_nested(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten every array and struct of ``df`` (see module docstring).

    Raises ``ValueError`` when a flattened name collides with an existing
    column (``a.b`` next to ``a_b``) instead of producing two equal names.
    """
    # Working schema: ordered (name, type, expression over the current frame).
    work: list[tuple[str, T.DataType, Column]] = [(f.name, f.dataType, _quoted(f.name)) for f in df.schema.fields]
    out = df
    while True:
        pos = next((i for i, (_, dtype, _) in enumerate(work) if _is_complex(dtype)), None)
        if pos is None:
            break
        name, dtype, expr = work[pos]
        if isinstance(dtype, T.StructType):
            rest = work[:pos] + work[pos + 1 :]
            taken = {n for n, _, _ in rest}
            children = []
            for field in dtype.fields:
                child = f"{name}{sep}{field.name}"
                if child in taken:
                    raise ValueError(f"flattening {name!r} gives {child!r}, which already exists")
                taken.add(child)
                children.append((child, field.dataType, expr.getField(field.name)))
            work = rest + children
        else:
            # Materialise the tracked expressions and unnest this array.
            out = out.select(
                *[
                    (F.explode_outer(e) if i == pos else e).alias(n)
                    for i, (n, _, e) in enumerate(work)
                ]
            )
            work = [
                (n, dtype.elementType if i == pos else t, _quoted(n)) for i, (n, t, _) in enumerate(work)
            ]
    return out.select(*[e.alias(n) for n, _, e in work])
