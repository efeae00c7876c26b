"""Path-selective unnesting of bundles into observation rows.

``flatten_nested`` unnests every array, so unrelated sibling arrays multiply
rows that every product later removes with DISTINCT. ``observations`` unnests
only the paths a product reads and drops what it does not need *before*
unnesting the next level:

* ``entry`` -> one row per observation,
* the observation codings whose code is the session code (``1158``),
* the components, then their codings whose code is asked for,
* optionally the sample-time ``extension`` of a sampled component.

After the products' DISTINCT the rows are the same as with the generic
flatten plus the same filter. Derived columns (patient, date, week, start
time) are computed once per observation, before the components are
unnested; codes are matched by plain filters right after each generator.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equilibra import codes as C
from equilibra.functions import iso_week, patient_id, session_date, start_time
from equilibra.sources.schemas import conformed

#: The arrays that are unnested; a frame that lacks one is read as if it were null there.
_CODED = T.StructType([T.StructField("coding", T.ArrayType(T.StructType([T.StructField("code", T.StringType())])))])
_SESSION = T.StructType([T.StructField("coding", T.ArrayType(T.StructType([T.StructField("code", T.StringType()), T.StructField("display", T.StringType())])))])
_RESOURCE = T.StructType([T.StructField("code", _SESSION), T.StructField("component", T.ArrayType(T.StructType([T.StructField("code", _CODED)])))])
NEEDED = T.StructType([T.StructField("entry", T.ArrayType(T.StructType([T.StructField("resource", _RESOURCE)])))])


def _has(dtype: T.DataType, path: str) -> bool:
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return False
        dtype = dtype[part].dataType
    return True


def _leaf(base: Column, dtype: T.DataType, path: str, leaf_type: str) -> Column:
    """``base.path`` when the schema has it, else a typed null."""
    if not _has(dtype, path):
        return F.lit(None).cast(leaf_type)
    out = base
    for part in path.split("."):
        out = out.getField(part)
    return out


def with_session_columns(df: DataFrame, *, reference: str = C.REFERENCE, effective: str = C.EFFECTIVE) -> DataFrame:
    """Add ``Patient_id``, ``Date``, ``Week``, ``Start_time`` (P7)."""
    return (
        df.withColumn(C.PATIENT, patient_id(reference))
        .withColumn(C.DATE, session_date(effective))
        .withColumn(C.WEEK, iso_week(C.DATE))
        .withColumn(C.START, start_time(effective))
    )


def observations(
    bundles: DataFrame,
    component_codes: Iterable[str],
    *,
    session_code: str = C.SESSION,
    times: bool = False,
) -> DataFrame:
    """One row per (observation, session coding, component, component coding)
    whose codes match, with the flattened column names of the reference and
    ``Patient_id``, ``Date``, ``Week``, ``Start_time`` added.

    Paths that the schema lacks are read as null (``equilibra.sources.schemas``): without
    components, or codings of them, there are no rows.

    ``times=True`` also unnests the sampled data's ``extension`` (outer: a
    component without one keeps a row whose time text is null).
    """
    wanted = sorted(set(component_codes))
    bundles = conformed(bundles, NEEDED)
    entry_t = bundles.schema["entry"].dataType.elementType
    res_t = entry_t["resource"].dataType
    comp_t = res_t["component"].dataType.elementType

    entries = bundles.select(F.explode_outer("entry").alias("_e"))
    res = F.col("_e").getField("resource")
    # Per observation: the leaves read, and the derived session columns
    # (computed once here rather than once per component).
    per_obs = with_session_columns(
        entries.select(
            _leaf(res, res_t, "subject.reference", "string").alias(C.REFERENCE),
            _leaf(res, res_t, "effectiveDateTime", "string").alias(C.EFFECTIVE),
            res["code"]["coding"].alias("_sc"),
            res["component"].alias("_cs"),
        )
    )
    head = [C.REFERENCE, C.EFFECTIVE, C.PATIENT, C.DATE, C.WEEK, C.START]
    # Plain generators + filters: Spark compiles these into whole-stage code;
    # generators over lambda-filtered arrays would run interpreted (~2x slower).
    # The generators are outer ones, whose rows of nulls the filters drop: for inner ones
    # Spark adds filters on the arrays' sizes, which it pushes below the projections
    # that make the arrays, so that bundles built by a plan are built once more per filter.
    by_session = per_obs.select(*head, F.explode_outer("_sc").alias("_s"), "_cs").filter(
        F.col("_s")["code"] == F.lit(session_code)
    )
    by_component = by_session.select(
        *head,
        F.col("_s")["code"].alias(C.SESSION_CODE),
        F.col("_s")["display"].alias(C.DISPLAY),
        F.explode_outer("_cs").alias("_k"),
    )
    comp = F.col("_k")
    by_coding = by_component.select(
        *head,
        C.SESSION_CODE,
        C.DISPLAY,
        "_k",
        F.explode_outer(comp["code"]["coding"]["code"]).alias(C.COMPONENT_CODE),
    ).filter(F.col(C.COMPONENT_CODE).isin(wanted))
    cols = [
        F.col(C.REFERENCE),
        F.col(C.EFFECTIVE),
        F.col(C.SESSION_CODE),
        F.col(C.DISPLAY),
        F.col(C.COMPONENT_CODE),
        _leaf(comp, comp_t, "code.text", "string").alias(C.TEXT),
        _leaf(comp, comp_t, "valueBoolean", "boolean").alias(C.FLAG),
        _leaf(comp, comp_t, "valueQuantity.value", "double").alias(C.QUANTITY),
        _leaf(comp, comp_t, "valueSampledData.data", "string").alias(C.SAMPLES),
    ]
    if times:
        ext = (
            comp["valueSampledData"]["extension"]["valueString"]
            if _has(comp_t, "valueSampledData.extension") and _has(comp_t["valueSampledData"].dataType["extension"].dataType.elementType, "valueString")
            else F.lit(None).cast("array<string>")
        )
        cols.append(F.explode_outer(ext).alias(C.SAMPLE_TIMES))
    return by_coding.select(*cols, C.PATIENT, C.DATE, C.WEEK, C.START)


def select_component(obs: DataFrame, code: str) -> DataFrame:
    """Rows of one component code (F1); the session code is already matched."""
    return obs.filter(F.col(C.COMPONENT_CODE) == F.lit(code))
