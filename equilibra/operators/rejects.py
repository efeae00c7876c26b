"""Rejected values: what turns null on its way into a product, with the reason.

A time that is no date, a reference that names no patient, a sample token that is no number:
products go on with null (or without the sample), as defined. Here the values come out
beside them, from the same reading of the texts: ``reject_list`` is an array per
observation, which the shared frame of a family carries along (``equilibra.plans.families``),
``quarantine`` makes it rows, and ``reject_counts`` are metrics for ``DataFrame.observe``.

An empty token (a doubled space) is a reject of its own kind; a null sample text has no
tokens and no rejects. Values are handed on whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import odd_tokens, parse_float, sample_tokens, session_date
from equilibra.operators.observations import observations

REJECTS = "_rejects"
#: Reasons (fixed values).
NO_DATE, NO_PATIENT, EMPTY, NO_NUMBER = "not a date", "no patient", "empty token", "not a number"
REASONS = (NO_DATE, NO_PATIENT, EMPTY, NO_NUMBER)
_TYPE = "array<struct<field: string, place: int, value: string, reason: string>>"


def _one(field: str, place: Column, value: Column, reason: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), place.cast("int").alias("place"), value.alias("value"), reason.alias("reason"))


def _tokens(field: str, text: str) -> Column:
    """Rejected tokens of a sample text, with their places; tokens are only gone through one by one where one may be rejected."""
    each = F.transform(sample_tokens(text), lambda t, k: F.when(parse_float(t).isNull(), _one(field, k, t, F.when(t == "", F.lit(EMPTY)).otherwise(F.lit(NO_NUMBER)))))
    return F.when(odd_tokens(text), F.filter(each, lambda r: r.isNotNull())).otherwise(F.array().cast(_TYPE))


def reject_list(*, times: bool = False) -> Column:
    """The rejects of an observation row (as ``observations`` gives it)."""
    none = F.lit(None)
    date = F.when(F.col(C.EFFECTIVE).isNotNull() & session_date(C.EFFECTIVE).isNull(), F.array(_one("effectiveDateTime", none, F.col(C.EFFECTIVE), F.lit(NO_DATE))))
    patient = F.when(F.coalesce(F.col(C.PATIENT), F.lit("")) == "", F.array(_one("subject.reference", none, F.col(C.REFERENCE), F.lit(NO_PATIENT))))
    blank = F.array().cast(_TYPE)
    texts = [_tokens("valueSampledData.data", C.SAMPLES)] + ([_tokens("valueSampledData.extension", C.SAMPLE_TIMES)] if times else [])
    return F.concat(F.coalesce(date.cast(_TYPE), blank), F.coalesce(patient.cast(_TYPE), blank), *[t.cast(_TYPE) for t in texts])


def reject_counts(rejects: str = REJECTS) -> list[Column]:
    """Metrics for ``observe``: rejected values by reason, and rows that have any."""

    def those(reason: str) -> Column:
        return F.filter(rejects, lambda r: r["reason"] == reason)

    return [*[F.sum(F.size(those(x))).alias(x) for x in REASONS], F.count_if(F.size(rejects) > 0).alias("rows")]


def unnest_rejects(rows: DataFrame, keys: list[str], rejects: str = REJECTS) -> DataFrame:
    """One row per rejected value: ``keys``, field, place, value, reason."""
    # An outer generator, see ``observations``: an inner one has filters pushed to where the list is made.
    return rows.select(*keys, F.explode_outer(rejects).alias("_r")).filter(F.col("_r").isNotNull()).select(*keys, "_r.field", "_r.place", "_r.value", "_r.reason")


def quarantine(bundles: DataFrame, component_codes: list[str], *, times: bool = False) -> DataFrame:
    """The rejected values of distinct observations with these codes: patient, exercise,
    text, code and time as written, then field, place (of a token), value, reason."""
    keys = [C.PATIENT, C.DISPLAY, C.TEXT, C.COMPONENT_CODE, C.EFFECTIVE]
    texts = [C.SAMPLES, *([C.SAMPLE_TIMES] if times else [])]
    rows = observations(bundles, component_codes, times=times).select(*keys, *texts, reject_list(times=times).alias("_list"))
    # A generator of the one list, so that it is made once and not again for the filter.
    rows = rows.select(*keys, *texts, F.explode_outer(F.array("_list")).alias(REJECTS)).filter(F.size(REJECTS) > 0)
    # Equal rejects of different observations that share these keys stay apart by their texts.
    prints = [F.sha2(c, 256).alias(f"_{k}") for k, c in enumerate(texts)]
    return unnest_rejects(rows.select(*keys, *prints, REJECTS).distinct(), keys)
