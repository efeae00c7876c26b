"""Sampled signals as rows (T1-T6).

``sample_rows``: distinct observations of one measure, their sample text
split and unnested (inner: an observation without text gives no row), each
token cast to float (null when not a number).

``timed_samples``: the same with the sample-time text unnested alongside;
the two token arrays are zipped position by position, the shorter padded with
null, and a missing array counts as ``[null]`` so the other side survives.
``sec`` = milliseconds / 1000.

These produce one row per sample, so they de-duplicate the observation text
first (the DISTINCT of the definition). The aggregate products do not use
them: they reduce each observation to moments inside the scan task
(``equilibra.operators.moments``) and never shuffle sample text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import parse_float, sample_tokens
from equilibra.operators.observations import observations, select_component

SAMPLE_COLUMNS = (C.PATIENT, C.DATE, C.WEEK, C.DISPLAY, C.TEXT)


def distinct_sampled(bundles: DataFrame, code: str, *, times: bool = False) -> DataFrame:
    """Distinct sampled observations of one code (the products' DISTINCT)."""
    cols = [C.PATIENT, C.DISPLAY, C.TEXT, C.SAMPLES]
    if times:
        cols.append(C.SAMPLE_TIMES)
    cols += [C.EFFECTIVE, C.DATE, C.WEEK]
    return select_component(observations(bundles, [code], times=times), code).select(*cols).distinct()


def sample_rows(bundles: DataFrame, code: str, value: str = "col") -> DataFrame:
    """One row per sample token: keys + ``value`` (float)."""
    obs = distinct_sampled(bundles, code)
    return obs.select(*SAMPLE_COLUMNS, F.explode(sample_tokens(C.SAMPLES)).alias(value)).withColumn(
        value, parse_float(value)
    )


def timed_samples(bundles: DataFrame, code: str) -> DataFrame:
    """One row per (value, time) position: keys, ``data_values`` (float),
    ``seconds`` (float, ms) and ``sec`` (double, s)."""
    obs = distinct_sampled(bundles, code, times=True)
    pad = F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(
        F.coalesce(sample_tokens(C.SAMPLES), pad).alias("data_values"),
        F.coalesce(sample_tokens(C.SAMPLE_TIMES), pad).alias("seconds"),
    )
    keys = [C.PATIENT, C.DISPLAY, C.TEXT, C.EFFECTIVE, C.DATE, C.WEEK]
    rows = obs.select(*keys, F.inline(zipped))
    return (
        rows.withColumn("data_values", parse_float("data_values"))
        .withColumn("seconds", parse_float("seconds"))
        .withColumn("sec", F.col("seconds") / F.lit(1000))
    )
