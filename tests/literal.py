"""Literal-shape forms of the products, for equivalence tests and the bench.

These follow the definitions step by step: generic flatten of everything,
code filter, DISTINCT, explode of the sample text, one aggregate per
statistic and segment, and full outer USING joins to glue them. They are
the slow shape the library avoids; equal answers check the rewrites.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import flag_text, parse_float, sample_tokens
from equilibra.operators import flatten_nested, with_session_columns

KEYS5 = [C.PATIENT, C.DATE, C.WEEK, C.DISPLAY, C.TEXT]
K3 = [C.PATIENT, C.DATE, C.DISPLAY]


def flat(bundles: DataFrame) -> DataFrame:
    return with_session_columns(flatten_nested(bundles))


def coded(flat_df: DataFrame, code: str) -> DataFrame:
    return flat_df.filter((F.col(C.COMPONENT_CODE) == code) & (F.col(C.SESSION_CODE) == C.SESSION))


def samples(flat_df: DataFrame, code: str) -> DataFrame:
    base = coded(flat_df, code).select(
        C.PATIENT, C.DISPLAY, C.TEXT, C.SAMPLES, C.EFFECTIVE, C.DATE, C.WEEK
    ).distinct()
    return base.select(*KEYS5, F.explode(sample_tokens(C.SAMPLES)).alias("col")).withColumn("col", parse_float("col"))


def timed(flat_df: DataFrame, code: str) -> DataFrame:
    base = coded(flat_df, code).select(
        C.PATIENT, C.DISPLAY, C.TEXT, C.SAMPLES, C.SAMPLE_TIMES, C.EFFECTIVE, C.DATE, C.WEEK
    ).distinct()
    pad = F.array(F.lit(None).cast("string"))
    z = F.arrays_zip(
        F.coalesce(sample_tokens(C.SAMPLES), pad).alias("v"), F.coalesce(sample_tokens(C.SAMPLE_TIMES), pad).alias("t")
    )
    return (
        base.select(*KEYS5, F.inline(z))
        .withColumn("v", parse_float("v"))
        .withColumn("sec", parse_float("t") / F.lit(1000))
    )


STAT = {"Mean": F.mean, "STD": F.stddev, "Min": F.min, "Max": F.max}


def segments(flat_df: DataFrame, code: str, stat: str) -> DataFrame:
    pts = timed(flat_df, code)
    parts = [
        pts.filter(F.col("sec").between(lo, hi)).groupBy(*KEYS5).agg(STAT[stat]("v").alias(f"{lo}_{hi} {stat}"))
        for lo, hi in C.SEGMENTS
    ]
    return reduce(lambda a, b: a.join(b, KEYS5, "full"), parts)


def movement(flat_df: DataFrame, code: str, keys: list[str], stat: str, name: str) -> DataFrame:
    return samples(flat_df, code).groupBy(*keys).agg(STAT[stat]("col").alias(name))


def report(flat_df: DataFrame) -> DataFrame:
    def stats(code: str, label: str) -> DataFrame:
        return (
            samples(flat_df, code)
            .groupBy(*K3, C.TEXT)
            .agg(
                F.min("col").alias(f"Min_{label}"),
                F.max("col").alias(f"Max_{label}"),
                F.mean("col").alias(f"Mean_{label}"),
            )
            .drop(C.TEXT)
        )

    def flags(code: str) -> DataFrame:
        days = coded(flat_df, code).select(C.DATE, C.WEEK, C.PATIENT, C.DISPLAY, C.FLAG).distinct()
        return days.select(*K3, flag_text(C.FLAG).alias(C.SYMPTOMS[code]))

    def quantity(code: str, name: str, cols: list[str]) -> DataFrame:
        return coded(flat_df, code).select(*cols, F.col(C.QUANTITY).alias(name)).distinct()

    score = quantity(C.SESSION_SCORE, "Session_score", [*K3, C.WEEK, C.START]).drop(C.WEEK)
    duration = quantity(C.DURATION, "Duration", [*K3, C.WEEK, C.START]).drop(C.WEEK)
    reps = quantity(C.REPETITIONS, "Total_reps", K3)
    chain = [stats(C.SPEED_OF_MOVEMENT, "speed"), stats(C.RANGE_OF_MOVEMENT, "range")]
    chain += [flags(code) for code in C.SYMPTOMS]
    out = reduce(lambda a, b: a.join(b, K3, "full"), chain + [score])
    out = out.join(duration, [*K3, C.START], "full").join(reps, K3, "full")
    return out
