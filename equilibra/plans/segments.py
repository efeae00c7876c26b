"""15-second segment statistics of a sampled measure, in one pass.

Definition: DISTINCT sampled observations with their sample-time text, the
value and time tokens zipped (shorter side padded with null), ``sec`` = ms /
1000; for each closed segment [0,15], [15,30], [30,45], [45,60] the mean,
sample standard deviation, min and max of the values whose ``sec`` falls in
it, per (Patient, Date, Week, exercise, text). A sample exactly on 15, 30 or
45 s belongs to both neighbouring segments. A key appears when at least one
of its samples lies in [0, 60]; a segment without samples is null.

Literally this is 16 filtered aggregates glued by 12 full outer joins. Here
each observation is reduced in its scan task to four moment structs (one per
segment), the structs are de-duplicated, and one aggregation merges them:
one scan, two small shuffles, no join. The four products are projections
of that one aggregate (``segment_statistics``).

Documented difference: a key with a null part (e.g. a null text) present in
two segments is one row here; the join form, where null never equals null,
would give one row per segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import sample_values
from equilibra.operators.moments import add_all_moments, max_of, mean_of, min_of, grouped, stddev_of
from equilibra.operators.observations import observations, select_component
from equilibra.plans.movement import fingerprint

KEYS = [C.PATIENT, C.DATE, C.WEEK, C.DISPLAY, C.TEXT]
INSIDE = "_inside"
STATS = {"Mean": mean_of, "STD": stddev_of, "Min": min_of, "Max": max_of}


def segment_label(lo: int, hi: int) -> str:
    return f"{lo}_{hi}"


def segment_moments(bundles: DataFrame, code: str, *, std: bool = True) -> DataFrame:
    """Distinct timed observations reduced to one moments struct per segment
    (``_m0`` .. ``_m3``) and the number of samples in [0, 60] s."""
    obs = select_component(observations(bundles, [code], times=True), code)
    pad = F.array(F.lit(None).cast("float"))
    points = F.arrays_zip(
        F.coalesce(sample_values(C.SAMPLES), pad).alias("v"),
        F.coalesce(sample_values(C.SAMPLE_TIMES), pad).alias("t"),
    )
    # In milliseconds: the bounds are whole seconds, so that no rounding of ms / 1000 moves a time across one.
    within = lambda p, lo, hi: p["t"].between(F.lit(1000 * lo).cast("float"), F.lit(1000 * hi).cast("float"))
    first, last = C.SEGMENTS[0][0], C.SEGMENTS[-1][1]
    df = obs.select(
        *KEYS,
        C.EFFECTIVE,
        fingerprint(F.coalesce(C.SAMPLES, F.lit(""))).alias("_fp_v"),
        C.SAMPLES,
        fingerprint(F.coalesce(C.SAMPLE_TIMES, F.lit(""))).alias("_fp_t"),
        C.SAMPLE_TIMES,
        points.alias("_z"),
    ).withColumn(INSIDE, F.size(F.filter("_z", lambda p: within(p, first, last))))
    # null and '' texts print alike; keep the null-ness in the identity.
    df = df.withColumn("_nulls", F.struct(F.col(C.SAMPLES).isNull(), F.col(C.SAMPLE_TIMES).isNull())).drop(
        C.SAMPLES, C.SAMPLE_TIMES
    )
    inside = lambda lo, hi: F.filter("_z", lambda p: within(p, lo, hi) & p["v"].isNotNull())["v"]
    return add_all_moments(df, {f"_m{j}": inside(lo, hi) for j, (lo, hi) in enumerate(C.SEGMENTS)}, std=std, nulls=False).drop("_z").distinct()


def segment_statistics(bundles: DataFrame, code: str, stats: tuple[str, ...] = tuple(STATS)) -> DataFrame:
    """``<lo>_<hi> <Mean|STD|Min|Max>`` per key, all 16 unless ``stats`` names fewer.

    A key stays if any of its samples, null values included, lies in [0, 60] s.
    That is decided after the aggregation: observations without such a sample
    change no statistic, and a filter before it would parse the texts twice.
    """
    moments = {f"_a{j}": f"_m{j}" for j in range(len(C.SEGMENTS))}
    merged = grouped(segment_moments(bundles, code, std="STD" in stats), KEYS, moments, (INSIDE,), std="STD" in stats).filter(F.col(INSIDE) > 0)
    cols = [
        STATS[stat](f"_a{j}").alias(f"{segment_label(lo, hi)} {stat}")
        for stat in stats
        for j, (lo, hi) in enumerate(C.SEGMENTS)
    ]
    return merged.select(*KEYS, *cols)


def segment_product(bundles: DataFrame, code: str, stat: str) -> DataFrame:
    """One of the four products: keys + the four segment columns of ``stat``."""
    return segment_statistics(bundles, code, (stat,))
