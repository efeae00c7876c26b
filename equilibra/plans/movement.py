"""Range- and speed-of-movement products over the samples of a sampled
component.

Definition: DISTINCT sampled observations (Patient, exercise, text, sample
text, effectiveDateTime, Date, Week), each sample token a float, then a
grouped mean / sample standard deviation / min / max.

Plan: the observation's sample text is fingerprinted (SHA-256) and reduced
to mergeable moments in the scan task (``operators.moments``); the DISTINCT
runs over (keys, effectiveDateTime, fingerprint, moments), a few dozen
bytes per observation, and the grouped statistics merge the moments. So the
only shuffles carry small fixed-size rows whatever the signal length, and a
hot patient or week is pre-aggregated in each task before its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import add_week_year, sample_floats, week_keys
from equilibra.operators.moments import add_moments, cells, grouped, max_of, mean_of, merge_cells, min_of, statistics, stddev_of
from equilibra.operators.observations import observations, select_component
from equilibra.operators.rejects import REJECTS, reject_list

FINGERPRINT = "_fp"
MOMENTS = "_m"

DETAIL_KEYS = [C.PATIENT, C.DATE, C.WEEK, C.DISPLAY, C.TEXT]


def fingerprint(text: Column | str) -> Column:
    """32-byte SHA-256 of a text: equal texts, equal prints; distinct texts
    collide with negligible probability."""
    return F.unhex(F.sha2(F.col(text) if isinstance(text, str) else text, 256))


def observation_moments(bundles: DataFrame, component_codes: list[str], *, rejects: bool = False, std: bool = True) -> DataFrame:
    """One row per distinct sampled observation of the given codes:
    component code, keys, effectiveDateTime, fingerprint, moments struct.

    An observation without sample text has no samples and no row. With ``rejects``,
    the values that turned null are in ``REJECTS`` (equal for equal texts). Without
    ``std`` the moments have no squared deviations.
    """
    obs = observations(bundles, component_codes).filter(F.col(C.SAMPLES).isNotNull())
    df = obs.select(
        C.COMPONENT_CODE,
        C.PATIENT,
        C.DISPLAY,
        C.TEXT,
        C.EFFECTIVE,
        C.DATE,
        C.WEEK,
        fingerprint(C.SAMPLES).alias(FINGERPRINT),
        sample_floats(C.SAMPLES).alias("_vals"),
        *([reject_list().alias(REJECTS)] if rejects else []),
    )
    return add_moments(df, MOMENTS, F.col("_vals"), std=std).drop("_vals").distinct()


#: Product -> code, keys, statistic, result column (fixed values).
MOVEMENT_PRODUCTS = {
    "range_mean": (C.RANGE_OF_MOVEMENT, DETAIL_KEYS, mean_of, "Range_of_movement"),
    "range_std": (C.RANGE_OF_MOVEMENT, [C.WEEK, C.DISPLAY, C.TEXT], stddev_of, "STD_value"),  # across all patients
    "range_min": (C.RANGE_OF_MOVEMENT, DETAIL_KEYS, min_of, "Min_value"),
    "range_max": (C.RANGE_OF_MOVEMENT, DETAIL_KEYS, max_of, "Max_value"),
    "speed_weekly_mean": (C.SPEED_OF_MOVEMENT, [C.PATIENT, C.WEEK, C.DISPLAY], mean_of, "Speed_of_movement"),  # all texts together
    "speed_std": (C.SPEED_OF_MOVEMENT, [C.PATIENT, C.WEEK, C.DISPLAY, C.TEXT], stddev_of, "STD_value"),
    "speed_min": (C.SPEED_OF_MOVEMENT, DETAIL_KEYS, min_of, "Min_value"),
    "speed_max": (C.SPEED_OF_MOVEMENT, DETAIL_KEYS, max_of, "Max_value"),
}


def _keys(keys: list[str], with_year: bool) -> list[str]:
    return [x for k in keys for x in (week_keys(with_year) if k == C.WEEK else [k])]


def _result(groups: DataFrame, keys: list[str], stat: Callable[[str], Column], name: str, sort: bool, with_year: bool) -> DataFrame:
    lead = week_keys(with_year)
    out = groups.select(*keys, stat("_a").alias(name))
    return out.orderBy(*lead, *[k for k in keys if k not in lead]) if sort else out


def movement_product(moments: DataFrame, product: str, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    """One of the eight products of distinct observations with moments (of any codes).
    ``with_year`` tells the weeks of years apart."""
    code, keys, stat, name = MOVEMENT_PRODUCTS[product]
    keys = _keys(keys, with_year)
    mine = add_week_year(select_component(moments, code), with_year)
    return _result(grouped(mine, keys, {"_a": MOMENTS}, std=stat is stddev_of), keys, stat, name, sort, with_year)


def movement_product_of_cells(state: DataFrame, product: str, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    """The same from stored cells (``observation_cells``), of any number of states."""
    code, keys, stat, name = MOVEMENT_PRODUCTS[product]
    keys = _keys(keys, with_year)
    mine = add_week_year(select_component(state, code), with_year)
    return _result(statistics(merge_cells(mine, keys), keys, ["_a"]), keys, stat, name, sort, with_year)


def observation_cells(moments: DataFrame) -> DataFrame:
    """The mergeable state of distinct observations: cells per code, day, patient, exercise and text."""
    return cells(moments, [C.COMPONENT_CODE, *DETAIL_KEYS], F.col(MOMENTS))


def movement_statistics(bundles: DataFrame, code: str) -> DataFrame:
    """Mean, STD, Min and Max per (Patient, Date, Week, exercise, text), from one scan and one DISTINCT."""
    merged = grouped(observation_moments(bundles, [code]), DETAIL_KEYS, {"_a": MOMENTS}, std=True)
    stats = {"Mean": mean_of, "STD": stddev_of, "Min": min_of, "Max": max_of}
    return merged.select(*DETAIL_KEYS, *[f("_a").alias(name) for name, f in stats.items()])


def _product(product: str) -> Callable[..., DataFrame]:
    code, _, stat, _ = MOVEMENT_PRODUCTS[product]

    def run(bundles: DataFrame, *, sort: bool = True, with_year: bool = False) -> DataFrame:
        return movement_product(observation_moments(bundles, [code], std=stat is stddev_of), product, sort=sort, with_year=with_year)

    run.__name__ = product
    return run


# --- range of movement (404979006) ---------------------------------------------
range_mean, range_std, range_min, range_max = map(_product, ("range_mean", "range_std", "range_min", "range_max"))

# --- speed of movement (282108002) ---------------------------------------------
speed_weekly_mean, speed_std, speed_min, speed_max = map(_product, ("speed_weekly_mean", "speed_std", "speed_min", "speed_max"))
