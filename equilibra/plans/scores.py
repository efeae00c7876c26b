"""Session score products (component ``89191-1`` of a session observation).

A score row is a DISTINCT (Patient, exercise, score, Date, Week, Start_time).
Four aggregates of it:

* ``score_session_mean``: (Date, exercise) -> ``Mean_for_session``
* ``score_weekly_mean``: (Week, Date, Patient, exercise) -> ``Mean_of_weekly_score``
* ``score_session_sum``: (Date, Week, Patient) -> ``Sum_of_session``
* ``score_weekly_sum``: (Week, Patient) -> ``Sum_of_weekly_score``

All are partial (map-side) aggregations; the coarse (Date, exercise) key of
the first is reduced in every task before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import add_week_year, week_keys
from equilibra.operators.observations import observations, select_component

SCORE = "Session_score"


def session_scores(bundles: DataFrame) -> DataFrame:
    return (
        select_component(observations(bundles, [C.SESSION_SCORE]), C.SESSION_SCORE)
        .select(C.PATIENT, C.DISPLAY, F.col(C.QUANTITY).alias(SCORE), C.DATE, C.WEEK, C.START)
        .distinct()
    )


#: Product -> keys, aggregate, result column, first column of the order (fixed values).
SCORE_PRODUCTS = {
    "score_session_mean": ((C.DATE, C.DISPLAY), F.mean, "Mean_for_session", C.DATE),
    "score_weekly_mean": ((C.WEEK, C.DATE, C.PATIENT, C.DISPLAY), F.mean, "Mean_of_weekly_score", C.WEEK),
    "score_session_sum": ((C.DATE, C.WEEK, C.PATIENT), F.sum, "Sum_of_session", C.DATE),
    "score_weekly_sum": ((C.WEEK, C.PATIENT), F.sum, "Sum_of_weekly_score", C.WEEK),
}


def score_product(scores: DataFrame, product: str, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    """One of the four aggregates of score rows; ``with_year`` tells the weeks of years apart."""
    keys, agg, name, first = SCORE_PRODUCTS[product]
    keys = [x for k in keys for x in (week_keys(with_year) if k == C.WEEK else [k])]
    out = add_week_year(scores, with_year).groupBy(*keys).agg(agg(F.col(SCORE)).alias(name))
    if not sort:
        return out
    lead = week_keys(with_year) if first == C.WEEK else [first]
    return out.orderBy(*lead, *[k for k in keys if k not in lead])


def score_session_mean(bundles: DataFrame, *, sort: bool = True) -> DataFrame:
    return score_product(session_scores(bundles), "score_session_mean", sort=sort)


def score_weekly_mean(bundles: DataFrame, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    return score_product(session_scores(bundles), "score_weekly_mean", sort=sort, with_year=with_year)


def score_session_sum(bundles: DataFrame, *, sort: bool = True) -> DataFrame:
    return score_product(session_scores(bundles), "score_session_sum", sort=sort)


def score_weekly_sum(bundles: DataFrame, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    return score_product(session_scores(bundles), "score_weekly_sum", sort=sort, with_year=with_year)


def score_statistics(bundles: DataFrame) -> DataFrame:
    """Number, mean and sum of the scores of a (Patient, Date, Week, exercise), from one
    scan and one DISTINCT; the four products are re-aggregations of it."""
    keys = [C.PATIENT, C.DATE, C.WEEK, C.DISPLAY]
    stats = [F.count(SCORE).alias("Scores"), F.mean(SCORE).alias("Mean"), F.sum(SCORE).alias("Sum")]
    return session_scores(bundles).groupBy(*keys).agg(*stats)
