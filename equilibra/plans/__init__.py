"""Analytic products. Every product is a function ``bundles -> DataFrame``
(a lazy plan); ``PRODUCTS`` lists all of them by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from equilibra import codes as C
from equilibra.sources.bundles import FLAG_FIELDS, QUANTITY_FIELDS, REPORT_FIELDS, SAMPLE_FIELDS, TIMED_FIELDS
from equilibra.plans.movement import (
    range_max,
    range_mean,
    range_min,
    range_std,
    speed_max,
    speed_min,
    speed_std,
    speed_weekly_mean,
)
from equilibra.plans.scores import score_session_mean, score_session_sum, score_weekly_mean, score_weekly_sum
from equilibra.plans.segments import segment_product, segment_statistics
from equilibra.plans.session_report import session_report
from equilibra.plans.symptoms import symptom_reported, symptom_weekly_sum

# --- fixed values: product names by symptom ------------------------------------
SYMPTOM_KEYS = {
    "disorientation": C.DISORIENTATION,
    "dizziness": C.DIZZINESS,
    "headache": C.HEADACHE,
    "vision": C.ABNORMAL_VISION,
}

Product = Callable[[DataFrame], DataFrame]

PRODUCTS: dict[str, Product] = {}
for _name, _code in SYMPTOM_KEYS.items():
    PRODUCTS[f"{_name}_weekly_sum"] = partial(symptom_weekly_sum, code=_code)
    PRODUCTS[f"{_name}_reported"] = partial(symptom_reported, code=_code)
PRODUCTS.update(
    {
        "score_session_mean": score_session_mean,
        "score_weekly_mean": score_weekly_mean,
        "score_session_sum": score_session_sum,
        "score_weekly_sum": score_weekly_sum,
        "range_mean": range_mean,
        "range_std": range_std,
        "range_min": range_min,
        "range_max": range_max,
        "speed_weekly_mean": speed_weekly_mean,
        "speed_std": speed_std,
        "speed_min": speed_min,
        "speed_max": speed_max,
    }
)
for _measure, _code in C.MEASURES.items():
    for _stat in ("Mean", "STD", "Min", "Max"):
        PRODUCTS[f"segment_{_stat.lower()}_{_measure}"] = partial(segment_product, code=_code, stat=_stat)
PRODUCTS["session_report"] = session_report


def _fields(name: str) -> tuple[str, ...]:
    if name.endswith(("_weekly_sum", "_reported")) and not name.startswith("score"):
        return FLAG_FIELDS
    if name.startswith("score"):
        return QUANTITY_FIELDS
    if name.startswith(("range", "speed")):
        return SAMPLE_FIELDS
    if name.startswith("segment"):
        return TIMED_FIELDS
    return REPORT_FIELDS


# Nested leaves each product reads: pass to ``load_bundle(..., fields=)``.
PRODUCT_FIELDS: dict[str, tuple[str, ...]] = {name: _fields(name) for name in PRODUCTS}

__all__ = [
    "PRODUCTS",
    "PRODUCT_FIELDS",
    "range_max",
    "range_mean",
    "range_min",
    "range_std",
    "score_session_mean",
    "score_session_sum",
    "score_weekly_mean",
    "score_weekly_sum",
    "segment_product",
    "segment_statistics",
    "session_report",
    "speed_max",
    "speed_min",
    "speed_std",
    "speed_weekly_mean",
    "symptom_reported",
    "symptom_weekly_sum",
]
