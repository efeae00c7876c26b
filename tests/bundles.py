"""Hand-made bundle rows for unit tests."""

from __future__ import annotations

from equilibra import codes as C
from equilibra.sources.bundles import BUNDLE_SCHEMA


def component(code, *, text=None, flag=None, qty=None, data=None, times=None, extension=True):
    sampled = None
    if data is not None or times is not None:
        sampled = {"data": data, "extension": [{"valueString": times}] if extension else None}
    return {
        "code": {"coding": [{"code": code}], "text": text},
        "valueBoolean": flag,
        "valueQuantity": None if qty is None else {"value": float(qty)},
        "valueSampledData": sampled,
    }


def observation(patient, when, display, components, *, session=C.SESSION, reference=...):
    """``reference=None`` gives a null subject reference."""
    return {
        "resource": {
            "subject": {"reference": f"Patient/{patient}" if reference is ... else reference},
            "effectiveDateTime": when,
            "category": [{"text": "a"}],
            "code": {"coding": [{"code": session, "display": display}, {"code": "0000", "display": "other"}]},
            "component": components,
        }
    }


def bundles(spark, *observations_per_bundle):
    """Each argument is the list of observations of one bundle."""
    rows = [{"entry": list(obs)} for obs in observations_per_bundle]
    return spark.createDataFrame(rows, schema=BUNDLE_SCHEMA)
