"""equilibra: Spark-native analytics over nested clinical-observation bundles
from home balance-rehabilitation sessions.

Flatten or selectively unnest bundles, pick measures by clinical code, parse
sampled signals with their timestamps, and build daily/weekly products per
patient. Every product is a lazy DataFrame built from built-in Spark
expressions.
"""

from equilibra.operators import flatten_nested, observations, sample_rows, select_component, timed_samples
from equilibra.plans import PRODUCTS
from equilibra.sources import event_bundle, load_bundle, publish, publish_all, session_bundle

__all__ = [
    "PRODUCTS",
    "event_bundle",
    "flatten_nested",
    "load_bundle",
    "observations",
    "publish",
    "publish_all",
    "sample_rows",
    "select_component",
    "session_bundle",
    "timed_samples",
]
