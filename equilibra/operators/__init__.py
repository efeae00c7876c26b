"""Structure and signal operators: flattening, observation unnesting,
sample parsing and mergeable moments."""

from equilibra.operators.flatten import flatten_nested
from equilibra.operators.moments import add_moments
from equilibra.operators.observations import observations, select_component, with_session_columns
from equilibra.operators.samples import distinct_sampled, sample_rows, timed_samples

__all__ = [
    "add_moments",
    "distinct_sampled",
    "flatten_nested",
    "observations",
    "sample_rows",
    "select_component",
    "timed_samples",
    "with_session_columns",
]
