"""Sources and sinks: the bundle table, bundle fixtures derived from the
driver's flat tables, and the result sink."""

from equilibra.sources.bundles import (
    BUNDLE_SCHEMA,
    FACT_FIELDS,
    FLAG_FIELDS,
    QUANTITY_FIELDS,
    REPORT_FIELDS,
    SAMPLE_FIELDS,
    SESSION_FIELDS,
    TIMED_FIELDS,
    load_bundle,
    prune_schema,
)
from equilibra.sources.fixtures import event_bundle, hard_bundle, session_bundle
from equilibra.sources.publish import publish, publish_all, publish_version, read_published, read_version
from equilibra.sources.skipping import StaleIndex, build_index, matching_files, refresh_index, write_clustered
from equilibra.sources.versions import Store, Write

__all__ = [
    "BUNDLE_SCHEMA",
    "FACT_FIELDS",
    "FLAG_FIELDS",
    "QUANTITY_FIELDS",
    "REPORT_FIELDS",
    "SAMPLE_FIELDS",
    "SESSION_FIELDS",
    "StaleIndex",
    "Store",
    "TIMED_FIELDS",
    "Write",
    "build_index",
    "event_bundle",
    "hard_bundle",
    "load_bundle",
    "matching_files",
    "prune_schema",
    "publish",
    "publish_all",
    "publish_version",
    "read_published",
    "read_version",
    "refresh_index",
    "session_bundle",
    "write_clustered",
]
