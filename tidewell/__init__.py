"""Keep an analytical table in sync with a change log and enrich it, on Spark DataFrames."""

from tidewell.operators.changes import (
    apply_deletes,
    apply_inserts,
    apply_updates,
    duplicate_keys,
    net_changes,
    rejects,
    replay,
    valid_changes,
)
from tidewell.plans.features import (
    city_features,
    city_stats,
    first_features,
    sort_features,
    summary_by_city,
    summary_by_state,
)
from tidewell.plans.synced_table import SyncedTable

__all__ = [
    "SyncedTable",
    "apply_deletes",
    "apply_inserts",
    "apply_updates",
    "city_features",
    "city_stats",
    "duplicate_keys",
    "first_features",
    "net_changes",
    "rejects",
    "replay",
    "sort_features",
    "summary_by_city",
    "summary_by_state",
    "valid_changes",
]
