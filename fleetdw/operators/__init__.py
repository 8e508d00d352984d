from fleetdw.operators.insert_ignore import dedup_batch, insert_ignore, skipped_by_reason, upsert
from fleetdw.operators.lookup import checked_broadcast, lookup
from fleetdw.operators.surrogate import assign_surrogate_key, assign_unique_key

__all__ = [
    "assign_surrogate_key",
    "assign_unique_key",
    "checked_broadcast",
    "dedup_batch",
    "insert_ignore",
    "lookup",
    "skipped_by_reason",
    "upsert",
]
