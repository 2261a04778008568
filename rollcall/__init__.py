"""rollcall — roster reconciliation as set-based Spark jobs.

Pipeline: extract (sources) → normalise (functions) → derive desired state
(plans) → diff against current state (operators.reconcile) → emit change
sets (operators.batches) → apply change sets to snapshots (operators.apply)
→ export (sinks).  Every job takes an explicit ``SyncConfig`` (with its
``as_of`` date) and returns a lazy DataFrame; writing is a separate call.
"""

from rollcall.config import SyncConfig

__all__ = ["SyncConfig"]
