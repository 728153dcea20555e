"""strata: a layered people-analytics warehouse expressed as PySpark DataFrame functions.

Landing files become raw (Bronze) tables with an audit trail, Silver cleans and types
them under data-quality gates, an event log is replayed into a versioned (SCD2)
history, and marts (dimensions, as-of facts, snapshots, one big table) sit on top.

Every public function takes and returns DataFrames (or Columns); nothing collects
rows to the driver except the gate enforcement, which reads one aggregate row.
"""

from strata.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
