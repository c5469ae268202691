"""Writers: lake (K1), load targets (K2, K4), load-mode matrix (K3)."""

from tidewater.sinks.modes import LoadAction, resolve_load, validate_mode
from tidewater.sinks.lake import write_lake
from tidewater.sinks.table import count_target, delete_jdbc_batch, qualify, write_target

__all__ = ["LoadAction", "resolve_load", "validate_mode", "write_lake",
           "write_target", "qualify", "count_target", "delete_jdbc_batch"]
