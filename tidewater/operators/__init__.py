"""DataFrame -> DataFrame transforms. Usable with ``df.transform(...)``."""

from tidewater.operators.rename import normalize_columns
from tidewater.operators.hashing import add_row_hash
from tidewater.operators.audit import add_audit_columns, shadowed_columns
from tidewater.operators.timestamps import sanitize_timestamps
from tidewater.operators.checks import load_gate, gate_reasons, reconcile
from tidewater.operators.dedupe import dedupe_by_hash, dedupe_new_rows, keep_hashes
from tidewater.operators.changes import detect_changes

__all__ = [
    "normalize_columns", "add_row_hash", "add_audit_columns", "shadowed_columns",
    "sanitize_timestamps", "load_gate", "gate_reasons", "reconcile",
    "dedupe_by_hash", "dedupe_new_rows", "keep_hashes", "detect_changes",
]
