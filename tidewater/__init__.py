"""tidewater: a Spark-native batch ingest library.

Every transform is a plain ``DataFrame -> DataFrame`` function built from
Spark's own expressions, so Catalyst plans the work and it runs on the
executors in whole-stage codegen; no Python UDF sits on the data path.

Sub-packages:

* ``functions`` - pure helpers that build names and ``Column`` expressions.
* ``operators`` - DataFrame transforms (rename, hash, audit, timestamps,
  checks, de-duplication, change detection).
* ``sources``   - readers (JDBC, query connectors, lake paths, existence probe).
* ``sinks``     - writers (lake, tables) and the load-mode matrix.
* ``plans``     - table specs, the per-table pipeline and the run report.
* ``streaming`` - the same pipeline driven by Structured Streaming micro-batches.
"""

from tidewater.constants import AUDIT_COLUMNS, ROW_HASH, BATCH_ID
from tidewater.functions.naming import snake_upper, normalized_names
from tidewater.operators.rename import normalize_columns
from tidewater.operators.hashing import add_row_hash
from tidewater.operators.audit import add_audit_columns
from tidewater.operators.timestamps import sanitize_timestamps
from tidewater.operators.dedupe import dedupe_by_hash, dedupe_new_rows
from tidewater.operators.changes import detect_changes
from tidewater.plans.spec import TableSpec, Target
from tidewater.plans.prepare import prepare
from tidewater.plans.ingest import ingest_table, ingest_all, summarize

__all__ = [
    "AUDIT_COLUMNS", "ROW_HASH", "BATCH_ID",
    "snake_upper", "normalized_names", "normalize_columns", "add_row_hash",
    "add_audit_columns", "sanitize_timestamps", "dedupe_by_hash", "dedupe_new_rows",
    "detect_changes",
    "TableSpec", "Target", "prepare", "ingest_table", "ingest_all", "summarize",
]
