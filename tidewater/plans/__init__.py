"""Table specs, the per-table pipeline (O1), the all-tables run (O2) and
the session settings (O4)."""

from tidewater.plans.spec import Source, Target, TableSpec, RunConfig
from tidewater.plans.prepare import prepare
from tidewater.plans.ingest import ingest_table, ingest_all, summarize, REPORT_SCHEMA
from tidewater.plans.session import session_conf, scratch_dir

__all__ = ["Source", "Target", "TableSpec", "RunConfig", "prepare", "ingest_table",
           "ingest_all", "summarize", "REPORT_SCHEMA", "session_conf", "scratch_dir"]
