"""Fixed values of the load contract.

These names and values must stay exactly as written: downstream tables,
existing row hashes and the pre-load gate depend on them.
"""

# --- fixed values: audit column names, in the order they are appended ---
ETL_CREATED_DATE = "ETL_CREATED_DATE"
ETL_LAST_UPDATE_DATE = "ETL_LAST_UPDATE_DATE"
CREATED_BY = "CREATED_BY"
TO_PROCESS = "TO_PROCESS"
SOURCE_SYSTEM = "EDW_EXTERNAL_SOURCE_SYSTEM"
BATCH_ID = "ETL_BATCH_ID"
# --- fixed value: copy of the row hash kept for internal tracking ---
ROW_HASH = "ETL_ROW_HASH"

# The six appended audit columns, in output order.
APPENDED_AUDIT = (
    ETL_CREATED_DATE,
    ETL_LAST_UPDATE_DATE,
    CREATED_BY,
    TO_PROCESS,
    SOURCE_SYSTEM,
    BATCH_ID,
)

# Columns never fed into the row hash and required by the pre-load gate.
AUDIT_COLUMNS = frozenset(APPENDED_AUDIT + (ROW_HASH,))

# --- fixed values: hash text format ---
HASH_DELIMITER = "||"
DEFAULT_HASH_BITS = 512
# --- fixed values: batch id format and timestamp plausibility bounds ---
BATCH_ID_FORMAT = "%Y%m%d%H%M%S"
MIN_PLAUSIBLE_YEAR = 1900
ETL_PREFIX = "ETL_"

# --- fixed values: load modes ---
HISTORICAL = "historical"
INCREMENTAL = "incremental"
MODES = (HISTORICAL, INCREMENTAL)
