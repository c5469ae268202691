"""Pure helpers: column-name rules and ``Column`` expression builders."""

from tidewater.functions.naming import snake_upper, normalized_names, qcol
from tidewater.functions.hashing import row_hash_expr, hash_input_columns
from tidewater.functions.timestamps import (
    implausible_timestamp, timestamp_literal, now_for, year_of,
)

__all__ = [
    "snake_upper", "normalized_names", "qcol", "row_hash_expr",
    "hash_input_columns", "implausible_timestamp", "timestamp_literal",
    "now_for", "year_of",
]
