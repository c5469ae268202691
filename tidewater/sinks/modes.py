"""O3 mode check and the K3 load-mode matrix."""

from __future__ import annotations

from dataclasses import dataclass

from tidewater.constants import HISTORICAL, INCREMENTAL, MODES


def validate_mode(mode: str) -> str:
    """Lower-cased; must be ``historical`` (full reload) or ``incremental``."""
    m = str(mode).strip().lower()
    if m not in MODES:
        raise ValueError(f"unknown load mode {mode!r}; known: {', '.join(MODES)}")
    return m


@dataclass(frozen=True)
class LoadAction:
    """How to write one batch to a target.

    ``replace``: rows before the load are gone afterwards.
    ``keep_schema``: the existing table definition is kept (truncate, not drop).
    ``creates``: the target does not exist yet.
    """
    replace: bool
    keep_schema: bool
    creates: bool

    @property
    def save_mode(self) -> str:
        return "overwrite" if (self.replace or self.creates) else "append"


def resolve_load(mode: str, exists: bool) -> LoadAction:
    """==============  ============================  ==================
    mode            target exists                 target missing
    ==============  ============================  ==================
    historical      replace rows, keep schema     create
    incremental     append                        create
    ==============  ============================  =================="""
    m = validate_mode(mode)
    if not exists:
        return LoadAction(replace=True, keep_schema=False, creates=True)
    if m == HISTORICAL:
        return LoadAction(replace=True, keep_schema=True, creates=False)
    assert m == INCREMENTAL
    return LoadAction(replace=False, keep_schema=True, creates=False)
