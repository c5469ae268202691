"""O2: a run that was interrupted goes on where it stopped.

A ledger is a folder with one small file per table and batch, written when the
table is loaded and reconciled, and only then. ``ingest_all`` with a ledger skips
what it finds there, so a run that is started again with the same batch id loads
the tables that are missing or failed. An entry counts for one mode, lake and
target: a table that was since sent elsewhere is loaded again.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tidewater.sources.files import create_text, delete_dir, escape_partition_value, read_text


def _path(spark: SparkSession, spec, config) -> str:
    batch, table = (escape_partition_value(spark, v) for v in (config.batch_id, spec.name))
    return f"{config.ledger.rstrip('/')}/{batch}/{table}.json"


def _work(spec, config) -> dict:
    return {"mode": config.mode, "lake": spec.lake_path, "hash_column": spec.hash_column,
            "target": [spec.target.kind, spec.target.name] if spec.target else None}


def finished(spark: SparkSession, spec, config) -> dict | None:
    """The report row of an earlier run of the same batch that loaded this table."""
    if config.ledger is None:
        return None
    text = read_text(spark, _path(spark, spec, config))
    entry = json.loads(text) if text else None
    if entry is None or entry["work"] != _work(spec, config):
        return None
    return {**entry["row"], "reason": "loaded by an earlier run", "elapsed_s": 0.0}


def record(spark: SparkSession, spec, config, row: dict) -> None:
    """Remember a table that is loaded and reconciled; forget one that is not."""
    if config.ledger is None:
        return
    path = _path(spark, spec, config)
    delete_dir(spark, path)
    if row["status"] == "success":
        create_text(spark, path, json.dumps({"work": _work(spec, config), "row": row}))
