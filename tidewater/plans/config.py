"""Table specs from a JSON document (the run's configuration file).

    {
      "mode": "incremental",
      "created_by": "INGEST_JOB",
      "source_system": "SRC",
      "batch_id": "20240101000000",            (optional)
      "tables": [
        {"name": "orders",
         "source": {"kind": "jdbc", "name": "dbo.orders", "options": {"url": "..."}},
         "hash_column": "STG_ORDERS_KEY",
         "lake_path": "s3a://lake/raw/orders",
         "target": {"kind": "table", "name": "stage.stg_orders"}}
      ]
    }

Unknown keys raise. Connection secrets do not belong in the file: option values of the form
``"env:NAME"`` are read from the environment of the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from tidewater.plans.spec import RunConfig, Source, TableSpec, Target
from tidewater.sources.jdbc import JdbcPartitioning

_RUN_KEYS = {"mode", "created_by", "source_system", "batch_id", "run_ts", "as_of", "bits",
             "include_ntz", "null_safe", "count_source", "future", "min_year",
             "max_in_flight", "time_zone", "verify", "canonical", "ledger"}
_SOURCE_KEYS = {"kind", "name", "format", "options", "is_query", "hint", "partitioning",
                "partition_column", "partitions", "predicates", "split", "split_sample"}
_TARGET_KEYS = {"kind", "name", "format", "options", "default_database", "default_schema",
                "partition_by", "truncate_options", "replace_batch", "versioned"}
_TABLE_KEYS = {"name", "source", "hash_column", "lake_path", "target", "lake_format",
               "lake_options", "exclude", "spread", "renames"}


def _known(d: Mapping, keys: set[str], where: str) -> None:
    unknown = sorted(set(d) - keys)
    if unknown:
        raise ValueError(f"unknown key in {where}: " + ", ".join(unknown))


def _options(opts: Mapping[str, str] | None) -> dict[str, str]:
    out = {}
    for k, v in (opts or {}).items():
        v = str(v)
        out[k] = os.environ[v[4:]] if v.startswith("env:") else v
    return out


def _source(d: Mapping) -> Source:
    _known(d, _SOURCE_KEYS, "source")
    part = d.get("partitioning")
    return Source(kind=d["kind"], name=d["name"], format=d.get("format", "parquet"),
                  options=_options(d.get("options")), is_query=bool(d.get("is_query", False)),
                  hint=d.get("hint"),
                  partitioning=JdbcPartitioning(**part) if part else None,
                  partition_column=d.get("partition_column"),
                  partitions=int(d.get("partitions", 0)), split=d.get("split", "even"),
                  split_sample=d.get("split_sample"),
                  predicates=tuple(d.get("predicates", ())))


def _target(d: Mapping | None) -> Target | None:
    if not d:
        return None
    _known(d, _TARGET_KEYS, "target")
    return Target(kind=d["kind"], name=d["name"], format=d.get("format", "parquet"),
                  options=_options(d.get("options")),
                  default_database=d.get("default_database"),
                  default_schema=d.get("default_schema"),
                  partition_by=tuple(d.get("partition_by", ("ETL_BATCH_ID",))),
                  truncate_options=_options(d.get("truncate_options", {"truncate": "true"})),
                  replace_batch=bool(d.get("replace_batch", False)),
                  versioned=bool(d.get("versioned", False)))


def specs_from_dict(doc: Mapping) -> tuple[list[TableSpec], RunConfig]:
    _known(doc, _RUN_KEYS | {"tables"}, "the run")
    for t in doc["tables"]:
        _known(t, _TABLE_KEYS, f"table {t.get('name')!r}")
    run = {k: doc[k] for k in _RUN_KEYS if k in doc}
    config = RunConfig(**run)
    specs = [TableSpec(name=t["name"], source=_source(t["source"]),
                       hash_column=t.get("hash_column"), lake_path=t["lake_path"],
                       target=_target(t.get("target")),
                       lake_format=t.get("lake_format", "parquet"),
                       lake_options=_options(t.get("lake_options")),
                       exclude=tuple(t.get("exclude", ())), spread=int(t.get("spread") or 0),
                       renames=dict(t.get("renames") or {}))
             for t in doc["tables"]]
    return specs, config


def specs_from_json(path: str) -> tuple[list[TableSpec], RunConfig]:
    with open(path, encoding="utf-8") as fh:
        return specs_from_dict(json.load(fh))
