"""O1 with I/O, O2 and A4: load tables and report every outcome.

Per table (``ingest_table``):

1. emptiness probe of the source (``historical`` only, where an empty overwrite
   would wipe the table; one incremental take, for a JDBC table the count
   query); empty -> ``skipped``;
2. ``prepare`` (one narrow projection);
3. pre-load gate on the schema (V1) -> ``failed`` with reasons;
4. stage the batch in the lake once, counting in the same pass (K1, A2), and with
   ``verify="content"`` summing its content; an empty incremental batch writes
   nothing, removes what an earlier run of the same batch left, and is ``skipped``;
5. audit the staged batch (V2: a partition-pruned count; V3: its content) and publish
   it; if it disagrees it is discarded and readers keep the old rows;
6. load the target *from the landed batch* (K5): the source is read once,
   the lineage is cut by the written files, and both copies carry the same
   audit times; path targets are staged, audited and published in the same way;
7. reconcile counts, content and column names (V3): any disagreement is ``failed``,
   not a log line. Catalog, database and connector targets are audited after the
   load; content is compared where Spark reads the target with the same types (path
   and catalog targets).

A table without a hash column is landed and not loaded.

Errors never pass silently: the report row says ``failed`` with the reason.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import APPENDED_AUDIT, AUDIT_COLUMNS, BATCH_ID, HISTORICAL
from tidewater.functions.content import content_metrics, content_text
from tidewater.functions.naming import qcol
from tidewater.operators.audit import shadowed_columns
from tidewater.operators.checks import gate_reasons, reconcile
from tidewater.operators.rename import normalize_columns
from tidewater.plans.ledger import finished, record
from tidewater.plans.prepare import prepare_with
from tidewater.plans.session import check_zone
from tidewater.sinks.lake import (
    discard, drop_batch, publish, read_staged, stage, versioned, write_lake,
)
from tidewater.sinks.modes import resolve_load
from tidewater.sinks.table import (
    can_stage, count_target, discard_target, drop_target_batch, publish_target,
    read_staged_target, stage_target, target_columns, write_target,
)
from tidewater.sources.catalog import table_name, target_exists
from tidewater.sources.lake import read_lake

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("rows_source", T.LongType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_landed", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("load_action", T.StringType()),
    T.StructField("shadowed", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("elapsed_s", T.DoubleType()),
])


def _action_name(action) -> str:
    if action.creates:
        return "create"
    return "replace" if action.replace else "append"


def ingest_table(spark: SparkSession, spec, config) -> dict:
    """Run one table; always returns a report row (a dict)."""
    return ingest_frame(spark, None, spec, config)


def ingest_frame(spark: SparkSession, raw: DataFrame | None, spec, config) -> dict:
    """Run one table from ``raw`` (or from ``spec.source`` when ``raw`` is
    None); always returns a report row (a dict)."""
    start = time.monotonic()
    row = {f.name: None for f in REPORT_SCHEMA.fields}
    row.update(table_name=spec.name, mode=config.mode, batch_id=config.batch_id)
    try:
        check_zone(spark, config.time_zone)
        from_source = raw is None
        if from_source:
            raw = spec.source.load(spark)
        if from_source and config.count_source:
            row["rows_source"] = spec.source.count_rows(spark)
            empty = row["rows_source"] == 0
        elif config.mode == HISTORICAL:
            # a full reload must not replace the lake with nothing: probe first
            # (a take of one row on a JDBC frame would start the whole query)
            counted = spec.source.kind == "jdbc" and not spec.source.is_query
            empty = (spec.source.count_rows(spark) == 0 if from_source and counted
                     else raw.isEmpty())
        else:
            # an empty incremental batch writes no partition and replaces
            # nothing, so the landing count decides (one source read saved)
            empty = False
        if empty:
            row.update(status="skipped", reason=_skip(spark, spec, config))
            return row
        if spec.spread > 1 and raw.rdd.getNumPartitions() < spec.spread:
            # round-robin: even slices whatever the keys; a retried stage gives
            # the same slices only if the source answers with the same rows
            raw = raw.repartition(spec.spread)
        shadowed = shadowed_columns(normalize_columns(raw).columns, spec.hash_column)
        row["shadowed"] = ",".join(shadowed) if shadowed else None
        prepared = prepare_with(raw, spec, config)
        # a table without a hash column is landed only: the target needs the hash
        required = AUDIT_COLUMNS if spec.hash_column else APPENDED_AUDIT
        reasons = gate_reasons(prepared.columns, spec.hash_column, required)
        if reasons:
            row.update(status="failed", reason="; ".join(reasons))
            return row
        row["rows_in"], landed, staged = _land(prepared, spec, config)
        if row["rows_in"] == 0:
            row.update(status="skipped", reason=_skip(spark, spec, config))
            return row
        audit = _Audit(prepared.columns, config.verify == "content")
        row["rows_landed"], content = audit.of(landed)
        row["content"] = staged.content if staged else content
        differs = audit.enabled and content != row["content"]
        if staged is not None:
            if differs or row["rows_landed"] != row["rows_in"]:
                discard(spark, staged)  # readers keep the old rows
                row.update(status="failed", ok=False, reason="landed rows differ from the source's"
                           if differs else "row counts disagree")
                return row
            publish(spark, staged, config.mode)
        if spec.target is not None and spec.hash_column:
            action = resolve_load(config.mode, target_exists(spark, spec.target))
            row["load_action"] = _action_name(action)
            row["rows_loaded"], content = _load(spark, landed, spec.target, action, config, audit,
                                                (row["rows_landed"], row["content"]))
            differs = differs or (content is not None and content != row["content"])
        lost = sorted(set(prepared.columns) - set(landed.columns))
        if spec.target is not None and spec.hash_column:
            # a load that failed its audit was not published: nothing to look at
            loaded = (None if differs or row["rows_loaded"] != row["rows_landed"]
                      else target_columns(spark, spec.target, config.batch_id))
            if loaded is not None:
                lost += sorted({c.lower() for c in prepared.columns}
                               - {c.lower() for c in loaded})
        ok = reconcile(row["rows_source"], row["rows_in"], row["rows_landed"],
                       row["rows_loaded"])
        row["ok"] = ok and not lost if ok is not None else None
        if lost:
            row.update(status="failed", ok=False, reason="columns lost: " + ",".join(lost))
        elif ok is False:
            row.update(status="failed", reason="row counts disagree")
        elif differs:
            row.update(status="failed", ok=False, reason="loaded rows differ from the landed ones")
        else:
            row["status"] = "success"
    except Exception as exc:  # reported, never swallowed
        row.update(status="failed", reason=_reason(exc))
    finally:
        row["elapsed_s"] = round(time.monotonic() - start, 3)
    return row


class _Audit:
    """Counts rows and, if enabled, sums the content of ``columns``."""

    def __init__(self, columns: list[str], enabled: bool):
        self.columns, self.enabled = columns, enabled

    def of(self, df: DataFrame) -> tuple[int, str | None]:
        if not self.enabled:
            return df.count(), None
        row = df.agg(F.count(F.lit(1)).alias("rows"),
                     *content_metrics(df.schema, self.columns)).first()
        return row["rows"], content_text(row)


def _land(prepared: DataFrame, spec, config):
    """Rows written, the frame that reads them back, and the staged load (None for
    layouts that are written in place)."""
    spark = prepared.sparkSession
    if not versioned(spec.lake_format):
        rows = write_lake(prepared, spec.lake_path, config.mode, fmt=spec.lake_format,
                          options=spec.lake_options)
        landed = read_lake(spark, spec.lake_path, spec.lake_format,
                           batch_id=config.batch_id) if rows else None
        return rows, landed, None
    staged = stage(prepared, spec.lake_path, config.mode, spec.lake_format, spec.lake_options,
                   config.verify == "content", spec.renames, config.batch_id)
    if not staged.rows:
        discard(spark, staged)
        return 0, None, None
    return staged.rows, read_staged(spark, staged), staged


def _load(spark: SparkSession, landed: DataFrame, target, action, config, audit: _Audit,
          expected: tuple[int, str | None]) -> tuple[int, str | None]:
    """Load the landed batch; rows found in the target, and their content where Spark
    reads it back with the same types (None otherwise)."""
    if can_stage(target):
        staged = stage_target(landed, target, action, config.batch_id)
        found = audit.of(read_staged_target(spark, staged))
        if found[0] == expected[0] and (found[1] is None or found[1] == expected[1]):
            publish_target(spark, staged, action)
        else:
            discard_target(spark, staged)
        return found
    write_target(landed, target, action, batch_id=config.batch_id)
    batch = None if config.mode == HISTORICAL else config.batch_id
    if target.kind == "table" and audit.enabled:
        df = spark.table(table_name(target))
        return audit.of(df if batch is None else df.where(qcol(BATCH_ID) == F.lit(batch)))
    return count_target(spark, target, batch), None


_FRAME = re.compile(r"^\s*(?:at [\w.$/<>]+\(.*\)|\.\.\. \d+ (?:more|common frames omitted))\s*$")


def _skip(spark: SparkSession, spec, config) -> str:
    """An empty incremental batch replaces what an earlier run of the same
    batch left behind: its rows go from the lake and the target."""
    if config.mode == HISTORICAL:
        return "empty"
    gone = drop_batch(spark, spec.lake_path, config.batch_id)
    if gone and spec.target is not None and target_exists(spark, spec.target):
        if not drop_target_batch(spark, spec.target, config.batch_id):
            return "empty; earlier rows of the batch removed from the lake only"
    return "empty; earlier rows of the batch removed" if gone else "empty"


def _reason(exc: Exception) -> str:
    """The error's message lines with all causes, without the JVM stack frames."""
    return " | ".join(line.strip() for line in f"{type(exc).__name__}: {exc}".splitlines()
                      if line.strip() and not _FRAME.match(line))


def report_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in REPORT_SCHEMA.fields)
                                  for r in rows], REPORT_SCHEMA)


def ingest_all(spark: SparkSession, specs: Iterable, config,
               raise_on_failure: bool = False) -> DataFrame:
    """Every table, ``config.max_in_flight`` at a time: driver threads that only
    submit Spark jobs, so small tables share the cluster. A failure in one table
    never stops the others. The report is one row per table, in the order of
    ``specs``; with ``raise_on_failure`` any failure raises afterwards. With a
    ``config.ledger``, tables that an earlier run of the batch finished are skipped."""
    specs = list(specs)

    def run(spec) -> dict:
        row = finished(spark, spec, config)
        if row is None:
            row = ingest_table(spark, spec, config)
            record(spark, spec, config, row)
        return row

    with ThreadPoolExecutor(max(1, config.max_in_flight)) as pool:
        rows = list(pool.map(run, specs))
    report = report_frame(spark, rows)
    failed = [r["table_name"] for r in rows if r["status"] == "failed"]
    if raise_on_failure and failed:
        raise RuntimeError(f"{len(failed)} table(s) failed: {failed}")
    return report


def summarize(report: DataFrame) -> DataFrame:
    """A4: one row - tables, succeeded, failed, skipped, failed tables and the
    summed elapsed seconds of the table runs (which overlap in time)."""
    st = F.col("status")
    return report.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count(F.when(st == "success", 1)).alias("succeeded"),
        F.count(F.when(st == "failed", 1)).alias("failed"),
        F.count(F.when(st == "skipped", 1)).alias("skipped"),
        F.concat_ws(",", F.array_sort(F.collect_list(
            F.when(st == "failed", F.col("table_name"))))).alias("failed_tables"),
        F.round(F.sum("elapsed_s"), 3).alias("elapsed_s"),
    )
