"""S5: read a landed lake table, optionally one batch only."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import BATCH_ID
from tidewater.functions.naming import qcol
from tidewater.sources.files import list_names
from tidewater.sources.manifest import Manifest, read_batches, read_manifest

_PLAIN_VALUE = re.compile(r"^[A-Za-z0-9_.-]+$")
#: Beside the data (readers skip names with an underscore): the union of the
#: schemas of all batches, as Spark's schema JSON.
SCHEMA_DIR = "_tidewater_schema"
#: Formats that store column names, so a column a file lacks reads as NULL.
NAMED_FORMATS = frozenset({"parquet", "orc", "json", "avro"})


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The lake's schema, from its manifest or kept beside it; None for a table
    landed by other tools."""
    found = read_manifest(spark, path)
    if found is not None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in found.table.fields])
    kept = f"{path.rstrip('/')}/{SCHEMA_DIR}"
    if not list_names(spark, kept):
        return None
    rows = spark.read.text(kept, wholetext=True).collect()
    return T.StructType.fromJson(json.loads(rows[0][0])) if rows else None


def merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """``old`` with the columns of ``new`` that it lacks; a column whose type
    changed raises, since the files already written cannot be read as the new one."""
    if old is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in new.fields])
    types = {f.name: f.dataType for f in old.fields}
    changed = [f"{f.name}: {types[f.name].simpleString()} to {f.dataType.simpleString()}"
               for f in new.fields if f.name in types and types[f.name] != f.dataType]
    if changed:
        raise ValueError("column type changed: " + "; ".join(changed))
    return T.StructType(old.fields + [T.StructField(f.name, f.dataType, True)
                                      for f in new.fields if f.name not in types])


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet",
              batch_id: str | None = None, options: Mapping[str, str] | None = None,
              batch_column: str = BATCH_ID, merge_schema: bool = False,
              version: int | None = None) -> DataFrame:
    """Read the landed table, or one batch of it, with all columns of all batches.

    A lake with a manifest is read as its newest version says (or the given
    ``version``): exactly the live batch directories, each with the schema it was
    written with, see ``tidewater.sources.manifest``. A batch it does not name
    raises. Otherwise, for plain batch directories:

    The schema kept beside the lake says which columns there are; a batch
    landed before a column was added has NULL there, and no footer is read to
    find out. It also types the batch column as a string, so the file index is
    built once. ``merge_schema`` reconciles the footers of all files; it is for
    tables that other tools landed, which have no kept schema.

    A batch is read straight from its own directory and the batch column is
    added as the known string literal: only that directory is listed (the
    cost does not grow with the number of batches landed) and no partition
    value has to be parsed.
    """
    opts = dict(options or {})
    found = read_manifest(spark, path, version)
    if found is not None:
        return read_version(spark, path, fmt, found, batch_id, opts)
    if version is not None:
        raise ValueError(f"{path} has no version {version}")
    if fmt == "parquet" and merge_schema:
        opts.setdefault("mergeSchema", "true")
    root = path.rstrip("/")
    schema = stored_schema(spark, path) if fmt in NAMED_FORMATS and not merge_schema else None
    reader = spark.read.format(fmt).options(**opts)
    if batch_id is not None and _PLAIN_VALUE.match(batch_id):
        if schema is not None:
            reader = reader.schema(T.StructType([f for f in schema.fields
                                                 if f.name != batch_column]))
        df = reader.load(f"{root}/{batch_column}={batch_id}")
        df = df.withColumn(batch_column, F.lit(batch_id))
        return df if schema is None else df.select(*[qcol(f.name) for f in schema.fields])
    if schema is not None:
        found = reader.schema(schema).load(path).select(*[qcol(f.name) for f in schema.fields])
    else:
        found = reader.load(path)
        if any(f.name == batch_column and not isinstance(f.dataType, T.StringType)
               for f in found.schema.fields):
            found = spark.read.format(fmt).options(**opts).schema(T.StructType(
                [T.StructField(f.name, T.StringType(), True) if f.name == batch_column else f
                 for f in found.schema.fields])).load(path)
    if batch_id is not None:
        found = found.where(qcol(batch_column) == F.lit(batch_id))
    return found


def read_version(spark: SparkSession, path: str, fmt: str, found: Manifest,
                 batch_id: str | None = None,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """The lake, or one batch, as one version of its manifest has it."""
    batches = found.batches
    if batch_id is not None:
        if batch_id not in batches:
            raise ValueError(f"{path} has no batch {batch_id!r}")
        batches = {batch_id: batches[batch_id]}
    return read_batches(spark, path, fmt, found, batches, options or {})
